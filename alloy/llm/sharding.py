"""Sharding (operator 2): a permutation-filled lookup table of prime size.

Shard i prefers the slots ``(offset_i + j * skip_i) mod size`` for j = 0, 1, ...
The shards take turns, each claiming its most preferred slot that is still
free, until the table is full; so shares differ by one slot at most, and a
shard that leaves moves few other slots. A document's slot is a hash of its
doc_id modulo the size, its shard the slot's owner: one lookup in a table of
``size`` rows, whatever the data. The table is built and joined with SQL
functions only and broadcast; its size is a parameter, not a property of the data.
The fold copies the table each turn, so ``MAX_SLOTS`` are accepted at most (some 20 s);
shares of a hundred shards are then within 2 % of each other.

Defined cases: a null doc_id has the hash of the empty string; equal ids share
a shard; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Largest lookup table that is made.
MAX_SLOTS = 5_003


def hashed(text: Column) -> Column:
    """60 bits of md5 as a long: the same number in any SQL dialect."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % p for p in range(2, int(n ** 0.5) + 1))


def lookup_table(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    """(slot, shard_no, shard) for every slot of a table of prime ``size``.

    One fold over the ``size`` turns: the state holds each slot's owner (-1:
    free) and how far each shard has read its preferences."""
    if not _is_prime(size) or not len(set(shards)) == len(shards) <= size <= MAX_SLOTS:
        raise ValueError("size must be a prime from the number of distinct shards to MAX_SLOTS")
    n = len(shards)
    names = F.array(*[F.lit(s) for s in shards])
    turn = f"turn % {n}"
    # The preferences are part of the state: a column beside it would be worked
    # out again at every use within the fold.
    owner = F.expr(f"""
        aggregate(sequence(0, {size - 1}),
          struct(array_repeat(-1, {size}) AS owner, array_repeat(0L, {n}) AS next,
                 transform(names, s -> cast(conv(substring(md5(concat(s, '/offset')), 1, 15), 16, 10) AS bigint) % {size}) AS offsets,
                 transform(names, s -> cast(conv(substring(md5(concat(s, '/skip')), 1, 15), 16, 10) AS bigint) % {size - 1} + 1) AS skips),
          (s, turn) -> transform(transform(
              array(filter(sequence(s.next[{turn}], {size - 1}L),
                           j -> s.owner[int((s.offsets[{turn}] + j * s.skips[{turn}]) % {size})] = -1)[0]),
              j -> struct(j, (s.offsets[{turn}] + j * s.skips[{turn}]) % {size} AS slot)),
            c -> struct(
              transform(s.owner, (o, k) -> IF(k = c.slot, {turn}, o)) AS owner,
              transform(s.next, (p, k) -> IF(k = {turn}, c.j + 1, p)) AS next,
              s.offsets AS offsets, s.skips AS skips))[0],
          s -> s.owner)""")
    one = spark.range(1).select(names.alias("names")).select("names", owner.alias("owner"))
    return one.select("names", F.posexplode("owner").alias("slot", "shard_no")).select(
        F.col("slot").cast("long").alias("slot"), F.col("shard_no").cast("long").alias("shard_no"),
        F.element_at("names", F.col("shard_no") + 1).alias("shard"))


def assign(docs: DataFrame, shards: list[str], size: int) -> DataFrame:
    """(doc_id, slot, shard_no, shard) for every row of ``docs``."""
    table = lookup_table(docs.sparkSession, shards, size)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        (hashed(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % size).alias("slot"))
    return keyed.join(F.broadcast(table), "slot").select("doc_id", "slot", "shard_no", "shard")


def oracle(shards: list[str], size: int) -> str:
    """DuckDB SQL of ``assign`` over ``documents``, one recursion for each turn."""
    n = len(shards)
    names = ", ".join(f"'{s}'" for s in shards)
    h = "('0x' || substr(md5({}), 1, 15))::BIGINT"
    return f"""
WITH RECURSIVE names AS (SELECT [{names}] AS names),
pref AS (SELECT names, list_transform(names, lambda s: {h.format("s || '/offset'")} % {size}) AS offsets,
                list_transform(names, lambda s: {h.format("s || '/skip'")} % {size - 1} + 1) AS skips FROM names),
fill(turn, slot, owner, next) AS (
  SELECT 0, -1::BIGINT, list_transform(range({size}), lambda x: -1), list_transform(range({n}), lambda x: 0::BIGINT)
  UNION ALL
  SELECT turn + 1, (o + j * k) % {size},
         list_concat(list_concat(owner[1:((o + j * k) % {size})], [turn % {n}]), owner[((o + j * k) % {size}) + 2:]),
         list_concat(list_concat(next[1:(turn % {n})], [j + 1]), next[(turn % {n}) + 2:])
  FROM (SELECT turn, owner, next, offsets[turn % {n} + 1] AS o, skips[turn % {n} + 1] AS k,
               list_filter(range(next[turn % {n} + 1], {size}), lambda i: owner[((offsets[turn % {n} + 1] + i * skips[turn % {n} + 1]) % {size}) + 1] = -1)[1] AS j
        FROM fill, pref WHERE turn < {size})),
slots AS (SELECT slot, (turn - 1) % {n} AS shard_no FROM fill WHERE turn > 0)
SELECT d.doc_id, s.slot, s.shard_no::BIGINT AS shard_no, names[s.shard_no + 1] AS shard
FROM (SELECT doc_id, {h.format("coalesce(doc_id::VARCHAR, '')")} % {size} AS slot FROM documents) d
JOIN slots s USING (slot), names"""
