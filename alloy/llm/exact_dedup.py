"""Exact dedup (operator 3): an extendible-hash index on shared files.

Texts are equal when they agree after white space (space, tab to carriage
return) is deleted. The index has one entry for each distinct text, keyed by a
64-bit hash:

* Entries are made by grouping rows on key and normalised bytes, so equal keys
  with other bytes stay apart (they are chained under the key), and a text's
  copies are folded before the shuffle, however many there are.
* The directory starts at the depth that the number of entries asks for and
  doubles as long as a bucket holds more entries than ``capacity``: each
  doubling looks one more key bit at the overfull buckets alone. A bucket at
  ``MAX_DEPTH`` keeps its overflow as a chain.
* Bucket files are written to the shared folder by ranges of the key, each
  range owned by one task. Every document finds its bucket by the directory, at
  the one depth at which that has its prefix, and its entry in the bucket's chain
  by key and the SHA-256 of its bytes.

DataFrame functions only; nothing but counts comes to the driver.

Defined cases: null text counts as empty, and empty texts are equal; of equal
texts the row with the most code points in the original text, then the smallest
doc_id, stays (a null doc_id after all others); rows that repeat a doc_id are
rows of the group each; an empty table gives an empty index and no rows; extra
columns are ignored (``keep_exact`` keeps them).
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from alloy.llm.common import id_text, written

SPACES = " \t\n\x0b\x0c\r"
#: Bits of a key that a directory can use.
MAX_DEPTH = 48
#: Entries that a bucket holds before it is split; buckets of a directory that is broadcast.
CAPACITY, SMALL_DIRECTORY = 4096, 1 << 20
# rank = code points * 10^20 + (2^63 - doc_id), or - 1 without an id
_SHIFT, _TOP, _ONE, _NONE = (Decimal(10 ** 20), Decimal(1 << 63), Decimal(1), Decimal(-1))


def normalised(text: Column) -> Column:
    """``text`` without the six white-space characters."""
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _prefix(key: Column, depth: int) -> Column:
    """The first ``depth`` of the MAX_DEPTH directory bits of a key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def _keyed(docs: DataFrame) -> DataFrame:
    d = id_text(docs).withColumn("norm", normalised(F.col("text")))
    return d.select("doc_id", "norm", F.xxhash64("norm").alias("key"), F.char_length("text").alias("n_points"))


def entries(docs: DataFrame) -> DataFrame:
    """(key, text_sha256, keep_id, group_size), one row for each distinct text.

    The row that stays is the greatest by code points, then by the smallest id:
    both in one decimal, so that the fold before the shuffle hashes rows and
    does not sort them."""
    shift, top, one, none = (F.lit(n) for n in (_SHIFT, _TOP, _ONE, _NONE))
    backwards = F.coalesce(top - F.col("doc_id").cast("decimal(20,0)"), none)
    rank = F.col("n_points").cast("decimal(12,0)") * shift + backwards
    folded = _keyed(docs).withColumn("rank", rank.cast("decimal(38,0)")).groupBy("key", "norm").agg(
        F.max("rank").alias("rank"), F.count(F.lit(1)).alias("group_size"))
    # A row without an id has -1 as its second part, so one is added before the parts are taken.
    rest = (F.col("rank") + one) % shift
    keep = F.when(rest > 0, (top + one - rest).cast("long"))
    return folded.select("key", F.sha2(F.encode("norm", "utf-8"), 256).alias("text_sha256"), keep.alias("keep_id"), "group_size")


def directory(index: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(depth, prefix, n_entries): the buckets after all splits.

    A round counts the next key bit for overfull buckets only; their number
    falls geometrically, and equal keys stop at MAX_DEPTH."""
    depth = max(0, math.ceil(math.log2(max(1, index.count() / capacity))))
    keys = index.select("key")
    done = None
    while True:
        counts = written(keys.groupBy(_prefix(F.col("key"), depth).alias("prefix")).agg(F.count(F.lit(1)).alias("n_entries")),
                         f"directory-{depth}")
        over = counts.filter(F.col("n_entries") > capacity)
        last = depth >= MAX_DEPTH or over.isEmpty()
        fits = (counts if last else counts.filter(F.col("n_entries") <= capacity)).select(
            F.lit(depth).alias("depth"), "prefix", "n_entries")
        done = fits if done is None else done.unionByName(fits)
        if last:
            return done
        keys = keys.withColumn("prefix", _prefix(F.col("key"), depth)).join(over.select("prefix"), "prefix", "left_semi").select("key")
        depth += 1


def build_index(docs: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """(bucket files, directory). A bucket file's rows: depth and prefix of the
    bucket, key, text_sha256, keep_id, group_size; sorted by key within ranges."""
    found = written(entries(docs), "dedup-entries")
    buckets = written(directory(found, capacity), "dedup-directory")
    depths = [r.depth for r in buckets.select("depth").distinct().collect()]  # MAX_DEPTH + 1 at most
    # Buckets do not overlap, so one of these equi-joins holds each entry.
    parts = [found.withColumn("prefix", _prefix(F.col("key"), d)).join(
        buckets.filter(F.col("depth") == d).select("depth", "prefix"), "prefix") for d in depths]
    owned = parts[0] if parts else found.withColumn("prefix", F.col("key")).withColumn("depth", F.lit(0)).limit(0)
    for p in parts[1:]:
        owned = owned.unionByName(p)
    spread = F.shiftrightunsigned("key", 1)  # unsigned order: buckets are ranges of it
    owned = owned.withColumn("spread", spread).repartitionByRange("spread").sortWithinPartitions("spread", "text_sha256")
    return written(owned.select("depth", "prefix", "key", "text_sha256", "keep_id", "group_size"), "dedup-buckets"), buckets


def located(rows: DataFrame, directory: DataFrame) -> DataFrame:
    """``rows`` (with a key) and the depth and prefix of the bucket that the directory
    has for each: no two buckets overlap, so one prefix of a key is found."""
    depths = sorted(r.depth for r in directory.select("depth").distinct().collect())  # MAX_DEPTH + 1 at most
    if not depths:
        return rows.withColumn("depth", F.lit(0)).withColumn("prefix", F.lit(0).cast("long")).limit(0)
    tries = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(F.col("key"), d).alias("prefix")) for d in depths]))
    known = directory.select("depth", "prefix")
    if directory.count() <= SMALL_DIRECTORY:
        known = F.broadcast(known)
    return rows.withColumn("at", tries).select("*", "at.depth", "at.prefix").drop("at").join(known, ["depth", "prefix"])


def mark(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    A row that shares doc_id and text with the row that stays is marked as kept
    as well: nothing tells such rows apart."""
    index, directory = build_index(docs, capacity)
    rows = _keyed(docs).select("doc_id", "key", F.sha2(F.encode("norm", "utf-8"), 256).alias("text_sha256"))
    found = located(rows, directory).join(index, ["depth", "prefix", "key", "text_sha256"])
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_exact(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``docs`` (all its columns) without the copies: one row of each group of equal
    texts, that which ``mark`` keeps. Of several such rows (they share its doc_id, or
    all have none) the longest original stays, then the first by a number that rows
    get, and that is written, before the index is built."""
    rows = written(docs.select(F.monotonically_increasing_id().alias("n"), F.struct("*").alias("row")), "dedup-rows")
    numbered = rows.select("n", F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("row.text"), F.lit("")).alias("text"))
    index, directory = build_index(numbered, capacity)
    norm = normalised(F.col("text"))
    keyed = numbered.select("n", "doc_id", F.char_length("text").alias("n_points"), F.xxhash64(norm).alias("key"),
                            F.sha2(F.encode(norm, "utf-8"), 256).alias("text_sha256"))
    found = located(keyed, directory).join(index, ["depth", "prefix", "key", "text_sha256"]).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    stays = found.groupBy("key", "text_sha256").agg(F.min_by("n", F.struct(-F.col("n_points"), "n")).alias("n")).select("n")
    return rows.join(stays, "n", "left_semi").select("row.*")
