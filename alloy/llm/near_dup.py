"""MinHash near-dedup (operator 6): a multi-index Hamming join of b-bit signatures.

A document's set holds its distinct shingles of five words. Its signature has
``POSITIONS`` MinHash values of 16 bits, split into ``CHUNKS`` chunks of
``WIDTH`` values. Two signatures that differ in at most
``2 * CHUNKS - 1`` positions have, by the pigeonhole principle, a chunk with one
difference at most; each chunk therefore gives ``WIDTH`` keys, one with each
position left out, and all pairs under that distance share a key. (At a
similarity of 0.75 a key is shared with a probability of 1 - 5e-6.)

From keys to components:

1. Equal sets are one node: the smallest doc_id stands for all.
2. In every bucket (rows of one key) the members are paired with the smallest
   member, so a large group of copies gives pairs in proportion to its rows.
   Pairs within ``MAX_BITS`` differences of the signatures' low bits are
   compared on their full sets, read from the documents again.
3. Members of one bucket that are still in different components are held against
   each other, in blocks of ``BLOCK`` members, each pair in the first of its
   common buckets. Their full sets are compared if they can be similar enough at
   all: a set shares no more than the shingles that some other open member has
   too, which rules out most outliers of a large group of near copies, and a
   sketch of ``SKETCH`` bits, made for open members only, is within ``MAX_SKETCH``.
   A member is read once for all its partners in two blocks, so rows and joins
   grow with members, not with pairs, and two blocks give no more links than tie
   their members. What is left out beside are pairs within one component, which
   cannot change the result.

No bucket is held by one task: stars are joins with partial minima, and a bucket
of more than ``BLOCK`` members is dealt as pairs of blocks. There is no cap on a
bucket, so n outliers of a group of m near copies still take n * m comparisons
of sketches.

Defined cases: null text is empty; a text without words has no shingles and is
linked with nothing; with fewer than five words the whole sequence is the one
shingle; rows that share a doc_id are one node; a row without doc_id is linked
with nothing; equal rows share all; an empty table gives no rows; extra columns
are ignored (``drop_near`` keeps them, and takes every row as a node).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from alloy.llm.common import id_text, slices, written
from alloy.llm.graph import components

SHINGLE = 5
CHUNKS, WIDTH = 16, 6
POSITIONS = CHUNKS * WIDTH
#: Four low bits of each value, in six longs. Differences allowed among these 384
#: bits: 48 are expected at a similarity of 0.75, the standard deviation is 9.8.
LONGS, MAX_BITS = 6, 97
PERCENT = 75
#: One bit of each of so many MinHash values. Of 1024 bits 128 are expected to
#: differ at 0.75, the standard deviation is 10.6: four of them are allowed.
SKETCH, MAX_SKETCH = 1024, 171
#: Members of a bucket that one task holds against each other, and the shingles of
#: those whose full sets it holds (of two such parts at once).
BLOCK, PARCEL = 1024, 2_000_000
#: The rows by which members of a bucket meet on their full sets.
MEETING = ["key", "p", "q", "parcel", "node", "set_id", "component", "at", "others"]
BITS = [f"bits_{i}" for i in range(LONGS)]
#: Words whose hashes a worker keeps: what it took stays with the idle worker, beside the JVM.
_WORDS = 100_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; the memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(SHINGLE, len(w))
    h = np.full(len(w) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        h = (h ^ (h >> np.uint64(29))) * _MIX + w[j:len(w) - k + 1 + j]
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return np.unique(h ^ (h >> np.uint64(29)))


def set_id(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _functions(n: int = POSITIONS, seed: int = 20240) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 32, n, dtype=np.uint32), rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def signature(found: np.ndarray, xor: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """16-bit MinHash values of a set that is not empty, one for each function."""
    low = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(xor), 0xFFFFFFFF, dtype=np.uint32)
    step = 200_000 // len(xor)
    for at in range(0, len(low), step):
        block = (low[None, at:at + step] ^ xor[:, None]) * odd[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return ((least * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)


def sets_of(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_id, signature, bits_0...); no shingles: nulls."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (xor, odd) = WordHashes(), _functions()
        place = np.arange(0, 64, 4, dtype=np.uint64)
        for batch in batches:
            for part in slices(batch):
                done: dict[str, tuple] = {}
                rows = []
                for text in part.column(1).to_pylist():
                    row = done.get(text)
                    if row is None:
                        s = shingles(text, known)
                        if len(s):
                            sig = signature(s, xor, odd)
                            low = (sig & np.uint16(15)).astype(np.uint64).reshape(LONGS, 16)
                            row = (len(s), set_id(s), sig.tobytes(), *(low << place).sum(axis=1, dtype=np.uint64).view(np.int64).tolist())
                        else:
                            row = (0, None, None, *[None] * LONGS)
                        done[text] = row
                    rows.append(row)
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], names=["doc_id", "n_shingles", "set_id", "signature", *BITS])

    types = (pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * LONGS)
    schema = "doc_id long, n_shingles long, set_id binary, signature binary, " + ", ".join(f"{b} long" for b in BITS)
    return id_text(docs).mapInArrow(make, schema)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """(n, CHUNKS, WIDTH) keys: of each chunk, with each of its positions left out."""
    sig = signatures.reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
    keys = np.empty((len(sig), CHUNKS, WIDTH), dtype=np.uint64)
    chunk = np.arange(CHUNKS, dtype=np.uint64)[None, :]
    for left_out in range(WIDTH):
        h = np.broadcast_to(chunk * np.uint64(WIDTH) + np.uint64(left_out + 1), (len(sig), CHUNKS))
        for j in range(WIDTH):
            if j != left_out:
                h = (h ^ (h >> np.uint64(31))) * _MIX + sig[:, :, j]
        h = (h ^ (h >> np.uint64(32))) * _MIX
        keys[:, :, left_out] = h ^ (h >> np.uint64(29))
    return keys.view(np.int64)


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, POSITIONS)


def keys_of(nodes: DataFrame) -> DataFrame:
    """(key, node): CHUNKS * WIDTH rows for each of ``nodes`` (node, signature)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                keys = chunk_keys(_signatures(part.column(1)))
                nodes = np.repeat(part.column(0).to_numpy(zero_copy_only=False), CHUNKS * WIDTH)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(nodes)], names=["key", "node"])

    return nodes.select("node", "signature").mapInArrow(make, "key long, node long")


def _first_common(keys: np.ndarray, sig: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """The key by which row i and each of ``others`` are paired: of the first chunk
    with one difference at most, leaving out the difference (or position 0)."""
    differ = (sig[others] != sig[i]).reshape(len(others), CHUNKS, WIDTH)
    chunk = (differ.sum(axis=2) <= 1).argmax(axis=1)
    left_out = differ[np.arange(len(others)), chunk].argmax(axis=1)
    return keys[i, chunk, left_out]


def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From members of buckets by (key, p, q), p and q being the blocks that meet: the
    members that have a partner in another component that may be similar enough, a row
    each with the places of its partners (``others``; a pair stands with one of the
    two). Members of more than ``PARCEL`` shingles are dealt as pairs of parts."""
    held: list[pa.RecordBatch] = []

    def meet(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        node, component, n, shared, block = (rows[c].to_numpy() for c in ("node", "component", "n_shingles", "n_shared", "block"))
        key, p, q = (rows[c][0].as_py() for c in ("key", "p", "q"))
        sig = _signatures(rows["signature"])
        bits = np.frombuffer(b"".join(rows["sketch"].to_pylist()), dtype=np.uint64).reshape(len(node), -1)
        keys = chunk_keys(sig)
        a, b = [], []
        for i in range(len(node)):
            if p != q and block[i] != p:
                continue
            other = (component != component[i]) & ((node > node[i]) if p == q else (block == q))
            most = np.minimum(shared, shared[i])
            other &= 100 * most >= PERCENT * (n + n[i] - most)
            other = np.flatnonzero(other)
            if len(other):
                other = other[np.bitwise_count(bits[other] ^ bits[i]).sum(axis=1) <= MAX_SKETCH]
            if len(other):
                other = other[_first_common(keys, sig, i, other) == key]
                a.append(np.full(len(other), i))
                b.append(other)
        if not a or not len(a := np.concatenate(a)):
            return
        b = np.concatenate(b)
        part = (np.cumsum(n) - n) // PARCEL
        parcel = np.minimum(part[a], part[b]) * (part[-1] + 1) + np.maximum(part[a], part[b])
        for here in np.unique(parcel):
            x, y = a[parcel == here], b[parcel == here]  # x in order
            members = np.union1d(x, y)
            first = np.searchsorted(x, [*members, len(node)])
            others = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(y, pa.int32()))
            group = [pa.array(np.full(len(members), v), pa.int64()) for v in (key, p, q, here)]
            yield pa.RecordBatch.from_arrays([*group, *[rows[c].combine_chunks().take(pa.array(members)) for c in ("node", "set_id", "component")],
                                              pa.array(members, pa.int32()), others], names=MEETING)

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        group = np.stack([batch.column(batch.schema.names.index(c)).to_numpy(zero_copy_only=False) for c in ("key", "p", "q")])
        cuts = [0, *(np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            here = tuple(group[:, s].tolist())
            if held and here != last:
                yield from meet(pa.Table.from_batches(held))
                held = []
            last = here
            held.append(batch.slice(s, e - s))
    if held:
        yield from meet(pa.Table.from_batches(held))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets are similar enough."""
    short, long = min(len(x), len(y)), max(len(x), len(y))
    both = len(np.intersect1d(x, y, assume_unique=True)) if 100 * short >= PERCENT * long else 0
    return both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both)


def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the rows of ``candidates`` by (key, p, q, parcel), with texts: the pairs
    (a, b) whose full sets are similar enough, but for those between nodes that
    other pairs of their group have tied already."""
    known = WordHashes()
    last, rows = None, {}  # place -> (node, component, set, others)

    def links() -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        a, b = [], []
        for node, component, found, others in rows.values():
            for other in others:
                if other in rows:
                    with_node, with_component, with_found, _ = rows[other]
                    u, v = find(component), find(with_component)
                    if u != v and similar(found, with_found):
                        root[u] = v
                        a.append(min(node, with_node))
                        b.append(max(node, with_node))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        for part in slices(batch):
            for *here, node, expected, component, at, others, text in zip(*(c.to_pylist() for c in part.select([*MEETING, "text"]).columns)):
                if here != last:
                    yield from links()
                    last, rows = here, {}
                if at not in rows:
                    found = shingles(text, known)
                    if len(found) and set_id(found) == expected:  # not another text of the doc_id
                        rows[at] = node, component, found, others
    yield from links()


def sketched(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, set_id, sketch) for ``nodes`` (node, set_id)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, functions = WordHashes(), _functions(SKETCH, 7)
        for batch in batches:
            rows = []
            for node, expected, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = shingles(text, known)
                if len(found) and set_id(found) == expected:  # not another text of the doc_id
                    rows.append((node, expected, np.packbits(signature(found, *functions) & np.uint16(1)).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))],
                                                 names=["node", "set_id", "sketch"])

    return nodes.join(texts, "node").select("node", "set_id", "text").mapInArrow(
        make, "node long, set_id binary, sketch binary").dropDuplicates(["node", "set_id"])


def _near() -> Column:
    differences = [F.bit_count(F.col(f"a_{b}").bitwiseXOR(F.col(f"b_{b}"))) for b in BITS]
    return sum(differences[1:], differences[0]) <= MAX_BITS


def _side(nodes: DataFrame, side: str, columns: list[str]) -> DataFrame:
    return nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; ``texts`` (node, text)."""
    sides = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        last: list[tuple] = [(None, None), (None, None)]

        def of(side: int, text: str) -> np.ndarray:
            if last[side][0] != text:
                last[side] = (text, shingles(text, known))
            return last[side][1]

        for batch in batches:
            good = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                good.append(similar(of(0, a), of(1, b)))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    # The joins leave rows of one b together; its set is worked out once.
    return sides.select("a", "b", "a_text", "b_text").mapInArrow(compare, "a long, b long").distinct()


def unshared(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, n_own): how many shingles of each of ``nodes`` (node, set_id) no other
    of them has; nodes without such are left out."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for part in slices(batch, 2):
                for node, expected, text in zip(*(c.to_pylist() for c in part.columns)):
                    found = shingles(text, known)
                    if len(found) and set_id(found) == expected:  # not another text of the doc_id
                        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.full(len(found), node, dtype=np.int64))],
                                                         names=["shingle", "node"])

    rows = nodes.join(texts, "node").select("node", "set_id", "text").mapInArrow(explode, "shingle long, node long")
    owners = rows.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("other")).filter("node = other")
    return owners.groupBy("node").agg(F.count(F.lit(1)).alias("n_own"))


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    rows = written(sets_of(docs), "near-sets")
    linked = rows.filter(F.col("n_shingles").cast("boolean") & F.col("doc_id").isNotNull())
    nodes = written(linked.groupBy("set_id").agg(F.min("doc_id").alias("node"), F.min("signature").alias("signature"),
                                                 *[F.min(c).alias(c) for c in ("n_shingles", *BITS)]), "near-nodes")
    # A doc_id with several sets ties their nodes.
    member = linked.select("doc_id", "set_id").join(nodes.select("set_id", "node"), "set_id").select("doc_id", "node")
    member = written(member, "near-members")
    ties = member.filter("doc_id != node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))

    keys = keys_of(nodes)
    live = written(keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("key", "lo"),
                   "near-buckets")
    held = written(keys.join(live, "key"), "near-held")  # the members of buckets with two or more
    ids = held.select("node").distinct()
    texts = written(id_text(docs).withColumnRenamed("doc_id", "node").join(ids, "node", "left_semi"), "near-texts")
    stars = held.filter("node != lo").select(F.col("lo").alias("a"), F.col("node").alias("b")).distinct()
    tried = written(stars.join(_side(nodes, "a", BITS), "a").join(_side(nodes, "b", BITS), "b").filter(_near()).select("a", "b").distinct(),
                    "near-stars")
    links = written(confirmed(tried, texts), "near-links")

    first = components(links)
    labelled = written(held.select("key", "node").join(first, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")), "near-labelled")
    split = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
    open_ = written(labelled.join(split, "key", "left_semi"), "near-open")
    some = nodes.join(open_.select("node").distinct(), "node")
    several = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")  # texts of a repeated doc_id: no bound
    own = unshared(some.select("node", "set_id"), texts).join(several, "node", "left_anti")
    able = some.join(own, "node", "left").withColumn("n_shared", F.col("n_shingles") - F.coalesce("n_own", F.lit(0)))
    able = able.filter(100 * F.col("n_shared") >= PERCENT * F.col("n_shingles")).drop("n_own", *BITS)
    able = written(able.join(sketched(able.select("node", "set_id"), texts), ["node", "set_id"]), "near-able")
    sides = written(open_.join(able.select("node"), "node", "left_semi"), "near-sides")
    sizes = sides.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    sizes = sizes.filter("lo < hi").select("key", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = sides.join(sizes, "key").withColumn("block", block).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("key", "node", "component", "block", F.least("block", "with").alias("p"), F.greatest("block", "with").alias("q"))
    dealt = dealt.join(able, "node").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    rest = dealt.mapInArrow(candidates, "key long, p long, q long, parcel long, node long, set_id binary, component long, at int, others array<int>")
    group = ("key", "p", "q", "parcel")
    full = written(rest, "near-rest").join(texts, "node").select(*MEETING, "text").repartition(*group).sortWithinPartitions(*group)
    more = full.mapInArrow(met, "a long, b long")
    final = components(links.unionByName(more).unionByName(ties))

    found = rows.join(member.groupBy("doc_id").agg(F.min("node").alias("node")), "doc_id", "left").join(final, "node", "left")
    component = F.coalesce("component", "node", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near(docs: DataFrame) -> DataFrame:
    """``docs`` (all its columns) with one row of each group: that of the smallest
    doc_id. Here every row is a node of its own, also one without a doc_id or with one
    that others have, so repeated rows are reduced to one."""
    rows = written(docs.select(F.monotonically_increasing_id().alias("n"), F.struct("*").alias("row")), "near-rows")
    groups = classes(rows.select(F.col("n").alias("doc_id"), F.col("row.text").alias("text")))
    groups = written(groups.select(F.col("doc_id").alias("n"), F.col("component_id").alias("component")), "near-groups")
    several = groups.filter("n != component").select("component").distinct()
    members = groups.join(several, "component").join(rows.select("n", F.col("row.doc_id").cast("long").alias("doc_id")), "n")
    stays = members.groupBy("component").agg(F.min_by("n", F.struct(F.col("doc_id").isNull(), "doc_id", "n")).alias("stays"))
    dropped = members.join(stays, "component").filter("n != stays").select("n")
    return rows.join(dropped, "n", "left_anti").select("row.*")
