"""N-gram Jaccard join (operator 11): prefix trees over globally ordered sets.

A document's set holds its distinct shingles of four words; two documents link
when 100 * intersection >= 85 * union. Equal sets are one class. One order of all
shingles holds everywhere: by hash, but the ``HOT`` most frequent ones come last,
the most frequent at the end (the counts are gathered over all documents; any
order is right, this one keeps common passages out of the prefixes).

1. Similar sets of n shingles have one of their first n - ceil(0.85 n) + 1 in
   common and lie in the same or neighbouring bands of lengths. Rows of (shingle,
   band) that several classes share name a group by the smallest class; a class
   is sent once to each group, with its prefix only.
2. In each group the prefixes are stored in a trie, which is walked depth first
   with the overlaps of all other members at once, so that members with a common
   beginning share them. A member is given up in a subtree as soon as the overlap
   plus what remains of its length is too little. What passes joins candidate
   components (only a spanning forest leaves the task, never all pairs).
3. Within candidate components the same walk over the full sets, made again from
   the texts, decides: it counts every class's links and yields a spanning forest.

Groups and components are dealt as pairs of bounded blocks, so none is held by
one task, there is no cap, and each pair of classes meets in one block pair of
step 3. The work there is the number of pairs that step 2 lets pass, which is near
the number of links: a group of k texts that are all similar takes k * k / 2.

Defined cases: null text is empty; a text without words has no shingles and links
with nothing; with fewer than four words the whole sequence is the one shingle;
rows that share a doc_id are one node, a row's own links are those of its text;
a row without doc_id links with nothing; equal rows link with each other; an
empty table gives no rows; extra columns are ignored. Shingles are compared by
63 bits of a hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from alloy.llm.common import id_text, slices, written
from alloy.llm.graph import components

SHINGLE = 4
PERCENT = 85
#: Shingles that come last in the order at most, and the count from which on.
HOT, HOT_FROM = 65_536, 32
#: Members and bytes of a block, of which one task holds two at a time.
BLOCK, BLOCK_BYTES = 512, 2 << 20
_RUN = 256  # shingles of a path between two bounds
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(1 << 63)


def least_overlap(n: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    """Shingles that sets of n and m must have in common to link."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def band_starts(longest: int = 1 << 31) -> list[int]:
    """Where the bands of lengths begin: linked sets lie at most one band apart."""
    starts = [1]
    while starts[-1] <= longest:
        starts.append(100 * starts[-1] // PERCENT + 1)
    return starts


_BANDS = np.array(band_starts())


def band_of(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(_BANDS, n, "right") - 1


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = pc.dictionary_encode(split.flatten())
    known = np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in words.dictionary.to_pylist()], dtype=np.uint64)
    empty = np.array([w == "" for w in words.dictionary.to_pylist()], dtype=bool)  # at the ends of a text
    index = words.indices.to_numpy()
    real = ~empty[index] if len(index) else np.empty(0, dtype=bool)
    w = known[index[real]] if len(index) else np.empty(0, dtype=np.uint64)
    stops = np.concatenate(([0], np.cumsum(real)))[split.offsets.to_numpy() - split.offsets[0].as_py()]
    every = _mixed(w, SHINGLE)
    out = []
    for start, stop in zip(stops[:-1].tolist(), stops[1:].tolist()):
        if stop - start >= SHINGLE:
            out.append(np.unique(every[start:stop - SHINGLE + 1]))
        else:
            out.append(_mixed(w[start:stop], stop - start) if stop > start else w[:0])
    return out


def _mixed(w: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each place on."""
    n = max(0, len(w) - k + 1)
    h = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        h = (h ^ (h >> np.uint64(29))) * _MIX + w[j:n + j]
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def ordered(found: np.ndarray, hot: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A set as sorted keys of the global order; ``hot`` (sorted hashes) come last,
    by ``place``."""
    keys = found >> np.uint64(1)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, found), len(hot) - 1)
        is_hot = hot[at] == found
        if is_hot.any():
            keys[is_hot] = _TOP | place[at[is_hot]]
            keys.sort()
    return keys


def frequent(docs: DataFrame, hot_from: int = HOT_FROM) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places): the most frequent shingles, sorted by hash, and their places
    in the order. At most ``HOT`` of them reach the driver. A shingle counts where it
    is in two documents of a slice at least, which shifts the order only."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                found, n = np.unique(np.concatenate([np.empty(0, dtype=np.uint64), *shingle_sets(part.column(0))]), return_counts=True)
                some = n > 1
                yield pa.RecordBatch.from_arrays([pa.array(found[some].view(np.int64)), pa.array(n[some])], names=["shingle", "n"])

    counts = id_text(docs).select("text").mapInArrow(make, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("n") >= hot_from).orderBy(F.desc("n"), "shingle").limit(HOT).collect()
    hashes = np.array([r.shingle for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.arange(len(top), 0, -1, dtype=np.uint64)[order]


def sets_of(docs: DataFrame, hot) -> DataFrame:
    """(doc_id, mark, n_shingles, class, band, prefix) for every row; ``mark`` is a
    hash of the text; without shingles the last three are null."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                n, cls, prefix = [], [], []
                for found in shingle_sets(part.column(2)):
                    keys = ordered(found, *hot.value)
                    n.append(len(keys))
                    cls.append(class_id(keys) if len(keys) else None)
                    prefix.append(keys[:prefix_length(len(keys))].tobytes() if len(keys) else None)
                band = band_of(np.array(n, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(band, mask=band < 0),
                     pa.array(prefix, pa.binary())], names=["doc_id", "mark", "n_shingles", "class", "band", "prefix"])

    return marked(docs).mapInArrow(make, "doc_id long, mark long, n_shingles long, class long, band long, prefix binary")


def marked(docs: DataFrame) -> DataFrame:
    return id_text(docs).select("doc_id", F.xxhash64("text").alias("mark"), "text")


def class_id(keys: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(keys.tobytes()) - (1 << 63)


class Trie:
    """Ordered sets of one block pair as a prefix tree, walked depth first."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, whole: bool):
        """``sets``: sorted keys, all of a set (``whole``) or its first ones;
        ``sizes``: lengths of the full sets."""
        self.sizes, self.whole, self.m = sizes, whole, len(sets)
        length = np.array([len(s) for s in sets])
        self.owner = np.repeat(np.arange(self.m), length)
        self.stop = np.cumsum(length)
        self.start = self.stop - length
        keys, self.token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        self.width = len(keys)
        self.flat = self.owner * self.width + self.token
        shared = df[self.token] > 1
        token = self.token[shared]
        cut = np.concatenate(([0], np.cumsum(shared)))
        self.paths = [token[cut[a]:cut[b]] for a, b in zip(self.start, self.stop)]
        self.last = np.where(length > 0, self.token[np.maximum(self.stop - 1, 0)], -1)
        by_token = np.argsort(token, kind="stable")
        self.members = self.owner[shared][by_token]
        self.at = np.searchsorted(token[by_token], np.arange(self.width + 1))
        self.least = -(-PERCENT * sizes // 100)

    def known(self, member: np.ndarray, token: np.ndarray | int) -> np.ndarray:
        """How many of a member's keys come up to ``token``."""
        return np.searchsorted(self.flat, member * self.width + token, "right") - self.start[member]

    def overlaps(self, path: np.ndarray) -> np.ndarray:
        """For every member, how many keys of the path it has."""
        first, n = self.at[path], self.at[path + 1] - self.at[path]
        where = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(self.members[where], minlength=self.m)

    def walk(self, partners: Callable[[int], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """(member, those that link with it and come later in the trie). ``partners(i)``:
        a mask of the members that i may meet."""
        order = sorted(range(self.m), key=lambda i: self.paths[i].tolist())
        rank = np.empty(self.m, dtype=np.int64)
        rank[order] = np.arange(self.m)
        common = [0, *(_common(self.paths[a], self.paths[b]) for a, b in zip(order, order[1:])), 0]
        nodes = [(0, np.arange(self.m), np.zeros(self.m, dtype=np.int64))]  # depth, members that are left, their overlaps
        for k, i in enumerate(order):
            path = self.paths[i]
            while nodes[-1][0] > common[k]:
                nodes.pop()
            depth, left, overlap = nodes[-1]
            if common[k + 1] > depth:  # a node that the next member shares
                later = rank[left] > k
                left, overlap = self.down(path, depth, common[k + 1], left[later], overlap[later])
                depth = common[k + 1]
                nodes.append((depth, left, overlap))
            n, m = self.sizes[i], self.sizes[left]
            here = partners(i)[left] & (rank[left] > k) & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m))
            left, overlap = self.down(path, depth, len(path), left[here], overlap[here], i)
            if not len(left):
                continue
            m = self.sizes[left]
            if self.whole:
                good = (overlap > 0) & (100 * overlap >= PERCENT * (n + m - overlap))
            else:  # what the two prefixes leave open
                both = np.minimum(self.last[left], self.last[i])
                most = overlap + np.minimum(n - self.known(np.full(len(left), i), both), m - self.known(left, both))
                good = (overlap > 0) & (most >= least_overlap(n, m))
            if good.any():
                yield i, left[good]

    def down(self, path: np.ndarray, depth: int, to: int, left: np.ndarray, overlap: np.ndarray, leaf: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """From ``depth`` to ``to`` along a path; members that cannot reach the overlap
        that their length (or the ``leaf``'s) needs are left behind."""
        while depth < to and len(left):
            step = path[depth:min(to, depth + _RUN)]
            overlap = overlap + self.overlaps(step)[left]
            depth += len(step)
            able = overlap + self.sizes[left] - self.known(left, int(step[-1])) >= self.least[left]
            if leaf is not None and self.whole:
                passed = self.known(np.array([leaf]), int(step[-1]))[0]
                able &= overlap + self.sizes[leaf] - passed >= self.least[leaf]
            left, overlap = left[able], overlap[able]
        return left, overlap


def _common(a: np.ndarray, b: np.ndarray) -> int:
    k = min(len(a), len(b))
    differ = np.flatnonzero(a[:k] != b[:k])
    return int(differ[0]) if len(differ) else k


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Rows with equal ``names``, from rows sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        group = np.stack([batch.column(batch.schema.names.index(c)).to_numpy(zero_copy_only=False) for c in names])
        cuts = [0, *(np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            here = tuple(group[:, s].tolist())
            if held and here != last:
                yield pa.Table.from_batches(held)
                held = []
            last = here
            held.append(batch.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)


def _joined(rows: pa.Table, whole: bool) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray]:
    """(classes, forest of links, weight of each one's links) of one block pair. The
    rows have class, n, unit, p, q, native, weight, keys."""
    cls, n, unit, native, weight = (rows[c].to_numpy() for c in ("class", "n", "unit", "native", "weight"))
    p, q = rows["p"][0].as_py(), rows["q"][0].as_py()
    trie = Trie([np.frombuffer(k, dtype=np.uint64) for k in rows["keys"].to_pylist()], n, whole)
    every = np.ones(len(cls), dtype=bool)

    def partners(i: int) -> np.ndarray:
        if p != q:
            return unit != unit[i]
        return every if native[i] else native

    label = np.arange(len(cls))
    forest, links = [], np.zeros(len(cls), dtype=np.int64)
    for i, found in trie.walk(partners):
        links[i] += weight[found].sum()
        links[found] += weight[i]
        roots, first = np.unique(label[found], return_index=True)
        for root, j in zip(roots.tolist(), found[first].tolist()):
            if label[i] != root:
                forest.append((int(cls[i]), int(cls[j])))
                label[label == root] = label[i]
    return cls, forest, links


def candidates(rows: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of what the prefixes of each block pair let pass."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, ["lo", "group_band", "p", "q"]):
            if block.num_rows > 1:
                _, forest, _ = _joined(block, False)
                if forest:
                    a, b = zip(*forest)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(make, "a long, b long")


def linked(rows: DataFrame) -> DataFrame:
    """(a, b, n): links of a spanning forest (n null), and the weight n of the links
    of class a (b null), from block pairs of full sets."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, ["component", "p", "q"]):
            if block.num_rows > 1:
                cls, forest, links = _joined(block, True)
                some = np.flatnonzero(links)
                a = [x for x, _ in forest] + cls[some].tolist()
                b = [y for _, y in forest] + [None] * len(some)
                n = [None] * len(forest) + links[some].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, n)], names=["a", "b", "n"])

    return rows.mapInArrow(make, "a long, b long, n long")


def groups(classes: DataFrame) -> DataFrame:
    """(lo, group_band, class, native): the members of the groups that several classes
    share, ``classes`` having (class, band, keys). A class is native to its own band
    and a guest of the next; guests meet natives only."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 1 << 20):
                token = np.frombuffer(b"".join(part.column(2).to_pylist()), dtype=np.uint64)
                token = (token ^ (token >> np.uint64(32))) * _MIX & ~np.uint64(255)
                count = pc.binary_length(part.column(2)).to_numpy(zero_copy_only=False) // 8
                cls, band = (np.repeat(part.column(i).to_numpy(zero_copy_only=False), count) for i in (0, 1))
                for native in (True, False):
                    key = (token | (band + (not native)).astype(np.uint64)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(cls), pa.array(np.full(len(cls), native))], names=["key", "class", "native"])

    keys = classes.select("class", "band", "keys").mapInArrow(make, "key long, class long, native boolean")
    shared = keys.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.max("native").alias("any"))
    shared = written(shared.filter("lo < hi AND any").select("key", "lo"), "ngram-shared")
    held = keys.join(shared, "key").select("lo", F.col("key").bitwiseAND(F.lit(255)).alias("group_band"), "class", "native")
    return held.distinct()


def dealt(members: DataFrame, group: list[str], sets: DataFrame) -> DataFrame:
    """``members`` (group, class, native, band, bytes) with ``sets`` (class, n, weight,
    keys) and (unit, p, q), once for every pair of blocks of their group; block pairs
    lie together, sorted. A group within one block stays whole, others are cut by
    bands of length, and blocks more than one band apart do not meet."""
    size = [F.count(F.lit(1)).alias("members"), F.sum("bytes").alias("total")]
    need = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("total") / BLOCK_BYTES))
    large = members.groupBy(*group).agg(*size).filter(need > 1).select(*group)
    zero = F.lit(0).cast("long")
    columns = [*group, "class", "native"]
    small = members.join(large, group, "left_anti").select(*columns, *[zero.alias(c) for c in ("unit", "p", "q")])
    large = written(members.join(large, group).select(*columns, "band", "bytes"), "ngram-large")
    units = written(large.groupBy(*group, "band").agg(*size).select(*group, "band", need.alias("blocks")), "ngram-units")
    at = large.join(units, [*group, "band"]).withColumn("unit", F.col("band") * (1 << 32) + F.pmod(F.xxhash64("class"), F.col("blocks")))
    near = at.select(*columns, "unit", F.explode(F.array(*[F.col("band") + d for d in (-1, 0, 1)])).alias("band"))
    near = near.join(units, [*group, "band"]).withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    other = F.col("band") * (1 << 32) + F.col("block")
    near = near.select(*columns, "unit", F.least("unit", other).alias("p"), F.greatest("unit", other).alias("q"))
    out = small.unionByName(near).join(sets.select("class", "n", "weight", "keys"), "class")
    return out.repartition(*group, "p", "q").sortWithinPartitions(*group, "p", "q")


def full_sets(texts: DataFrame, hot) -> DataFrame:
    """(class, component, band, weight, n, keys) from (class, component, band, weight, text)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 4):
                sets = [ordered(found, *hot.value) for found in shingle_sets(part.column(4))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["class", "component", "band", "weight", "n", "keys"])

    return texts.mapInArrow(make, "class long, component long, band long, weight long, n long, keys binary")


def join_similar(docs: DataFrame, hot_from: int = HOT_FROM) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links, class) for every row of ``docs``;
    n_links: how many other rows link with it."""
    hot = docs.sparkSession.sparkContext.broadcast(frequent(docs, hot_from))  # 1 MB at most
    rows = written(sets_of(docs, hot), "ngram-sets")
    with_id = rows.filter("class IS NOT NULL AND doc_id IS NOT NULL")
    classes = with_id.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.min_by("mark", "doc_id").alias("mark"), F.count(F.lit(1)).alias("weight"),
                                           F.min("n_shingles").alias("n"), F.min("band").alias("band"), F.min("prefix").alias("keys"))
    classes = written(classes, "ngram-classes")

    sizes = classes.select("class", "band", F.octet_length("keys").alias("bytes"))
    members = written(groups(classes).join(sizes, "class"), "ngram-members")
    near = components(candidates(dealt(members, ["lo", "group_band"], classes))).withColumnRenamed("node", "class")

    chosen = near.join(classes.select("class", "doc_id", "mark", "band", "weight"), "class")
    texts = chosen.join(marked(docs), ["doc_id", "mark"]).select("class", "component", "band", "weight", "text")
    full = written(full_sets(texts, hot).dropDuplicates(["class"]), "ngram-full")
    members = full.select("class", "component", "band", F.lit(True).alias("native"), F.octet_length("keys").alias("bytes"))
    links = written(linked(dealt(members, ["component"], full)), "ngram-links")

    several = with_id.groupBy("doc_id").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo < hi")
    ties = with_id.join(several, "doc_id").select(F.col("lo").alias("a"), F.col("class").alias("b"))
    joined = components(links.filter("b IS NOT NULL").select("a", "b").unionByName(ties))
    of_class = classes.select("class", "doc_id", "weight").join(joined.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    least = of_class.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    counts = links.filter("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n_links"))
    known = of_class.join(least, "component").join(counts, "class", "left").select(
        "class", "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    found = rows.select("doc_id", "n_shingles", "class").join(known, "class", "left")
    mine = F.col("doc_id").isNotNull()
    return found.select("doc_id", "n_shingles", F.when(mine, F.coalesce("component_id", "doc_id")).alias("component_id"),
                        F.when(mine, F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"), "class")
