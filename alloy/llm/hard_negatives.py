"""Hard-negative mining (operator 13): segment summary filtering.

Every vector is stored with the mean and the deviation of its segments, 1, 4 and
16 of them. Over a segment of w places the inner product of two vectors lies within
w * (mean * mean' - deviation * deviation') and w * (mean * mean' + deviation *
deviation'). The bounds of the whole vector rule out most pairs of an anchor and a
row; what is left is refined level by level, and only pairs that no level rules out
are scored exactly.

Anchors are taken in blocks of ``BLOCK_BYTES``, which each task holds, and every
block meets all rows where they lie; a task keeps the best rows of each anchor so
far, whose scores tighten the bounds. A first pass finds an anchor's positives (the
best rows of its label), a second its negatives (rows of other labels whose score
lies in a window set by a positive's). Nothing but the best of each task is
shuffled, so no label and no vector can be too frequent.

Components are floor(scale * x), scores integers and exact; higher scores come
first, ties by smaller id.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component take no part; repeated rows count once; rows of one id but different
vectors are rows of their own, none of which is "other" to an anchor of that id;
vectors of different lengths have no score, empty ones score 0; a score beyond a
long is held at its end; a positive score of 0 or less has a window of 0 or nothing;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from alloy.llm.common import written

SEGMENTS = (1, 4, 16)
#: Bytes of anchors that are held at a time; anchors and rows that are compared at a time.
BLOCK_BYTES = 8 << 20
_ANCHORS, _ROWS = 256, 2048
_NONE = np.iinfo(np.int64).min
_LAST = np.iinfo(np.int64).max
_FOUND = "anchor long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
STORED = "vec_id long, label long, dim int, vector binary, means binary, deviations binary"


def segment_bounds(dim: int, segments: int) -> np.ndarray:
    return np.arange(segments + 1) * dim // segments


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of all levels' segments, each times the root of the
    segment's width, so that plain inner products give the bounds."""
    means, deviations = [], []
    for segments in SEGMENTS:
        at = segment_bounds(vectors.shape[1], segments)
        for start, stop in zip(at, at[1:]):
            part = vectors[:, start:stop]
            root = np.sqrt(stop - start)
            means.append(part.mean(axis=1) * root if stop > start else np.zeros(len(vectors)))
            deviations.append(part.std(axis=1) * root if stop > start else np.zeros(len(vectors)))
    return np.stack(means, axis=1), np.stack(deviations, axis=1)


def stored(rows: DataFrame, label: Column | str = "label", scale: float = 256.0) -> DataFrame:
    """Rows that take part, each once, with components floor(scale * x), segment
    means and deviations. ``rows`` has vec_id and embedding."""
    inside = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    label = F.expr(label) if isinstance(label, str) else label
    ids = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    ids = ids.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(inside)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            dims = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                which = pa.array(np.flatnonzero(dims == dim))
                flat = lists.take(which).flatten().to_numpy(zero_copy_only=False)
                vectors = np.floor(scale * flat).reshape(len(which), dim)
                means, deviations = summaries(vectors)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(which), batch.column(1).take(which), pa.array(np.full(len(which), dim, dtype=np.int32)),
                     *[pa.array([row.tobytes() for row in x], pa.binary()) for x in (vectors, means, deviations)]],
                    names=[f.split()[0] for f in STORED.split(", ")])

    return ids.mapInArrow(make, STORED).dropDuplicates(["vec_id", "label", "dim", "vector"])


class Vectors:
    """Stored rows of one length as arrays."""

    def __init__(self, rows: pa.Table | pa.RecordBatch, dim: int):
        self.id, self.label = (rows.column(i).to_numpy() if isinstance(rows, pa.Table) else rows.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        self.vector = _matrix(rows.column(3), dim)
        self.mean, self.deviation = (_matrix(rows.column(i), sum(SEGMENTS)) for i in (4, 5))

    def take(self, which: np.ndarray) -> "Vectors":
        out = object.__new__(Vectors)
        for name, value in vars(self).items():
            setattr(out, name, value[which])
        return out


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), width)


def scores_within(anchors: Vectors, rows: Vectors, low: np.ndarray, high: np.ndarray, allowed: np.ndarray):
    """(anchors, rows, scores): which of them have allowed pairs with scores that may
    lie from ``low`` to ``high`` (of each anchor), and their exact scores; ``_NONE``
    where a bound rules a pair out."""
    a, r = np.arange(len(anchors.id)), np.arange(len(rows.id))
    norms = np.sqrt((anchors.vector ** 2).sum(axis=1).max(initial=0)) * np.sqrt((rows.vector ** 2).sum(axis=1).max(initial=0))
    slack = 1 + norms * 1e-9
    at = 0
    for segments in SEGMENTS:
        level = slice(at, at + segments)
        at += segments
        middle = anchors.mean[a, level] @ rows.mean[r, level].T
        spread = anchors.deviation[a, level] @ rows.deviation[r, level].T + slack
        allowed = allowed & (middle + spread >= low[a, None]) & (middle - spread <= high[a, None])
        some_a, some_r = allowed.any(axis=1), allowed.any(axis=0)
        a, r, allowed = a[some_a], r[some_r], allowed[np.ix_(some_a, some_r)]
    if norms < 2.0 ** 52:
        exact = (anchors.vector[a] @ rows.vector[r].T).astype(np.int64)
    else:  # beyond a double's exact integers
        whole = [[[int(x) for x in v] for v in side] for side in (anchors.vector[a], rows.vector[r])]
        exact = np.array([[max(_NONE + 1, min(_LAST, sum(x * y for x, y in zip(v, w)))) for w in whole[1]] for v in whole[0]],
                         dtype=np.int64).reshape(len(a), len(r))
    return a, r, np.where(allowed, exact, _NONE)


class Best:
    """The best k rows of each of n places so far: higher scores, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), _NONE)
        self.id = np.full((n, k), _LAST)

    @property
    def least(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, places: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores by place and row; ``ids`` of the rows ascend."""
        k = self.score.shape[1]
        scores = scores.copy()
        every = np.arange(len(places))
        found, found_ids = [self.score[places]], [self.id[places]]
        for _ in range(min(k, scores.shape[1])):
            best = scores.argmax(axis=1)  # the first of equal ones
            found.append(scores[every, best][:, None])
            found_ids.append(np.where(found[-1] == _NONE, _LAST, ids[best][:, None]))
            scores[every, best] = _NONE
        score, row = np.concatenate(found, axis=1), np.concatenate(found_ids, axis=1)
        order = np.lexsort((row, ~score), axis=1)[:, :k]  # ~: descending, within a long
        self.score[places] = np.take_along_axis(score, order, axis=1)
        self.id[places] = np.take_along_axis(row, order, axis=1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place, at = np.nonzero(self.score != _NONE)
        return place, self.id[place, at], self.score[place, at]


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[int, Vectors]]:
    dims = batch.column(2).to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        rows = batch.filter(pa.array(dims == dim))
        for low in range(0, rows.num_rows, _ROWS):
            part = Vectors(rows.slice(low, _ROWS), dim)
            yield dim, part.take(np.argsort(part.id, kind="stable"))


def _anchor_tiles(block: pa.Table) -> dict[int, list[tuple[np.ndarray, Vectors]]]:
    """By length: (numbers within the block, arrays) of up to ``_ANCHORS`` anchors."""
    dims = block.column(2).to_numpy()
    tiles: dict[int, list] = {}
    for dim in np.unique(dims).tolist():
        number = np.flatnonzero(dims == dim)
        rows = Vectors(block.take(pa.array(number)), dim)
        tiles[dim] = [(number[at:at + _ANCHORS], rows.take(slice(at, at + _ANCHORS))) for at in range(0, len(number), _ANCHORS)]
    return tiles


def _positives(held, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.value
        tiles, best = _anchor_tiles(block), Best(block.num_rows, k)
        for batch in batches:
            for dim, rows in _parts(batch):
                for number, anchors in tiles.get(dim, []):
                    allowed = (anchors.label[:, None] == rows.label) & (anchors.id[:, None] != rows.id)
                    a, r, scores = scores_within(anchors, rows, best.least[number], np.full(len(number), np.inf), allowed)
                    if scores.size:
                        best.add(number[a], scores, rows.id[r])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best.rows()], names=["anchor", "positive_id", "positive_score"])

    return search


def _negatives(held, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, positive, score, low, high = held.value  # arrays by anchor and positive; low > high where there is none
        tiles, n = _anchor_tiles(block), low.shape[1]
        best = Best(low.size, k)
        for batch in batches:
            for dim, rows in _parts(batch):
                for number, anchors in tiles.get(dim, []):
                    least = np.maximum(low[number], best.least.reshape(-1, n)[number])
                    able = least <= high[number]
                    floor = np.where(able, least, np.inf).min(axis=1, initial=np.inf)
                    top = np.where(able, high[number], -np.inf).max(axis=1, initial=-np.inf)
                    a, r, scores = scores_within(anchors, rows, floor, top, anchors.label[:, None] != rows.label)
                    if not scores.size:
                        continue
                    for j in range(n):
                        at = number[a]
                        inside = (scores >= low[at, j][:, None]) & (scores <= high[at, j][:, None]) & (scores != _NONE)
                        some_a, some_r = inside.any(axis=1), inside.any(axis=0)
                        if some_a.any():
                            cut = np.ix_(some_a, some_r)
                            best.add(at[some_a] * n + j, np.where(inside[cut], scores[cut], _NONE), rows.id[r][some_r])
        place, ids, scores = best.rows()
        columns = place // max(n, 1), block.column(0).to_numpy()[place // max(n, 1)], positive.ravel()[place], score.ravel()[place], ids, scores
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=_FOUND.replace(" long", "").split(", "))

    return search


def _first(rows: DataFrame, group: list[str], score: str, row_id: str, k: int) -> DataFrame:
    """The first k of each group of what the tasks kept (k a task at most), as ``rank``."""
    ahead = Window.partitionBy(*group).orderBy(F.desc(score), row_id)
    return rows.withColumn("rank", F.row_number().over(ahead)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column | str, label: Column | str = "label", positives: int = 5, negatives: int = 3,
         least_percent: int = 50, most_percent: int = 95, scale: float = 256.0, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for
    each of an anchor's first ``positives`` rows of its label the first ``negatives``
    rows of other labels that score from ``least_percent`` to ``most_percent`` per cent
    of the positive's score. ``anchor`` is a condition on vec_id and label, ``label`` an
    expression over ``rows``."""
    spark = rows.sparkSession
    table = written(stored(rows, label, scale), "vectors")
    of_anchor = F.expr(anchor) if isinstance(anchor, str) else anchor
    chosen = table.filter(of_anchor)
    size = F.octet_length("vector") + F.octet_length("means") + F.octet_length("deviations")
    total = chosen.agg(F.sum(size).alias("n")).first().n or 0
    n_blocks = max(1, -(-total // block_bytes))
    dealt = chosen if n_blocks == 1 else written(chosen.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n_blocks))), "anchor-blocks")
    found = []
    for b in range(n_blocks):
        part = dealt if n_blocks == 1 else dealt.filter(F.col("block") == b)
        block = part.select(*table.columns).orderBy("vec_id", "label", "vector").toArrow().combine_chunks()
        held = spark.sparkContext.broadcast(block)  # about block_bytes
        best = table.mapInArrow(_positives(held, positives), "anchor long, positive_id long, positive_score long")
        near = _first(best, ["anchor"], "positive_score", "positive_id", positives).toArrow()  # at most ``positives`` rows an anchor of the block
        at, slot = near["anchor"].to_numpy(), near["rank"].to_numpy() - 1
        row, score, low, high = (np.full((block.num_rows, positives), x) for x in (0, 0, 1, 0))
        row[at, slot], score[at, slot] = near["positive_id"].to_numpy(), near["positive_score"].to_numpy()
        low[at, slot] = [-(-least_percent * x // 100) for x in near["positive_score"].to_pylist()]
        high[at, slot] = [most_percent * x // 100 for x in near["positive_score"].to_pylist()]
        both = spark.sparkContext.broadcast((block, row, score, low, high))
        rest = _first(table.mapInArrow(_negatives(both, negatives), _FOUND), ["anchor", "positive_id"], "negative_score", "negative_id", negatives)
        found.append(written(rest.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                                         "negative_score"), "negatives"))
        held.unpersist()
        both.unpersist()
    return reduce(DataFrame.unionByName, found)


#: The same as DuckDB SQL over ``embeddings``, with the parameters of the query.
ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS "rank", s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3
"""
