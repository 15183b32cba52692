"""Cross-tokenizer alignment (operator 12): galloping intersection of token ends.

A text is encoded by two tokenizers, a byte-level BPE (A, over a space and the text)
and a piece BPE (B, over the text, which adds the space). Both sequences spell the
same bytes; the places where a token of each ends cut them into groups. The shorter
list of ends is looked up in the longer one by exponential and binary search, each
search going on from the last; the common ends are the groups' borders, and the
differences of their ranks in both lists say how many tokens of each a group has.

The tokens of a group are linked, every one of A with every one of B. An id pair's
count is the number of documents (rows) that hold it linked, over the whole corpus;
a link is best if no other pair of its A id has a higher count.

Texts are encoded once. Each document's links are written as distinct id pairs with
their number; the counts are aggregated from them (partially before the shuffle) and
meet them by a join, which is a broadcast only where the written counts are small.

Defined cases: null and empty texts, and texts whose tokens do not spell a space and
the text (one of the tokenizers changes it), have no tokens: zeros and ''; special
tokens' strings are plain text; a null doc_id stays null; equal rows are documents
each; an empty table gives no rows; extra columns are ignored. A worker holds the
tokens and distinct pairs of 2 MB of text, or of one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from alloy.llm.common import id_text, slices, written
from alloy.llm.packing import default_tokenizer, rank_encoder, rank_encoding

_LINKS = 1 << 20  # links that are written out at a time
_SMALL = 64 << 20  # bytes of counts up to which they are broadcast
_SUMMARY = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, links array<long>"


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common values of two ascending arrays in either.

    Every value of the shorter one is looked up from where one before it was found:
    first each 4096th, from there each 512th, and so on, all values of a round at once."""
    place = np.zeros(len(short), dtype=np.int64)
    before = len(short) or 1
    for stride in (4096, 512, 64, 8, 1):
        at = np.arange(0, len(short), stride)
        place[at] = _search(long, short[at], place[at // before * before])
        before = stride
    inside = np.minimum(place, max(len(long) - 1, 0))
    common = np.flatnonzero((place < len(long)) & (long[inside] == short)) if len(long) else np.empty(0, dtype=np.int64)
    return common, place[common]


def _search(long: np.ndarray, values: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The first place from ``low`` on whose value is not less: steps that double, then halves."""
    low, n = low.copy(), len(long)
    high, step = low.copy(), 1
    todo = np.arange(len(values))
    while True:
        todo = todo[high[todo] < n]
        todo = todo[long[high[todo]] < values[todo]]
        if not len(todo):
            break
        low[todo] = high[todo] + 1
        high[todo] += step
        step *= 2
    high = np.minimum(high, n)
    todo = np.flatnonzero(low < high)
    while len(todo):
        middle = (low[todo] + high[todo]) >> 1
        less = long[middle] < values[todo]
        low[todo[less]] = middle[less] + 1
        high[todo[~less]] = middle[~less]
        todo = todo[low[todo] < high[todo]]
    return low


class Sides:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, rank_file: str, json_file: str, piece_file: str):
        import sentencepiece

        self.encode_a = rank_encoder(rank_file, json_file, lambda encoding: encoding.encode_to_numpy)
        spelled = rank_encoding(rank_file)
        bytes_a = [_or_empty(spelled.decode_single_token_bytes, i) for i in range(spelled.n_vocab)]
        self.model = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        pieces = range(self.model.get_piece_size())
        bytes_b = [bytes([int(self.model.id_to_piece(i)[1:-1], 16)]) if self.model.is_byte(i)
                   else self.model.id_to_piece(i).replace("▁", " ").encode() for i in pieces]
        self.bytes_a, self.bytes_b = pa.array(bytes_a, pa.binary()), pa.array(bytes_b, pa.binary())
        # Ids as written in a digest: within a group, at the end of its side, and at the text's end.
        self.said = pa.array([f"{i}{end}" for i in range(len(bytes_a)) for end in (",", "|")] + [f"{i}{end}" for i in pieces for end in (",", ";", "")])
        self.n_b = len(bytes_b)

    def encode(self, texts: list[str]) -> "Tokens":
        """The tokens of both sides of all texts; a text without tokens has none."""
        whole = [(" " + text).encode() if text else b"" for text in texts]
        a = [np.asarray(self.encode_a(" " + text), dtype=np.int64) if text else _NO_IDS for text in texts]
        b = [np.array(x, dtype=np.int64) for x in self.model.encode(texts, num_threads=1)] if texts else []
        spelled = [self._spelled(side, table) for side, table in ((a, self.bytes_a), (b, self.bytes_b))]
        same = [w != b"" and w == x and w == y for w, x, y in zip(whole, *spelled)]
        return Tokens(self, [x if ok else _NO_IDS for x, ok in zip(a, same)], [x if ok else _NO_IDS for x, ok in zip(b, same)])

    @staticmethod
    def _spelled(ids: list[np.ndarray], table: pa.Array) -> list[bytes]:
        """The bytes of each text's tokens."""
        said = table.take(pa.array(np.concatenate([_NO_IDS, *ids])))
        at = np.frombuffer(said.buffers()[1], dtype=np.int32)[said.offset:said.offset + len(said) + 1]
        data = memoryview(said.buffers()[2] or b"")
        cuts = at[np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64)].tolist()
        return [bytes(data[s:e]) for s, e in zip(cuts, cuts[1:])]


_NO_IDS = np.empty(0, dtype=np.int64)


def _or_empty(spell, i: int) -> bytes:
    try:
        return spell(i)
    except KeyError:  # an id without a token
        return b""


class Tokens:
    """The tokens of some texts, one after another, and their groups: the texts' ends are
    ends on both sides, so one intersection cuts them all."""

    def __init__(self, sides: Sides, a: list[np.ndarray], b: list[np.ndarray]):
        self.sides, self.n = sides, len(a)
        self.n_a, self.n_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (a, b))
        self.a, self.b = np.concatenate([_NO_IDS, *a]), np.concatenate([_NO_IDS, *b])
        ends_a, ends_b = (np.cumsum(_lengths(table)[ids]) for table, ids in ((sides.bytes_a, self.a), (sides.bytes_b, self.b)))
        if len(ends_a) <= len(ends_b):
            i, j = gallop(ends_a, ends_b)
        else:
            j, i = gallop(ends_b, ends_a)
        self.cut_a, self.cut_b = i + 1, j + 1  # tokens up to the end of each group
        self.group_a, self.group_b = np.diff(self.cut_a, prepend=0), np.diff(self.cut_b, prepend=0)
        self.of_a, self.of_b = np.repeat(np.arange(self.n), self.n_a), np.repeat(np.arange(self.n), self.n_b)
        self.of_group = self.of_a[self.cut_a - 1]

    @property
    def n_groups(self) -> np.ndarray:
        return np.bincount(self.of_group, minlength=self.n)

    @property
    def n_links(self) -> np.ndarray:
        return np.bincount(self.of_group, weights=self.group_a * self.group_b, minlength=self.n).astype(np.int64)

    def written_out(self) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3``: the groups' ids, for each text."""
        end_a, end_b = np.zeros(len(self.a), dtype=np.int64), np.zeros(len(self.b), dtype=np.int64)
        end_a[self.cut_a - 1] = end_b[self.cut_b - 1] = 1
        stop_b = np.cumsum(self.n_b)
        end_b[stop_b[self.n_b > 0] - 1] = 2
        which = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        which[np.arange(len(self.a)) + np.repeat(self.cut_b - self.group_b, self.group_a)] = 2 * self.a + end_a
        which[np.arange(len(self.b)) + np.repeat(self.cut_a, self.group_b)] = 2 * len(self.sides.bytes_a) + 3 * self.b + end_b
        said = self.sides.said.take(pa.array(which))
        at = np.frombuffer(said.buffers()[1], dtype=np.int32)[:len(said) + 1]
        cuts = at[np.concatenate(([0], np.cumsum(self.n_a + self.n_b)))].astype(np.int32)
        return pa.StringArray.from_buffers(self.n, pa.py_buffer(cuts), said.buffers()[2] or pa.py_buffer(b""))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offsets, pairs, numbers): for each text its distinct linked id pairs (a << 32
        | b) and the number of links of each."""
        n_b = self.sides.n_b
        kinds = len(self.sides.bytes_a) * n_b
        per_token = np.repeat(self.group_b, self.group_a)  # links of each token of A
        first = np.repeat(self.cut_b - self.group_b, self.group_a)
        ends = per_token.cumsum()
        parts = []
        start = 0
        while start < len(self.a):  # runs of tokens of A with about _LINKS links
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _LINKS, "right")))
            n = per_token[start:stop]
            at_b = np.repeat(first[start:stop] - (n.cumsum() - n), n) + np.arange(n.sum())
            of_text = np.repeat(self.of_a[start:stop] * kinds + self.a[start:stop] * n_b, n)
            parts.append(np.unique(of_text + self.b[at_b], return_counts=True))
            start = stop
        keys, count = parts[0] if parts else (_NO_IDS, _NO_IDS)
        if len(parts) > 1:
            keys, which = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
            count = np.bincount(which, weights=np.concatenate([n for _, n in parts])).astype(np.int64)
        text, pair = keys // kinds, keys % kinds
        return np.searchsorted(text, np.arange(self.n + 1)), pair // n_b << 32 | pair % n_b, count


def _lengths(table: pa.Array) -> np.ndarray:
    return np.diff(np.frombuffer(table.buffers()[1], dtype=np.int32)[table.offset:table.offset + len(table) + 1]).astype(np.int64)


def aligned(docs: DataFrame, files: tuple[str, str, str] | None = None) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, links) for every row of
    ``docs``: the groups written as ``a1,a2|b1;a3|b2,b3``, the distinct linked id pairs
    (a << 32 | b) and the number of links of each. ``row`` tells rows apart.
    ``files``: the places of the rank, JSON and piece files on each machine."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides(*(files or default_files()))
        for batch in batches:
            for part in slices(batch, 2, 2 << 20):
                found = sides.encode(part.column(2).to_pylist())
                offsets, pairs, numbers = found.links()
                lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x)) for x in (pairs, numbers)]
                counts = [pa.array(x) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *counts, found.written_out(), *lists],
                                                 names=[f.split()[0] for f in _SUMMARY.split(", ")])

    ids = id_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return ids.mapInArrow(make, _SUMMARY)


def default_files() -> tuple[str, str, str]:
    import public_tokenizers

    return *default_tokenizer(), public_tokenizers.path("piece_bpe_32k.model")


def align(docs: DataFrame, files: tuple[str, str, str] | None = None, said: Column | str = "groups") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) for every row of
    ``docs``: n_best links whose count is the highest of their A id, count_sum the sum
    of the links' counts. ``said`` is what the result holds as ``groups``, an expression
    over the groups written out: they are several times longer than the text, and what
    is made of them goes through a written table."""
    rows = written(aligned(docs, files).withColumn("groups", F.col(said) if isinstance(said, str) else said), "alignment")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.links").alias("n"))
    pairs = rows.select(F.explode("pairs").alias("pair"))
    counts = written(pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("count")), "alignment-counts")
    a = F.shiftright("pair", 32)
    highest = counts.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))
    counts = written(counts.withColumn("a", a).join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best")), "alignment-best")
    size = 24 * counts.count()
    weighed = links.join(F.broadcast(counts) if size <= _SMALL else counts, "pair").groupBy("row").agg(
        F.sum(F.col("n") * F.col("count")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"))
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "links").join(weighed, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups")
