"""Suffix-array dedup (operator 8): repeated 100-byte strings by collection BWT.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
earlier (smaller doc_id, or earlier in the same document).

The suffixes of a whole corpus cannot be sorted in one place, so they are dealt
to tasks in a way that keeps equal strings together. Of the ``GRAM``-byte grams
of a string, the one with the least hash (the leftmost of equals) is its anchor:
equal strings have equal anchors at equal offsets. The strings of a document
that share one anchor occurrence follow each other; the bytes that they cover
are a *piece* of 168 bytes at most.

1. One pass over the texts makes the pieces. Each row carries hashes of its
   anchor and its bytes; equal pieces are folded to the first of them within a
   slice of the input and then, after a shuffle, among all. Whatever a later
   copy covers is removed. A third of all rows holding one passage is thereby
   reduced before the shuffle.
2. Where one anchor is left with several different pieces, their bytes are
   fetched and dealt by anchor. A task takes a collection of whole anchor
   groups, of ``COLLECTION_BYTES``, and builds its Burrows-Wheeler transform
   column by column: a round inserts one more symbol of every piece, from its
   end to its start, at the place that the transform so far gives.
   Walking the finished transform ranks all suffixes; common prefixes of
   neighbours tell which strings are equal, and all but the first are removed.
3. Pieces of an anchor whose bytes exceed a collection are cut into their single
   strings, which are folded as in step 1: the exact way for such groups.

The rounds run over bounded collections in memory: files on one machine would be
out of reach of the others. For the same reason common prefixes are taken
from neighbours after the last round, up to LENGTH, and not kept in files.

Defined cases: null or empty text and texts below LENGTH bytes keep all; a row
without doc_id keeps all and removes nothing elsewhere; a doc_id names one
document, so rows that repeat it count once and each gets that result; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from alloy.llm.common import id_text, slices, written

LENGTH = 100
GRAM = 32
WINDOW = LENGTH - GRAM + 1  # grams of a string
SEGMENT = 1 << 18
COLLECTION_BYTES = 1 << 20
_AT = 7  # bits of a piece's length beyond LENGTH
_BASE = 0x9E3779B97F4A7C15
_FOLD = "anchor long, bytes long, doc long, at long"
_COVER = "doc long, start long, stop long"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte grams, by doubling."""
    h, base = data.astype(np.uint64) + np.uint64(1), _BASE
    n = 1
    while n < GRAM:
        h = h[:-n] * np.uint64(base) + h[n:]
        base = base * base & 0xFFFFFFFFFFFFFFFF
        n *= 2
    return _mixed(h)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``."""
    n, least = 1, values
    while 2 * n <= width:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    return np.minimum(least[:len(values) - width + 1], least[width - n:]) if n < width else least


def pieces(data: bytes) -> tuple[np.ndarray, ...]:
    """(anchor hash, hash of the bytes, start, stop) of each piece of ``data``."""
    parts = []
    for first in range(0, max(1, len(data) - LENGTH + 1), SEGMENT):
        # Every string of the segment lies in these bytes as a whole.
        cut = np.frombuffer(data, dtype=np.uint8)[first:first + SEGMENT + LENGTH - 1]
        if len(cut) < LENGTH:
            break
        grams = gram_hashes(cut)
        place = np.arange(len(grams), dtype=np.uint64)
        least = window_minima((grams & ~np.uint64(0xFFFFF)) | place, WINDOW) & np.uint64(0xFFFFF)
        starts = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        stops = np.append(starts[1:], len(least)) - 1 + LENGTH
        parts.append((grams[least[starts].astype(np.int64)].view(np.int64), starts + first, stops + first))
    if not parts:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    anchor, start, stop = (np.concatenate(c) for c in zip(*parts))
    digest = xxhash.xxh3_64_intdigest
    content = np.fromiter((digest(data[s:e]) for s, e in zip(start.tolist(), stop.tolist())), dtype=np.uint64, count=len(start))
    return anchor, content.view(np.int64), start, stop


def _covers(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    """Rows of _COVER; neighbouring rows of a document that touch become one."""
    if len(doc):
        order = np.lexsort((start, doc))
        doc, start, stop = doc[order], start[order], stop[order]
        # Stops ascend with starts within a document but for nested ones.
        new = np.append(True, (doc[1:] != doc[:-1]) | (start[1:] > stop[:-1]))
        first = np.flatnonzero(new)
        doc, start, stop = doc[first], start[first], np.maximum.reduceat(stop, first)
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(stop)], names=["doc", "start", "stop"])


def _folded(anchor, content, doc, start, stop) -> pa.RecordBatch:
    """Rows of _FOLD: of equal pieces the first, by document and start; the rest
    as covered ranges (anchor null, the range's stop in ``bytes``)."""
    order = np.lexsort((start, doc, content ^ (anchor << 1)))
    anchor, content, doc, start, stop = anchor[order], content[order], doc[order], start[order], stop[order]
    first = np.append(True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]))
    lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    later = (doc != doc[lead]) | (start != start[lead])  # a repeated row is not a later string
    covered = _covers(doc[later], start[later], stop[later])
    at = (start[first] << _AT) | (stop[first] - start[first] - LENGTH)
    n = covered.num_rows
    return pa.RecordBatch.from_arrays([
        pa.concat_arrays([pa.array(anchor[first]), pa.nulls(n, pa.int64())]),
        pa.concat_arrays([pa.array(content[first]), covered.column(2)]),
        pa.concat_arrays([pa.array(doc[first]), covered.column(0)]),
        pa.concat_arrays([pa.array(at), covered.column(1)])], names=["anchor", "bytes", "doc", "at"])


def _make_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            rows = []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                found = pieces(text.encode())
                if len(found[0]):
                    rows.append((found[0], found[1], np.full(len(found[0]), doc, dtype=np.int64), found[2], found[3]))
            if rows:
                yield _folded(*(np.concatenate(c) for c in zip(*rows)))


_FOUND = "doc long, start long, stop long, anchor long"


def _found(doc, start, stop, anchor=None) -> pa.RecordBatch:
    anchors = pa.nulls(len(doc), pa.int64()) if anchor is None else pa.array(anchor)
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(stop), anchors], names=["doc", "start", "stop", "anchor"])


def _fold_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows of _FOLD by anchor, bytes, doc, at: covered ranges (no anchor) and,
    for anchors with several different pieces, the first row of each."""
    last = lead = None  # anchor and bytes of the row before; doc and at of the first row with them
    held = None  # the last first row (anchor, doc, at) and whether its anchor has had another
    for batch in batches:
        if not batch.num_rows:
            continue
        passed = batch.filter(batch.column(0).is_null())
        if passed.num_rows:
            yield _found(*(passed.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 1)))
        batch = batch.filter(batch.column(0).is_valid())
        if not batch.num_rows:
            continue
        anchor, content, doc, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        first = np.append(True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]))
        first[0] = last != (anchor[0], content[0])
        last = (anchor[-1], content[-1])
        start = at >> _AT
        stop = start + LENGTH + (at & ((1 << _AT) - 1))
        place = np.maximum.accumulate(np.where(first, np.arange(len(first)), -1))
        lead = lead or (doc[0], at[0])
        later = ((doc != np.where(place < 0, lead[0], doc[place])) | (at != np.where(place < 0, lead[1], at[place])))
        if place[-1] >= 0:
            lead = (doc[place[-1]], at[place[-1]])
        rest = _covers(doc[later], start[later], stop[later])
        if rest.num_rows:
            yield _found(*(rest.column(i).to_numpy() for i in range(3)))
        a, d, s, e = anchor[first], doc[first], start[first], stop[first]
        before = False
        if held:
            a, d, s, e = (np.append(x, y) for x, y in zip(held[0], (a, d, s, e)))
            before = held[1]
        if not len(a):
            continue
        same = a[1:] == a[:-1]
        several = np.append(before, same)  # shares its anchor with the row before
        several[:-1] |= same
        out = several[:-1]
        if out.any():
            yield _found(d[:-1][out], s[:-1][out], e[:-1][out], a[:-1][out])
        held = ((a[-1:], d[-1:], s[-1:], e[-1:]), bool(several[-1]))
    if held and held[1]:
        a, d, s, e = held[0]
        yield _found(d, s, e, a)


def transform(texts: list[bytes]) -> np.ndarray:
    """Burrows-Wheeler transform of a collection, one symbol of each text a round.

    Symbols are bytes + 1, 0 ends a text (no byte of UTF-8 is 255); the end
    markers sort in the order of the texts."""
    m = len(texts)
    lengths = np.array([len(t) for t in texts])
    # Column j holds the symbol j places before the end; 0 beyond the start.
    columns = np.zeros((int(lengths.max()) + 1, m), dtype=np.uint8)
    for i, t in enumerate(texts):
        columns[:len(t), i] = np.frombuffer(t, dtype=np.uint8)[::-1] + np.uint8(1)
    bwt = columns[0].copy()
    at = np.arange(m)
    for j in range(1, len(columns)):
        active = np.flatnonzero(lengths >= j)
        at = place(bwt, m)[at[active]] if len(active) < m else place(bwt, m)[at]
        new = np.zeros(len(bwt) + len(active), dtype=bool)
        new[at] = True
        grown = np.empty(len(new), dtype=np.uint8)
        grown[~new] = bwt
        grown[at] = columns[j, active]
        bwt = grown
        full = np.zeros(m, dtype=np.int64)
        full[active] = at
        at = full
    return bwt


def place(bwt: np.ndarray, m: int) -> np.ndarray:
    """For each row, the row of the suffix one symbol longer, among the m end
    markers and one row for each symbol of ``bwt`` that is not an end."""
    order = np.argsort(bwt, kind="stable")
    to = np.empty(len(bwt), dtype=np.int64)
    to[order] = np.arange(len(bwt))
    return to + (m - np.count_nonzero(bwt == 0))


def equal_strings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, offset, class) of every string of LENGTH bytes in ``texts``;
    equal strings have one class."""
    m = len(texts)
    lengths = np.array([len(t) for t in texts])
    to = place(transform(texts), m)
    at = np.arange(m)
    ranks, owners, offsets = [], [], []
    for j in range(1, int(lengths.max()) + 1):
        at = to[at]  # of texts that have ended, rows that are not looked at
        if j >= LENGTH:
            here = np.flatnonzero(lengths >= j)
            ranks.append(at[here])
            owners.append(here)
            offsets.append(lengths[here] - j)
    rank, owner, offset = (np.concatenate(x) for x in (ranks, owners, offsets))
    order = np.argsort(rank)
    owner, offset = owner[order], offset[order]
    base = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    strings = np.lib.stride_tricks.sliding_window_view(joined, LENGTH)
    at = base[owner] + offset
    label = np.zeros(len(at), dtype=np.int64)
    for s in range(1, len(at), 20_000):  # neighbours with a common prefix of LENGTH
        e = min(len(at), s + 20_000)
        label[s:e] = (strings[at[s:e]] != strings[at[s - 1:e - 1]]).any(axis=1)
    return owner, offset, np.cumsum(label)


def _cover_collection(doc: list[int], start: list[int], texts: list[bytes]) -> pa.RecordBatch:
    owner, offset, label = equal_strings(texts)
    d = np.array(doc, dtype=np.int64)[owner]
    s = np.array(start, dtype=np.int64)[owner] + offset
    order = np.lexsort((s, d, label))
    d, s, label = d[order], s[order], label[order]
    later = np.append(False, label[1:] == label[:-1])
    return _covers(d[later], s[later], s[later] + LENGTH)


def _collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (anchor, doc, start, piece) by anchor: covered ranges."""
    doc: list[int] = []
    start: list[int] = []
    texts: list[bytes] = []
    held, last, row = 0, None, None
    for batch in batches:
        for a, d, s, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if row == (a, d, s):
                continue  # of a repeated row
            row = (a, d, s)
            if a != last and held >= COLLECTION_BYTES:
                yield _cover_collection(doc, start, texts)
                doc, start, texts, held = [], [], [], 0
            last = a
            doc.append(d)
            start.append(s)
            texts.append(piece)
            held += len(piece)
    if texts:
        yield _cover_collection(doc, start, texts)


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (doc, text, pieces): the bytes of each piece."""
    for batch in batches:
        rows: list[tuple] = []
        held = 0
        for doc, text, found in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode()
            for p in found:
                rows.append((p["anchor"], doc, p["start"], data[p["start"]:p["stop"]]))
                held += p["stop"] - p["start"]
                if held >= 8 << 20:
                    yield _piece_rows(rows)
                    rows, held = [], 0
        if rows:
            yield _piece_rows(rows)


def _piece_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                      names=["anchor", "doc", "start", "piece"])


def _cut_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (doc, start, piece): rows of _FOLD for each single string."""
    digest = xxhash.xxh3_128_intdigest
    for batch in batches:
        doc, at, both = [], [], []
        for d, s, piece in zip(*(c.to_pylist() for c in batch.columns)):
            for i in range(len(piece) - LENGTH + 1):
                doc.append(d)
                at.append(s + i)
                both.append(divmod(digest(piece[i:i + LENGTH]), 1 << 64))
        if at:
            keys = np.array(both, dtype=np.uint64).view(np.int64)
            start = np.array(at, dtype=np.int64)
            yield _folded(keys[:, 0].copy(), keys[:, 1].copy(), np.array(doc, dtype=np.int64), start, start + LENGTH)


def _fold(rows: DataFrame) -> DataFrame:
    """Rows of _FOLD folded over all tasks."""
    key = F.coalesce("anchor", F.xxhash64("doc", "at"))
    return rows.repartition(key).sortWithinPartitions("anchor", "bytes", "doc", "at").mapInArrow(_fold_sorted, _FOUND)


def covered(docs: DataFrame) -> DataFrame:
    """(doc, start, stop): ranges of bytes to remove; they may overlap."""
    texts = id_text(docs).filter(F.col("doc_id").isNotNull())
    found = written(_fold(texts.mapInArrow(_make_pieces, _FOLD)), "suffix-pieces")
    ranges = found.filter("anchor IS NULL").select("doc", "start", "stop")
    several = found.filter("anchor IS NOT NULL")
    large = written(several.groupBy("anchor").agg(F.sum(F.col("stop") - F.col("start")).alias("held"))
                    .filter(F.col("held") > COLLECTION_BYTES).select("anchor"), "suffix-large")

    listed = several.groupBy("doc").agg(F.collect_list(F.struct("anchor", "start", "stop")).alias("pieces"))  # one document's own
    once = texts.select(F.col("doc_id").alias("doc"), "text")
    cut = listed.join(once, "doc").select("doc", "text", "pieces").mapInArrow(_cut_pieces, "anchor long, doc long, start long, piece binary")
    cut = written(cut, "suffix-bytes")  # read by both ways below
    dealt = cut.join(large, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor", "doc", "start")
    ranges = ranges.unionByName(written(dealt.mapInArrow(_collections, _COVER), "suffix-covered"))
    strings = cut.join(large, "anchor", "left_semi").select("doc", "start", "piece").mapInArrow(_cut_strings, _FOLD)
    ranges = ranges.unionByName(_fold(strings).filter("anchor IS NULL").select("doc", "start", "stop"))
    return ranges


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): the ranges removed, merged, and the rest
    of the bytes, for every row of ``docs``."""
    listed = covered(docs).groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    joined = id_text(docs).join(listed, "doc_id", "left").select("doc_id", "text", "ranges")
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sizes, removed, kept = [], [], []
                for text, ranges in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    data = text.encode()
                    merged: list[list[int]] = []
                    for s, e in sorted((r["start"], min(r["stop"], len(data))) for r in ranges or ()):
                        if merged and s <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        elif s < e:
                            merged.append([s, e])
                    edges = [0, *(x for r in merged for x in r), len(data)]
                    sizes.append(len(data))
                    removed.append([{"start": s, "stop": e} for s, e in merged])
                    kept.append(b"".join(data[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, spans),
                                                  pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "removed", "kept"])

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, removed array<struct<start:long,stop:long>>, kept binary")
