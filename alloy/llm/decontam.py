"""Benchmark decontamination (operator 1): pigeonhole seeds and exact edit distance.

An item leaks into a document if some part of the document is within ``max_edit``
times the item's length of it by edit distance, both in lower case with single
spaces between words. Every such pair is found, at every length of the item,
with or without spaces: each step below only drops what cannot be within reach.

* Seeds. An item of k allowed edits is cut into nodes of b allowed edits (b = 7,
  3, 1 or 0), k // (b + 1) + 1 of them, so that one node at least has no more than
  b. A node of b edits is cut into halves of (b - 1) / 2, one of which has no more,
  down to leaves without an edit. All leaves are looked up at every character.
* Nodes. From a leaf's hit the halves are checked upwards, by the exact edit
  distance of a node to the text around the hit (bit-parallel, all hits at once).
  Characters count as equal here if they are of one class of 63, which only lets
  more pass.
* Verification. The exact edit distance of the item to the text around what is
  left decides (bit-parallel, one step a character).

The dealt CGK walks and bit sampling are not used: they lose pairs within reach.

Items are taken in blocks of at most ``BLOCK_BYTES`` of text; a block is what
each task holds, so memory is bounded for any number of items, and the documents
are read once a block (the usual benchmark is one block). The hits grow with the
text of the block.

Defined cases: null or empty item texts, or items without words, leak nowhere;
items of fewer characters than one edit needs leak verbatim, also inside words;
null or empty documents hold nothing; a null doc_id is reported with a null;
equal documents are reported each; equal items all; an empty table on either
side gives no rows; extra columns are ignored (``drop_leaks`` keeps them).
Whole texts are searched.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from alloy.llm.common import id_text, slices, written

MAX_EDIT = 0.2
BLOCK_BYTES = 4 << 20
#: Characters of a seed at most; of text, and hits, that are looked at at a time: their
#: arrays stay within a core's cache.
_SEED, _CHARS, _HITS = 8, 1 << 17, 1 << 17
_STEP = 32
_NODE = 64  # characters of a node whose distance is taken before the item's
_PAD = 2 * _NODE
_WINDOW = 16  # characters of a window whose set of classes is known; a power of two


def words_of(text: str) -> list[str]:
    return text.lower().split()


def distance_to_part(item: str, text: str, most: int) -> tuple[int, int]:
    """(least edit distance of ``item`` to a part of ``text``, end of the part), or
    (most + 1, -1). One bit of a number for each character of the item."""
    m = len(item)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = most + 1, -1
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | down
        d = (((x & up) + up) ^ up) | x
        h_up = down | ~(d | up) & full
        h_down = up & d
        if h_up & top:
            score += 1
        elif h_down & top:
            score -= 1
        h_up = h_up << 1 & full  # a part may start anywhere: row 0 is all zero
        h_down = h_down << 1 & full
        up = h_down | ~(d | h_up) & full
        down = h_up & d
        if score < best:
            best, end = score, j + 1
    return best, end


def allowed(length: int, max_edit: float) -> int:
    return int(max_edit * length)


def cut_up(start: int, stop: int, parts: int) -> list[tuple[int, int]]:
    """``parts`` runs of nearly equal length."""
    n = stop - start
    return [(start + n * i // parts, start + n * (i + 1) // parts) for i in range(parts)]


def node_edits(length: int, most: int) -> int:
    """The allowed edits of an item's nodes: the most that leave leaves of four
    characters, or else leaves as long as can be."""
    leaf = {b: length // ((most // (b + 1) + 1) * (b + 1)) for b in (7, 3, 1, 0) if b <= most}
    return max(leaf, key=lambda b: (min(4, leaf[b]), b))


class Items:
    """A block of items, ready for search: classes of characters, leaves, nodes."""

    def __init__(self, rows: list[tuple[int, str]], max_edit: float):
        self.max_edit = max_edit
        self.items = [(item_id, " ".join(w)) for item_id, text in rows if (w := words_of(text))]
        codes = _codes("".join(t for _, t in self.items))
        self.classes = np.zeros(0x110000, dtype=np.uint8)  # 0: in no item
        seen, n = np.unique(codes, return_counts=True)
        self.classes[seen[np.argsort(-n, kind="stable")]] = np.arange(len(seen)) % 63 + 1
        self.text = np.concatenate((self.classes[codes], np.zeros(_NODE, dtype=np.uint8)))
        # A leaf: item, its place in the item, its nodes (place in ``text``, length) upwards.
        leaves: list[tuple[int, ...]] = []
        keys: dict[int, list[int]] = defaultdict(list)
        at = 0
        for n, (_, text) in enumerate(self.items):
            most = allowed(len(text), max_edit)
            b = node_edits(len(text), most)
            level = [(p, ()) for p in cut_up(0, len(text), most // (b + 1) + 1)]
            while b:
                level = [(h, ((p[0], p[1] - p[0]), *up)) for p, up in level for h in cut_up(*p, 2)]
                b = (b - 1) // 2
            for (start, stop), up in level:
                nodes = [x for first, size in up for x in (at + first, size)]
                keys[min(_SEED, stop - start)].append(len(leaves))
                leaves.append((n, start, *nodes, *[0] * (6 - len(nodes)), stop))
            at += len(text)
        self.leaves = np.array(leaves, dtype=np.int64).reshape(-1, 9).T.copy()
        self.starts = np.concatenate(([0], np.cumsum([len(t) for _, t in self.items]))).astype(np.int64)
        self.pairs, self.partners = self.beside(), self.partner()
        # By seed size and place of a pair beside the seed (None: the seed alone): a
        # table of those that some leaf needs, and the leaves by slot.
        self.tables = {size: self.tables_of(np.array(which), size) for size, which in sorted(keys.items())}

    def tables_of(self, leaves: np.ndarray, size: int) -> dict[int | None, tuple[np.ndarray, ...]]:
        side, first, near_at, near, far_at, far, _, short, _ = self.pairs
        seeds = _seeds(self.text, size)[self.starts[self.leaves[0, leaves]] + self.leaves[1, leaves]]
        wanted: dict[int | None, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        if short[leaves].any():
            wanted[None].append((seeds[short[leaves]], leaves[short[leaves]]))
        for at, pair, move in ((near_at, near, 0), (far_at, far, -1), (far_at, far, 0), (far_at, far, 1)):
            for place in np.unique(at[leaves] + move).tolist():
                here = ~short[leaves] & (at[leaves] + move == place)
                if here.any():
                    which = leaves[here]
                    wanted[place].append((seeds[here] ^ _spread(pair[which]), which))
        out = {}
        for place, parts in wanted.items():
            mixed, which = (np.concatenate(x) for x in zip(*parts))
            bits = np.uint32(min(20, max(12, len(which).bit_length() + 5)))
            slots = _slots(mixed, bits)
            order = np.argsort(slots, kind="stable")
            count = np.bincount(slots, minlength=1 << int(bits))
            out[place] = bits, count > 0, np.concatenate(([0], np.cumsum(count))).astype(np.int32), which[order]
        return out

    def classes_of(self, text: str) -> np.ndarray:
        codes = _codes(text)
        return np.concatenate([self.classes[codes[i:i + _CHARS]] for i in range(0, max(1, len(codes)), _CHARS)])

    def hits(self, here: np.ndarray, two: np.ndarray, left: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, leaves) of the leaves found in a piece of text (``here``: its classes
        between pads, their pairs; ``left``: characters from its start to the text's end);
        those whose other half is out of reach by every pair that it could show are left
        out here, before they are counted out one by one."""
        spread = _spread(two)
        for size, tables in self.tables.items():
            n = min(_CHARS, left - size + 1)
            if n <= 0:
                continue
            seeds = _seeds(here[_PAD:_PAD + n + size - 1], size)
            mixed, at_slot = np.empty(n, dtype=np.uint32), np.empty(n, dtype=np.intp)
            for beside, (bits, taken, first, ids) in tables.items():
                np.copyto(mixed, seeds) if beside is None else np.bitwise_xor(seeds, spread[_PAD + beside:_PAD + beside + n], out=mixed)
                np.copyto(at_slot, _slots(mixed, bits, mixed))
                places = np.flatnonzero(taken.take(at_slot, mode="clip"))
                slots = at_slot[places]
                start = first[slots]
                many = first[slots + 1] - start
                ends = np.cumsum(many)
                cuts = np.unique(np.searchsorted(ends, np.arange(_HITS, ends[-1], _HITS))) if len(ends) else []
                for part in np.split(np.arange(len(places)), cuts) if len(cuts) else [slice(None)]:
                    n_here = many[part]
                    entry = np.repeat(start[part] - np.cumsum(n_here) + n_here, n_here) + np.arange(n_here.sum())
                    yield np.repeat(places[part], n_here), ids[entry]

    def beside(self) -> tuple[np.ndarray, ...]:
        """Of each leaf, its other half as read away from the leaf: direction, place of
        the first character as seen from the leaf's, place and key of the first two,
        of the two after those, the four, and whether it is too short to be looked at."""
        item, start, node, size, stop = self.leaves[[0, 1, 2, 3, 8]]
        at = self.starts[item] + start
        right = at == node
        side = np.where(right, 1, -1)
        first = np.where(right, stop - start, -1)
        short = (size == 0) | (stop - start > _NODE) | (np.where(right, node + size - at - first, at - node) < 4)
        read = [self.text[np.clip(at + first + side * x, 0, len(self.text) - 1)] for x in range(4)]
        wide = [x.astype(np.uint16) for x in read]
        near, far = (np.where(right, x << 6 | y, y << 6 | x).astype(np.uint16) for x, y in (wide[:2], wide[2:]))
        first[short] = 0
        outer = first - (side < 0)  # on the left, a pair's first place is its outer one
        return side, first, outer, near, outer + 2 * side, far, read, short, bool(short.any())

    def half_near(self, text: np.ndarray, two: np.ndarray, place: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """Whether the other half may be within one edit: its first two characters are
        there, and one of the next two about where it belongs; or the next two are,
        moved by one at most, and what the one edit leaves of the first two."""
        side, first, near_at, near, far_at, far, (a, b, c, e), short, any_short = self.pairs
        keep = two[place + near_at[leaf]] == near[leaf]
        i = np.flatnonzero(keep)
        at, d, x, y = place[i] + first[leaf[i]], side[leaf[i]], c[leaf[i]], e[leaf[i]]
        third, fourth = text[at + 2 * d], text[at + 3 * d]
        keep[i] = (third == x) | (third == y) | (fourth == y) | (text[at + 4 * d] == y)
        at, key = place + far_at[leaf], far[leaf]
        for move in (-1, 0, 1):
            i = np.flatnonzero(two[at + move] == key)
            which, d = leaf[i], side[leaf[i]]
            x, y, to = a[which], b[which], place[i] + first[which]
            left = np.where(move * d < 0, (text[to] == x) | (text[to] == y),
                            np.where(move * d > 0, text[to + 2 * d] == y, (text[to] == x) | (text[to + d] == y)))
            keep[i[left]] = True
        return keep | short[leaf] if any_short else keep

    def partner(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each leaf, where the other half of its node of three edits begins as seen
        from the leaf, and the set of that half's classes; no set where there is no such
        node, or where the half is too long for a window."""
        item, start, node, size, upper, length = self.leaves[:6]
        right = node == upper  # the leaf's own half is the left one
        begin, n = np.where(right, node + size, upper), length - size
        able = (length > 0) & (n <= _WINDOW - 6)
        sets = np.zeros(len(item), dtype=np.uint64)
        for j in range(_WINDOW - 6):
            c = self.text[np.minimum(begin + j, len(self.text) - 1)]
            sets |= np.where(able & (j < n), np.uint64(1) << c.astype(np.uint64), np.uint64(0))
        return np.where(able, begin - self.starts[item] - start, 0), sets

    def partner_near(self, windows: np.ndarray, place: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """Whether no more than three classes of the other half of a leaf's node of three
        edits are absent from the text about it: an edit takes away one at most."""
        away, sets = self.partners
        return np.bitwise_count(sets[leaf] & ~windows[place + away[leaf] - 3]) <= 3

    def near(self, text: np.ndarray, place: np.ndarray, node: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
        """Whether the nodes (place in ``self.text``, length) are within ``most`` edits
        of a part of ``text`` that starts up to ``most`` from ``place``."""
        out = np.empty(len(place), dtype=bool)
        for low in range(0, len(place), 1 << 15):
            part = slice(low, low + (1 << 15))
            out[part] = self._near(text, place[part], node[part], size[part], most)
        return out

    def _near(self, text: np.ndarray, place: np.ndarray, node: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
        longest = int(size.max(initial=0))
        word = np.uint16 if longest <= 16 else np.uint32 if longest <= 32 else np.uint64
        one = word(1)
        nodes, at, row = np.unique(node, return_index=True, return_inverse=True)
        sizes = size[at]
        masks = np.zeros((len(nodes), 64), dtype=word)
        every = np.arange(len(nodes))
        for i in range(longest):
            masks[every, self.text[nodes + i]] |= np.where(i < sizes, word(1 << i), word(0))
        masks[:, 0] = 0
        masks, row = masks.ravel(), row * 64
        top = (size - 1).astype(word)
        up, down = np.full(len(node), -1, dtype=np.int64).astype(word), np.zeros(len(node), dtype=word)
        score = size.astype(np.int16)
        found = score <= most
        first = place - most
        for j in range(longest + 2 * most):
            eq = masks[row + text[first + j]]
            x = eq | down
            d = (((x & up) + up) ^ up) | x
            h_up = down | ~(d | up)
            h_down = up & d
            score += (h_up >> top & one).astype(np.int16)
            score -= (h_down >> top & one).astype(np.int16)
            h_up <<= one
            h_down <<= one
            up = h_down | ~(d | h_up)
            down = h_up & d
            found |= score <= most
        return found

    def candidates(self, text: np.ndarray) -> Iterator[np.ndarray]:
        """Rows (place of a hit, item, place where it would start) of the leaves whose
        nodes are near; starts are rounded down to ``_STEP`` and given once a run."""
        padded = np.concatenate((np.zeros(_PAD, dtype=np.uint8), text, np.zeros(2 * _PAD, dtype=np.uint8)))
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n_held = 0
        for low in range(0, len(text), _CHARS):
            here = padded[low:low + _CHARS + 3 * _PAD]
            two = here[:-1].astype(np.uint16) << 6 | here[1:]
            windows = np.uint64(1) << here.astype(np.uint64)  # the classes of the next _WINDOW characters
            width = 1
            while width < _WINDOW:
                windows[:-width] |= windows[width:]
                width *= 2
            for place, leaf in joined(self.hits(here, two, len(text) - low)):
                keep = self.half_near(here, two, place + _PAD, leaf)
                place, leaf = place[keep], leaf[keep]
                keep = self.partner_near(windows, place + _PAD, leaf)
                held.append((place[keep] + low, leaf[keep]))
                n_held += len(held[-1][0])
                if n_held >= _HITS:
                    yield from self.checked(padded, held)
                    held, n_held = [], 0
        yield from self.checked(padded, held)

    def checked(self, padded: np.ndarray, held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
        if not held:
            return
        place, leaf = (np.concatenate(x) for x in zip(*held))
        for level, most in enumerate((1, 3, 7)):
            node, size = self.leaves[2 + 2 * level][leaf], self.leaves[3 + 2 * level][leaf]
            taken = np.flatnonzero((size > 0) & (size <= _NODE))
            which = leaf[taken]
            at = place[taken] - self.leaves[1][which] + node[taken] - self.starts[self.leaves[0][which]]
            # Leaves that put a node at one place are looked at once, and one of them goes on.
            _, once = np.unique(at * len(self.text) + node[taken], return_index=True)
            taken, at = taken[once], at[once]
            keep = (size == 0) | (size > _NODE)
            keep[taken] = self.near(padded, at + _PAD, node[taken], size[taken], most)
            place, leaf = place[keep], leaf[keep]
        if len(leaf):
            yield np.stack((place, self.leaves[0][leaf], (place - self.leaves[1][leaf]) // _STEP * _STEP))

    def leaks(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item_id, distance, start, end) of the best leak of each item
        in each text; start and end count characters of the normalised text."""
        joined = [" ".join(words_of(text)) for text in texts]
        first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in joined]))).astype(np.int64)
        found: dict[tuple[int, int], set[int]] = defaultdict(set)
        for place, item, start in self.candidates(self.classes_of("\n".join(joined))):
            text = np.searchsorted(first, place, "right") - 1
            for t, n, s in np.unique(np.stack((text, item, start)), axis=1).T.tolist():
                found[t, n].add(s - int(first[t]))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for (t, n), starts in found.items():
            item_id, wanted = self.items[n]
            d, end = self.best_part(wanted, joined[t], sorted(starts))
            most = allowed(len(wanted), self.max_edit)
            if d <= most and d < best.get((t, item_id), (most + 1,))[0]:
                best[t, item_id] = (d, max(0, end - len(wanted)), end)
        return [(t, item_id, *x) for (t, item_id), x in sorted(best.items())]

    def best_part(self, item: str, text: str, starts: list[int]) -> tuple[int, int]:
        """(least distance, end of the part) near any of the ``starts``, in order."""
        most = allowed(len(item), self.max_edit)
        at = text.find(item)  # a verbatim copy needs no distance
        if at >= 0:
            return 0, at + len(item)
        best = most + 1, -1
        runs: list[list[int]] = []
        for s in starts:
            low, high = max(0, s - most), min(len(text), s + _STEP + len(item) + most)
            if runs and low <= runs[-1][1]:
                runs[-1][1] = max(high, runs[-1][1])
            else:
                runs.append([low, high])
        for low, high in runs:
            d, end = distance_to_part(item, text[low:high], most)
            if d < best[0]:
                best = d, low + end
        return best


def joined(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The hits in runs of about ``_HITS``."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= _HITS:
            yield np.concatenate([p for p, _ in held]), np.concatenate([x for _, x in held])
            held, n = [], 0
    if held:
        yield np.concatenate([p for p, _ in held]), np.concatenate([x for _, x in held])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _seeds(text: np.ndarray, size: int) -> np.ndarray:
    """32 bits of a hash of the ``size`` classes from each place on."""
    n = max(0, len(text) - size + 1)
    keys = text[:n].astype(np.uint64)
    for j in range(1, size):
        keys <<= np.uint64(6)
        keys |= text[j:n + j]
    return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


def _spread(pair: np.ndarray) -> np.ndarray:
    return pair.astype(np.uint32) * np.uint32(0x85EBCA6B)


def _slots(mixed: np.ndarray, bits: np.uint32, out: np.ndarray | None = None) -> np.ndarray:
    out = np.multiply(mixed, np.uint32(0x9E3779B1), out=out)
    return np.right_shift(out, np.uint32(32) - bits, out=out)


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_bytes``, one on the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n = max(1, -(-size // block_bytes))
    dealt = items if n == 1 else written(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "benchmark-blocks")
    for b in range(n):
        part = dealt if n == 1 else dealt.filter(F.col("block") == b)
        yield [(r.item_id, r.text) for r in part.select("item_id", "text").distinct().orderBy("item_id", "text").collect()]


def _searcher(held, max_edit: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(held.value, max_edit)
        for batch in batches:
            for part in slices(batch):
                ids = part.column(0).to_pylist()
                hits = items.leaks(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[h[0]] for h in hits], pa.int64()), *[pa.array([h[i] for h in hits], pa.int64()) for i in range(1, 5)]],
                    names=["doc_id", "item_id", "distance", "start", "end"])

    return search


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT) -> DataFrame:
    """(doc_id, item_id, distance, start, end): each document's leaks."""
    found = []
    for rows in blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(rows)  # at most about BLOCK_BYTES
        found.append(id_text(docs).mapInArrow(_searcher(held, max_edit), "doc_id long, item_id long, distance long, start long, end long"))
    return reduce(DataFrame.unionByName, found)


def _cleaner(held, max_edit: float, at: int):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(held.value, max_edit)
        for batch in batches:
            for part in slices(batch, at):
                hit = {h[0] for h in items.leaks([t or "" for t in part.column(at).to_pylist()])}
                yield part.filter(pa.array([i not in hit for i in range(part.num_rows)], pa.bool_()))

    return clean


def drop_leaks(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT) -> DataFrame:
    """``docs`` (all its columns) without the documents that hold an item."""
    at = docs.columns.index("text")
    for rows in blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(rows)
        docs = docs.mapInArrow(_cleaner(held, max_edit, at), docs.schema)
    return docs
