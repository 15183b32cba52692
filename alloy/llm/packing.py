"""Packing (operator 4): cost-balanced sequences of at most ``seq_len`` tokens.

Each input partition is tokenised once and packed on its own, in blocks of
``block_tokens``, so nothing is shuffled, no group can grow and a lost task is
redone alone. A document is cut into full sequences and one rest. The rests of
a block hold T tokens; their sequences are T // seq_len full ones and one for
each binary digit of T % seq_len, so every sequence is full or has a length
that is a power of two, and none is padded.

Placement estimates a piece of n tokens at ``linear * n + quadratic * n * n``
(attention is quadratic within a piece). Pieces in descending cost go to the
sequence of the lowest cost whose free tokens hold them; if none holds the
piece whole, it is cut: the lowest-cost sequence with any free token is filled
and the rest waits its turn.

Defined cases: null or empty text is the end token alone; a null doc_id stays
null; equal rows are packed each for itself; an empty table gives no pieces;
extra columns are ignored. A special token's string in a text is that token, as the
JSON file says.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from alloy.llm.common import id_text, slices

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long, sequence_cost double")


def rank_encoding(rank_file: str):
    """The byte-level BPE of a rank file; it knows no special tokens."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rank_encoder(rank_file: str, json_file: str, fast_of=lambda encoding: encoding.encode_ordinary):
    """text -> token ids, special tokens' strings being plain text. The rank file and
    the JSON file hold one vocabulary; the ranks are several times faster, the JSON
    file serves texts on which their splitter gives up (very long runs of white space)."""
    from tokenizers import Tokenizer

    fast = fast_of(rank_encoding(rank_file))
    slow: list = []

    def encode(text: str) -> list[int]:
        try:
            return fast(text)
        except (KeyboardInterrupt, SystemExit):
            raise
        except BaseException:  # the Rust side panics with a BaseException
            if not slow:
                slow.append(Tokenizer.from_file(json_file))
                slow[0].encode_special_tokens = True
            return slow[0].encode(text, add_special_tokens=False).ids

    return encode


def with_specials(encode: Callable[[str], list[int]], json_file: str) -> Callable[[str], list[int]]:
    """``encode`` on the parts of a text between the strings of the special tokens
    that the JSON file names, and these tokens' ids."""
    with open(json_file, encoding="utf-8") as f:
        specials = json.load(f)["added_tokens"]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in specials):
        raise ValueError("special tokens that reach beyond their string are not supported")
    ids = {t["content"]: t["id"] for t in specials}
    cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(ids, key=len, reverse=True)) + ")")

    def encoded(text: str) -> list[int]:
        out: list[int] = []
        for i, part in enumerate(cut.split(text) if ids else [text]):
            out += [ids[part]] if i % 2 else encode(part) if part else []
        return out

    return encoded


def default_tokenizer() -> tuple[str, str]:
    """Places of the public vocabulary as ranks and as JSON (on each machine)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def place(lengths: list[int], seq_len: int, linear: float, quadratic: float):
    """Pieces of ``lengths`` packed without padding.

    Returns (pieces, capacities, costs); a piece is (item, start, length,
    sequence, offset), start counted within the item."""
    total = sum(lengths)
    capacities = [seq_len] * (total // seq_len) + [1 << b for b in range(seq_len.bit_length() - 1, -1, -1)
                                                  if total % seq_len >> b & 1]
    free = np.array(capacities, dtype=np.int64)
    cost = np.zeros(len(capacities))
    waiting = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    pieces = []
    while waiting:
        n, item, start = heapq.heappop(waiting)
        n = -n
        fits = np.flatnonzero(free >= n)
        if len(fits) == 0:
            fits = np.flatnonzero(free > 0)
        seq = int(fits[np.argmin(cost[fits])])
        part = min(n, int(free[seq]))
        pieces.append((item, start, part, seq, capacities[seq] - int(free[seq])))
        free[seq] -= part
        cost[seq] += linear * part + quadratic * part * part
        if part < n:
            heapq.heappush(waiting, (part - n, item, start + part))
    return pieces, capacities, cost


def pack(docs: DataFrame, seq_len: int = 1024, linear: float = 1.0, quadratic: float = 1 / 1024, end_id: int = 0,
         block_tokens: int = 4 << 20, tokenizer: tuple[str, str] | None = None) -> DataFrame:
    """Pieces of all documents with their ids (little-endian unsigned 32-bit).

    ``start`` counts the document's ids before the piece, ``offset`` the
    sequence's ids before it. ``seq_len`` must be a power of two."""

    if seq_len & (seq_len - 1):
        raise ValueError("seq_len must be a power of two")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = tokenizer or default_tokenizer()
        encode = with_specials(rank_encoder(*files), files[1])
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        types = [pa.binary() if n == "ids" else pa.float64() if n == "sequence_cost" else pa.int64() for n in names]
        base = TaskContext.get().partitionId() << 40
        used = 0
        full_cost = linear * seq_len + quadratic * seq_len * seq_len
        out: list[tuple] = []
        rests: list[tuple] = []  # doc_id, ids, tokens before, tokens of the document
        held = 0

        def emit() -> pa.RecordBatch:
            rows, out[:] = list(zip(*out)), []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)

        def close_block() -> None:
            nonlocal used, held
            pieces, capacities, cost = place([len(r[1]) for r in rests], seq_len, linear, quadratic)
            for item, start, n, seq, offset in pieces:
                doc_id, ids, before, tokens = rests[item]
                out.append((doc_id, before + start, n, ids[start:start + n].astype("<u4").tobytes(), tokens,
                            base + used + seq, offset, capacities[seq], float(cost[seq])))
            used += len(capacities)
            rests.clear()
            held = 0

        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encode(text)
                    ids.append(end_id)
                    ids = np.array(ids, dtype=np.uint32)
                    full = len(ids) // seq_len
                    for k in range(full):
                        out.append((doc_id, k * seq_len, seq_len, ids[k * seq_len:(k + 1) * seq_len].astype("<u4").tobytes(),
                                    len(ids), base + used, 0, seq_len, full_cost))
                        used += 1
                    if len(ids) > full * seq_len:
                        rests.append((doc_id, ids[full * seq_len:], full * seq_len, len(ids)))
                        held += len(ids) - full * seq_len
                    if held >= block_tokens:
                        close_block()
                    if len(out) >= 4096:
                        yield emit()
        close_block()
        if out:
            yield emit()

    return id_text(docs).mapInArrow(packed, SCHEMA)
