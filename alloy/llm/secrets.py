"""Secret scans (operator 7): character Markov models compared by likelihood ratio.

Base rules find assigned secrets, access keys and hex strings. The strings they
find are the labelled sample of random text; all other text is the sample of
ordinary identifiers and words. Spark counts character transitions of both over
all documents (two square tables of ``N_CLASSES`` classes are all that the
driver sees), and a second pass scores every token of ``MIN_TOKEN`` characters (the
shortest secret that the base rules know) that does not lie within a base span: it is
reported as ``markov`` if its transitions are likelier under the random model by
``min_llr`` nats in all and ``min_per_char`` a character. Where a base span lies within
a longer token, both are reported.

Defined cases: null or empty text has no spans; a null doc_id stays null; equal
rows are scanned each for itself; with no base hit anywhere there is no random
sample and nothing is added; an empty table gives no rows; extra columns are
ignored. Whole texts are scanned, of any length. Positions are code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from alloy.llm.common import id_text, slices

KINDS = ("assign", "access", "hex", "markov")
BASE_KINDS = KINDS[:3]
N_CLASSES = 64  # a-z, A-Z, 0-9, other ASCII of tokens, all else

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run, so a shorter one would have been dropped
MIN_TOKEN = 12
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN)
CUES = ("passw", "secret", "token", "key")

SPANS = "array<struct<kind:string,start:long,end:long>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def base_spans(text: str, longest: int | None = None) -> list[tuple[str, int, int]]:
    """Spans of the base rules by start, then kind. ``longest``: length of the
    longest run without white space, if known; it rules out whole texts."""
    if longest is None:
        longest = max(map(len, text.split()), default=0)
    found = []
    low = text.lower()  # for the cues only: positions in it are not used
    if any(c in low for c in CUES):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if longest >= 16:
        if "AKIA" in text:
            found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


def _classes() -> np.ndarray:
    table = np.full(256, 63, dtype=np.uint16)
    for first, chars in ((0, b"abcdefghijklmnopqrstuvwxyz"), (26, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (52, b"0123456789")):
        table[list(chars)] = np.arange(first, first + len(chars))
    table[list(b"+/_=-")] = 62
    return table


def transitions(data: bytes, table: np.ndarray) -> np.ndarray:
    """Counts of neighbouring classes in ``data``, as one long row."""
    c = table[np.frombuffer(data, dtype=np.uint8)]
    return np.bincount(c[:-1] * N_CLASSES + c[1:], minlength=N_CLASSES * N_CLASSES)


def train(docs: DataFrame, smoothing: float = 0.5) -> np.ndarray | None:
    """Log-likelihood ratio of each transition, random over ordinary; None without
    a base hit in the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _classes()
        every = np.zeros(N_CLASSES * N_CLASSES, dtype=np.int64)
        random = np.zeros_like(every)
        for batch in batches:
            for part in slices(batch):
                texts = part.column(1).to_pylist()
                every += transitions("\n".join(texts).encode() + b"\n", table)
                for text in texts:
                    spans = [text[s:e] for _, s, e in base_spans(text)]
                    if spans:
                        # The value, not its cue: from the last separator on.
                        values = [re.split(r"[\s:=\"']", x)[-1] or x for x in spans]
                        random += transitions("\n".join(values).encode(), table)
        for label, counts in (("random", random), ("every", every)):
            cells = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(cells), pa.string()), pa.array(cells, pa.int64()),
                                              pa.array(counts[cells], pa.int64())], names=["label", "cell", "n"])

    counted = id_text(docs).mapInArrow(count, "label string, cell long, n long").groupBy("label", "cell").agg(F.sum("n").alias("n"))
    tables = {"random": np.zeros(N_CLASSES * N_CLASSES), "every": np.zeros(N_CLASSES * N_CLASSES)}
    for r in counted.collect():  # two tables of N_CLASSES squared cells at most
        tables[r.label][r.cell] = r.n
    if not tables["random"].any():
        return None

    def log_p(counts: np.ndarray) -> np.ndarray:
        square = np.maximum(counts, 0).reshape(N_CLASSES, N_CLASSES) + smoothing
        return np.log(square / square.sum(axis=1, keepdims=True))

    return log_p(tables["random"]) - log_p(tables["every"] - tables["random"])


def find_secrets(docs: DataFrame, min_llr: float = 12.0, min_per_char: float = 0.5) -> DataFrame:
    """(doc_id, spans) for every document; spans by start, then kind."""
    model = train(docs)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _classes()
        for batch in batches:
            for part in slices(batch):
                rows = []
                for text in part.column(1).to_pylist():
                    longest = max(map(len, text.split()), default=0)
                    spans = base_spans(text, longest)
                    if model is not None and longest >= MIN_TOKEN:
                        base = list(spans)
                        for m in TOKEN.finditer(text):
                            s, e = m.span()
                            c = table[np.frombuffer(m[0].encode(), dtype=np.uint8)]
                            llr = float(model[c[:-1], c[1:]].sum())
                            if llr >= min_llr and llr >= min_per_char * (e - s) and not any(a <= s and e <= b for _, a, b in base):
                                spans.append(("markov", s, e))
                        spans.sort(key=lambda x: (x[1], KINDS.index(x[0])))
                    rows.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, _SPAN_TYPE)], names=["doc_id", "spans"])

    return id_text(docs).mapInArrow(scan, f"doc_id long, spans {SPANS}")


def span_columns(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """doc_id, a count for each base kind, base_sha256 and spans as text."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def only(*chosen):
        return F.filter("spans", lambda s: s["kind"].isin(*chosen))

    return found.select("doc_id", *[F.size(only(k)).cast("long").alias(f"n_{k}") for k in kinds],
                        F.sha2(text(only(*kinds)).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
