"""Quality classifier (operator 10): weak labels, then a hashed linear scorer.

Heuristic labellers look at a whole text and vote good, low or nothing. Spark
counts how often each pattern of votes occurs over all documents; patterns are
at most 3 ** labellers, whatever the corpus. Expectation-maximisation on these
counts estimates the share of good documents and what each labeller says of
either class, abstention included; labellers overlap and none is trusted. A
document's posterior is that of its pattern. The posteriors of at most
``max_sample`` documents (the first by a hash of doc_id) train a hashed linear
model on words and token shapes, which scores every document.

Defined cases: null or empty text has its own votes and no features, so it gets
the bias; a null doc_id is scored, but not used for training; of several
documents with one doc_id one is used for training, all are scored; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from alloy.llm import linear
from alloy.llm.common import id_text, slices, written
from alloy.llm.toxicity import sample_features

MAX_SAMPLE = 12_000
ABSTAIN, LOW, GOOD = 0, 1, 2
LABELLERS = ("symbols", "upper", "function_words", "repeated_lines", "length", "word_length", "line_ends", "bars", "repeated_words")
#: Frequent function words of the languages that the corpus is expected to hold.
FUNCTION_WORDS = frozenset(
    "the of and to in a is that it for was on are as with be this by from or an at "
    "der die das und in zu den von mit ist des auf für nicht dem ein eine als auch es "
    "de la que el en y los se del las un por con una su para es al lo "
    "le les et des est du une dans qui pour pas sur au avec ce il sont".split())


def _byte_kinds() -> np.ndarray:
    """0 lower case and other letters, 1 upper case, 2 digit, 3 space, 4 plain punctuation, 5 symbol, 6 bar."""
    kinds = np.zeros(256, dtype=np.uint8)
    kinds[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
    kinds[list(b"0123456789")] = 2
    kinds[list(b" \t\n\x0b\x0c\r")] = 3
    kinds[list(b".,;:?\"'()-/")] = 4
    kinds[list(b"!#$%&*+<=>@[\\]^_`{}~")] = 5
    kinds[ord("|")] = 6
    return kinds


def _vote(low: bool, good: bool) -> int:
    return LOW if low else GOOD if good else ABSTAIN


def votes(text: str, kinds: np.ndarray) -> tuple[int, ...]:
    """One vote for each of LABELLERS."""
    data = text.encode()
    n = np.bincount(kinds[np.frombuffer(data, dtype=np.uint8)], minlength=7) if data else np.zeros(7, dtype=np.int64)
    words = text.split()
    size = max(1, len(data))
    letters = max(1, int(n[0] + n[1]))
    lines = [line for line in text.split("\n") if line.strip()]
    common = sum(map(FUNCTION_WORDS.__contains__, words)) / max(1, len(words))
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
    ends = sum(line.rstrip()[-1] in ".!?" for line in lines) / max(1, len(lines))
    mean = (size - int(n[3])) / max(1, len(words))
    echo = sum(map(eq, words, words[1:])) / max(1, len(words))
    symbols, upper, bars = n[5] / size, n[1] / letters, n[6] / max(1, len(words))
    return (
        _vote(symbols > 0.04, symbols < 0.01),
        _vote(upper > 0.25, upper < 0.08),
        _vote(common < 0.08, common > 0.16),
        _vote(repeated > 0.2, len(lines) >= 3 and repeated < 0.05),
        _vote(len(words) < 8, 30 <= len(words) <= 20_000),
        _vote(mean < 2.5 or mean > 8.5, 3.5 < mean < 7),
        _vote(ends < 0.4, ends > 0.8),
        _vote(bars > 0.05, bars == 0),
        _vote(echo > 0.1, len(words) >= 8 and echo < 0.02),
    )


def pattern(found: tuple[int, ...]) -> int:
    code = 0
    for v in found:
        code = code * 3 + v
    return code


def estimate(counts: dict[int, int], rounds: int = 200, smoothing: float = 0.1) -> dict[int, float]:
    """Posterior of good for each pattern, by expectation-maximisation from the
    majority vote."""
    if not counts:
        return {}
    m = len(LABELLERS)
    codes = sorted(counts)
    v = np.array([[code // 3 ** (m - 1 - j) % 3 for j in range(m)] for code in codes])
    weight = np.array([counts[c] for c in codes], dtype=float)
    good, low = (v == GOOD).sum(axis=1), (v == LOW).sum(axis=1)
    # A low vote is rarer and says more; a tie is open.
    p = np.clip(0.5 + 0.15 * good - 0.3 * low, 0.05, 0.95)
    for _ in range(rounds):
        share = np.array([(weight * (1 - p)).sum(), (weight * p).sum()]) + smoothing
        log = np.log(share / share.sum())[None, :].repeat(len(codes), axis=0)
        for j in range(m):
            said = np.stack([np.bincount(v[:, j], weights=weight * q, minlength=3) for q in (1 - p, p)]) + smoothing
            log += np.log(said / said.sum(axis=1, keepdims=True))[:, v[:, j]].T
        new = linear.sigmoid(log[:, 1] - log[:, 0])
        done = np.abs(new - p).max() < 1e-9
        p = new
        if done:
            break
    return dict(zip(codes, p.tolist()))


def fit_quality(docs: DataFrame, max_sample: int = MAX_SAMPLE) -> tuple[dict[int, float], np.ndarray]:
    """(posterior of each vote pattern, weights of the linear scorer)."""

    def vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _byte_kinds()
        for batch in batches:
            for part in slices(batch):
                codes = [pattern(votes(t, kinds)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(codes, pa.int32())], names=["doc_id", "pattern"])

    voted = written(id_text(docs).mapInArrow(vote_rows, "doc_id long, pattern int"), "votes")
    counts = {r.pattern: r.n for r in voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()}  # 3 ** labellers at most
    posterior = estimate(counts)
    chosen = (voted.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("pattern").alias("pattern"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_sample))
    rows = sample_features(docs, chosen, shapes=True)

    def fit_all(key, group):
        import pandas as pd

        group = group.sort_values("doc_id")
        w = linear.fit([np.frombuffer(c, "<u4").astype(np.int64) for c in group["cells"]],
                       np.array([posterior.get(int(x), 0.5) for x in group["pattern"]]), np.zeros((len(group), 0)))
        return pd.DataFrame({"weights": [w.tobytes()]})

    made = rows.groupBy(F.lit(0).alias("all")).applyInPandas(fit_all, "weights binary").head()  # max_sample rows
    return posterior, np.frombuffer(made.weights) if made else linear.fit([], np.zeros(0), np.zeros((0, 0)))


def score_quality(docs: DataFrame, threshold: float = 0.5, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """(doc_id, votes, posterior, score, good) for every document."""
    posterior, w = fit_quality(docs, max_sample)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, known = _byte_kinds(), linear.Cells(True, w)
        for batch in batches:
            for part in slices(batch):
                texts = part.column(1).to_pylist()
                codes = [pattern(votes(t, kinds)) for t in texts]
                p = [float(linear.sigmoid(linear.margin(w, known.of(t)))) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(codes, pa.int32()), pa.array([posterior.get(c, 0.5) for c in codes], pa.float64()),
                     pa.array(p, pa.float64()), pa.array([x > threshold for x in p], pa.bool_())],
                    names=["doc_id", "votes", "posterior", "score", "good"])

    return id_text(docs).mapInArrow(scored, "doc_id long, votes int, posterior double, score double, good boolean")
