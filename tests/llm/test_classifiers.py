"""Operators 5 and 10."""

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import no_docs, odd_docs, odd_rows, sentence  # noqa: E402

from alloy.llm import linear, quality, toxicity  # noqa: E402

LABELS = "doc_id long, quality int, toxic int"


def _corpus(n=400):
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        text = sentence(60, 1000 + i) + (" vileword" if bad and i % 2 else " Foulling!" if bad else "")
        rows.append((i, text, "en", "a", 0))
        labels.append((i, int(i % 7 != 0), int(bad)))
    return rows, labels


def test_chain_on_held_out_documents(spark):
    rows, labels = _corpus()
    known = spark.createDataFrame([x for x in labels if x[0] < 300] + [(None, 1, 1), (5, None, 1), (1, 1, 0)], LABELS)
    docs = odd_docs(spark, rows)
    weights = toxicity.fit_chain(docs, known)
    assert len(weights) == 2 and len(weights[1]) == len(weights[0]) + 1  # the later model takes the earlier probability
    scored = {r.doc_id: r.toxic for r in toxicity.score(docs, weights).collect()}
    held_out = [x for x in labels if x[0] >= 300]
    assert all(scored[d] == bool(t) for d, _, t in held_out)
    kept = toxicity.drop_toxic(docs, known)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, toxic in scored.items() if not toxic}


def test_chain_odd_rows(spark):
    docs = odd_docs(spark)
    n = len(odd_rows())
    for rows in ([], [(1, 1, 0), (2, 1, 0)], [(2, 1, 1), (2, 0, 0), (3, 0, 0), (4, 1, 1)]):
        labels = spark.createDataFrame(rows, LABELS)
        scored = toxicity.score(docs, toxicity.fit_chain(docs, labels)).collect()
        assert len(scored) == n and all(0.0 <= r.p_toxic <= 1.0 for r in scored)
        if len(rows) < 3:
            assert not any(r.toxic for r in scored)
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert toxicity.drop_toxic(no_docs(spark), labels).count() == 0


def test_chain_bound_on_labels(spark):
    rows, labels = _corpus(60)
    chosen = spark.createDataFrame(labels, LABELS)
    weights = toxicity.fit_chain(odd_docs(spark, rows), chosen, max_labelled=20)
    assert len(weights) == 2


def test_out_of_fold_predictions_differ_from_fitted():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(5000, 30, replace=False)) for _ in range(80)]
    y = rng.integers(0, 2, 80).astype(float)
    none = np.zeros((80, 0))
    seen = linear.fit(rows, y, none)
    unseen = linear.fit(rows[40:], y[40:], none[40:])
    hits = lambda w: np.mean([(linear.margin(w, x) > 0) == bool(t) for x, t in zip(rows[:40], y[:40])])
    assert hits(seen) > hits(unseen) + 0.2  # labels are noise: only a model that saw them knows them


def test_em_finds_the_accurate_labellers():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.8
    m = len(quality.LABELLERS)
    accuracy = [0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.9, 0.6, 0.55]
    counts: dict[int, int] = {}
    voted = []
    for t in truth:
        v = tuple(quality.ABSTAIN if rng.random() < 0.2 else (quality.GOOD if (rng.random() < a) == t else quality.LOW)
                  for a in accuracy[:m])
        voted.append(quality.pattern(v))
        counts[voted[-1]] = counts.get(voted[-1], 0) + 1
    posterior = quality.estimate(counts)
    hits = np.mean([(posterior[c] > 0.5) == t for c, t in zip(voted, truth)])
    votes = [[c // 3 ** (m - 1 - j) % 3 for j in range(m)] for c in voted]
    majority = np.mean([(v.count(quality.GOOD) >= v.count(quality.LOW)) == t for v, t in zip(votes, truth)])
    assert hits > 0.95 and hits > majority
    assert quality.estimate({}) == {}


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = {r.doc_id: r.good for r in quality.score_quality(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()  # never seen by the operator
    hits = np.mean([scored[r.doc_id] == bool(r.quality) for r in labels])
    assert hits >= 0.93


def test_quality_odd_rows(spark):
    scored = quality.score_quality(odd_docs(spark)).collect()
    assert len(scored) == len(odd_rows()) and all(0.0 <= r.score <= 1.0 for r in scored)
    assert quality.score_quality(no_docs(spark)).count() == 0


def test_a_shape_is_of_the_whole_token():
    cells = linear.Cells(shapes=True)
    start = "aB3-" * 16
    assert cells[start + "xxxx"][-1] != cells[start + "7777"][-1]
    assert cells[start + "xxxx"][-1] == cells[start + "yyyyyyy"][-1]


def test_scorer_keeps_only_cells_with_a_weight():
    """The margin is that of all cells; a token without any keeps no cell, so that more tokens fit."""
    w = np.zeros(linear.DIMS + 1)
    every = linear.Cells(True)
    text = "The Quick brown fox-trot 12,5% naïve ÉCOLE !!! running runner " * 2
    w[every.of("Quick running")] = np.arange(1, 1 + len(every.of("Quick running"))) / 8
    known = linear.Cells(True, w)
    assert linear.margin(w, known.of(text)) == pytest.approx(linear.margin(w, every.of(text)), abs=1e-12)
    assert len(known.of(text)) == np.count_nonzero(w[every.of(text)]) < len(every.of(text))
    assert known["zzz,"] == () and every["zzz,"] != ()
    tokens = [f"w{i}" for i in range(150_000)]
    for t in tokens:
        known[t]
    assert len(known) > 150_000
