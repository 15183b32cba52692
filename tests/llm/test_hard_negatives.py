"""Hard-negative mining against a plain version of it."""

import math

import numpy as np
import pytest

from alloy.llm import hard_negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, anchor int, vector string, rank int"


def plain(rows):
    """The contract, row by row."""
    seen = set()
    for vec_id, embedding, label, *_ in rows:
        if vec_id is None or label is None or embedding is None or any(x is None or not math.isfinite(x) for x in embedding):
            continue
        seen.add((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in embedding)))
    out = []
    for a, label, v in seen:
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), r, lab) for r, lab, w in seen if r != a and len(w) == len(v))
        for score, positive, _ in [x for x in scored if x[2] == label][:5]:
            good = [(s, r) for s, r, lab in scored if lab != label and 50 * -score <= 100 * -s <= 95 * -score]
            out += [(a, positive, rank, r, -score, -s) for rank, (s, r) in enumerate(good[:3], 1)]
    return sorted(out)


def mined(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def of(spark, rows, **options):
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA).repartition(3)
    return mined(hard_negatives.mine(docs, "vec_id % 50 = 0", queries.MOVED_LABEL, **options))


def random_rows(n, dim, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, dim))
    labels = rng.integers(0, 10, n)
    vectors = (centres[labels] * spread + rng.normal(size=(n, dim)) * 0.2).astype(np.float32)
    return [(i, vectors[i].tolist(), int(labels[i])) for i in range(n)]


@pytest.mark.parametrize("dim,block_bytes", [(64, 8 << 20), (7, 2000)])
def test_equals_plain(spark, dim, block_bytes):
    rows = random_rows(900, dim, dim)
    got = of(spark, rows, block_bytes=block_bytes)
    assert got == plain(rows)
    assert len(got) > 50


def test_odd_rows(spark):
    rows = random_rows(300, 5, 1)
    common = [0.5, 0.25, 0.5, -0.125, 0.75]
    rows += [(1000 + i, common, i % 3) for i in range(120)]                 # ties: one vector in many rows
    rows += [(50, common, 1), (50, common, 1), (100, [1.0] * 5, 2)]         # repeated rows, one id with several vectors
    rows += [(None, common, 1), (2050, None, 1), (2100, common, None), (2150, [1.0, None, 1.0, 1.0, 1.0], 1), (2200, [float("nan")] * 5, 1),
             (2250, [float("inf")] * 5, 1), (2300, [], 1), (2301, [], 1), (2302, [], 2), (2350, [1.0, 2.0], 3), (2351, [1.0, 2.0], 3),
             (2352, [1.0, 1.0], 4), (2400, [0.0] * 5, 4)]
    got = of(spark, rows)
    assert got == plain(rows)
    assert {r[0] for r in got} >= {1050, 2300, 2350}
    assert of(spark, []) == []


def test_scores_beyond_a_doubles_integers(spark):
    rows = [(50 * i, [3e6 + i, 1.0 + i, 2e5], 1) for i in range(3)] + [(50 * i + 1, [2.7e6 + i, 2.0, 1e5], 2) for i in range(5)]
    got = of(spark, rows)
    assert got == plain(rows)
    assert max(r[4] for r in got) > 2 ** 53


def test_bounds_hold():
    rng = np.random.default_rng(4)
    vectors = np.floor(rng.normal(size=(60, 64)) * 100)
    means, deviations = hard_negatives.summaries(vectors)
    exact = vectors @ vectors.T
    at, widths = 0, []
    for segments in hard_negatives.SEGMENTS:
        level = slice(at, at + segments)
        at += segments
        middle, spread = means[:, level] @ means[:, level].T, deviations[:, level] @ deviations[:, level].T
        assert (exact <= middle + spread + 1e-6).all() and (exact >= middle - spread - 1e-6).all()
        widths.append(spread.mean())
    assert widths == sorted(widths, reverse=True)


def test_bounds_rule_pairs_out():
    rows = random_rows(400, 64, 9, spread=2.0)
    import pyarrow as pa

    vectors = np.floor(256 * np.array([r[1] for r in rows]))
    means, deviations = hard_negatives.summaries(vectors)
    binary = [pa.array([row.tobytes() for row in x], pa.binary()) for x in (vectors, means, deviations)]
    table = pa.table([pa.array([r[0] for r in rows]), pa.array([r[2] for r in rows]), pa.array([64] * 400, pa.int32()), *binary],
                     names=["vec_id", "label", "dim", "vector", "means", "deviations"])
    both = hard_negatives.Vectors(table, 64)
    low = np.sort(vectors @ vectors.T, axis=1)[:, -5].astype(float)
    a, r, scores = hard_negatives.scores_within(both, both, low, np.full(400, np.inf), np.ones((400, 400), dtype=bool))
    assert (scores != hard_negatives._NONE).sum() < 400 * 400 / 4
    exact = vectors @ vectors.T
    assert ((scores >= low[a, None]).sum(axis=1) == (exact >= low[:, None]).sum(axis=1)[a]).all()
