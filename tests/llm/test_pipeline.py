"""The corpus pipeline, stage by stage against plain versions."""

import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
from helpers import odd_rows, sentence  # noqa: E402
from test_exact_sharding_packing import _check_packing, _groups  # noqa: E402
from test_near_suffix_decontam import components  # noqa: E402

import corpus_pipeline  # noqa: E402
from alloy.llm import decontam, toxicity  # noqa: E402


def _folder(spark, tmp_path, docs, labels, items):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages(spark, tmp_path):
    item = sentence(40, 321)
    docs = odd_rows() + [(100 + i, sentence(50, 3000 + i) + (" vileword" if i % 4 == 0 else ""), "en", "a", 0) for i in range(120)]
    docs += [(500, sentence(30, 600) + " " + item + " end", "en", "a", 0), (501, docs[20][1], "en", "a", 0)]
    labels = [(100 + i, 1, int(i % 4 == 0)) for i in range(100)]
    sf = _folder(spark, tmp_path, docs, labels, [(1, item)])
    read = spark.read.parquet(f"{sf}/documents.parquet")
    at = read
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf)
        assert at.columns == read.columns
        seen.append((name, [(r.doc_id, r.text) for r in at.collect()]))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dup", "decontamination", "packing"]
    toxic = {r.doc_id for r in toxicity.score(read, toxicity.fit_chain(read, spark.read.parquet(f"{sf}/labels.parquet"))).filter("toxic").collect()}
    assert {100 + i for i in range(120) if i % 4 == 0} <= toxic
    clean = dict(seen)["toxicity"]
    assert sorted(map(repr, clean)) == sorted(repr((d[0], d[1])) for d in docs if d[0] not in toxic)
    exact = dict(seen)["exact_dedup"]
    assert sorted(str(d) for d, _ in exact) == sorted(str(keep) for _, keep in {(g[4], g[1]) for g in _groups(clean)})
    near = dict(seen)["near_dup"]
    expected = components(exact)
    assert sorted(d for d, _ in near if d is not None) == sorted(set(expected.values()))
    left = dict(seen)["decontamination"]
    assert {d for d, _ in near} - {d for d, _ in left} == {500}
    pieces = corpus_pipeline.run(spark, sf).collect()
    _check_packing(left, pieces)


def test_nothing_in_nothing_out(spark, tmp_path):
    sf = _folder(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, sf).count() == 0
    assert decontam.find_leaks(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
