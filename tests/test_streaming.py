"""A landing of several files: no row is lost to the marks of its own rows."""

import os

import pytest

from conftest import SMOKE

from alloy.operators import silver as S
from alloy.operators import state as ST
from alloy.session import scratch_path
from alloy.sinks import store
from alloy.sources import fixture as FX
from alloy.sources.grid import GRID_SCHEMA
from alloy.streaming.available_now import run_available_now

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")


def _land(spark, path, rows):
    spark.createDataFrame(rows, GRID_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _case(spark):
    header = list(FX.raw_grid(FX.load_events(spark, SMOKE), 0).filter("row_no = 2").first()["cells"])

    def row(n, day, sheet="s"):
        named = {"Tanggal": day, "Waktu Live": "09:30", "ID Kreator": f"id{n}"}
        return (sheet, "k", n, [named.get(name, "1") for name in header])

    return header, row


def _state(spark):
    registry = spark.createDataFrame([("s", "k", 0), ("t", "k", 1)], "sheet_name string, creds string, ord int")
    return registry, scratch_path(spark, "s-landing"), scratch_path(spark, "s-tables"), scratch_path(spark, "s-checkpoint")


def _bronze(spark, root):
    b = store.read_bronze(spark, root, S.BRONZE_SCHEMA)
    return sorted((r.sheet_name, r.row_no) for r in b.select("sheet_name", "row_no").collect())


def _marks(spark, root):
    return [r.last_processed_date for r in store.read_state(spark, root, "watermark", ST.WATERMARK_SCHEMA).collect()]


def test_later_files_of_a_landing_may_bring_earlier_days(spark):
    header, row = _case(spark)
    registry, landing, root, checkpoint = _state(spark)
    _land(spark, landing, [("s", "k", 2, header), row(3, "2024-01-20")])
    _land(spark, landing, [row(4, "2024-01-10"), row(5, "2024-01-20")])
    _land(spark, landing, [row(6, "2024-01-05")])
    # Parked: the sheet's header comes with the next landing.
    _land(spark, landing, [row(3, "2024-01-07", "t")])
    results = run_available_now(spark, landing, root, registry, checkpoint, files_per_batch=1)
    assert len(results) == 3
    assert _bronze(spark, root) == [("s", 3), ("s", 4), ("s", 5), ("s", 6)]
    assert _marks(spark, root) == ["2024-01-20"]
    # The next landing meets the moved mark, the parked row that of its own landing.
    _land(spark, landing, [("t", "k", 2, header), row(4, "2024-01-08", "t"), row(5, "2024-01-25", "t")])
    run_available_now(spark, landing, root, registry, checkpoint)
    assert _bronze(spark, root) == [("s", 3), ("s", 4), ("s", 5), ("s", 6), ("t", 3), ("t", 5)]
    assert _marks(spark, root) == ["2024-01-25"]
    assert len(store.silver_versions(spark, root)) == 2  # one merge a landing
    silver = store.read_silver(spark, root, S.SILVER_SCHEMA)
    assert sorted(r["id_kreator"] for r in silver.select("id_kreator").collect()) == ["ID3", "ID3", "ID4", "ID5", "ID5", "ID6"]
    assert store.read_state(spark, root, "unmerged", "load_id string").isEmpty()


def test_a_landing_that_fails_goes_on_as_one_run(spark, monkeypatch):
    """The second micro-batch dies: its retry adds what is missing, under the same run."""
    from alloy.streaming import available_now as AN

    header, row = _case(spark)
    registry, landing, root, checkpoint = _state(spark)
    _land(spark, landing, [("s", "k", 2, header), row(3, "2024-01-20")])
    _land(spark, landing, [row(4, "2024-01-10")])
    run, calls = AN.run_pipeline, []

    def dies(*args, **kw):
        calls.append(1)
        out = run(*args, **kw)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return out

    monkeypatch.setattr(AN, "run_pipeline", dies)
    with pytest.raises(Exception, match="lost"):
        run_available_now(spark, landing, root, registry, checkpoint, files_per_batch=1)
    assert store.silver_versions(spark, root) == []
    run_available_now(spark, landing, root, registry, checkpoint, files_per_batch=1)
    assert _bronze(spark, root) == [("s", 3), ("s", 4)]
    assert store.read_bronze(spark, root, S.BRONZE_SCHEMA).select("run_id").distinct().count() == 1
    assert store.read_silver(spark, root, S.SILVER_SCHEMA).count() == 2
    assert _marks(spark, root) == ["2024-01-20"]
