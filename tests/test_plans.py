"""Physical-plan properties the design relies on at scale."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from alloy.operators import bronze as B
from alloy.operators import silver as S
from alloy.sources import grid as G
from conftest import SMOKE


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # run once so AQE shows the final plan
    return df._jdf.queryExecution().executedPlan().toString()


def _grid(spark):
    rows = [("a", "k", 2, ["X", "Y"]), ("b", "k", 2, ["Y", "X"])] + [
        ("a" if i % 3 else "b", "k", 3 + i, [str(i), str(i % 7)]) for i in range(200)]
    return spark.createDataFrame(rows, G.GRID_SCHEMA)


def test_header_promotion_has_no_shuffle(spark):
    plan = _plan(G.grid_to_frame(_grid(spark)))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def _bronze(spark):
    d = dt.datetime(2024, 1, 5)
    rows = [("s", "k", i, d, "T", "U", i % 3, d, "r", f"h{i % 5}", 0) for i in range(300)]
    return spark.createDataFrame(rows, "sheet_name string, creds string, row_no bigint, tanggal timestamp_ntz, "
                                       "toko string, id_kreator string, pukul_live int, snapshot_ts timestamp_ntz, "
                                       "run_id string, row_hash_raw string, path int")


def test_dedup_and_latest_aggregate_before_the_shuffle(spark):
    for df in (B.dedup_first(_bronze(spark)), S.latest_per_session(_bronze(spark).drop("path"))):
        plan = _plan(df)
        assert "partial_min_by" in plan or "partial_max_by" in plan
        assert "Window" not in plan


def test_watermark_lookup_does_not_shuffle_the_rows(spark):
    """One row per source is broadcast behind the size check."""
    valid = _bronze(spark).drop("path", "row_hash_raw", "snapshot_ts", "run_id", "pukul_live")
    valid = valid.withColumnRenamed("tanggal", "Tanggal")
    wm = spark.createDataFrame([("k", "2024-01-01")], "creds string, last_processed_date string")
    b, _ = B.build_bronze(valid, B.RunInfo.at("2024-01-16 00:00:00", "r"), wm)
    plan = _plan(b)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_a_large_side_is_not_broadcast(spark, monkeypatch):
    from alloy.operators import common

    monkeypatch.setattr(common, "BROADCAST_MAX_BYTES", 1)
    df = common.measured(spark.range(1000), "large")
    assert common.small(df, common.BROADCAST_MAX_BYTES) is df


def test_recovered_split_does_not_shuffle_the_rows(spark):
    """Recovered keys are broadcast behind the size check."""
    from alloy.operators import state as ST

    valid = spark.createDataFrame([("s", "k", dt.datetime(2024, 1, 5), i) for i in range(50)],
                                  "sheet_name string, creds string, Tanggal timestamp_ntz, row_no bigint")
    resolved = spark.createDataFrame([("s", "k", "2024-01-05", ["A"], 50, "t", "p", "open")], ST.MANIFEST_SCHEMA)
    counts = ST.valid_counts(valid)
    recovered, regular = ST.split_recovered(valid, resolved, counts)
    assert recovered.count() == 50 and regular.count() == 0
    plan = _plan(regular)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_scan_prunes_columns_and_pushes_filters(spark):
    from alloy.sources import fixture as FX

    grid = FX.landed_grid(spark, SMOKE, 1)
    df = grid.filter(F.col("row_no") == 2).select("sheet_name", "cells")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(row_no), EqualTo(row_no,2)]" in plan
    assert "ReadSchema: struct<sheet_name:string,row_no:bigint,cells:array<string>>" in plan


def _files_read(df):
    """Files that the scans of ``df`` read when it runs."""
    df = df.select("*")  # a plan of its own: a scan counts its files once
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.getClass().getSimpleName() else plan
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.metrics().contains("numFiles"):
            total += node.metrics().apply("numFiles").value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
    return total


def test_by_day_merge_reads_touched_days_only(spark):
    from alloy.session import scratch_path
    from alloy.sinks import store

    root = scratch_path(spark, "by-day")
    days = spark.range(40).selectExpr("id", "IF(id = 39, NULL, date_add(date'2024-01-01', CAST(id AS int))) AS tanggal")
    store.commit_days(spark, root, store.stage_days(days, root), store.distinct_days(days, "tanggal"))
    whole = store.read_silver_by_day(spark, root, "id bigint, tanggal date")
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, days.collect()), key=str)
    one = store.read_silver_by_day(spark, root, "id bigint, tanggal date", store.distinct_days(days.filter("id IN (4, 39)"), "tanggal"))
    assert sorted(r["id"] for r in one.collect()) == [4, 39]
    assert _files_read(one) == 2


def test_bronze_scan_reads_touched_days_only(spark):
    from alloy.operators import bronze as B
    from alloy.session import scratch_path
    from alloy.sinks import store

    root = scratch_path(spark, "bronze-days")
    rows = spark.range(30).selectExpr("id", "IF(id = 29, NULL, timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(CAST(id AS int))) AS tanggal")
    store.write_bronze(rows, root, B.RunInfo.at("2024-02-01 00:00:00", "r"))
    schema = "id bigint, tanggal timestamp_ntz, date string, run_key string, load_id string, day date"
    some = store.of_days(store.read_bronze(spark, root, schema), store.distinct_days(rows.filter("id IN (2, 7, 29)"), "tanggal"))
    assert sorted(r["id"] for r in some.collect()) == [2, 7, 29]
    assert _files_read(some) == 3


def test_bucketed_merge_does_not_move_silver(spark):
    """The target's side of the merge has no exchange, and each bucket is one file."""
    from alloy.session import scratch_path
    from alloy.sinks import buckets, store

    root = scratch_path(spark, "bucketed-plan")

    def source(n, tag):
        cols = {"tanggal": "date_add(date'2024-01-01', CAST(id % 3 AS int))", "toko": "concat('s', id)", "id_kreator": "concat('c', id % 7)", "pukul_live": "IF(id % 5 = 4, NULL, 1L)",
                "row_hash_clean": f"'{tag}'"}
        types = dict(x.strip().split(" ", 1) for x in re.split(r",(?![^(]*[)])", S.SILVER_SCHEMA))
        return spark.range(n).selectExpr(*[f"CAST({cols.get(c, 'NULL')} AS {types[c]}) AS {c}" for c in S.SILVER_COLS])

    buckets.upsert_bucketed(spark, root, source(100, "a"), buckets=4)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        keyed, _ = buckets.merged(spark, root, source(60, "b"))
        plan = keyed._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        buckets.upsert_bucketed(spark, root, source(60, "b"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert len(store.data_files(spark, f"{root}/silver_buckets/v=0000000002/keyed")) == 4
    got = buckets.read_bucketed(spark, root)
    assert sorted((r["row_hash_clean"], r["n"]) for r in got.groupBy("row_hash_clean").agg(F.count("*").alias("n")).collect()) == [("a", 52), ("b", 60)]


def test_observed_report_takes_no_job(spark):
    """A run's report comes with the write of the flagged frame."""
    from alloy.operators import validate as V
    from alloy.operators.common import measured, observed

    raw = spark.range(50).selectExpr("IF(id % 7 = 0, 'x', '2024-01-15') AS Tanggal", "CAST(id AS string) AS Komentar")
    flagged = V.flag(raw, ("Komentar",), ())

    def jobs(name, action):
        spark.sparkContext.setJobGroup(name, name)
        out = action()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    (kept, seen), with_report = jobs("observed", lambda: observed(flagged, "flagged", V.report_columns()))
    _, without = jobs("kept", lambda: measured(flagged, "flagged"))
    assert with_report == without
    assert seen == V.report(kept).first().asDict()


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_stream_available_now_matches_batch(spark):
    """Two landed files through the availableNow stream give the two-run silver table."""
    import duckdb

    import __spark_entry__ as E
    from tools.check_oracle import digest

    df = E.queries()["stream_available_now"](spark, SMOKE)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SMOKE}/events.parquet')")
    rel = con.sql(E.oracle_sql()["stream_available_now"])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


def test_silver_version_skips_a_failed_write(spark):
    """A half-written version folder (no _SUCCESS) is neither read nor reused."""
    import os as _os

    from alloy.session import scratch_path
    from alloy.sinks import store

    root = scratch_path(spark, "silver-versions")
    first = S.empty_silver(spark)
    assert store.write_silver(first, root, spark) == 1
    broken = f"{root}/silver/v={2:010d}"
    _os.makedirs(broken.replace("file:", ""), exist_ok=True)
    assert store.silver_versions(spark, root) == [1]
    assert store.write_silver(first, root, spark) == 3
    assert store.silver_versions(spark, root) == [1, 3]
