"""What lets a run's time follow its rows: even landed files, bronze only where it is read, and written once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from alloy.operators import silver as S
from alloy.operators.bronze import RunInfo
from alloy.plans import catalog, pipeline as P
from alloy.session import scratch_path
from alloy.sinks import store
from alloy.sources import fixture as FX


def _events(spark, n, parts=1):
    ids = spark.range(0, n, 1, parts)
    return ids.select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id % 30, id % 24)").alias("ts"),
        (F.col("id") % 50).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") % 90 + 0.5).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 70).alias("props"))


@pytest.fixture(scope="module")
def folder(spark):
    path = scratch_path(spark, "growth-events")
    _events(spark, 20_500).write.parquet(f"{path}/events.parquet")  # one file with one row group
    return path


def test_landed_files_are_even(spark, folder):
    """However few row groups the events have, the grid lands in files of about one size."""
    assert FX.load_events(spark, folder).rdd.getNumPartitions() == 1
    grid = FX.landed_grid(spark, folder, 0).filter("row_no >= 3")
    sizes = [r["count"] for r in grid.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 20_500 and len(sizes) == 4 and max(sizes) < 2 * min(sizes)


def test_small_and_empty_events_land(spark):
    for n in (0, 1, 10):
        assert FX.raw_grid(_events(spark, n), 0).filter("row_no >= 3").count() == n
    same = _events(spark, 10).withColumn("event_id", F.lit(None).cast("long"))
    assert FX.dealt(same.unionByName(same)).count() == 20  # null and repeated ids stay


def test_rows_and_state_need_no_bronze(spark, folder):
    catalog.forget_scenarios()
    sc = catalog.scenario(spark, folder)
    try:
        assert catalog.SPARK_QUERIES["regular_rows"](spark, folder).count() > 0
        assert not {"bronze1", "bronze2"} & set(vars(sc))
        assert catalog.SPARK_QUERIES["bronze_two_paths"](spark, folder).count() > 0
        assert "bronze2" in vars(sc)
    finally:
        catalog.forget_scenarios()


def test_bronze_is_written_once(spark, monkeypatch):
    """First rows go to the table at once; a run without rows leaves what is there."""
    kept = []
    cut_with = P.cut_with
    monkeypatch.setattr(P, "cut_with", lambda df, how, columns: kept.append(df.columns) or cut_with(df, how, columns))
    rows = _events(spark, 300)
    raw = FX.raw_sheet(rows, 0)
    registry = FX.sheet_registry(rows)
    root = scratch_path(spark, "bronze-once")
    run = RunInfo.at("2024-02-01 00:00:00", "a")
    empty = P.run_pipeline(spark, raw.filter("false"), root, run, registry)
    assert empty.n_bronze == 0 and store.read_bronze(spark, root) is None
    first = P.run_pipeline(spark, raw, root, run, registry)
    assert not [c for c in kept if "row_hash_raw" in c]
    bronze = store.read_bronze(spark, root, S.BRONZE_SCHEMA)
    assert first.n_bronze == bronze.count() == bronze.select("row_hash_raw").distinct().count() > 0
    again = P.run_pipeline(spark, raw, root, run, registry, watermark_by_day=True)
    assert again.n_bronze == 0 and store.read_bronze(spark, root, S.BRONZE_SCHEMA).count() == first.n_bronze


def test_write_bronze_counts(spark):
    day = dt.datetime(2024, 1, 5)
    run = RunInfo.at("2024-02-01 00:00:00", "a")
    for mode in store.MODES:
        df = spark.createDataFrame([(day, "x"), (None, "y"), (day, "z")], "tanggal timestamp_ntz, row_hash_raw string")
        assert store.write_bronze(df, scratch_path(spark, f"counted-{mode}"), run, mode) == 3


def test_scratch_tables_are_zstd(spark):
    from alloy.operators.common import measured

    kept = measured(spark.range(1000), "zstd")
    assert all(".zstd." in f for f in kept.inputFiles())


@pytest.mark.parametrize("name", ["session_split_by_time", "bronze_new_column"])
def test_a_source_that_is_read_again_is_kept(spark, folder, name):
    """The merge reads its source in several branches: none works it out once more."""
    plan = catalog.all_queries()[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan and "min_by" not in plan


def test_a_session_made_elsewhere_compiles_its_methods(spark, folder, monkeypatch):
    other = spark.newSession()
    name = "spark.sql.codegen.hugeMethodLimit"
    other.conf.set(name, "65535")  # Spark's own
    monkeypatch.setattr(catalog, "_SCENARIOS", {})
    own = other.sparkContext.getConf()
    monkeypatch.setattr(type(own), "contains", lambda self, key: False)  # no deployment has set it
    catalog.scenario(other, folder)
    assert other.conf.get(name) == "8000"
    monkeypatch.setattr(type(own), "contains", lambda self, key: True)
    other.conf.set(name, "65535")
    catalog.forget_scenarios()
    catalog.scenario(other, folder)
    assert other.conf.get(name) == "65535"
