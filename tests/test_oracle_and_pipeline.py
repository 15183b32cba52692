"""Registered queries against their DuckDB oracle (sf0.001), and the two-run pipeline."""

import os

import duckdb
import pytest

from conftest import SMOKE

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")

FAST = ["grid_to_frame", "snake_case_rename", "blank_rows", "mixed_dates", "valid_rows", "error_rows",
        "validation_report", "affected_columns", "validation_by_group", "raw_hash", "dedup_hash",
        "watermark_filter", "watermark_filter_by_day", "bronze_append_modes", "bronze_new_column",
        "grid_headers_apart", "affected_dates_list", "fixes_roundtrip", "session_split_by_time", "clean_hash_extremes",
        "manifest_reconcile", "recovered_rows", "recovery_report",
        "watermark_rewrite_retain", "silver_typed", "silver_upsert", "merge_full_reload", "preview"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SMOKE}/events.parquet')")
    return con


def _digest(cols, rows):
    from tools.check_oracle import digest

    return digest(cols, rows)[0]


def test_every_query_has_an_oracle():
    from alloy.plans import catalog

    assert set(catalog.all_oracles()) == set(catalog.all_queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E

    df = E.queries()[name](spark, SMOKE)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(rel.columns, drows)


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert "n_rows" in df.columns


def test_pipeline_two_runs_and_rerun(spark, duck):
    """Full pipeline twice equals the oracle; a re-run of unchanged input adds no bronze."""
    import __spark_entry__ as E
    from alloy.operators.bronze import RunInfo
    from alloy.plans import catalog
    from alloy.plans.pipeline import run_pipeline
    from alloy.session import scratch_path
    from alloy.sinks import store
    from alloy.operators import silver as S
    from alloy.sources import fixture as FX

    sc = catalog.scenario(spark, SMOKE)
    root = scratch_path(spark, "test-pipeline")
    r1 = run_pipeline(spark, FX.landed_sheet(spark, SMOKE, 1), root, sc.run1, sc.registry, incremental_silver=False)
    r2 = run_pipeline(spark, FX.landed_sheet(spark, SMOKE, 2), root, sc.run2, sc.registry, incremental_silver=False)
    assert r1.n_bronze > 0 and r2.silver_version == 2
    assert r1.report["n_rows"] == r1.report["n_valid_rows"] + r1.report["n_bad_rows"] + r1.report["n_blank_rows"]
    silver = store.read_silver(spark, root, S.SILVER_SCHEMA)
    rel = duck.sql(E.oracle_sql()["pipeline_two_runs"])
    assert _digest(silver.columns, [tuple(r) for r in silver.collect()]) == _digest(rel.columns, rel.fetchall())
    again = run_pipeline(spark, FX.landed_sheet(spark, SMOKE, 2), root, RunInfo.at("2024-02-01 05:00:00", "r3"),
                         sc.registry, watermark_by_day=True)
    assert again.n_bronze == 0 and again.silver_version is None and not again.watermark_written
