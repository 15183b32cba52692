"""Rows that are alone with their key are neither sorted nor shuffled."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from alloy.operators import bronze as B
from alloy.operators import common
from alloy.operators import silver as S


def _bronze(spark):
    day = dt.datetime(2024, 1, 5)
    rows = [(f"s{i % 3}", "k", i, None if i % 50 == 0 else day, None if i % 7 == 0 else f" t{i % 40} ", f"u{i}", None if i % 5 == 0 else i % 24,
             dt.datetime(2024, 1, 16 + i % 2), f"r{i % 2}", f"h{i % 170}" if i % 2 else f"g{i}", i % 2) for i in range(400)]
    rows += [rows[i][:2] + (1000 + i,) + rows[i][3:] for i in range(0, 400, 9)]  # the session and the hash of another row
    return spark.createDataFrame(rows, "sheet_name string, creds string, row_no bigint, tanggal timestamp_ntz, toko string, id_kreator string, "
                                       "pukul_live int, snapshot_ts timestamp_ntz, run_id string, row_hash_raw string, path int")


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("most", [common.SEVERAL_MAX_BYTES, 0])
def test_picks_of_a_table_are_those_of_all_rows(spark, monkeypatch, most):
    monkeypatch.setattr(common, "SEVERAL_MAX_BYTES", most)
    table = common.measured(_bronze(spark), "bronze-rows")
    for key in (("row_hash_raw",), ("run_id", "row_hash_raw")):
        first = B.first_rows(table, key)
        assert first.columns == table.columns and _rows(first) == _rows(B.dedup_first(table, key))
    latest = S.latest_per_session(table, table=True)
    assert latest.columns == table.columns and _rows(latest) == _rows(S.latest_per_session(table))
    assert 0 < latest.count() < table.count()


def test_hashes_that_meet_lose_no_row(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *keys: F.lit(1).cast("long"))
    table = common.measured(_bronze(spark), "bronze-rows")
    assert _rows(B.first_rows(table)) == _rows(B.dedup_first(table))


def test_only_rows_that_share_their_key_are_moved(spark):
    table = common.measured(_bronze(spark).withColumn("row_hash_raw", F.concat("row_hash_raw", F.col("row_no").cast("string"))), "bronze-rows")
    first = B.first_rows(table)
    assert first.count() == table.count()
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and plan.index("LeftAnti") < plan.index("Aggregate")
