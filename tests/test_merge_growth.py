"""What a merge must not do again for rows that it already knows."""

import datetime as dt

from pyspark.sql import functions as F

from alloy.functions.numbers import canonical_number_text
from alloy.operators import silver as S
from alloy.operators.bronze import RunInfo
from alloy.plans import pipeline as P
from alloy.session import scratch_path
from alloy.sinks import store

_COLUMNS = ("sheet_name string, creds string, row_no bigint, tanggal timestamp_ntz, toko string, id_kreator string, "
            "waktu_live string, pukul_live int, snapshot_ts timestamp, snapshot_date date, run_id string, row_hash_raw string, path int")


def _rows(spark, run, users):
    day = dt.datetime(2024, 1, 5)
    rows = [("s", "k", i, day, "T", u, "2024/01/05/07:10", 7, run.snapshot_ts, run.snapshot_ts.date(), run.run_id, f"{run.run_id}{u}{i}", 0)
            for i, u in enumerate(users)]
    return spark.createDataFrame(rows, _COLUMNS)


def test_first_merge_is_no_join(spark):
    """An empty target is known to be empty when the merge is planned."""
    source = S.silver_source(_rows(spark, RunInfo.at("2024-01-16 00:00:00", "a"), ["u", "v", None]).drop("path"))
    root = scratch_path(spark, "no-silver")
    for target in (S.empty_silver(spark), store.read_silver(spark, root, S.SILVER_SCHEMA), store.read_silver_by_day(spark, root, S.SILVER_SCHEMA)):
        assert target.columns == S.SILVER_COLS and target.count() == 0
        assert [t for _, t in target.dtypes] == [t for _, t in spark.createDataFrame([], S.SILVER_SCHEMA).dtypes]
        merged = S.upsert(target, source)
        assert "Join" not in merged._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, merged.collect())) == sorted(map(str, source.collect()))


def test_merge_looks_up_earlier_rows_only(spark, monkeypatch):
    """The rows of the run itself are taken as they are; of earlier rows those of its sessions."""
    looked_up = []
    restrict = S.restrict_to_sessions

    def counted(bronze, new_rows):
        looked_up.append(bronze.count())
        return restrict(bronze, new_rows)

    monkeypatch.setattr(S, "restrict_to_sessions", counted)
    first, second = RunInfo.at("2024-01-16 00:00:00", "a"), RunInfo.at("2024-02-01 00:00:00", "b")
    found = []
    for own in (True, False):
        root = scratch_path(spark, "merge-own")
        for run, users in ((first, ["u", "v", "w", None]), (second, ["v", "x", None])):
            new = _rows(spark, run, users)
            store.write_bronze(new, root, run)
            P.merge_silver(spark, root, new, own=store.of_run(run) if own else None)
        found.append(sorted(map(str, store.read_silver(spark, root, S.SILVER_SCHEMA).collect())))
    assert found[0] == found[1] and len(found[0]) == 6
    assert looked_up == [0, 4, 4, 7]


def test_canonical_number_text_takes_no_regular_expression(spark):
    values = ["0", "12", "100", "1.5", "10.50", "-7.000000001", "1000000000000.1", "0.000000001", None]
    rows = spark.createDataFrame([(v,) for v in values], "x string").select(F.col("x").cast("decimal(38,9)").alias("x"))
    out = rows.select(canonical_number_text(F.col("x")).alias("t"))
    assert [r["t"] for r in out.collect()] == ["0", "12", "100", "1.5", "10.5", "-7.000000001", "1000000000000.1", "0.000000001", None]
    assert "regexp" not in out._jdf.queryExecution().optimizedPlan().toString()
