"""Watermark and error-manifest state operators."""

from pyspark.sql import functions as F

from alloy.operators import state as ST

REG = [("north", "KEY_N", 0), ("south", "KEY_S", 1), ("south_two", "KEY_S", 2)]


def _reg(spark):
    return spark.createDataFrame(REG, "sheet_name string, creds string, ord int")


def test_load_watermarks_old_format_and_shared_key(spark):
    recs = spark.createDataFrame([
        (None, "north", "2024-01-10T08:00:00", "x"),     # old format -> registry key
        ("KEY_S", "south", "2024-01-12", "x"),
        ("KEY_S", "south_two", " 2024-01-14 ", "x"),    # shared key: greatest date wins
        (None, "unknown", "2024-01-01", "x"),           # untranslatable: keyed by its name
    ], ST.WATERMARK_SCHEMA)
    got = {r["creds"]: r["last_processed_date"] for r in ST.load_watermarks(recs, _reg(spark)).collect()}
    assert got == {"KEY_N": "2024-01-10", "KEY_S": "2024-01-14", "unknown": "2024-01-01"}


def test_rewrite_watermarks_modes(spark):
    prev = spark.createDataFrame([
        ("KEY_N", "north", "2024-01-10", "t0"),
        ("KEY_X", "gone", "2024-01-09", "t0"),
    ], ST.WATERMARK_SCHEMA).withColumn("_ord", F.monotonically_increasing_id())
    new = spark.createDataFrame([("KEY_S", "2024-01-20")], "creds string, last_processed_date string")
    rep = [r.asDict() for r in ST.rewrite_watermarks(prev, new, _reg(spark), "NOW", "replace").collect()]
    # only this run's sources; the shared key takes the last registered name
    assert rep == [{"creds": "KEY_S", "sheet_name": "south_two", "last_processed_date": "2024-01-20",
                    "updated_at": "NOW"}]
    ret = {r["creds"]: r.asDict() for r in ST.rewrite_watermarks(prev, new, _reg(spark), "NOW", "retain").collect()}
    assert set(ret) == {"KEY_N", "KEY_S", "KEY_X"}
    assert ret["KEY_N"]["last_processed_date"] == "2024-01-10" and ret["KEY_N"]["updated_at"] == "t0"
    assert ret["KEY_X"]["sheet_name"] == "gone"


def _entries(spark, rows):
    return spark.createDataFrame(
        [(s, c, d, ["A"], n, "t", "p", st) for s, c, d, n, st in rows], ST.MANIFEST_SCHEMA)


def test_reconcile_branches(spark):
    prev = _entries(spark, [
        ("s1", "k", "2024-01-05", 3, "open"),   # not failing now, 3 valid rows -> resolved
        ("s1", "k", "2024-01-06", 3, "open"),   # not failing now, 2 valid rows -> stays open
        ("s1", "k", "2024-01-07", 3, "open"),   # failing again -> refreshed by current entry
        ("s1", "k", "INVALID_DATE", 2, "open"), # can never be confirmed -> stays open
        ("s1", "k", "2024-01-08", 1, "fixed"),  # other status: dropped
    ])
    cur = _entries(spark, [("s1", "k", "2024-01-07", 1, "open"), ("s1", "k", "2024-01-09", 4, "open")])
    counts = spark.createDataFrame([("s1", "k", "2024-01-05", 3), ("s1", "k", "2024-01-06", 2)],
                                   "sheet_name string, creds string, error_date string, n_valid bigint")
    remaining, resolved = ST.reconcile(prev, cur, counts)
    assert [r["error_date"] for r in resolved.collect()] == ["2024-01-05"]
    rem = {r["error_date"]: r["n_rows"] for r in remaining.collect()}
    assert rem == {"2024-01-06": 3, "2024-01-07": 1, "INVALID_DATE": 2, "2024-01-09": 4}
    assert ST.manifest_changed(prev, remaining, resolved)
    fx = ST.fix_records(resolved, "NOW").first()
    assert fx["status"] == "fixed" and fx["resolved_at"] == "NOW"
    # the same inputs again: nothing changes
    rem2, res2 = ST.reconcile(remaining, cur, counts.limit(0))
    assert not ST.manifest_changed(remaining, rem2, res2)


def test_recovery_report_counts(spark):
    resolved = _entries(spark, [("s", "k", "2024-01-05", 2, "open"), ("s", "k", "2024-01-06", 2, "open"),
                                ("s", "k", "2024-01-07", 2, "open")])
    counts = spark.createDataFrame([("s", "k", "2024-01-05", 2), ("s", "k", "2024-01-06", 5)],
                                   "sheet_name string, creds string, error_date string, n_valid bigint")
    rep = ST.recovery_report(resolved, counts).first().asDict()
    assert rep == {"recovery_resolved": 3, "recovery_recovered_rows": 2, "recovery_count_mismatch": 1,
                   "recovery_absent": 1}


def test_lookups_by_join(spark):
    """Watermarks compare timestamps (or days); recovered keys are NULL-safe."""
    import datetime as dt

    from alloy.operators import bronze as B

    d = dt.datetime
    valid = spark.createDataFrame(
        [("s", "k1", i, d(2024, 1, 4 + i % 3, i % 2), "2024/01/05/10:00", "t", "u") for i in range(12)]
        + [("s", None, 99, d(2024, 1, 1), "2024/01/01/10:00", "t", "u")],
        "sheet_name string, creds string, row_no bigint, Tanggal timestamp_ntz, `Waktu Live` string, "
        "Toko string, `ID Kreator` string")
    wm = spark.createDataFrame([("k1", "2024-01-04")], "creds string, last_processed_date string")
    run = B.RunInfo.at("2024-01-16 00:00:00", "r")
    by_time = sorted(r["row_no"] for r in B.build_bronze(valid, run, wm)[0].collect())
    by_day = sorted(r["row_no"] for r in B.build_bronze(valid, run, wm, by_day=True)[0].collect())
    assert 3 in by_time and 9 in by_time and 0 not in by_time and 99 in by_time  # 01:00 on the marked day is after it
    assert by_day == [i for i in by_time if i not in (3, 9)]

    resolved = _entries(spark, [("s", "k1", "2024-01-05", 4, "open")])
    recovered, regular = ST.split_recovered(valid, resolved, ST.valid_counts(valid))
    assert sorted(r["row_no"] for r in recovered.collect()) == [1, 4, 7, 10]
    assert regular.count() == 9


def test_damaged_state_fails(spark, tmp_path):
    import pytest

    from alloy.sinks import store

    root = str(tmp_path)
    spark.createDataFrame([("{broken",)], "value string").write.text(f"{root}/state/watermark/v=0000000001")
    with pytest.raises(Exception, match="(?i)malformed"):
        store.read_state(spark, root, "watermark", ST.WATERMARK_SCHEMA).collect()


def test_state_documents_in_all_forms(spark, tmp_path):
    import json

    from alloy.sinks import store

    old = {"sheets": [{"sheet_name": "a", "last_processed_date": 20240105}, {"creds": "k", "sheet_name": "b", "last_processed_date": "2024-01-07"}]}
    for i, text in enumerate((json.dumps(old), json.dumps(old, indent=2))):
        (tmp_path / f"{i}").mkdir()
        (tmp_path / f"{i}" / "watermark.json").write_text(text)
        got = store.read_records(spark, str(tmp_path / f"{i}" / "watermark.json"), "sheets", ST.WATERMARK_SCHEMA, True).orderBy("_ord").collect()
        assert [(r.creds, r.sheet_name, r.last_processed_date, r._ord) for r in got] == [(None, "a", "20240105", 0), ("k", "b", "2024-01-07", 1)]
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "x.json").write_text("\n".join(json.dumps(r) for r in old["sheets"]) + "\n\n")
    got = store.read_records(spark, str(lines), "sheets", ST.WATERMARK_SCHEMA, False).collect()
    assert sorted((r.creds or "", r.sheet_name) for r in got) == [("", "a"), ("k", "b")]


def test_damaged_documents_fail(spark, tmp_path):
    import pytest

    from alloy.sinks import store

    for i, text in enumerate(('{"sheets": [', '{"rows": []}', '{"sheets": [5]}', '{"sheets": {"a": 1}}', '{"errors": [], "x": 1}',
                              '{"sheets": [{"creds": "k"}, null]}')):
        path = tmp_path / str(i)
        path.mkdir()
        (path / "watermark.json").write_text(text)
        with pytest.raises(Exception, match="(?i)malformed|document without|no object|cast"):
            print(store.read_records(spark, str(path / "watermark.json"), "sheets", ST.WATERMARK_SCHEMA, True).collect())


def test_document_of_many_records(spark, tmp_path):
    """No cap: each record is a row of its own till it is written."""
    from alloy.sinks import store

    path = str(tmp_path / "manifest")
    rows = spark.range(120_000).selectExpr("concat('s', id) AS sheet_name", "'k' AS creds", "'2024-01-05' AS error_date", "array('a') AS affected_columns",
                                           "id AS n_rows", "CAST(NULL AS string) AS reported_at", "'p' AS path", "'open' AS status")
    store.write_document(rows, path, "errors", ["sheet_name"])
    got = store.read_records(spark, path, "errors", ST.MANIFEST_SCHEMA, True)
    assert got.agg({"n_rows": "sum"}).first()[0] == 120_000 * 119_999 // 2
    assert got.filter("_ord = 1").first().sheet_name == "s1"


def test_many_sources_plan_alike(spark):
    """The plan holds no literal for each source, so it does not grow with them."""
    from alloy.operators import bronze as B

    rows = spark.createDataFrame([("k1",)], "creds string").selectExpr("creds", "timestamp_ntz'2024-01-05' AS tanggal")

    def plan(n):
        wm = spark.range(n).selectExpr("concat('k', id) AS creds", "'2024-01-04' AS last_processed_date")
        return B.watermark_filter(rows, wm)._jdf.queryExecution().optimizedPlan().toString()

    assert abs(len(plan(10)) - len(plan(100_000))) < 50
