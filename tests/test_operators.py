"""Grid ingest, validation, bronze and silver operators on small hand-made frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from alloy.operators import bronze as B
from alloy.operators import silver as S
from alloy.operators import validate as V
from alloy.sources import grid as G

RUN = B.RunInfo.at("2024-01-16 00:00:00", "run-x")


def test_grid_headers_first_wins_empty_dropped_union(spark):
    rows = [
        ("a", "k", 0, ["title"]), ("a", "k", 1, []), ("a", "k", 2, ["X", "Y", "X", ""]),
        ("a", "k", 3, ["1", "2", "3", "junk"]),
        ("b", "k2", 2, ["Y", "Z"]), ("b", "k2", 3, ["y", "z"]),
    ]
    grid = spark.createDataFrame(rows, G.GRID_SCHEMA)
    out = G.grid_to_frame(grid)
    assert out.columns == ["sheet_name", "creds", "row_no", "X", "Y", "Z"]
    got = {r["sheet_name"]: r.asDict() for r in out.collect()}
    assert (got["a"]["X"], got["a"]["Y"], got["a"]["Z"]) == ("1", "2", None)
    assert (got["b"]["X"], got["b"]["Y"], got["b"]["Z"]) == (None, "y", "z")


def test_grid_headers_missing_or_two(spark):
    rows = [("a", "k", 2, ["X"]), ("b", "k", 3, ["1"])]
    grid = spark.createDataFrame(rows, G.GRID_SCHEMA)
    ready, parked = G.split_headerless(grid, G.headers_of(grid))
    assert [r["sheet_name"] for r in ready.collect()] == ["a"] and [r["sheet_name"] for r in parked.collect()] == ["b"]
    with pytest.raises(Exception, match="no header row for sheet b"):
        G.grid_to_frame(grid).collect()
    two = spark.createDataFrame([("a", "k", 2, ["X"]), ("a", "k", 2, ["Y"]), ("a", "k", 3, ["1"])], G.GRID_SCHEMA)
    with pytest.raises(Exception, match="two different header rows in sheet a"):
        G.grid_to_frame(two).collect()
    again = spark.createDataFrame([("a", "k", 2, ["X"]), ("a", "k", 2, ["X"]), ("a", "k", 3, ["1"])], G.GRID_SCHEMA)
    assert [r["X"] for r in G.grid_to_frame(again).collect()] == ["1"]


def test_extreme_ratio_hash(spark):
    from alloy.functions import hash_text

    df = spark.createDataFrame([(0.125,), (1e-7,), (9999999999999.99,), (1e300,), (None,)], "x double")
    assert [r[0] for r in df.select(hash_text(F.col("x"), "double")).collect()] == [
        "0.125000000000", "0.000000100000", "9999999999999.99", "huge", None]


def test_duplicate_source_keys_are_refused(spark):
    day = dt.date(2024, 1, 5)
    row = (day, "A", "U", 10, "10:00:00", 1, "h1")
    S.require_unique(_silver_rows(spark, [row]))
    with pytest.raises(ValueError):
        S.require_unique(_silver_rows(spark, [row, row]))


def _raw(spark, rows):
    cols = ["sheet_name", "creds", "row_no", "Tanggal", "ID Kreator", "Komentar", "CTR"]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {'bigint' if c == 'row_no' else 'string'}" for c in cols))


def test_flag_split_and_report(spark):
    raw = _raw(spark, [
        ("s", "k", 3, "2024-01-05", "u1", "12", "5%"),       # valid
        ("s", "k", 4, "2024-01-05", "u2", "12,5%", "5%"),    # numeric corrupt
        ("s", "k", 5, "31/02/2024", "u3", "1", "1%"),        # date error
        ("s", "k", 6, "junk", "u4", "IDR", "IDR"),           # both
        ("s", "k", 7, "nan", "-", "-", ""),                  # blank row (ID '-' passes the filter)
        ("s", "k", 8, "2024-01-05", "  ", "1", "1%"),        # blank ID text: dropped before validation
    ])
    fl = V.flag(V.filter_creator_id(raw))
    rep = V.report(fl).first().asDict()
    assert rep["n_rows"] == 5
    assert rep["n_bad_rows"] == 3
    assert rep["n_blank_rows"] == 1
    assert rep["n_date_errors"] == 3          # blank rows count as date errors too
    assert rep["n_valid_rows"] == 1
    reasons = {r["row_no"]: r["error_reason"] for r in V.error_rows(fl).collect()}
    assert reasons == {4: "numeric_mixed", 5: "date_unparsable", 6: "numeric_mixed|date_unparsable"}
    cols = [r["column_name"] for r in V.affected_columns(fl).orderBy("position").collect()]
    assert cols == ["Komentar", "CTR"]
    valid = V.valid_rows(fl).first()
    assert valid["Komentar"] == Decimal("12") and valid["Tanggal"] == dt.datetime(2024, 1, 5)
    # error rows keep raw text
    assert V.error_rows(fl).filter("row_no = 4").first()["Komentar"] == "12,5%"


def _bronze_input(spark, rows):
    return spark.createDataFrame(rows, "sheet_name string, creds string, row_no bigint, Tanggal timestamp_ntz, "
                                       "`Waktu Live` string, Toko string, `ID Kreator` string, "
                                       "`Produk yang ditambahkan` decimal(38,9), `Produk Dilihat` decimal(38,9)")


def test_bronze_watermark_dedup(spark):
    d = dt.datetime
    rows = [
        ("s", "k1", 3, d(2024, 1, 5, 10), "2024/01/05/10:00", "t", "u", Decimal(1), Decimal(2)),
        ("s", "k1", 4, d(2024, 1, 6), "2024/01/06/11:00", "t", "u", Decimal(1), Decimal(2)),
        ("s", "k1", 5, d(2024, 1, 6), "2024/01/06/11:00", "t", "u", Decimal(1), Decimal(2)),  # duplicate
        ("s", "k2", 6, d(2024, 1, 1), "", "t", "u", Decimal(1), Decimal(2)),                  # no session time
        ("s", None, 7, d(2024, 1, 1), "08:00", "t", "u", Decimal(1), Decimal(2)),             # NULL key: kept
    ]
    valid = _bronze_input(spark, rows)
    wm = spark.createDataFrame([("k1", "2024-01-05")], "creds string, last_processed_date string")
    b, mx = B.build_bronze(valid, RUN, wm)
    kept = sorted(r["row_no"] for r in b.collect())
    assert kept == [3, 4, 5, 7]  # 2024-01-05 10:00 is after the mark, the start of that day
    assert {r["creds"]: r["last_processed_date"] for r in mx.collect()} == {"k1": "2024-01-06"}
    first = B.dedup_first(b)
    assert len(first.collect()) == len({r["row_hash_raw"] for r in b.collect()})
    by_day, _ = B.build_bronze(valid, RUN, wm, by_day=True)
    assert sorted(r["row_no"] for r in by_day.collect()) == [4, 5, 7]
    row = b.filter("row_no = 4").first()
    assert row["pukul_live"] == 11 and row["run_id"] == "run-x"
    assert "gmv_live_rp" not in b.columns


def _silver_rows(spark, rows):
    """rows: (tanggal, toko, id, pukul, time, gmv, hash)"""
    base = []
    for t, toko, idk, h, tm, gmv, hsh in rows:
        r = {c: None for c in S.SILVER_COLS}
        r.update(tanggal=t, toko=toko, id_kreator=idk, pukul_live=h, waktu_live_time=tm,
                 gmv_live=Decimal(gmv) if gmv is not None else None, row_hash_clean=hsh, run_id="r")
        base.append(tuple(r[c] for c in S.SILVER_COLS))
    return spark.createDataFrame(base, S.SILVER_SCHEMA)


def test_upsert_semantics(spark):
    day = dt.date(2024, 1, 5)
    target = _silver_rows(spark, [
        (day, "A", "U", 10, "10:00:00", 1, "h1"),        # updated (hash differs)
        (day, "A", "U", 11, "11:00:00", 2, "h2"),        # kept (hash equal)
        (day, "A", "U", None, "09:30:00", 3, "h3"),      # matched on time (no hour)
        (day, "A", "U", 12, "12:00:00", 4, "h4"),        # retained (not in source)
        (None, "A", "U", 13, "13:00:00", 5, "h5"),       # unkeyed target row: kept
    ])
    source = _silver_rows(spark, [
        (day, "A", "U", 10, "10:00:00", 10, "h1x"),
        (day, "A", "U", 11, "11:00:00", 2, "h2"),
        (day, "A", "U", None, "09:30:00", 30, "h3x"),
        (day, "A", "U", 14, "14:00:00", 7, "h7"),        # insert
        (day, "A", "U", None, None, 8, "h8"),            # unkeyed source row: inserted every time
    ])
    out = S.upsert(target, source, with_action=True)
    acts = {(r["pukul_live"], r["waktu_live_time"], r["_action"]): r["gmv_live"] for r in out.collect()}
    assert acts[(10, "10:00:00", "update")] == Decimal(10)
    assert acts[(11, "11:00:00", "keep")] == Decimal(2)
    assert acts[(None, "09:30:00", "update")] == Decimal(30)
    assert acts[(12, "12:00:00", "retain")] == Decimal(4)
    assert acts[(14, "14:00:00", "insert")] == Decimal(7)
    assert acts[(None, None, "insert")] == Decimal(8)
    assert out.count() == 7
    # idempotence on keyed rows: merging the same source again changes nothing keyed
    again = S.upsert(out.drop("_action"), source, with_action=True)
    keyed = again.filter(F.col("tanggal").isNotNull() & F.col("waktu_live_time").isNotNull())
    assert {r["_action"] for r in keyed.collect()} <= {"keep", "retain"}
    assert again.count() == 8  # the unkeyed source row is inserted again


def test_latest_per_session_prefers_newest_run(spark):
    d = dt.datetime
    rows = [
        ("s", "k", 3, d(2024, 1, 5), " shop ", "u", 10, d(2024, 1, 16), "run-1", "a"),
        ("s", "k", 4, d(2024, 1, 5), "SHOP", "U", 10, d(2024, 2, 1), "run-2", "b"),
        ("s", "k", 5, d(2024, 1, 5), "SHOP", "U", 11, d(2024, 1, 16), "run-1", "c"),
    ]
    b = spark.createDataFrame(rows, "sheet_name string, creds string, row_no bigint, tanggal timestamp_ntz, "
                                    "toko string, id_kreator string, pukul_live int, snapshot_ts timestamp_ntz, "
                                    "run_id string, row_hash_raw string")
    got = sorted(r["row_no"] for r in S.latest_per_session(b).collect())
    assert got == [4, 5]


def test_upsert_null_safe_keys_updates_unkeyed_rows(spark):
    day = dt.date(2024, 1, 5)
    target = _silver_rows(spark, [(day, "A", "U", None, None, 1, "h1"), (None, "A", "U", 9, "09:00:00", 2, "h2")])
    source = _silver_rows(spark, [(day, "A", "U", None, None, 5, "h1x"), (None, "A", "U", 9, "09:00:00", 2, "h2")])
    default = S.upsert(target, source, with_action=True)
    assert default.count() == 4  # unkeyed rows are inserted again
    safe = {(r["tanggal"], r["_action"]): r["gmv_live"]
            for r in S.upsert(target, source, with_action=True, null_safe_keys=True).collect()}
    assert safe == {(day, "update"): Decimal(5), (None, "keep"): Decimal(2)}


def test_latest_split_by_time(spark):
    d = dt.datetime
    rows = [
        ("s", "k", 3, d(2024, 1, 5), "SHOP", "U", None, "9:30", d(2024, 1, 16), "run-1", "a"),
        ("s", "k", 4, d(2024, 1, 5), "SHOP", "U", None, "11:00", d(2024, 1, 16), "run-1", "b"),
        ("s", "k", 5, d(2024, 1, 5), "SHOP", "U", None, "09:30", d(2024, 1, 16), "run-1", "c"),  # as row 3
    ]
    b = spark.createDataFrame(rows, "sheet_name string, creds string, row_no bigint, tanggal timestamp_ntz, "
                                    "toko string, id_kreator string, pukul_live int, waktu_live string, "
                                    "snapshot_ts timestamp_ntz, run_id string, row_hash_raw string")
    assert S.latest_per_session(b).count() == 1            # source-system default: one session
    assert S.latest_per_session(b, split_by_time=True).count() == 2
