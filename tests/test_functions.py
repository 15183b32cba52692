"""Table-driven checks of the Column expressions (edge cases of the source rules)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from alloy import functions as AF

D = Decimal


def _eval(spark, rows, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, x {dtype}")
    out = df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in out]


def test_locale_number(spark):
    rows = ["Rp1.234,56", "1.5", "-5", "1,2,3", "", "######", "-", "Rp 12", ",5", "5,", None]
    got = _eval(spark, rows, AF.locale_number)
    assert got == [D("1234.560000000"), D("15.000000000"), D("5.000000000"), None, None, None, None,
                   D("12.000000000"), D("0.500000000"), D("5.000000000"), None]


def test_locale_number_fill_zero(spark):
    got = _eval(spark, ["N/A", "-", None, "7"], AF.locale_number_fill)
    assert got == [D(0), D(0), D(0), D(7)]


@pytest.mark.parametrize("value,bad", [
    ("12,5%", True), ("######", True), ("IDR", True), ("1,2,3", True), (",", True),
    ("-", False), ("N/A", False), ("nan", False), ("", False), (None, False),
    ("Rp 1.000", False), ("Rp1.234,56", False), ("  42 ", False), ("-5", False),
])
def test_numeric_corrupt(spark, value, bad):
    assert _eval(spark, [value], AF.numeric_corrupt) == [bad]


@pytest.mark.parametrize("value,bad", [
    ("0,00%", False), ("12.5%", False), ("125", False), ("######", False), ("-", False),
    ("IDR", True), ("5 pct", True), ("N/A", False),
])
def test_percent_corrupt(spark, value, bad):
    assert _eval(spark, [value], AF.percent_corrupt) == [bad]


@pytest.mark.parametrize("value,blank", [
    (None, True), ("", True), ("  ", True), ("-", True), ("NaN", True), ("None", True), ("NaT", True),
    ("n/a", False), ("0", False), ("x", False), (" - ", True),
])
def test_blank_cell(spark, value, blank):
    assert _eval(spark, [value], AF.is_blank_cell) == [blank]


def test_has_content_tokens(spark):
    got = _eval(spark, ["n/a", "nat", "None", " - ", "0"], AF.has_content)
    # n/a is empty for the corruption test; nat is not (token sets differ).
    assert got == [False, True, False, False, True]


def test_mixed_dates(spark):
    rows = ["2024-01-05", "2024/1/5", "05/01/2024", "5.1.2024", "05/01/24", "31/12/69", "1/1/68",
            "45678", "2025", "106752", "2024-01-05 13:45:00", "2024-01-05T13:45:00", "2024-01-05 13:45",
            "31/02/2024", "2024/02/31", "nan", "-", "", None, "hello", " 2024-01-05 "]
    got = _eval(spark, rows, AF.parse_mixed_date)
    d = dt.datetime
    assert got == [
        d(2024, 1, 5), d(2024, 1, 5), d(2024, 1, 5), d(2024, 1, 5), d(2024, 1, 5), d(1969, 12, 31),
        d(2068, 1, 1), d(2025, 1, 21), d(1905, 7, 17), None, d(2024, 1, 5, 13, 45), d(2024, 1, 5, 13, 45),
        d(2024, 1, 5, 13, 45), None, None, None, None, None, None, None, d(2024, 1, 5),
    ]


def test_error_date_key(spark):
    df = spark.createDataFrame([("2024-01-05",), ("junk",)], "x string")
    got = [r[0] for r in df.select(AF.error_date_key(AF.parse_mixed_date(F.col("x")))).collect()]
    assert got == ["2024-01-05", "INVALID_DATE"]


def test_session_hour(spark):
    got = _eval(spark, ["2024/01/05/13:45", "13:45", "", None, "2024/01/05/x:00", "2024/01/05/07:00"],
                AF.session_hour)
    assert got == [13, None, None, None, None, 7]


def test_time_helpers(spark):
    assert _eval(spark, [0, 23, 24, -1, None], AF.time_from_hour, "int") == ["00:00:00", "23:00:00", None, None, None]
    assert _eval(spark, ["9:05", "13:45", "24:00", "12:60", "2024/01/05/13:45"], AF.parse_hhmm) == \
        ["09:05:00", "13:45:00", None, None, None]


def test_session_start(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), "13:45:00"), (None, "01:00:00"), (dt.date(2024, 1, 5), None)],
                               "d date, t string")
    got = [r[0] for r in df.select(AF.session_start(F.col("d"), F.col("t"))).collect()]
    assert got == [dt.datetime(2024, 1, 5, 13, 45), None, None]


def test_percent_ratio_modes(spark):
    rows = ["12,5%", "12.5%", "87", "-", "######", "0,00%", None]
    assert _eval(spark, rows, AF.percent_ratio) == [None, 0.125, 0.87, None, None, None, None]
    assert _eval(spark, rows, lambda c: AF.percent_ratio(c, decimal_comma=True)) == \
        [0.125, 0.125, 0.87, None, None, 0.0, None]


def test_round_to_long(spark):
    got = _eval(spark, [D("2.5"), D("-2.5"), D("2.4"), D("2.7"), None], AF.round_to_long, "decimal(38,9)")
    assert got == [3, -3, 2, 3, None]


def test_canonical_number_text(spark):
    got = _eval(spark, [D("12"), D("1.5"), D("10"), D("0"), D("0.125")], AF.canonical_number_text, "decimal(38,9)")
    assert got == ["12", "1.5", "10", "0", "0.125"]


def test_strip_and_canon(spark):
    assert _eval(spark, ["  ab \t", None], AF.ustrip) == ["ab", None]
    assert _eval(spark, [" ab ", None], AF.canon) == ["AB", ""]


def test_snake_case():
    assert AF.snake_case("Nilai barang dagangan bruto (LIVE) (Rp)") == "nilai_barang_dagangan_bruto_live_rp"
    assert AF.snake_case("Harga Rata-Rata (Rp)") == "harga_ratarata_rp"
    assert AF.snake_case(" ID Kreator ") == "id_kreator"
    with pytest.raises(ValueError):
        AF.snake_case_columns(["Rata-Rata", "RataRata"])


def test_snake_case_col_matches_python(spark):
    names = ["Nilai barang dagangan bruto (LIVE) (Rp)", "Harga Rata-Rata (Rp)", "CTR", "Pesanan SKU (LIVE)"]
    assert _eval(spark, names, AF.snake_case_col) == [AF.snake_case(n) for n in names]


@pytest.mark.parametrize("text,parsed", [
    ("15 Jan 2024", dt.datetime(2024, 1, 15)), ("January 15th, 2024", dt.datetime(2024, 1, 15)), ("15-SEPT-24", dt.datetime(2024, 9, 15)),
    ("Mon, 15 Jan 2024 10:30:05 GMT", dt.datetime(2024, 1, 15, 10, 30, 5)), ("2024-01-15T10:30:00Z", dt.datetime(2024, 1, 15, 10, 30)),
    ("2024-01-15T23:30:00.1234567+07:00", dt.datetime(2024, 1, 15, 23, 30, 0, 123456)), ("2024-01-15 10:30 -0330", dt.datetime(2024, 1, 15, 10, 30)),
    ("01/31/2024", dt.datetime(2024, 1, 31)), ("1-31-99", dt.datetime(1999, 1, 31)), ("02/01/2024", dt.datetime(2024, 1, 2)),
    ("01/02/2024 10:30", dt.datetime(2024, 1, 2, 10, 30)), ("13/02/2024 10:30", dt.datetime(2024, 2, 13, 10, 30)),
    ("20240115", dt.datetime(2024, 1, 15)), ("20240115T103005Z", dt.datetime(2024, 1, 15, 10, 30, 5)), ("20240115103005", dt.datetime(2024, 1, 15, 10, 30, 5)),
    ("Jan 15 2024 12:05 am", dt.datetime(2024, 1, 15, 0, 5)), ("Jan 15 2024, 12:05 P.M.", dt.datetime(2024, 1, 15, 12, 5)),
    ("may 2024", dt.datetime(2024, 5, 1)), ("2024-05", dt.datetime(2024, 5, 1)), ("2024 Dec 24", dt.datetime(2024, 12, 24)),
    ("31/02/2024", None), ("2024-13-01", None), ("Jan 32 2024", None), ("15 Foo 2024", None), ("Jan 15 2024 13:05 pm", None),
    ("2024-01-15 25:00", None), ("12345678", None), ("10:30", None), ("2024", dt.datetime(1905, 7, 16)), ("around noon", None),
    ("15", None), ("1,5", None), ("", None), ("-", None), (None, None),
])
def test_generic_dates(spark, text, parsed):
    assert _eval(spark, [text], AF.parse_mixed_date) == [parsed]


def test_quick_cell_tests_equal_the_whole_ones(spark):
    import random

    from alloy.constants import PERCENT_ALLOWED, WS_CLASS
    from alloy.functions.numbers import NUMERIC_CORRUPT_RE

    r = random.Random(4)
    cells = ["".join(r.choice("0123456789.,Rp#- \t\n\u00a0\u2003x%+") for _ in range(r.randint(0, 7))) for _ in range(4000)]
    cells += ["n/a", "NaN", " none ", "-", "5\n", "\n", "1,\n2", None]
    df = spark.createDataFrame([(c,) for c in cells], "x string")
    x = F.col("x")
    fine = AF.has_content(x) & x.rlike(NUMERIC_CORRUPT_RE)
    percent = AF.has_content(x) & x.rlike(f"[^{PERCENT_ALLOWED}{WS_CLASS}]")
    same = df.select(x, AF.numeric_corrupt(x).eqNullSafe(fine).alias("a"), AF.percent_corrupt(x).eqNullSafe(percent).alias("b"),
                     (AF.numeric_corrupt(x) | AF.checked_number_fill(x).eqNullSafe(AF.locale_number_fill(x))).alias("c"))
    assert same.filter("NOT a OR NOT b OR NOT c").collect() == []


def test_sql_functions_are_inlined(spark):
    from alloy.functions import sql

    assert len(sql.register(spark)) == 13
    df = spark.sql("SELECT alloy_canon(' ab ') AS a, alloy_error_reason(true, true, false) AS b, alloy_raw_hash(array(' x', NULL)) AS c, "
                   "alloy_session_start(DATE'2024-01-05', alloy_parse_hhmm('9:30')) AS d, alloy_is_blank(' - ') AS e")
    row = df.first()
    assert row.a == "AB" and row.b == "numeric_mixed|date_unparsable" and row.d == dt.datetime(2024, 1, 5, 9, 30) and row.e
    assert row.c == spark.sql("SELECT sha2('X||', 256) AS h").first().h
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "alloy_" not in plan and "UDF" not in plan
