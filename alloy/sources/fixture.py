"""Landed report sheets derived from the driver's ``events`` table.

The rules are written once as SQL templates and rendered for two dialects:
Spark SQL (run through ``selectExpr``, so Catalyst plans it) and DuckDB (used
by the correctness oracle). Both engines therefore compute the same input.

Rules, with e = event_id, u = user_id, d = date of ts, n = floor(value*1000),
k = props.$.k (tried top-down):

* sheet_name = 'sheet_' || u % 5; creds = 'key_' || least(u % 5, 3)
  (sheet_3 and sheet_4 share one key); row_no = e + 3.
* e % 89 = 0: a blank row (every data cell a blank token, ID '-').
* Toko: e%3=0 padded with spaces, e%3=1 upper case, else as is.
* ID Kreator: e%97=0 two spaces (dropped by the ID filter), else 'usr' || u.
* Tanggal: e%160=15 '31/02/2024'; by e%8: 0,7 yyyy-MM-dd, 1 yyyy/M/d,
  2 dd/MM/yyyy, 3 d.M.yyyy, 4 dd/MM/yy, 5 day serial, 6 yyyy-MM-dd HH:mm:ss.
* Waktu Live: e%101=0 empty; e%11=0 HH:mm; else yyyy/MM/dd/HH:mm.
* GMV yang didapat dari LIVE (Rp): e%53=0 '12,5%'; e%59=0 '######';
  e%61=0 '-'; e%67=0 'N/A'; else 'Rp' || n with '.' thousands || ',' || e%100.
* CTR: e%71=0 'IDR'; e%3=0 k || ',5%'; e%3=1 k || '.5%'; else k.
* Other numeric columns: fixed formulas over e, n, k (see ``_numeric_value``).

Run 0 keeps every row, for queries that need no state. Two runs for those that
do: run 1 keeps d < 2024-01-16; run 2 keeps every row and doubles n where
e%10=0. On four (sheet, date) pairs the corruption rules of Tanggal,
GMV and CTR are replaced by a schedule (corrupt means GMV = '12,5%'):

  sheet_2 2024-01-05: run 1 all corrupt, run 2 all clean (resolved, recovered)
  sheet_1 2024-01-07: run 1 all corrupt, run 2 odd e corrupt (refreshed)
  sheet_0 2024-01-09: run 1 odd e corrupt, run 2 all clean (count differs)
  sheet_3 2024-01-11: run 1 all corrupt, run 2 rows absent (stays open)

Run 0 has run 1's schedule.

Sheets differ in layout: sheet_1 repeats a header, sheet_2 has an empty
header, sheet_3 lacks ``Nama Panggilan``, sheet_4 lists columns in reverse.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from alloy.constants import FIRST_DATA_ROW, HEADER_ROW, NUMERIC_COLS, PERCENT_COLS
from alloy.session import table_path

TEXT_COLS = ["Tanggal", "ID Kreator", "Kreator", "Nama Panggilan", "Toko", "Waktu Live"]
EXTRA_COLS = ["GMV LIVE (Rp)", "Produk yang terjual melalui LIVE"]
FIXTURE_COLS = TEXT_COLS + NUMERIC_COLS + PERCENT_COLS + EXTRA_COLS
N_SHEETS = 5

# (sheet, date, run-1 mode, run-2 mode); modes: all, odd, none, absent
SPECIAL_PAIRS = [
    ("sheet_2", "2024-01-05", "all", "none"),
    ("sheet_1", "2024-01-07", "all", "odd"),
    ("sheet_0", "2024-01-09", "odd", "none"),
    ("sheet_3", "2024-01-11", "all", "absent"),
]
RUN1_END = "2024-01-16"
RUN_SNAPSHOTS = {0: ("2024-02-01 00:00:00", "run-all"), 1: ("2024-01-16 00:00:00", "run-1"), 2: ("2024-02-01 00:00:00", "run-2")}


@dataclass(frozen=True)
class Dialect:
    name: str

    def q(self, ident: str) -> str:
        return f"`{ident}`" if self.name == "spark" else '"' + ident.replace('"', '""') + '"'

    def div(self, a: str, b: str) -> str:
        return f"(({a}) div ({b}))" if self.name == "spark" else f"(({a}) // ({b}))"

    def fmt(self, col: str, key: str) -> str:
        spark_fmt, duck_fmt = {
            "iso": ("yyyy-MM-dd", "%Y-%m-%d"),
            "ymd_slash": ("yyyy/M/d", "%Y/%-m/%-d"),
            "dmy4": ("dd/MM/yyyy", "%d/%m/%Y"),
            "dmy_dot": ("d.M.yyyy", "%-d.%-m.%Y"),
            "dmy2": ("dd/MM/yy", "%d/%m/%y"),
            "datetime": ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
            "hhmm": ("HH:mm", "%H:%M"),
            "slash_hhmm": ("yyyy/MM/dd/HH:mm", "%Y/%m/%d/%H:%M"),
        }[key]
        if self.name == "spark":
            return f"date_format({col}, '{spark_fmt}')"
        return f"strftime({col}, '{duck_fmt}')"

    def json_k(self, col: str) -> str:
        return f"get_json_object({col}, '$.k')" if self.name == "spark" else f"json_extract_string({col}, '$.k')"

    def days_since_epoch(self, col: str) -> str:
        if self.name == "spark":
            return f"datediff({col}, DATE '1899-12-30')"
        return f"date_diff('day', DATE '1899-12-30', {col})"

    def s(self, expr: str) -> str:
        """Cast to text."""
        return f"CAST({expr} AS STRING)" if self.name == "spark" else f"CAST({expr} AS VARCHAR)"


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")


def _thousands(dl: Dialect, n: str) -> str:
    """Integer text with '.' grouping thousands (n < 1e9)."""
    s = dl.s
    lo = f"lpad({s(f'({n}) % 1000')}, 3, '0')"
    mid = f"lpad({s(dl.div(n, '1000') + ' % 1000')}, 3, '0')"
    return (
        f"CASE WHEN ({n}) >= 1000000 THEN {s(dl.div(n, '1000000'))} || '.' || {mid} || '.' || {lo} "
        f"WHEN ({n}) >= 1000 THEN {s(dl.div(n, '1000'))} || '.' || {lo} "
        f"ELSE {s(n)} END"
    )


def base_select(dl: Dialect, run: int) -> tuple[list[str], str]:
    """First projection over ``events`` (derived scalars used by the rules) and
    the CASE branches naming each row's special-pair mode."""
    modes = " ".join(
        f"WHEN u % 5 = {int(sh[-1])} AND d = DATE '{day}' THEN '{m2 if run == 2 else m1}'"
        for sh, day, m1, m2 in SPECIAL_PAIRS
    )
    n_expr = "CAST(floor(value * 1000) AS BIGINT)"
    if run == 2:
        n_expr = f"CASE WHEN event_id % 10 = 0 THEN 2 * {n_expr} ELSE {n_expr} END"
    return [
        "event_id AS e", "user_id AS u", "ts", "event_type AS et",
        f"{n_expr} AS n", f"{dl.json_k('props')} AS k", "CAST(ts AS DATE) AS d",
    ], modes  # `modes` needs u and d, so it is evaluated in the second projection


def raw_select(dl: Dialect, run: int) -> tuple[list[str], list[str], str]:
    """(base projection, raw projection, row filter) for the flat raw sheet."""
    base, modes = base_select(dl, run)
    q, s = dl.q, dl.s
    blank = "e % 89 = 0"
    sp = f"(CASE {modes} ELSE 'normal' END)"
    corrupt_sp = f"({sp} = 'all' OR ({sp} = 'odd' AND e % 2 = 1))"
    rp_gmv = f"'Rp' || {_thousands(dl, 'n')} || ',' || lpad({s('e % 100')}, 2, '0')"

    tanggal = (
        f"CASE WHEN {blank} THEN 'nan' "
        f"WHEN {sp} <> 'normal' THEN {dl.fmt('d', 'iso')} "
        f"WHEN e % 160 = 15 THEN '31/02/2024' "
        f"WHEN e % 8 IN (0, 7) THEN {dl.fmt('d', 'iso')} "
        f"WHEN e % 8 = 1 THEN {dl.fmt('d', 'ymd_slash')} "
        f"WHEN e % 8 = 2 THEN {dl.fmt('d', 'dmy4')} "
        f"WHEN e % 8 = 3 THEN {dl.fmt('d', 'dmy_dot')} "
        f"WHEN e % 8 = 4 THEN {dl.fmt('d', 'dmy2')} "
        f"WHEN e % 8 = 5 THEN {s(dl.days_since_epoch('d'))} "
        f"ELSE {dl.fmt('ts', 'datetime')} END"
    )
    gmv = (
        f"CASE WHEN {blank} THEN '-' "
        f"WHEN {sp} <> 'normal' THEN (CASE WHEN {corrupt_sp} THEN '12,5%' ELSE {rp_gmv} END) "
        f"WHEN e % 53 = 0 THEN '12,5%' WHEN e % 59 = 0 THEN '######' "
        f"WHEN e % 61 = 0 THEN '-' WHEN e % 67 = 0 THEN 'N/A' ELSE {rp_gmv} END"
    )
    ctr = (
        f"CASE WHEN {blank} THEN '' WHEN {sp} <> 'normal' THEN k "
        f"WHEN e % 71 = 0 THEN 'IDR' WHEN e % 3 = 0 THEN k || ',5%' "
        f"WHEN e % 3 = 1 THEN k || '.5%' ELSE k END"
    )
    cols = {
        "Tanggal": tanggal,
        "ID Kreator": f"CASE WHEN {blank} THEN '-' WHEN e % 97 = 0 THEN '  ' ELSE 'usr' || {s('u')} END",
        "Kreator": f"CASE WHEN {blank} THEN '' ELSE 'Creator ' || {s('u')} END",
        "Nama Panggilan": (
            f"CASE WHEN u % 5 = 3 THEN NULL WHEN {blank} THEN 'None' ELSE 'nick' || {s('u % 7')} END"
        ),
        "Toko": (
            f"CASE WHEN {blank} THEN ' ' WHEN e % 3 = 0 THEN ' ' || et || ' ' "
            f"WHEN e % 3 = 1 THEN upper(et) ELSE et END"
        ),
        "Waktu Live": (
            f"CASE WHEN {blank} OR e % 101 = 0 THEN '' WHEN e % 11 = 0 THEN {dl.fmt('ts', 'hhmm')} "
            f"ELSE {dl.fmt('ts', 'slash_hhmm')} END"
        ),
        "CTR": ctr,
        "Rasio pesanan per klik (LIVE)": (
            f"CASE WHEN {blank} THEN '' WHEN e % 13 = 0 THEN '0,00%' "
            f"ELSE {s('e % 40')} || '.' || {s('e % 10')} || '%' END"
        ),
        "GMV LIVE (Rp)": f"CASE WHEN {blank} THEN '' ELSE {s('e % 9')} END",
        "Produk yang terjual melalui LIVE": f"CASE WHEN {blank} THEN '' ELSE {s('e % 4')} END",
    }
    for i, name in enumerate(NUMERIC_COLS):
        if name == "GMV yang didapat dari LIVE (Rp)":
            cols[name] = gmv
        else:
            cols[name] = f"CASE WHEN {blank} THEN '-' ELSE {_numeric_value(dl, name, i)} END"

    proj = [
        f"'sheet_' || {s('u % 5')} AS sheet_name",
        f"'key_' || {s('least(u % 5, 3)')} AS creds",
        "e + 3 AS row_no",
    ] + [f"{cols[c]} AS {q(c)}" for c in FIXTURE_COLS]
    filt = {0: "true", 1: f"d < DATE '{RUN1_END}'", 2: f"{sp} <> 'absent'"}[run]
    return base, proj, filt


def _numeric_value(dl: Dialect, name: str, ordinal: int) -> str:
    s = dl.s
    if name in ("Komentar", "Produk yang ditambahkan"):
        return "k"
    if name == "Produk Dilihat":
        return s("e % 7")
    if name == "Nilai barang dagangan bruto (LIVE) (Rp)":
        return f"'Rp' || {_thousands(dl, dl.div('n', '2'))}"
    if name == "Harga Rata-Rata (Rp)":
        return f"'Rp ' || {s('n % 997')} || ',' || {s('e % 10')}"
    return s(f"(e + {ordinal}) % 50")


def fixture_sql(run: int, source: str = "events") -> str:
    """DuckDB SELECT producing the flat raw sheet of a run (for the oracle)."""
    base, proj, filt = raw_select(DUCK, run)
    return (
        f"SELECT {', '.join(proj)} FROM (SELECT {', '.join(base)} FROM {source}) b WHERE {filt}"
    )


def raw_sheet(events: DataFrame, run: int = 1) -> DataFrame:
    """Flat raw sheet (all text, plus sheet_name / creds / row_no) of a run."""
    base, proj, filt = raw_select(SPARK, run)
    b = events.selectExpr(*base)
    # Filter before the wide projection so Catalyst prunes early.
    b = b.filter(F.expr(filt))
    return b.selectExpr(*proj)


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "events"))


# --- dates in other forms -----------------------------------------------------

#: Of each form: Spark's and DuckDB's format, what follows, and what it keeps of the
#: event's time: a unit, or how it is read where day and month cannot be told apart.
GENERIC_FORMS = [
    ("d MMM yyyy", "%-d %b %Y", "", "day"),
    ("dd MMMM yyyy", "%d %B %Y", "", "day"),
    ("MMMM d, yyyy", "%B %-d, %Y", "", "day"),
    ("EEEE, MMMM d, yyyy", "%A, %B %-d, %Y", "", "day"),
    ("d-MMM-yy", "%-d-%b-%y", "", "day"),
    ("yyyy-MMM-dd", "%Y-%b-%d", "", "day"),
    ("MMM yyyy", "%b %Y", "", "month"),
    ("yyyy-MM", "%Y-%m", "", "month"),
    ("yyyyMMdd", "%Y%m%d", "", "day"),
    ("yyyyMMdd'T'HHmmss", "%Y%m%dT%H%M%S", "Z", "second"),
    ("yyyyMMddHHmmss", "%Y%m%d%H%M%S", "", "second"),
    ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S", "Z", "second"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS", "%Y-%m-%dT%H:%M:%S.%g", "+07:00", "millisecond"),
    ("yyyy-MM-dd HH:mm", "%Y-%m-%d %H:%M", " +0700", "minute"),
    ("yyyy/MM/dd HH:mm:ss", "%Y/%m/%d %H:%M:%S", "", "second"),
    ("EEE, dd MMM yyyy HH:mm:ss", "%a, %d %b %Y %H:%M:%S", " GMT", "second"),
    ("MMM d yyyy hh:mm a", "%b %-d %Y %I:%M %p", "", "minute"),
    ("d MMMM yyyy h:mm:ss a", "%-d %B %Y %-I:%M:%S %p", "", "second"),
    ("M/d/yyyy", "%-m/%-d/%Y", "", "day first"),
    ("MM-dd-yy", "%m-%d-%y", "", "day first"),
    ("MM/dd/yyyy hh:mm:ss a", "%m/%d/%Y %I:%M:%S %p", "", "second"),
    ("dd.MM.yyyy HH:mm", "%d.%m.%Y %H:%M", "", "month first"),
    ("MMMM d'th at' HH", "%B %-dth at %H", "", "never"),
    ("yyyy-MM-dd", "%Y-%m-%d", " 25:61", "never"),
    ("yyyy-'13'-dd", "%Y-13-%d", "", "never"),
]


def generic_date_sql(dl: Dialect) -> str:
    """The text of event e: its time in form e % number of forms."""
    spark = dl.name == "spark"
    whens = []
    for i, (a, b, tail, _) in enumerate(GENERIC_FORMS):
        text = "date_format(ts, '" + a.replace("'", "\\'") + "')" if spark else f"strftime(ts, '{b}')"
        whens.append(f"WHEN {i} THEN {text} || '{tail}'")
    return f"CASE event_id % {len(GENERIC_FORMS)} {' '.join(whens)} END"


def generic_date_expected() -> str:
    """DuckDB SQL of what the text of an event says, worked out from the event's time."""
    swapped = "make_timestamp(year(ts), day(ts), month(ts), {}, {}, 0.0)"
    says = {"day first": f"CASE WHEN day(ts) <= 12 THEN {swapped.format(0, 0)} ELSE date_trunc('day', ts) END",
            "month first": f"CASE WHEN day(ts) <= 12 THEN {swapped.format('hour(ts)', 'minute(ts)')} ELSE date_trunc('minute', ts) END",
            "never": "NULL"}
    whens = [f"WHEN {i} THEN {says.get(kept) or f'date_trunc({chr(39)}{kept}{chr(39)}, ts)'}" for i, (*_, kept) in enumerate(GENERIC_FORMS)]
    return f"CAST(CASE event_id % {len(GENERIC_FORMS)} {' '.join(whens)} END AS TIMESTAMP)"


# --- grid form -------------------------------------------------------------

def sheet_headers() -> dict[str, list[str]]:
    """Header row of each sheet (see module doc for the differences)."""
    full = list(FIXTURE_COLS)
    out = {}
    for i in range(N_SHEETS):
        name = f"sheet_{i}"
        if i == 1:
            out[name] = full + ["Komentar"]
        elif i == 2:
            out[name] = full[:5] + [""] + full[5:]
        elif i == 3:
            out[name] = [c for c in full if c != "Nama Panggilan"]
        elif i == 4:
            out[name] = list(reversed(full))
        else:
            out[name] = full
    return out


_JUNK = {"sheet_1": "dup", "sheet_2": "x"}


#: Rows of a landed file, at most and (of small tables) at least.
FILE_ROWS, LEAST_ROWS = 250_000, 5_000


def dealt(events: DataFrame) -> DataFrame:
    """The events in even ranges of their ids. Spark splits a Parquet file at its row
    groups, of which a table of millions of rows may have one or two: the sheet's many
    text columns would be made, and later be read, by as many tasks."""
    n = events.count()
    parts = max(2 * events.sparkSession.sparkContext.defaultParallelism, -(-n // FILE_ROWS))
    return events.repartitionByRange(max(1, min(parts, n // LEAST_ROWS)), "event_id", "ts")


def raw_grid(events: DataFrame, run: int = 1) -> DataFrame:
    """Landed grid form ``(sheet_name, creds, row_no, cells)`` of a run.

    Rows 0-1 are title rows, row 2 the header, data from row 3 (``row_no`` of a
    data row is ``event_id + 3``).
    """
    flat = raw_sheet(dealt(events), run)
    headers = sheet_headers()
    case = F.lit(None).cast("array<string>")
    branches = None
    for sheet, hdr in headers.items():
        cells = F.array(*[
            F.col(f"`{h}`") if h in FIXTURE_COLS and h not in hdr[:j] else F.lit(_JUNK[sheet])
            for j, h in enumerate(hdr)
        ])
        cond = F.col("sheet_name") == F.lit(sheet)
        branches = F.when(cond, cells) if branches is None else branches.when(cond, cells)
    data = flat.select("sheet_name", "creds", "row_no", branches.otherwise(case).alias("cells"))

    # Title and header rows: one set per sheet present in the data.
    hdr_case = None
    for sheet, hdr in headers.items():
        arr = F.array(*[F.lit(h) for h in hdr])
        cond = F.col("sheet_name") == F.lit(sheet)
        hdr_case = F.when(cond, arr) if hdr_case is None else hdr_case.when(cond, arr)
    sheets = raw_sheet(events, run).select("sheet_name", "creds").distinct().coalesce(1)
    top = sheets.withColumn("row_no", F.explode(F.array(*[F.lit(i) for i in range(FIRST_DATA_ROW)]))).select(
        "sheet_name", "creds", F.col("row_no").cast("bigint").alias("row_no"),
        F.when(F.col("row_no") == HEADER_ROW, hdr_case)
        .when(F.col("row_no") == 0, F.array(F.lit("Performa Sesi Live")))
        .otherwise(F.array().cast("array<string>")).alias("cells"),
    )
    return top.unionByName(data.withColumn("row_no", F.col("row_no").cast("bigint")))


def sheet_registry(events: DataFrame) -> DataFrame:
    """Registry ``(sheet_name, creds, ord)`` of the sheets present in the data."""
    u = F.col("user_id") % N_SHEETS
    return (events.select(u.alias("i")).distinct()
            .select(F.concat(F.lit("sheet_"), F.col("i").cast("string")).alias("sheet_name"),
                    F.concat(F.lit("key_"), F.least(F.col("i"), F.lit(3)).cast("string")).alias("creds"),
                    F.col("i").cast("int").alias("ord")))


# --- landed copies -----------------------------------------------------------

_LANDED: dict[tuple, str] = {}


def landed_grid(spark: SparkSession, sf_dir: str, run: int = 1) -> DataFrame:
    """The run's grid, landed once per session as Parquet under the shared
    scratch folder and read back, as raw sheets arrive in a landing zone.

    Later queries start from a Parquet scan (pruning, pushdown) instead of
    re-deriving the sheet inside their own plans.
    """
    from alloy.session import scratch_path
    from alloy.sinks.store import exists
    from alloy.sources.grid import GRID_SCHEMA

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), run)
    path = _LANDED.get(key)
    if path is None or not exists(spark, path):
        path = scratch_path(spark, f"landed-grid-run{run}")
        # Lands as several files of one size (like many uploads), so reads are parallel.
        raw_grid(load_events(spark, sf_dir), run).write.option("compression", "zstd").parquet(path)
        _LANDED[key] = path
    return spark.read.schema(GRID_SCHEMA).parquet(path)


def landed_sheet(spark: SparkSession, sf_dir: str, run: int = 1) -> DataFrame:
    """Raw frame of a run: the landed grid with its headers promoted."""
    from alloy.sources.grid import grid_to_frame

    return grid_to_frame(landed_grid(spark, sf_dir, run), column_order=FIXTURE_COLS)
