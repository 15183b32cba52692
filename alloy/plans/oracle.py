"""DuckDB SQL for the correctness oracle.

Each function returns SQL text (CTE bodies or whole queries) that recomputes,
from the driver's ``events`` view, what the Spark plans compute. The fixture is
ASCII, so whitespace classes here are the ASCII ones.
"""

from __future__ import annotations

from alloy.sources.fixture import RUN_SNAPSHOTS, fixture_sql

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WSC = r"\t\n\x0b\f\r "

# What follows is stated here once more, not taken from the engine, so that a mistake in
# its lists or its renaming shows: header, bronze name ('' if bronze drops it), kind.
COLUMNS = [
    ("Tanggal", "tanggal", "date"),
    ("ID Kreator", "id_kreator", "text"),
    ("Kreator", "kreator", "text"),
    ("Nama Panggilan", "nama_panggilan", "text"),
    ("Toko", "toko", "text"),
    ("Waktu Live", "waktu_live", "text"),
    ("Nilai barang dagangan bruto (LIVE) (Rp)", "nilai_barang_dagangan_bruto_live_rp", "number"),
    ("Produk yang ditambahkan", "produk_yang_ditambahkan", "number"),
    ("Produk Terjual", "produk_terjual", "number"),
    ("Pesanan SKU yang dibuat", "pesanan_sku_yang_dibuat", "number"),
    ("Pesanan SKU (LIVE)", "pesanan_sku_live", "number"),
    ("Produk yang terjual dari LIVE", "produk_yang_terjual_dari_live", "number"),
    ("Pembeli", "pembeli", "number"),
    ("Harga Rata-Rata (Rp)", "harga_ratarata_rp", "number"),
    ("GMV yang didapat dari LIVE (Rp)", "gmv_yang_didapat_dari_live_rp", "number"),
    ("Penonton", "penonton", "number"),
    ("Live Stream Dilihat", "live_stream_dilihat", "number"),
    ("Durasi menonton rata-rata (Siaran LIVE)", "durasi_menonton_ratarata_siaran_live", "number"),
    ("Komentar", "komentar", "number"),
    ("Live Dibagikan", "live_dibagikan", "number"),
    ("Suka pada LIVE", "suka_pada_live", "number"),
    ("Pengikut baru (Video kreator)", "pengikut_baru_video_kreator", "number"),
    ("Produk Dilihat", "produk_dilihat", "number"),
    ("Klik Produk", "klik_produk", "number"),
    ("Rasio pesanan per klik (LIVE)", "rasio_pesanan_per_klik_live", "percent"),
    ("CTR", "ctr", "percent"),
    ("GMV LIVE (Rp)", "", "text"),
    ("Produk yang terjual melalui LIVE", "", "text"),
]
DATA_COLS = [c for c, _, _ in COLUMNS]
NUMERIC = [c for c, _, kind in COLUMNS if kind == "number"]
CHECKED = NUMERIC + [c for c, _, kind in COLUMNS if kind == "percent"]
RAW_HASH = ["Waktu Live", "Toko", "ID Kreator", "Produk yang ditambahkan", "Produk Dilihat"]

# Silver column, bronze column, kind.
TEXT = ["toko", "id_kreator", "kreator", "nama_panggilan"]
TYPED = [
    ("gmv_bruto_live", "nilai_barang_dagangan_bruto_live_rp", "money"),
    ("gmv_live", "gmv_yang_didapat_dari_live_rp", "money"),
    ("produk_ditambahkan", "produk_yang_ditambahkan", "int"),
    ("produk_terjual", "produk_terjual", "int"),
    ("pesanan_sku_dibuat", "pesanan_sku_yang_dibuat", "int"),
    ("pesanan_sku_live", "pesanan_sku_live", "int"),
    ("produk_terjual_dari_live", "produk_yang_terjual_dari_live", "int"),
    ("pembeli", "pembeli", "int"),
    ("harga_rata_rata", "harga_ratarata_rp", "money"),
    ("cvr_live", "rasio_pesanan_per_klik_live", "ratio"),
    ("penonton", "penonton", "int"),
    ("live_stream_dilihat", "live_stream_dilihat", "int"),
    ("durasi_tonton_rata", "durasi_menonton_ratarata_siaran_live", "int"),
    ("komentar", "komentar", "int"),
    ("live_dibagikan", "live_dibagikan", "int"),
    ("suka_pada_live", "suka_pada_live", "int"),
    ("follower_baru", "pengikut_baru_video_kreator", "int"),
    ("produk_dilihat", "produk_dilihat", "int"),
    ("klik_produk", "klik_produk", "int"),
    ("ctr_live", "ctr", "ratio"),
]
LINEAGE = ["snapshot_ts", "snapshot_date", "run_id", "row_hash_raw"]
SILVER = ["tanggal", *TEXT, "pukul_live", "waktu_live_time", "sesi_start", *[name for name, _, _ in TYPED], *LINEAGE, "row_hash_clean"]


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def blank_cell(c: str) -> str:
    return f"({c} IS NULL OR regexp_full_match({c}, '(?i)[{WSC}]*(\\-|nan|none|nat)?[{WSC}]*'))"


def has_content(c: str) -> str:
    return f"({c} IS NOT NULL AND NOT regexp_full_match({c}, '(?i)[{WSC}]*(nan|none|\\-|n/a)?[{WSC}]*'))"


def numeric_corrupt(c: str) -> str:
    return f"({has_content(c)} AND regexp_matches({c}, '(?s)[^0-9.,Rp#\\-{WSC}]|^[^0-9]*$|,.*,'))"


def percent_corrupt(c: str) -> str:
    return f"({has_content(c)} AND regexp_matches({c}, '[^0-9.,%#\\-{WSC}]'))"


def number_text(c: str) -> str:
    return f"translate(regexp_replace({c}, '[^0-9,.]', '', 'g'), ',.', '.')"


def number(c: str) -> str:
    return f"TRY_CAST({number_text(c)} AS DECIMAL(38,9))"


def number_fill(c: str) -> str:
    return f"coalesce({number(c)}, CAST(0 AS DECIMAL(38,9)))"


def parse_date(c: str) -> str:
    """Mixed-date parse; ``c`` is referenced many times, so pass a column name."""
    s = f"(CASE WHEN {strip(c)} IN ('', '-', 'nan', 'None') THEN NULL ELSE {strip(c)} END)"
    sn = f"translate({s}, '-.', '//')"
    return (
        "coalesce("
        f"CASE WHEN regexp_full_match({sn}, '[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}') THEN try_strptime({sn}, '%Y/%m/%d') END, "
        f"CASE WHEN regexp_full_match({sn}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') THEN try_strptime({sn}, '%d/%m/%Y') END, "
        f"CASE WHEN regexp_full_match({sn}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}}') THEN try_strptime({sn}, '%d/%m/%y') END, "
        f"CASE WHEN regexp_full_match({s}, '[0-9]{{3,6}}') AND TRY_CAST({s} AS INTEGER) <= 106751 "
        f"THEN CAST(DATE '1899-12-30' + TRY_CAST({s} AS INTEGER) AS TIMESTAMP) END, "
        f"CASE WHEN regexp_full_match({s}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[ T][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}([.][0-9]{{1,6}})?)?') "
        f"THEN TRY_CAST({s} AS TIMESTAMP) END)"
    )


FLOAT_RE = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)"


def session_hour(w: str) -> str:
    h = f"{strip(f'split_part(list_extract(string_split({w}, {chr(39)}/{chr(39)}), 4), {chr(39)}:{chr(39)}, 1)')}"
    return f"(CASE WHEN regexp_full_match({h}, '{FLOAT_RE}') THEN TRY_CAST(round(TRY_CAST({h} AS DOUBLE)) AS INTEGER) END)"


def time_from_hour(h: str) -> str:
    return f"(CASE WHEN {h} >= 0 AND {h} <= 23 THEN lpad(CAST({h} AS VARCHAR), 2, '0') || ':00:00' END)"


def parse_hhmm(w: str) -> str:
    hh = f"TRY_CAST(split_part({w}, ':', 1) AS INTEGER)"
    mm = f"TRY_CAST(split_part({w}, ':', 2) AS INTEGER)"
    return (f"(CASE WHEN regexp_full_match({w}, '[0-9]{{1,2}}:[0-9]{{1,2}}') AND {hh} <= 23 AND {mm} <= 59 "
            f"THEN lpad(CAST({hh} AS VARCHAR), 2, '0') || ':' || lpad(CAST({mm} AS VARCHAR), 2, '0') || ':00' END)")


def percent_ratio(c: str, decimal_comma: bool = False) -> str:
    txt = f"regexp_replace({c}, '[%\\\\s]', '', 'g')"
    if decimal_comma:
        txt = f"translate({strip(txt)}, ',', '.')"
    return f"(CASE WHEN regexp_full_match({txt}, '{FLOAT_RE}') THEN TRY_CAST({txt} AS DOUBLE) / 100.0 END)"


def canon(c: str) -> str:
    return f"upper({strip(f'coalesce(CAST({c} AS VARCHAR), {chr(39)}{chr(39)})')})"


def upper_trim(c: str) -> str:
    return f"upper({strip(c)})"


def num_text(c: str) -> str:
    s = f"CAST(CAST({c} AS DECIMAL(38,9)) AS VARCHAR)"
    return f"(CASE WHEN contains({s}, '.') THEN regexp_replace({s}, '\\.?0+$', '') ELSE {s} END)"


def round_to_long(c: str) -> str:
    return f"TRY_CAST(round({c}) AS BIGINT)"


# --- stage CTEs ------------------------------------------------------------------

def raw_cte(run: int) -> str:
    return f"raw{run} AS ({fixture_sql(run)})"


def flag_cte(run: int) -> str:
    idc = q("ID Kreator")
    blank = " AND ".join(blank_cell(q(c)) for c in DATA_COLS)
    bits = " | ".join(
        f"(CASE WHEN {numeric_corrupt(q(c)) if i < len(NUMERIC) else percent_corrupt(q(c))} "
        f"THEN CAST({1 << i} AS BIGINT) ELSE CAST(0 AS BIGINT) END)"
        for i, c in enumerate(CHECKED)
    )
    return (
        f"f0_{run} AS (SELECT *, {blank} AS _blank, ({bits}) AS _bad_mask, "
        f"{parse_date(q('Tanggal'))} AS _parsed FROM raw{run} "
        f"WHERE {idc} IS NULL OR {strip(idc)} <> ''), "
        f"flag{run} AS (SELECT *, _bad_mask <> 0 AS _corrupt, _parsed IS NULL AS _date_error, "
        f"((_bad_mask <> 0) OR _parsed IS NULL) AND NOT _blank AS _error, "
        f"CASE WHEN ((_bad_mask <> 0) OR _parsed IS NULL) AND NOT _blank THEN concat_ws('|', "
        f"CASE WHEN _bad_mask <> 0 THEN 'numeric_mixed' END, CASE WHEN _parsed IS NULL THEN 'date_unparsable' END) "
        f"END AS error_reason FROM f0_{run})"
    )


def valid_cte(run: int) -> str:
    cols = ["sheet_name", "creds", "row_no"]
    for c in DATA_COLS:
        if c in NUMERIC:
            cols.append(f"{number_fill(q(c))} AS {q(c)}")
        elif c == "Tanggal":
            cols.append(f"_parsed AS {q(c)}")
        else:
            cols.append(q(c))
    return f"valid{run} AS (SELECT {', '.join(cols)} FROM flag{run} WHERE NOT _error AND NOT _blank)"


def counts_cte(run: int) -> str:
    return (f"counts{run} AS (SELECT sheet_name, creds, strftime(CAST({q('Tanggal')} AS DATE), '%Y-%m-%d') AS error_date, "
            f"count(*) AS n_valid FROM valid{run} GROUP BY ALL)")


def entries_cte(run: int) -> str:
    """Manifest entries of a run (affected columns as a comma list)."""
    aff = " || ".join(
        f"CASE WHEN (m & {1 << i}) <> 0 THEN {chr(39)}{c}{chr(39)} || ',' ELSE '' END" for i, c in enumerate(CHECKED)
    )
    ts, _ = RUN_SNAPSHOTS[run]
    now = ts.replace(" ", "T")
    day = ts[:10].replace("-", "")
    path = f"quarantine/date={day}/run_key={day}{ts[11:13]}"
    return (
        f"aff{run} AS (SELECT rtrim({aff}, ',') AS affected FROM (SELECT coalesce(bit_or(_bad_mask), 0) AS m FROM flag{run})), "
        f"entries{run} AS (SELECT sheet_name, creds, coalesce(strftime(CAST(_parsed AS DATE), '%Y-%m-%d'), 'INVALID_DATE') AS error_date, "
        f"(SELECT affected FROM aff{run}) AS affected_columns, count(*) AS n_rows, '{now}' AS reported_at, "
        f"'{path}' AS path, 'open' AS status FROM flag{run} WHERE _error GROUP BY sheet_name, creds, 3)"
    )


def reconcile2_cte() -> str:
    """Run 2 against run 1's manifest (run 1 had no earlier manifest)."""
    k = "sheet_name, creds, error_date"
    return (
        f"stale2 AS (SELECT p.* FROM entries1 p WHERE NOT EXISTS (SELECT 1 FROM entries2 c WHERE "
        f"c.sheet_name IS NOT DISTINCT FROM p.sheet_name AND c.creds IS NOT DISTINCT FROM p.creds "
        f"AND c.error_date IS NOT DISTINCT FROM p.error_date)), "
        f"judged2 AS (SELECT s.*, v.n_valid FROM stale2 s LEFT JOIN counts2 v ON "
        f"s.sheet_name IS NOT DISTINCT FROM v.sheet_name AND s.creds IS NOT DISTINCT FROM v.creds "
        f"AND s.error_date IS NOT DISTINCT FROM v.error_date), "
        f"resolved2 AS (SELECT * EXCLUDE (n_valid) FROM judged2 WHERE n_rows > 0 AND coalesce(n_valid, 0) = n_rows), "
        f"remaining2 AS (SELECT * EXCLUDE (n_valid) FROM judged2 WHERE NOT (n_rows > 0 AND coalesce(n_valid, 0) = n_rows) "
        f"UNION ALL SELECT * FROM entries2), "
        f"rgroups2 AS (SELECT r.{k.replace(', ', ', r.')}, r.n_rows, coalesce(v.n_valid, 0) AS n_valid, "
        f"CASE WHEN coalesce(v.n_valid, 0) = 0 THEN 'absent' WHEN coalesce(v.n_valid, 0) = coalesce(r.n_rows, 0) "
        f"THEN 'recovered' ELSE 'count_mismatch' END AS outcome FROM resolved2 r LEFT JOIN counts2 v ON "
        f"r.sheet_name IS NOT DISTINCT FROM v.sheet_name AND r.creds IS NOT DISTINCT FROM v.creds "
        f"AND r.error_date IS NOT DISTINCT FROM v.error_date), "
        f"vk2 AS (SELECT *, strftime(CAST({q('Tanggal')} AS DATE), '%Y-%m-%d') AS _ek FROM valid2), "
        f"recovered2 AS (SELECT * EXCLUDE (_ek) FROM vk2 v WHERE EXISTS (SELECT 1 FROM rgroups2 g WHERE "
        f"g.outcome = 'recovered' AND g.sheet_name IS NOT DISTINCT FROM v.sheet_name AND g.creds IS NOT DISTINCT FROM v.creds "
        f"AND g.error_date IS NOT DISTINCT FROM v._ek)), "
        f"regular2 AS (SELECT * EXCLUDE (_ek) FROM vk2 v WHERE NOT EXISTS (SELECT 1 FROM rgroups2 g WHERE "
        f"g.outcome = 'recovered' AND g.sheet_name IS NOT DISTINCT FROM v.sheet_name AND g.creds IS NOT DISTINCT FROM v.creds "
        f"AND g.error_date IS NOT DISTINCT FROM v._ek))"
    )


def bronze_select(src: str, run: int, path: int) -> str:
    """SELECT of bronze rows (before watermark filter and dedup) from valid rows."""
    ts, rid = RUN_SNAPSHOTS[run]
    out = []
    for c, name, _ in [(t, t, "") for t in ("sheet_name", "creds", "row_no")] + COLUMNS:
        if name:
            out.append(f"{q(c)} AS {name}")
    w = q("Waktu Live")
    hash_parts = []
    for orig in RAW_HASH:
        if orig in NUMERIC:
            hash_parts.append(f"coalesce({num_text(q(orig))}, '')")
        else:
            hash_parts.append(canon(q(orig)))
    out += [
        f"{session_hour(w)} AS pukul_live",
        f"TIMESTAMP '{ts}' AS snapshot_ts",
        f"DATE '{ts[:10]}' AS snapshot_date",
        f"'{rid}' AS run_id",
        f"sha256(concat_ws('||', {', '.join(hash_parts)})) AS row_hash_raw",
        f"{path} AS path",
    ]
    return f"SELECT {', '.join(out)} FROM {src} WHERE {w} IS NULL OR {strip(w)} <> ''"


def wm_filter(src: str, wm: str, by_day: bool = False) -> str:
    """Keep rows after their source's watermark (``wm``: creds, last_processed_date)."""
    when, mark = ("CAST(b.tanggal AS DATE)", "w._wm") if by_day else ("CAST(b.tanggal AS TIMESTAMP)", "CAST(w._wm AS TIMESTAMP)")
    return (f"SELECT b.* FROM ({src}) b LEFT JOIN (SELECT creds AS _wk, TRY_CAST(last_processed_date AS DATE) AS _wm "
            f"FROM {wm} WHERE TRY_CAST(last_processed_date AS DATE) IS NOT NULL) w ON b.creds = w._wk "
            f"WHERE w._wm IS NULL OR {when} > {mark}")


def dedup(src: str) -> str:
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY row_hash_raw "
            f"ORDER BY path, sheet_name, row_no) AS _rn FROM ({src})) WHERE _rn = 1")


def max_dates(src: str) -> str:
    return (f"SELECT creds, strftime(max(CAST(tanggal AS DATE)), '%Y-%m-%d') AS last_processed_date FROM ({src}) "
            f"WHERE creds IS NOT NULL AND tanggal IS NOT NULL GROUP BY creds")


def bronze_ctes() -> str:
    """bronze1 (full load), maxd1, bronze2 (regular with run-1 marks + recovered)."""
    return (
        f"pre1 AS ({bronze_select('valid1', 1, 0)}), "
        f"bronze1 AS ({dedup('SELECT * FROM pre1')}), "
        f"maxd1 AS ({max_dates('SELECT * FROM pre1')}), "
        f"pre2r AS ({wm_filter(bronze_select('regular2', 2, 0), 'maxd1')}), "
        f"pre2a AS ({bronze_select('recovered2', 2, 1)}), "
        f"maxd2 AS ({max_dates('SELECT * FROM pre2r')}), "
        f"bronze2 AS ({dedup('SELECT * FROM pre2r UNION ALL SELECT * FROM pre2a')})"
    )


def silver_source(bronze: str, decimal_comma: bool = False) -> str:
    """Latest per session, typed, hashed."""
    order = "snapshot_ts DESC, run_id DESC, row_hash_raw DESC, sheet_name DESC, row_no DESC"
    latest = (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {upper_trim('toko')}, "
              f"{upper_trim('id_kreator')}, CAST(tanggal AS DATE), pukul_live ORDER BY {order}) AS _rn "
              f"FROM ({bronze})) WHERE _rn = 1")
    hour = round_to_long("pukul_live")
    t = f"(CASE WHEN {hour} IS NOT NULL THEN {time_from_hour(hour)} ELSE {parse_hhmm('waktu_live')} END)"
    day = "CAST(tanggal AS DATE)"
    cols = [f"{day} AS tanggal"] + [f"{upper_trim(c)} AS {c}" for c in TEXT] + [
        f"{hour} AS pukul_live", f"{t} AS waktu_live_time",
        f"CASE WHEN {day} IS NOT NULL AND {t} IS NOT NULL THEN {day} + CAST({t} AS TIME) END AS sesi_start",
    ]
    for name, src, kind in TYPED:
        if kind == "money":
            cols.append(f"TRY_CAST({src} AS DECIMAL(38,9)) AS {name}")
        elif kind == "int":
            cols.append(f"{round_to_long(f'TRY_CAST({src} AS DECIMAL(38,9))')} AS {name}")
        else:
            cols.append(f"{percent_ratio(src, decimal_comma)} AS {name}")
    cols += LINEAGE
    parts = ["strftime(tanggal, '%Y-%m-%d')"] + [f"coalesce({c}, '')" for c in TEXT] + [
        "CAST(coalesce(pukul_live, -1) AS VARCHAR)", "waktu_live_time",
        "strftime(sesi_start, '%Y-%m-%d %H:%M:%S')",
    ] + [(f"CASE WHEN abs({n}) < 1000 THEN CAST(CAST({n} AS DECIMAL(38,12)) AS VARCHAR) WHEN {n} IS NOT NULL THEN "
          f"coalesce(CAST(TRY_CAST({n} AS DECIMAL(38,2)) AS VARCHAR), 'huge') END") if k == "ratio" else f"CAST({n} AS VARCHAR)"
         for n, _, k in TYPED]
    return (f"SELECT {', '.join(SILVER[:-1])}, sha256(concat_ws('||', {', '.join(parts)})) AS row_hash_clean "
            f"FROM (SELECT {', '.join(cols)} FROM ({latest}))")


def upsert(target: str, source: str, with_action: bool = False) -> str:
    """MERGE as a keyed full outer join plus pass-through of unkeyed rows."""
    mk = "coalesce('H' || CAST(pukul_live AS VARCHAR), 'T' || waktu_live_time)"
    keyed = "tanggal IS NOT NULL AND toko IS NOT NULL AND id_kreator IS NOT NULL AND _mk IS NOT NULL"
    take_s = "(s._mk IS NOT NULL AND (t._mk IS NULL OR coalesce(t.row_hash_clean <> s.row_hash_clean, false)))"
    sel = ", ".join(f"CASE WHEN {take_s} THEN s.{c} ELSE t.{c} END AS {c}" for c in SILVER)
    action = (f"CASE WHEN t._mk IS NULL THEN 'insert' WHEN s._mk IS NULL THEN 'retain' "
              f"WHEN {take_s} THEN 'update' ELSE 'keep' END AS _action")
    cols = ", ".join(SILVER)
    tk = f"(SELECT * FROM (SELECT *, {mk} AS _mk FROM ({target})) WHERE {keyed})"
    sk = f"(SELECT * FROM (SELECT *, {mk} AS _mk FROM ({source})) WHERE {keyed})"
    body = (
        f"SELECT {sel}, {action} FROM {tk} t FULL OUTER JOIN {sk} s "
        f"ON t.tanggal = s.tanggal AND t.toko = s.toko AND t.id_kreator = s.id_kreator AND t._mk = s._mk "
        f"UNION ALL SELECT {cols}, 'retain' FROM (SELECT *, {mk} AS _mk FROM ({target})) WHERE NOT ({keyed}) "
        f"UNION ALL SELECT {cols}, 'insert' FROM (SELECT *, {mk} AS _mk FROM ({source})) WHERE NOT ({keyed})"
    )
    if with_action:
        return body
    return f"SELECT * EXCLUDE (_action) FROM ({body})"


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ", ".join(ctes) + " " + select


def base_ctes(runs=(1, 2), bronze: bool = True) -> list[str]:
    out = []
    for r in runs:
        out += [raw_cte(r), flag_cte(r), valid_cte(r), counts_cte(r), entries_cte(r)]
    if 0 in runs and bronze:
        out.append(f"pre0 AS ({bronze_select('valid0', 0, 0)}), bronze0 AS ({dedup('SELECT * FROM pre0')})")
    if 2 in runs:
        out.append(reconcile2_cte())
        if bronze:
            out.append(bronze_ctes())
    return out
