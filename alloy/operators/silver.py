"""Silver: latest bronze row per session, typed projection, clean hash, upsert.

The upsert has the warehouse MERGE's effect: a session is known by day, shop,
creator and hour (or, if neither side has an hour, time); a known session is
replaced when its clean hash differs, an unknown one is added.

Hour and time become one equi key, ``merge_key = coalesce('H'||hour,
'T'||time)``, so the match is a plain four-key join. Rows with a NULL in any
key can never match; they are split off before the join (so they cannot pile
onto one reducer) and pass straight through: target rows are kept, source rows
are inserted again every run, as in the warehouse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from alloy.functions import (
    clean_row_hash,
    hash_text,
    parse_hhmm,
    percent_ratio,
    round_to_long,
    session_start,
    time_from_hour,
    upper_trim,
)
from alloy.operators.common import empty, one_per_key

MONEY = "decimal(38,9)"

# Fixed values: (silver column, bronze column, kind); kind drives type and hash text.
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
TEXT = ["toko", "id_kreator", "kreator", "nama_panggilan"]
LINEAGE = ["snapshot_ts", "snapshot_date", "run_id", "row_hash_raw"]
SILVER_COLS = (["tanggal"] + TEXT + ["pukul_live", "waktu_live_time", "sesi_start"]
               + [t[0] for t in TYPED] + LINEAGE + ["row_hash_clean"])
SILVER_SCHEMA = (
    "tanggal date, toko string, id_kreator string, kreator string, nama_panggilan string, "
    "pukul_live bigint, waktu_live_time string, sesi_start timestamp_ntz, "
    + ", ".join(f"{n} {dict(money=MONEY, int='bigint', ratio='double')[k]}" for n, _, k in TYPED)
    + ", snapshot_ts timestamp, snapshot_date date, run_id string, row_hash_raw string, row_hash_clean string"
)
MATCH_KEYS = ["tanggal", "toko", "id_kreator", "_mk"]


def _col(df: DataFrame, name: str, dtype: str = "string") -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(dtype)


def session_keys(df: DataFrame, split_by_time: bool = False) -> list[Column]:
    """Dedup key of a session: UPPER(TRIM(toko)), UPPER(TRIM(id)), DATE(tanggal), hour.

    By default sessions without an hour share one key per shop/creator/day (as
    in the source system). ``split_by_time`` keys them by their parsed time instead,
    which is also what the merge matches on.
    """
    hour = _col(df, "pukul_live", "int")
    if split_by_time:
        hour = F.coalesce(F.concat(F.lit("H"), hour.cast("string")),
                          F.concat(F.lit("T"), parse_hhmm(_col(df, "waktu_live"))))
    return [
        upper_trim(_col(df, "toko")).alias("_k_toko"),
        upper_trim(_col(df, "id_kreator")).alias("_k_id"),
        _col(df, "tanggal", "timestamp_ntz").cast("date").alias("_k_day"),
        hour.alias("_k_hour"),
    ]


LATEST_ORDER = ("snapshot_ts", "run_id", "row_hash_raw", "sheet_name", "row_no")


def latest_per_session(bronze: DataFrame, order=LATEST_ORDER, split_by_time: bool = False, table: bool = False) -> DataFrame:
    """ROW_NUMBER() = 1 per session ordered by snapshot_ts DESC, run_id DESC.

    Rows of one build share snapshot_ts and run_id, so ties are broken by
    row_hash_raw DESC (unique within a run after dedup) and then the source
    position, which makes the pick deterministic. Written as a ``max_by``
    aggregate: partial aggregation keeps a hot session key (e.g. blank shop
    and creator) from arriving whole at one task. Of a ``table``, sessions of one
    row are taken as they are (``one_per_key``).
    """
    if table:
        return one_per_key(bronze, session_keys(bronze, split_by_time), lambda rows: latest_per_session(rows, order, split_by_time))
    cols = bronze.columns
    order_cols = [c for c in order if c in cols]
    keyed = bronze.select("*", *session_keys(bronze, split_by_time))
    picked = keyed.groupBy("_k_toko", "_k_id", "_k_day", "_k_hour").agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in cols]),
                 F.struct(*[F.col(f"`{c}`") for c in order_cols])).alias("_r"))
    return picked.select(*[F.col(f"_r.`{c}`").alias(c) for c in cols])


def restrict_to_sessions(bronze: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Bronze rows of the sessions that ``new_rows`` touch (NULL-safe: rows with
    a blank shop or no hour are sessions too). The touched key set is distinct
    and usually far smaller than bronze; AQE broadcasts it when it is."""
    keys = ["_k_toko", "_k_id", "_k_day", "_k_hour"]
    touched = new_rows.select(*session_keys(new_rows)).distinct() \
        .select(*[F.col(k).alias(f"_t{k}") for k in keys])
    keyed = bronze.select("*", *session_keys(bronze))
    cond = [F.col(k).eqNullSafe(F.col(f"_t{k}")) for k in keys]
    return keyed.join(touched, cond, "left_semi").drop(*keys)


def typed(latest: DataFrame, decimal_comma: bool = False) -> DataFrame:
    """The warehouse's typed projection (``base`` CTE), without the hash."""
    hour = round_to_long(_col(latest, "pukul_live", "int"))
    time_txt = F.when(hour.isNotNull(), time_from_hour(hour)).otherwise(parse_hhmm(_col(latest, "waktu_live")))
    day = _col(latest, "tanggal", "timestamp_ntz").cast("date")
    sel = [day.alias("tanggal")] + [upper_trim(_col(latest, c)).alias(c) for c in TEXT] + [
        hour.alias("pukul_live"),
        time_txt.alias("waktu_live_time"),
        session_start(day, time_txt).alias("sesi_start"),
    ]
    for name, src, kind in TYPED:
        c = _col(latest, src, MONEY if kind != "ratio" else "string")
        if kind == "money":
            sel.append(c.try_cast(MONEY).alias(name))
        elif kind == "int":
            sel.append(round_to_long(c.try_cast(MONEY)).alias(name))
        else:
            sel.append(percent_ratio(c.cast("string"), decimal_comma).alias(name))
    sel += [_col(latest, c, t).alias(c) for c, t in
            zip(LINEAGE, ["timestamp", "date", "string", "string"])]
    return latest.select(*sel)


def with_clean_hash(t: DataFrame) -> DataFrame:
    """SHA-256 over 28 typed values joined by '||', NULL values skipped."""
    parts = [
        hash_text(F.col("tanggal"), "date"),
        *[F.coalesce(F.col(c), F.lit("")) for c in TEXT],
        F.coalesce(F.col("pukul_live"), F.lit(-1)).cast("string"),
        F.col("waktu_live_time"),
        hash_text(F.col("sesi_start"), "timestamp"),
        *[hash_text(F.col(n), "double" if k == "ratio" else "plain") for n, _, k in TYPED],
    ]
    return t.withColumn("row_hash_clean", clean_row_hash(parts))


def silver_source(bronze: DataFrame, decimal_comma: bool = False, split_by_time: bool = False, table: bool = False) -> DataFrame:
    """Bronze -> merge source S (latest, typed, hashed), in silver column order.
    ``table``: bronze is one (or several), cheap to scan more than once."""
    latest = latest_per_session(bronze, split_by_time=split_by_time, table=table)
    return with_clean_hash(typed(latest, decimal_comma)).select(*SILVER_COLS)


def _merge_key(df: DataFrame) -> Column:
    if "_mk" in df.columns:  # stored, as the layout by match key does
        return F.col("_mk")
    return F.coalesce(F.concat(F.lit("H"), F.col("pukul_live").cast("string")),
                      F.concat(F.lit("T"), F.col("waktu_live_time")))


def _keyed(df: DataFrame) -> Column:
    return F.col("tanggal").isNotNull() & F.col("toko").isNotNull() & F.col("id_kreator").isNotNull() \
        & F.col("_mk").isNotNull()


def upsert(target: DataFrame, source: DataFrame, with_action: bool = False,
           null_safe_keys: bool = False) -> DataFrame:
    """New silver snapshot = MERGE(target, source).

    With ``with_action`` an ``_action`` column tells ``insert`` / ``update`` /
    ``keep`` (matched, hash equal) / ``retain`` (target row not in source).
    ``null_safe_keys`` lets NULL key parts match each other, so an unkeyed
    session is updated instead of inserted again by every run. Both sides are
    unique on the NULL-safe key (the source by its session dedup), so this adds
    no hot key either.
    """
    t = target.select(*SILVER_COLS, _merge_key(target).alias("_mk"))
    s = source.select(*SILVER_COLS, _merge_key(source).alias("_mk"))
    if null_safe_keys:
        empty = F.lit(False)
        t_keyed, t_loose = t, t.filter(empty)
        s_keyed, s_loose = s, s.filter(empty)
    else:
        t_keyed, t_loose = t.filter(_keyed(t)), t.filter(~_keyed(t))
        s_keyed, s_loose = s.filter(_keyed(s)), s.filter(~_keyed(s))

    merged = match_keyed(t_keyed, s_keyed, null_safe_keys, "_action")
    loose = (t_loose.select(*SILVER_COLS, F.lit("retain").alias("_action"))
             .unionByName(s_loose.select(*SILVER_COLS, F.lit("insert").alias("_action"))))
    out = merged.unionByName(loose)
    return out if with_action else out.drop("_action")


def match_keyed(t: DataFrame, s: DataFrame, null_safe_keys: bool = False, *extra: str) -> DataFrame:
    """Keyed rows of MERGE(t, s), both with ``_mk``; ``extra``: ``_mk`` or ``_action``
    beside the silver columns (without any: ``_mk``)."""
    present = F.lit(True).alias("_present")
    ta = t.select(*SILVER_COLS, "_mk", present).select(*[F.col(c).alias(f"t_{c}") for c in (*SILVER_COLS, "_mk", "_present")])
    sa = s.select(*SILVER_COLS, "_mk", present).select(*[F.col(c).alias(f"s_{c}") for c in (*SILVER_COLS, "_mk", "_present")])
    if null_safe_keys:
        cond = [F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}")) for k in MATCH_KEYS]
    else:
        cond = [F.col(f"t_{k}") == F.col(f"s_{k}") for k in MATCH_KEYS]
    j = ta.join(sa, cond, "full_outer")
    t_present = F.col("t__present").isNotNull()
    s_present = F.col("s__present").isNotNull()
    changed = F.col("t_row_hash_clean") != F.col("s_row_hash_clean")
    take_s = s_present & (~t_present | F.coalesce(changed, F.lit(False)))
    action = (F.when(~t_present, F.lit("insert"))
              .when(~s_present, F.lit("retain"))
              .when(take_s, F.lit("update"))
              .otherwise(F.lit("keep")))
    columns = (*SILVER_COLS, *(extra or ("_mk",)))
    return j.select(*[action.alias(c) if c == "_action" else F.when(take_s, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c)
                      for c in columns])


def split_keyed(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a whole match key, with it as ``_mk``; rows that no merge can match)."""
    known = silver.select(*SILVER_COLS, _merge_key(silver).alias("_mk"))
    return known.filter(_keyed(known)), known.filter(~_keyed(known))


def require_unique(source: DataFrame) -> None:
    """Fail if two source rows have one match key: a merge would multiply them.
    One job over four narrow columns, with partial counts before the shuffle."""
    keyed = source.withColumn("_mk", _merge_key(source))
    twice = keyed.filter(_keyed(keyed)).groupBy(*MATCH_KEYS).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not twice.isEmpty():
        raise ValueError("the merge source has several rows for one session")


#: What silver reads of bronze, whatever columns a load brought.
BRONZE_SCHEMA = (
    "sheet_name string, creds string, row_no bigint, tanggal timestamp_ntz, toko string, id_kreator string, "
    "kreator string, nama_panggilan string, waktu_live string, pukul_live int, "
    + ", ".join(f"{src} {'string' if k == 'ratio' else MONEY}" for _, src, k in TYPED)
    + ", snapshot_ts timestamp, snapshot_date date, run_id string, row_hash_raw string, path int, "
    "date string, run_key string, load_id string, day date"
)


def empty_silver(spark) -> DataFrame:
    """Empty target with the fixed 33-column silver schema."""
    return empty(spark, SILVER_SCHEMA)
