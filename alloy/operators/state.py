"""Persisted run state as DataFrames: source watermarks and the error manifest.

State tables are small (one row per source, one per failing (sheet, source,
day)); they are joined to the data with size-checked broadcasts. Nothing is
looped over on the driver.

Watermark record: ``(creds, sheet_name, last_processed_date, updated_at)``; an
old-format record has no ``creds`` and is translated through the registry
``(sheet_name, creds, ord)``.

Manifest entry: ``(sheet_name, creds, error_date, affected_columns,
n_rows, reported_at, path, status)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from alloy.constants import INVALID_DATE, STATUS_FIXED, STATUS_OPEN, WHITESPACE
from alloy.functions import error_date_key
from alloy.operators.common import measured, small

WATERMARK_SCHEMA = "creds string, sheet_name string, last_processed_date string, updated_at string"
DATES_SCHEMA = "creds string, last_processed_date string"
MANIFEST_SCHEMA = ("sheet_name string, creds string, error_date string, affected_columns array<string>, "
                   "n_rows bigint, reported_at string, path string, status string")
FIX_SCHEMA = ("sheet_name string, creds string, error_date string, affected_columns array<string>, "
              "resolved_at string, path string, status string")  # of the fix records on disk
KEYS = ["sheet_name", "creds", "error_date"]


def _blank(c: Column) -> Column:
    return c.isNull() | (c == F.lit(""))


# --- watermarks --------------------------------------------------------------

def resolve_record_creds(records: DataFrame, registry: DataFrame) -> DataFrame:
    """Add ``_creds``: the record's creds, or (old format) the registry's creds
    for its sheet name, or the sheet name itself (which means a full load)."""
    reg = registry.select(F.col("sheet_name").alias("_reg_name"), F.col("creds").alias("_reg_creds"))
    j = records.join(small(reg), records["sheet_name"] == F.col("_reg_name"), "left")
    creds = F.when(~_blank(F.col("creds")), F.col("creds")).otherwise(
        F.when(~_blank(F.col("_reg_creds")), F.col("_reg_creds")).otherwise(F.col("sheet_name")))
    return j.withColumn("_creds", creds).drop("_reg_name", "_reg_creds")


def load_watermarks(records: DataFrame, registry: DataFrame) -> DataFrame:
    """Watermark map ``(creds, last_processed_date)``: for sources sharing one
    key the greatest date wins; dates are the first 10 characters, stripped."""
    r = resolve_record_creds(records, registry)
    day = F.substring(F.btrim(F.col("last_processed_date").cast("string"), F.lit(WHITESPACE)), 1, 10)
    return (r.filter(F.col("_creds").isNotNull())
            .groupBy(F.col("_creds").alias("creds"))
            .agg(F.max(day).alias("last_processed_date")))


def rewrite_watermarks(prev_records: DataFrame, new_dates: DataFrame, registry: DataFrame,
                       now_iso: str, mode: str = "replace") -> DataFrame:
    """Watermark records to write after a run, sorted by creds.

    ``replace`` (the source system): only sources with new rows this run are
    written, so an idle source loses its mark. ``retain``: earlier marks are
    kept and each source keeps the greater of its old and new date.
    The sheet name of a key is the registry's (last registered name wins), else
    the first earlier record's, else the key itself.
    """
    reg_last = (registry.groupBy("creds")
                .agg(F.max_by("sheet_name", "ord").alias("_reg_name")))
    reg_names = registry.select(F.col("sheet_name").alias("_n"), F.col("creds").alias("_c"))
    # Earlier records: resolve their key the way the source system does.
    prev = prev_records.withColumn("_ord", F.monotonically_increasing_id()) if "_ord" not in prev_records.columns \
        else prev_records
    pj = (prev.join(small(reg_names), prev["sheet_name"] == F.col("_n"), "left")
          .join(small(reg_last.select(F.col("creds").alias("_rc"), F.lit(True).alias("_known"))),
                prev["creds"] == F.col("_rc"), "left"))
    key = (F.when(_blank(F.col("creds")), F.coalesce(F.when(~_blank(F.col("_c")), F.col("_c")), F.col("sheet_name")))
           .when(~_blank(F.col("sheet_name")) & F.col("_known").isNull() & ~_blank(F.col("_c")), F.col("_c"))
           .otherwise(F.col("creds")))
    prev_names = (pj.select(key.alias("creds"), "sheet_name", "_ord", "last_processed_date", "updated_at")
                  .groupBy("creds").agg(F.min_by("sheet_name", "_ord").alias("_prev_name"),
                                        F.max(F.substring("last_processed_date", 1, 10)).alias("_old_date"),
                                        F.max("updated_at").alias("_old_at")))

    new = new_dates.select("creds", F.col("last_processed_date").alias("_new_date"))
    if mode == "replace":
        rows = new.join(prev_names, "creds", "left")
        date, at = F.col("_new_date"), F.lit(now_iso)
    elif mode == "retain":
        rows = new.join(prev_names, "creds", "full_outer")
        date = F.greatest(F.col("_new_date"), F.col("_old_date"))
        at = F.when(F.col("_new_date").isNotNull(), F.lit(now_iso)).otherwise(F.col("_old_at"))
    else:
        raise ValueError(f"unknown watermark mode {mode!r}")
    rows = rows.join(reg_last, "creds", "left")
    return rows.select(
        "creds",
        F.coalesce(F.col("_reg_name"), F.col("_prev_name"), F.col("creds")).alias("sheet_name"),
        date.alias("last_processed_date"),
        at.alias("updated_at"),
    ).orderBy("creds")


# --- error manifest ----------------------------------------------------------

def manifest_entries(flagged: DataFrame, affected: Column, now_iso: str, path: str) -> DataFrame:
    """Open entries of this run: error rows grouped by (sheet, creds, day)."""
    err = flagged.filter(F.col("_error"))
    return (err.groupBy(F.col("sheet_name").cast("string").alias("sheet_name"),
                        F.col("creds").cast("string").alias("creds"),
                        error_date_key(F.col("_parsed")).alias("error_date"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(*KEYS, affected.alias("affected_columns"), "n_rows",
                    F.lit(now_iso).alias("reported_at"), F.lit(path).alias("path"),
                    F.lit(STATUS_OPEN).alias("status")))


def valid_counts(valid: DataFrame, date_col: str = "Tanggal") -> DataFrame:
    """Valid rows per (sheet, creds, day); partial aggregation absorbs skew."""
    return (valid.groupBy(F.col("sheet_name").cast("string").alias("sheet_name"),
                          F.col("creds").cast("string").alias("creds"),
                          F.date_format(F.col(f"`{date_col}`").cast("date"), "yyyy-MM-dd").alias("error_date"))
            .agg(F.count(F.lit(1)).alias("n_valid")))


def _key_join(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the manifest key with NULL-safe equality (the source compares
    ``str()`` of the values, so two missing values are equal). The right side
    is re-aliased so frames sharing lineage can be joined without ambiguity."""
    r = right.select(*[F.col(f"`{c}`").alias(f"_r_{c}" if c in KEYS else c) for c in right.columns])
    cond = [left[k].eqNullSafe(F.col(f"_r_{k}")) for k in KEYS]
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti"):
        return out
    return out.drop(*[f"_r_{k}" for k in KEYS])


def open_entries(previous: DataFrame) -> DataFrame:
    return previous.filter(F.col("status") == F.lit(STATUS_OPEN))


def reconcile(previous: DataFrame, current: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge the open manifest with this run's entries.

    Returns ``(remaining, resolved)``:
    * an open entry whose key failed again is replaced by the fresh entry;
    * an open entry not seen this run is resolved only if it is confirmed: its
      key now has exactly ``n_rows`` (> 0) valid rows; otherwise it stays open;
    * fresh entries for new keys are added.
    Records with another status are dropped.
    """
    prev = open_entries(previous).select(*MANIFEST_SCHEMA_COLS)
    cur_keys = current.select(*KEYS).distinct()
    stale = _key_join(prev, small(cur_keys), "left_anti")
    judged = _key_join(stale, counts_for(counts, stale), "left")
    confirmed = (F.col("n_rows") > 0) & (F.coalesce(F.col("n_valid"), F.lit(0)) == F.col("n_rows"))
    resolved = judged.filter(confirmed).select(*MANIFEST_SCHEMA_COLS)
    still_open = judged.filter(~confirmed).select(*MANIFEST_SCHEMA_COLS)
    remaining = still_open.unionByName(current.select(*MANIFEST_SCHEMA_COLS))
    return remaining, resolved


MANIFEST_SCHEMA_COLS = ["sheet_name", "creds", "error_date", "affected_columns", "n_rows",
                        "reported_at", "path", "status"]


def counts_for(counts: DataFrame, keys: DataFrame) -> DataFrame:
    """Valid counts restricted to the given keys (keeps the broadcast side small)."""
    return _key_join(counts, keys.select(*KEYS).distinct(), "left_semi")


def manifest_changed(previous: DataFrame, remaining: DataFrame, resolved: DataFrame) -> bool:
    """True when a write is needed: something resolved, or the open set differs
    (ignoring ``reported_at``, which changes every run). One job."""
    cols = [c for c in MANIFEST_SCHEMA_COLS if c != "reported_at"]
    a = open_entries(previous).select(*cols)
    b = remaining.select(*cols)
    probe = (resolved.select(F.lit(1).alias("x"))
             .unionByName(a.exceptAll(b).select(F.lit(1).alias("x")))
             .unionByName(b.exceptAll(a).select(F.lit(1).alias("x"))))
    return not probe.isEmpty()


def fix_records(resolved: DataFrame, now_iso: str) -> DataFrame:
    return resolved.select(
        *KEYS,
        F.coalesce(F.col("affected_columns"), F.array().cast("array<string>")).alias("affected_columns"),
        F.lit(now_iso).alias("resolved_at"),
        F.coalesce(F.col("path"), F.lit("")).alias("path"),
        F.lit(STATUS_FIXED).alias("status"),
    )


def _valid_key(valid: DataFrame, date_col: str) -> DataFrame:
    return valid.withColumn("error_date", F.date_format(F.col(f"`{date_col}`").cast("date"), "yyyy-MM-dd"))


def recovery_groups(resolved: DataFrame, counts: DataFrame) -> DataFrame:
    """Resolved keys with their valid count and the recovery outcome."""
    j = _key_join(resolved.select(*KEYS, "n_rows"), counts, "left")
    n = F.coalesce(F.col("n_valid"), F.lit(0))
    outcome = (F.when(n == 0, F.lit("absent"))
               .when(n == F.coalesce(F.col("n_rows"), F.lit(0)), F.lit("recovered"))
               .otherwise(F.lit("count_mismatch")))
    return j.select(*KEYS, "n_rows", n.alias("n_valid"), outcome.alias("outcome"))


def split_recovered(valid: DataFrame, resolved: DataFrame, counts: DataFrame,
                    date_col: str = "Tanggal") -> tuple[DataFrame, DataFrame]:
    """(recovered, regular): valid rows of fully recovered keys bypass the
    watermark; every other valid row takes the regular path.

    Recovered keys are a subset of the previous manifest's open entries. They
    meet the rows in one NULL-safe semi / anti join: a broadcast join behind the
    size check, else one that Spark plans (and splits on a hot key) at run time.
    """
    groups = recovery_groups(resolved, counts).filter(F.col("outcome") == "recovered").select(*KEYS)
    groups = measured(groups, "recovered-keys")
    keyed = _valid_key(valid, date_col)
    recovered = _key_join(keyed, small(groups), "left_semi")
    regular = _key_join(keyed, small(groups), "left_anti")
    return recovered.drop("error_date"), regular.drop("error_date")


def recovery_report(resolved: DataFrame, counts: DataFrame) -> DataFrame:
    """One row: resolved keys, recovered rows, count mismatches, absent keys."""
    g = recovery_groups(resolved, counts)
    return g.agg(
        F.count(F.lit(1)).alias("recovery_resolved"),
        F.coalesce(F.sum(F.when(F.col("outcome") == "recovered", F.col("n_valid"))), F.lit(0))
        .cast("bigint").alias("recovery_recovered_rows"),
        F.count_if(F.col("outcome") == "count_mismatch").alias("recovery_count_mismatch"),
        F.count_if(F.col("outcome") == "absent").alias("recovery_absent"),
    )


__all__ = [
    "FIX_SCHEMA", "INVALID_DATE", "KEYS", "MANIFEST_SCHEMA", "WATERMARK_SCHEMA", "fix_records",
    "load_watermarks", "manifest_changed", "manifest_entries", "open_entries", "reconcile",
    "recovery_groups", "recovery_report", "resolve_record_creds", "rewrite_watermarks",
    "split_recovered", "valid_counts",
]
