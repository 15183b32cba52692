"""Row-level validation: one flagged frame, then valid / error / report views.

Every test is a native predicate evaluated once per row in one projection
(``flag``); the branches below are filters and aggregates over that frame, so
the pipeline persists it once and reads it several times.

Semantics:
* blank row: every data cell (tags excluded) is NULL or a blank token;
* numeric cell corrupt: has content and a forbidden character, or does not
  coerce after cleaning; percentage cell corrupt: has content and a forbidden
  character (no coercion test);
* date error: the mixed-date parse is NULL;
* error = (corrupt or date error) and not blank; valid = neither error nor blank;
* ``n_date_errors`` counts blank rows too (they have no date), ``n_bad_rows``
  does not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from alloy.constants import (
    CREATOR_ID_COL,
    DATE_COL,
    NUMERIC_COLS,
    PERCENT_COLS,
)
from alloy.functions import (
    checked_number_fill,
    is_blank_cell,
    not_blank_or_null,
    numeric_corrupt,
    parse_mixed_date,
    percent_corrupt,
)
from alloy.functions.sql import error_reason

# Columns that are tags or lineage, never data.
TAG_COLS = ("creds", "sheet_name", "error_reason", "row_no")
FLAG_COLS = ("_blank", "_bad_mask", "_corrupt", "_parsed", "_date_error", "_error")


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def filter_creator_id(raw: DataFrame, id_col: str = CREATOR_ID_COL) -> DataFrame:
    """Drop rows whose creator ID is blank text (a NULL ID is kept)."""
    if id_col not in raw.columns:
        return raw
    return raw.filter(not_blank_or_null(_q(id_col)))


def checked_columns(columns: list[str], numeric_cols=NUMERIC_COLS, percent_cols=PERCENT_COLS):
    """(bit, name, kind) of every checked column present, in declared order."""
    out = []
    for i, c in enumerate(list(numeric_cols) + list(percent_cols)):
        if c in columns:
            out.append((i, c, "numeric" if i < len(numeric_cols) else "percent"))
    return out


def flag(raw: DataFrame, numeric_cols=NUMERIC_COLS, percent_cols=PERCENT_COLS,
         date_col: str = DATE_COL) -> DataFrame:
    """Raw frame plus ``_blank``, ``_bad_mask`` (bit per corrupt column),
    ``_corrupt``, ``_parsed`` (TIMESTAMP_NTZ), ``_date_error``, ``_error`` and
    ``error_reason``."""
    data_cols = [c for c in raw.columns if c not in TAG_COLS]
    blank = reduce(lambda a, b: a & b, [is_blank_cell(_q(c)) for c in data_cols]) if data_cols else F.lit(False)
    checks = checked_columns(raw.columns, numeric_cols, percent_cols)
    bits = [
        F.when(numeric_corrupt(_q(c)) if kind == "numeric" else percent_corrupt(_q(c)),
               F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
        for i, c, kind in checks
    ]
    mask = reduce(lambda a, b: a.bitwiseOR(b), bits) if bits else F.lit(0).cast("bigint")
    parsed = parse_mixed_date(_q(date_col)) if date_col in raw.columns else F.lit(None).cast("timestamp_ntz")

    out = raw.select("*", blank.alias("_blank"), mask.alias("_bad_mask"), parsed.alias("_parsed"))
    corrupt = F.col("_bad_mask") != 0
    date_error = F.col("_parsed").isNull()
    return out.select(
        "*",
        corrupt.alias("_corrupt"),
        date_error.alias("_date_error"),
        ((corrupt | date_error) & ~F.col("_blank")).alias("_error"),
    ).withColumn("error_reason", error_reason(F.col("_corrupt"), F.col("_date_error"), F.col("_blank")))


def raw_columns(flagged: DataFrame) -> list[str]:
    return [c for c in flagged.columns if c not in FLAG_COLS and c != "error_reason"]


def error_rows(flagged: DataFrame) -> DataFrame:
    """Error rows with their ORIGINAL raw values plus ``error_reason``."""
    return flagged.filter(F.col("_error")).select(*[_q(c) for c in raw_columns(flagged)], "error_reason")


def valid_rows(flagged: DataFrame, numeric_cols=NUMERIC_COLS, date_col: str = DATE_COL) -> DataFrame:
    """Valid rows, cleaned: numeric columns as DECIMAL(38,9) with missing -> 0,
    the date column as the parsed TIMESTAMP_NTZ. Percentages stay text."""
    nums = set(numeric_cols)
    cols = []
    for c in raw_columns(flagged):
        if c in nums:
            cols.append(checked_number_fill(_q(c)).alias(c))
        elif c == date_col:
            cols.append(F.col("_parsed").alias(c))
        else:
            cols.append(_q(c))
    return flagged.filter(~F.col("_error") & ~F.col("_blank")).select(*cols)


def report_columns() -> list[Column]:
    """The validation report's aggregates over the flagged frame."""
    err, blank = F.col("_error"), F.col("_blank")
    corrupt_date = F.when(F.col("_corrupt"), F.col("_parsed"))
    return [
        F.coalesce(F.bool_or(err), F.lit(False)).alias("has_changes"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~err & ~blank).alias("n_valid_rows"),
        F.count_if(err).alias("n_bad_rows"),
        F.count_if(F.col("_date_error")).alias("n_date_errors"),
        F.count_if(blank).alias("n_blank_rows"),
        F.coalesce(F.bit_or("_bad_mask"), F.lit(0).cast("bigint")).alias("affected_mask"),
        F.min(corrupt_date).alias("first_affected_date"),
        F.max(corrupt_date).alias("last_affected_date"),
    ]


def report(flagged: DataFrame) -> DataFrame:
    """One-row validation report (counters, affected-column mask, date range)."""
    return flagged.agg(*report_columns())


def affected_columns(flagged: DataFrame, numeric_cols=NUMERIC_COLS, percent_cols=PERCENT_COLS) -> DataFrame:
    """One row per affected column: ``(position, column_name)`` in declared order."""
    checks = checked_columns(flagged.columns, numeric_cols, percent_cols)
    rep = flagged.agg(F.coalesce(F.bit_or("_bad_mask"), F.lit(0).cast("bigint")).alias("m"))
    pairs = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                               F.lit(1 << i).cast("bigint").alias("bit")) for i, c, _ in checks])
    return (rep.select("m", F.explode(pairs).alias("p"))
            .filter(F.col("m").bitwiseAND(F.col("p.bit")) != 0)
            .select("p.position", "p.column_name"))


def affected_dates(flagged: DataFrame) -> DataFrame:
    """Distinct parsed dates of corrupt rows (kept distributed, not collected)."""
    return (flagged.filter(F.col("_corrupt") & F.col("_parsed").isNotNull())
            .select(F.col("_parsed").alias("affected_date")).distinct())


def sorted_dates(flagged: DataFrame) -> DataFrame:
    """One row: the days of corrupt rows as an ascending list (a day each)."""
    day = F.when(F.col("_corrupt"), F.col("_parsed").cast("date"))
    return flagged.agg(F.sort_array(F.collect_set(day)).alias("affected_dates"))


def integral_columns(valid: DataFrame, numeric_cols=NUMERIC_COLS) -> DataFrame:
    """Per numeric column, whether every cleaned value is whole (x % 1 == 0)."""
    cols = [c for c in numeric_cols if c in valid.columns]
    return valid.agg(*[
        F.coalesce(F.bool_and((_q(c) % 1) == 0), F.lit(True)).alias(c) for c in cols
    ])
