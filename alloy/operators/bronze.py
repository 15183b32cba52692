"""Bronze build: snake-case, session hour, lineage, raw hash, watermark filter.

``build_bronze`` is one projection plus one (broadcast, size-checked) lookup of
the per-source watermark; its max-date side output is a ``groupBy(creds)``
whose map-side partial aggregation keeps a hot source cheap.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from alloy.constants import BRONZE_DROP_COLS, RAW_HASH_COLS
from alloy.functions import not_blank_or_null, raw_row_hash, session_hour, snake_case_columns
from alloy.operators.common import measured, one_per_key, small

TAGS = ("sheet_name", "creds", "row_no")


@dataclass(frozen=True)
class RunInfo:
    """Literals fixed once per run on the driver (never per-row functions). ``part``
    tells the loads of one run apart, where it comes in several."""

    snapshot_ts: datetime
    run_id: str
    part: str = ""

    @property
    def load_id(self) -> str:
        return self.run_id + self.part

    @property
    def today_key(self) -> str:
        return self.snapshot_ts.strftime("%Y%m%d")

    @property
    def run_key(self) -> str:
        return self.snapshot_ts.strftime("%Y%m%d%H")

    @property
    def now_iso(self) -> str:
        return self.snapshot_ts.replace(tzinfo=None).isoformat()

    @staticmethod
    def now(run_id: str | None = None) -> "RunInfo":
        import uuid

        return RunInfo(datetime.now(timezone.utc), run_id or str(uuid.uuid4()))

    @staticmethod
    def at(ts: str, run_id: str) -> "RunInfo":
        return RunInfo(datetime.fromisoformat(ts).replace(tzinfo=timezone.utc), run_id)


def snake_rename(df: DataFrame) -> DataFrame:
    """Rename every column to snake case; two columns may not collide."""
    mapping = snake_case_columns(df.columns)
    return df.select(*[F.col(f"`{c}`").alias(mapping[c]) for c in df.columns])


def drop_columns(df: DataFrame, names=BRONZE_DROP_COLS) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def watermark_filter(df: DataFrame, watermarks: DataFrame | None, key: str = "creds",
                     date_col: str = "tanggal", by_day: bool = False) -> DataFrame:
    """Keep rows whose timestamp is after their source's watermark.

    ``watermarks`` has ``(creds, last_processed_date)`` (ISO text; a mark is the
    start of its day). A source without a watermark (or a NULL key) loads fully.
    A session later on the marked day is therefore taken in; ``by_day`` compares
    days instead and leaves the whole marked day out.

    One row per source joins the data: a broadcast join behind the size check,
    else a join that Spark plans (and splits on a hot source) at run time.
    """
    if watermarks is None or key not in df.columns:
        return df
    wm = (watermarks.select(F.col(key).alias("_wm_key"),
                            F.col("last_processed_date").try_cast("date").alias("_wm"))
          .filter(F.col("_wm").isNotNull() & F.col("_wm_key").isNotNull()))
    joined = df.join(small(measured(wm, "watermarks")), df[key] == F.col("_wm_key"), "left")
    when = F.col(date_col).cast("date") if by_day else F.col(date_col).cast("timestamp_ntz")
    mark = F.col("_wm") if by_day else F.col("_wm").cast("timestamp_ntz")
    return joined.filter(mark.isNull() | (when > mark)).drop("_wm_key", "_wm")


def max_dates(df: DataFrame, key: str = "creds", date_col: str = "tanggal") -> DataFrame:
    """``(creds, last_processed_date)``: latest kept date per source, ISO text."""
    return (df.filter(F.col(key).isNotNull() & F.col(date_col).isNotNull())
            .groupBy(key)
            .agg(F.date_format(F.max(F.col(date_col).cast("date")), "yyyy-MM-dd").alias("last_processed_date")))


def build_bronze(valid: DataFrame, run: RunInfo, watermarks: DataFrame | None = None,
                 path: int = 0, hash_cols=RAW_HASH_COLS, by_day: bool = False) -> tuple[DataFrame, DataFrame]:
    """Valid rows -> (bronze rows, max date per source of the kept rows).

    ``path`` is 0 for regular rows and 1 for recovered rows; together with
    ``sheet_name`` and ``row_no`` it gives "first occurrence" a fixed meaning.
    """
    df = snake_rename(valid)
    if "waktu_live" in df.columns:
        df = df.filter(not_blank_or_null("waktu_live"))
        df = df.withColumn("pukul_live", session_hour("waktu_live"))
    else:
        df = df.withColumn("pukul_live", F.lit(None).cast("int"))
    df = df.withColumns({
        "snapshot_ts": F.lit(run.snapshot_ts).cast("timestamp"),
        "snapshot_date": F.lit(run.snapshot_ts.date()),
        "run_id": F.lit(run.run_id),
    })
    df = df.withColumn("row_hash_raw", raw_row_hash(df, list(hash_cols)))
    df = watermark_filter(df, watermarks, by_day=by_day)
    mx = max_dates(df) if "creds" in df.columns else None
    df = drop_columns(df).withColumn("path", F.lit(path))
    return df, mx


def dedup_first(df: DataFrame, key=("row_hash_raw",), order=("path", "sheet_name", "row_no")) -> DataFrame:
    """Keep the first row per ``key`` by ``order`` (regular before recovered;
    ``sheet_name`` + ``row_no`` identify a source row, so the order is total).

    A ``min_by`` aggregate rather than a window: partial aggregation collapses
    duplicates inside each map task, so a key holding a third of all rows never
    lands whole on one reducer.
    """
    cols = [c for c in df.columns if c not in key]
    order_cols = [c for c in order if c in df.columns]
    picked = df.groupBy(*key).agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in cols]),
                 F.struct(*[F.col(f"`{c}`") for c in order_cols])).alias("_r"))
    return picked.select(*[F.col(f"_r.`{c}`").alias(c) if c not in key else F.col(c) for c in df.columns])


def first_rows(table: DataFrame, key=("row_hash_raw",)) -> DataFrame:
    """``dedup_first`` of a table: only rows that share their key are sorted and moved."""
    return one_per_key(table, [F.col(k) for k in key], lambda rows: dedup_first(rows, key))
