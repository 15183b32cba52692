"""One incremental run: raw sheets -> quarantine, bronze, silver, state.

    raw -> ID filter -> flag (persisted once) -> {valid, error, report}
        error  -> quarantine, manifest entries
        manifest reconcile (previous open entries, this run's entries, valid counts)
            -> resolved keys -> recovered rows (bypass watermark) / regular rows
        regular -> build_bronze(watermarks) ; recovered -> build_bronze(no watermark)
        union -> first row per raw hash -> bronze append
        whole bronze -> latest per session -> typed + hash -> MERGE into silver
    commit order: quarantine, bronze, silver, fixes, manifest, watermark
    (state last, so a failed data write is retried on the next run).

The driver only holds run literals, the one-row report and the affected
column list (bounded by the number of checked columns).
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from alloy.constants import NUMERIC_COLS, PERCENT_COLS
from alloy.operators import bronze as B
from alloy.operators import silver as S
from alloy.operators import state as ST
from alloy.operators import validate as V
from alloy.operators.common import measured, observed
from alloy.sinks import buckets, store


@dataclass
class RunResult:
    report: dict
    recovery: dict
    n_bronze: int
    silver_version: int | None
    manifest_written: bool
    watermark_written: bool
    affected_columns: list[str] = field(default_factory=list)
    affected_dates: list = field(default_factory=list)
    timings: dict = field(default_factory=dict)


@dataclass
class Stages:
    """Lazily planned stages of a run (nothing written but what is kept)."""

    flagged: DataFrame
    valid: DataFrame
    errors: DataFrame
    report_row: dict
    affected: list[str]
    current: DataFrame
    remaining: DataFrame
    resolved: DataFrame
    counts: DataFrame
    recovered: DataFrame
    regular: DataFrame
    loaded: DataFrame
    max_dates: DataFrame
    how: str | None = None

    @cached_property
    def bronze(self) -> DataFrame:
        """First row per raw hash. Queries that read none do not work it out: the rows
        are kept as a table before, of which only those with copies are moved."""
        return B.first_rows(cut(self.loaded, self.how)) if self.how == "checkpoint" else B.dedup_first(self.loaded)


def affected_list(mask: int, columns: list[str]) -> list[str]:
    return [c for i, c, _ in V.checked_columns(columns, NUMERIC_COLS, PERCENT_COLS) if mask & (1 << i)]


def cut(df: DataFrame, how: str | None) -> DataFrame:
    """Keep a frame that several branches read: ``persist`` (memory and local
    disk; a lost block is recomputed from its short lineage) or ``checkpoint``
    (a table in the shared checkpoint folder: lineage cut, planning later queries
    on it is cheap, and each reader scans its own columns only)."""
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return measured(df, "cut") if how == "checkpoint" else df


def cut_with(df: DataFrame, how: str | None, columns: list) -> tuple[DataFrame, dict]:
    """``cut`` and aggregates over the frame: observed while it is written, else a job."""
    if how == "checkpoint":
        return observed(df, "cut", columns)
    df = cut(df, how)
    return df, df.agg(*columns).first().asDict()


def plan_run(raw: DataFrame, run: B.RunInfo, watermarks: DataFrame | None, previous_manifest: DataFrame | None,
             quarantine_rel_path: str, persist: bool | str = True, watermark_by_day: bool = False) -> Stages:
    """Build every stage of a run as DataFrames over one kept flagged frame.

    Keeping it matters beyond reuse: the flags become columns of a table,
    so filters on them are not rewritten into the full expressions
    (which Catalyst would otherwise push below the projection and duplicate).
    The report is observed while the frame is written.
    """
    how = ("persist" if persist is True else None) if isinstance(persist, bool) else persist
    flagged, rep = cut_with(V.flag(V.filter_creator_id(raw)), how, V.report_columns())
    affected = affected_list(int(rep["affected_mask"] or 0), flagged.columns)
    valid = V.valid_rows(flagged)
    errors = V.error_rows(flagged)
    counts = cut(ST.valid_counts(valid), how)
    aff_col = F.array(*[F.lit(c) for c in affected]).cast("array<string>")
    current = ST.manifest_entries(flagged, aff_col, run.now_iso, quarantine_rel_path)
    if previous_manifest is None:
        # No earlier manifest: nothing can be resolved, every valid row is regular.
        remaining = current
        resolved = flagged.sparkSession.createDataFrame([], ST.MANIFEST_SCHEMA)
        recovered, regular = valid.limit(0), valid
        loaded, max_dates = B.build_bronze(regular, run, watermarks, path=0, by_day=watermark_by_day)
    else:
        remaining, resolved = ST.reconcile(previous_manifest, current, counts)
        # Small (one row per failing key) and read by several actions.
        remaining, resolved = cut(remaining, how), cut(resolved, how)
        recovered, regular = ST.split_recovered(valid, resolved, counts)
        b_reg, max_dates = B.build_bronze(regular, run, watermarks, path=0, by_day=watermark_by_day)
        b_rec, _ = B.build_bronze(recovered, run, None, path=1)
        loaded = b_reg.unionByName(b_rec, allowMissingColumns=True)
    return Stages(flagged, valid, errors, rep, affected, current, remaining, resolved, counts,
                  recovered, regular, loaded, max_dates, how)


def run_pipeline(spark: SparkSession, raw: DataFrame, root: str, run: B.RunInfo, registry: DataFrame,
                 watermark_mode: str = "retain", incremental_silver: bool = True,
                 decimal_comma: bool = False, silver_layout: str = "snapshot",
                 keep: str = "checkpoint", split_sessions_by_time: bool = False,
                 null_safe_keys: bool = False, watermark_by_day: bool = False,
                 bronze_mode: str = "append", marks_version: int | None = None, state_form: str = "records",
                 merge: bool = True) -> RunResult:
    """Execute one run against the tables under ``root``.

    ``silver_layout="snapshot"`` writes each merge as a new full version;
    ``"by_day"`` keeps silver partitioned by business day and rewrites only the
    days this run's source touches; ``"bucketed"`` keeps it bucketed by the match key
    and merges without moving it. ``incremental_silver`` merges only the
    sessions that the new bronze rows touch, from the days that they hold; without it
    the whole bronze table is merged again, as in the source system. ``keep``
    chooses how the flagged frame is kept for its several readers:
    ``checkpoint`` (written to the shared checkpoint folder: survives the loss
    of executors without recomputation, and cuts the lineage) or ``persist``
    (executor memory and disk). ``watermark_by_day`` compares days, not
    timestamps, with the watermark. ``bronze_mode``: append, replace or fail.
    ``marks_version`` runs a part of a landing: rows meet that version of the
    watermarks, and the run's greatest dates wait in state ``landed_dates`` until
    the landing is over (``advance_watermarks``).
    ``state_form``: watermarks and manifest are written as ``records`` or each as one
    ``document``; either is read, and so are an earlier system's documents.
    Without ``merge`` the bronze rows wait for a ``merge_silver`` of their own.
    ``split_sessions_by_time`` keeps hour-less sessions of one shop/creator/day
    apart by their time text; ``null_safe_keys`` lets NULL merge-key parts match.
    Both default to the source system's behaviour.
    """
    timings: dict[str, float] = {}
    clock = [time.time()]

    def lap(name: str) -> None:
        now = time.time()
        timings[name] = round(now - clock[0], 3)
        clock[0] = now

    wm_records = store.read_state(spark, root, "watermark", ST.WATERMARK_SCHEMA, marks_version)
    watermarks = ST.load_watermarks(wm_records, registry)
    has_manifest = store.has_state(spark, root, "manifest")
    prev_manifest = store.read_state(spark, root, "manifest", ST.MANIFEST_SCHEMA)
    lap("state_read")
    st = plan_run(raw, run, watermarks, prev_manifest if has_manifest else None, store.quarantine_path(run),
                  persist=keep, watermark_by_day=watermark_by_day)
    lap("plan_and_report")

    if has_manifest:
        recovery = ST.recovery_report(st.resolved, st.counts).first().asDict()
    else:
        recovery = dict(recovery_resolved=0, recovery_recovered_rows=0, recovery_count_mismatch=0,
                        recovery_absent=0)
    lap("recovery_report")
    if st.report_row["n_bad_rows"]:
        store.write_quarantine(st.errors, root, run, check_empty=False)
    lap("quarantine")

    # First rows are picked from rows, so there are some if there is a row to load; the
    # picked ones go to the table at once and are read back from it.
    n_bronze = 0
    silver_version = None
    if not st.loaded.isEmpty():
        n_bronze = store.write_bronze(st.bronze, root, run, bronze_mode)
        lap("bronze_write")
        if merge:
            bronze = store.read_bronze(spark, root, S.BRONZE_SCHEMA).filter(store.of_run(run))
            silver_version = merge_silver(spark, root, bronze, incremental_silver, decimal_comma, silver_layout, split_sessions_by_time, null_safe_keys,
                                          own=store.of_run(run))
            lap("silver_merge")

    # The manifest is written only when its content changed (ignoring the
    # report time); resolved entries also leave a fix record.
    manifest_written = False
    changed = (ST.manifest_changed(prev_manifest, st.remaining, st.resolved) if has_manifest
               else bool(st.report_row["n_bad_rows"]))
    if changed:
        if recovery["recovery_resolved"]:
            store.write_fixes(ST.fix_records(st.resolved, run.now_iso), root, run)
        store.write_state(st.remaining, root, "manifest", state_form, ST.KEYS)
        manifest_written = True
    lap("manifest")

    watermark_written = False
    if n_bronze and marks_version is not None:
        waiting = store.read_state(spark, root, "landed_dates", ST.DATES_SCHEMA)
        store.write_state(waiting.unionByName(st.max_dates).groupBy("creds").agg(F.max("last_processed_date").alias("last_processed_date")),
                          root, "landed_dates")
    elif n_bronze:
        new_wm = ST.rewrite_watermarks(wm_records, st.max_dates, registry, run.now_iso, watermark_mode)
        store.write_state(new_wm, root, "watermark", state_form, ["creds"])
        watermark_written = True
    lap("watermark")

    result = RunResult(st.report_row, recovery, n_bronze, silver_version, manifest_written,
                     watermark_written, st.affected, V.sorted_dates(st.flagged).first()["affected_dates"], timings)
    for df in (st.counts, st.flagged, st.remaining, st.resolved):
        df.unpersist()
    return result


def merge_silver(spark: SparkSession, root: str, new_rows: DataFrame, incremental_silver: bool = True, decimal_comma: bool = False,
                 silver_layout: str = "snapshot", split_sessions_by_time: bool = False, null_safe_keys: bool = False, in_parts: bool = False,
                 own: Column | None = None) -> int:
    """MERGE bronze into silver after ``new_rows`` were added to it; the options are
    those of ``run_pipeline``. ``in_parts``: runs came in several loads, each with
    its own first rows per hash, of which the run's first is taken here. ``own``: a
    condition on bronze's partition columns by which just ``new_rows`` are read; then
    only the earlier rows of their days are looked up."""
    all_bronze = store.read_bronze(spark, root, S.BRONZE_SCHEMA)
    if incremental_silver:
        # A session lies on one day: no other day's bronze is read.
        all_bronze = store.of_days(all_bronze, store.distinct_days(new_rows, "tanggal"))
        if own is None:
            all_bronze = S.restrict_to_sessions(all_bronze, new_rows)
        else:
            own = F.coalesce(own, F.lit(False))  # a partition without a name is looked up
            earlier = cut(S.restrict_to_sessions(all_bronze.filter(~own), new_rows), "checkpoint")
            all_bronze = all_bronze.filter(own).unionByName(earlier)
    all_bronze = all_bronze.drop(*store.BRONZE_PARTITIONS)
    if in_parts:
        first = B.dedup_first if incremental_silver else B.first_rows
        all_bronze = cut(first(all_bronze, ("run_id", "row_hash_raw")), "checkpoint")
    # Read by several branches of the merge, so it is worked out once.
    table = in_parts or own is not None or not incremental_silver
    source = cut(S.silver_source(all_bronze, decimal_comma, split_sessions_by_time, table), "checkpoint")
    S.require_unique(source)
    if silver_layout == "bucketed":
        return buckets.upsert_bucketed(spark, root, source, null_safe_keys)
    if silver_layout == "by_day":
        return store.upsert_silver_by_day(spark, root, source, S.SILVER_SCHEMA, null_safe_keys)
    target = store.read_silver(spark, root, S.SILVER_SCHEMA)
    return store.write_silver(S.upsert(target, source, null_safe_keys=null_safe_keys), root, spark)


def advance_watermarks(spark: SparkSession, root: str, registry: DataFrame, now_iso: str, mode: str = "retain") -> bool:
    """The end of a landing: the dates that its runs left become the watermarks.
    Done again after a failure half-way, it writes the same marks."""
    waiting = store.read_state(spark, root, "landed_dates", ST.DATES_SCHEMA)
    if waiting.isEmpty():
        return False
    records = store.read_state(spark, root, "watermark", ST.WATERMARK_SCHEMA)
    store.write_state(ST.rewrite_watermarks(records, waiting, registry, now_iso, mode), root, "watermark")
    store.write_state(spark.createDataFrame([], ST.DATES_SCHEMA), root, "landed_dates")
    return True
