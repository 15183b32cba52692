"""Incremental runs driven by Structured Streaming.

Landed grid files arrive in a folder. A file stream with ``availableNow``
processes everything that has landed, and each micro-batch runs the batch
pipeline through ``foreachBatch``. The streaming checkpoint records which files
are done, so a restarted job neither skips nor repeats a landed file.

A sheet may land as several files, so its header can come in another
micro-batch than its rows. The headers seen so far are state; rows that come
before their sheet's header are parked and join the first batch that knows it.

A landing is what one call finds, and one run: its micro-batches, dealt by bytes, are
loads of that run, and silver is merged once, after the last of them. A batch that is
retried replaces its own load and no other; a batch that was finished (state
``batches``) is not run again; a landing that fails half-way goes on as the same run
(state ``landing``), with the loads that it has (state ``unmerged``).

The per-source
watermark is persisted state of the pipeline (not a streaming event-time
watermark): a source's mark is a processed business date. All micro-batches of a
landing meet the marks from before it, and the marks move on after its last one. A
parked row keeps the version of the marks of its own landing and meets those when
its header comes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from alloy.constants import FIRST_DATA_ROW
from alloy.operators import silver as S
from alloy.operators.bronze import RunInfo
from alloy.plans.pipeline import RunResult, advance_watermarks, cut, merge_silver, run_pipeline
from alloy.sinks import store
from alloy.sources import grid as G

PARKED_SCHEMA = f"{G.GRID_SCHEMA}, marks bigint"
LANDING_SCHEMA = "run_id string, snapshot_ts string"
LOADS_SCHEMA = "load_id string"


def run_of_landing(spark: SparkSession, root: str, epoch: int, run: RunInfo | None = None) -> RunInfo:
    """The run of the landing that a micro-batch belongs to, recorded by its first one."""
    known = store.read_state(spark, root, "landing", LANDING_SCHEMA).first()
    if known:
        return RunInfo.at(known["snapshot_ts"], known["run_id"])
    run = run or RunInfo.now(f"landing-{epoch}")
    store.write_state(spark.createDataFrame([(run.run_id, run.now_iso)], LANDING_SCHEMA), root, "landing")
    return run


def run_available_now(spark: SparkSession, landing_dir: str, root: str, registry: DataFrame,
                      checkpoint: str, run_for_landing: RunInfo | None = None,
                      column_order: list[str] | None = None, bytes_per_batch: int = 8 << 30, files_per_batch: int | None = None,
                      watermark_mode: str = "retain", **options) -> list[RunResult]:
    """Process every landed grid file not yet processed, then stop. A micro-batch takes
    files of about ``bytes_per_batch`` (or ``files_per_batch`` files, if given); silver
    is merged once. ``options`` go to ``run_pipeline``."""
    results: list[RunResult] = []
    marks = store.state_version(spark, root, "watermark")

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        done = store.read_state(session, root, "batches", "epoch bigint").agg(F.max("epoch")).first()[0]
        if done is not None and epoch_id <= done:
            return  # finished before the stream could note it
        run = run_of_landing(session, root, epoch_id, run_for_landing)
        parked = store.read_batch(session, root, "parked", epoch_id, PARKED_SCHEMA).fillna(marks, "marks")
        here = cut(batch.withColumn("marks", F.lit(marks).cast("long")).unionByName(parked), "checkpoint")
        headers = cut(G.known_headers(store.read_batch(session, root, "headers", epoch_id, G.HEADER_SCHEMA), here), "checkpoint")
        ready, waiting = G.split_headerless(here, headers)
        # One version, and one more for each earlier landing whose rows were parked till now.
        found = ready.filter(F.col("row_no") >= FIRST_DATA_ROW).select("marks").distinct().orderBy("marks").collect()
        loads = []
        for version in [r["marks"] for r in found]:
            raw = G.grid_to_frame(ready.filter(F.col("marks") == version).drop("marks"), headers, column_order)
            part = RunInfo(run.snapshot_ts, run.run_id, f"-{epoch_id}" if version == marks else f"-{epoch_id}-parked-{version}")
            results.append(run_pipeline(session, raw, root, part, registry, watermark_mode, marks_version=version, merge=False, **options))
            loads.append(part.load_id)
        store.write_batch(headers, root, "headers", epoch_id)
        store.write_batch(waiting, root, "parked", epoch_id)
        unmerged = store.read_state(session, root, "unmerged", LOADS_SCHEMA).unionByName(session.createDataFrame([(x,) for x in loads], LOADS_SCHEMA))
        store.write_state(unmerged.distinct().coalesce(1), root, "unmerged")
        store.write_state(session.createDataFrame([(epoch_id,)], "epoch bigint"), root, "batches")

    reader = spark.readStream.schema(G.GRID_SCHEMA)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader.option("maxBytesPerTrigger", bytes_per_batch)
    query = (reader.parquet(landing_dir).writeStream.foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    finish_landing(spark, root, registry, watermark_mode, **options)
    return results


def finish_landing(spark: SparkSession, root: str, registry: DataFrame, watermark_mode: str = "retain", **options) -> None:
    """The end of a landing: its loads are merged into silver, its dates become the marks.
    Done again after a failure half-way, it changes keyed rows and marks no more."""
    loads = [r["load_id"] for r in store.read_state(spark, root, "unmerged", LOADS_SCHEMA).collect()]  # a row a micro-batch
    bronze = store.read_bronze(spark, root, S.BRONZE_SCHEMA) if loads else None
    if bronze is not None:
        known = {k: v for k, v in options.items() if k in MERGE_OPTIONS}
        own = F.col("load_id").isin(loads)
        new_rows = bronze.filter(own)
        if not new_rows.isEmpty():
            merge_silver(spark, root, new_rows, in_parts=True, own=own, **known)
    if loads:
        store.write_state(spark.createDataFrame([], LOADS_SCHEMA), root, "unmerged")
    run = store.read_state(spark, root, "landing", LANDING_SCHEMA).first()
    advance_watermarks(spark, root, registry, run["snapshot_ts"] if run else RunInfo.now().now_iso, watermark_mode)
    if run:
        store.write_state(spark.createDataFrame([], LANDING_SCHEMA), root, "landing")


MERGE_OPTIONS = ("incremental_silver", "decimal_comma", "silver_layout", "split_sessions_by_time", "null_safe_keys")
