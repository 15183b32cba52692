"""Watermarks as keyed state of a stream: one value a source, in Spark's state store.

Where ``available_now`` keeps the marks as versions that the driver writes, here each
source's mark, and the greatest day that the running landing has brought (pending), are
a value of the state store, checkpointed with the stream's offsets. A source's state is
held by the task that its key hashes to, so sources may be as many as they like, and a
restarted stream goes on from its checkpoint.

All rows of a landing meet the marks from before it, so a day stays pending until a
row of a later landing comes, or until a reader asks for the marks before a later
landing (``read_marks``).

Rows are folded to their sources' greatest days before the shuffle, so a hot source
sends a row a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_SCHEMA = "mark string, pending string, landing long"
DATES_SCHEMA = "creds string, last_processed_date string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SourceMarks(StatefulProcessor):
    """Rows (creds, day, landing) -> the source's mark and pending day."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("mark", STATE_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark, pending, landing = self.state.get() if self.state.exists() else (None, None, None)
        for part in rows:
            for at, days in part.groupby("landing")["day"]:
                if landing is not None and at > landing:  # the landing before is over
                    mark, pending = max(filter(None, (mark, pending)), default=None), None
                landing = max(int(at), landing if landing is not None else int(at))
                pending = max(filter(None, (pending, days.max())), default=None)
        self.state.update((mark, pending, landing))
        yield pd.DataFrame({"creds": [key[0]], "mark": [mark], "pending": [pending]})

    def close(self) -> None:
        pass


def _greatest_days(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a source for each run of rows."""
    for batch in batches:
        if batch.num_rows:
            folded = pa.table(batch.columns, names=["creds", "day"]).group_by("creds").aggregate([("day", "max")])
            yield from folded.select(["creds", "day_max"]).rename_columns(["creds", "day"]).combine_chunks().to_batches()


def keyed_marks(rows: DataFrame, landing: int) -> DataFrame:
    """The stateful stream over ``rows`` (creds, tanggal) of a landing; rows without a
    source or a day say nothing of it."""
    day = F.date_format(F.col("tanggal").cast("date"), "yyyy-MM-dd")
    days = rows.filter("creds IS NOT NULL AND tanggal IS NOT NULL").select("creds", day.alias("day"))
    folded = days.mapInArrow(_greatest_days, "creds string, day string").withColumn("landing", F.lit(landing).cast("long"))
    return folded.groupBy("creds").transformWithStateInPandas(
        SourceMarks(), outputStructType="creds string, mark string, pending string", outputMode="Update", timeMode="None")


@contextmanager
def _rocksdb(spark: SparkSession):
    """Keyed state needs this provider; the session's own comes back after."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def advance(rows: DataFrame, landing: int, checkpoint: str) -> None:
    """Take in what has landed since the checkpoint, as landing number ``landing``."""
    with _rocksdb(rows.sparkSession):
        query = (keyed_marks(rows, landing).writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()


def read_marks(spark: SparkSession, checkpoint: str, landing: int) -> DataFrame:
    """(creds, last_processed_date) as landing number ``landing`` meets them."""
    with _rocksdb(spark):
        state = spark.read.format("statestore").option("stateVarName", "mark").load(checkpoint)
    mark = F.when(F.col("value.landing") < landing, F.greatest("value.mark", "value.pending")).otherwise(F.col("value.mark"))
    return state.select(F.col("key.creds").alias("creds"), mark.alias("last_processed_date")).filter("last_processed_date IS NOT NULL")
