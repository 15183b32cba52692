"""Shared helpers for small-side joins."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from alloy.session import scratch_path

# Largest estimated size of a side that is broadcast explicitly.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Largest file size of the keys (8 bytes each) that ``one_per_key`` broadcasts.
SEVERAL_MAX_BYTES = 32 * 1024 * 1024


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A frame without rows that the optimizer knows to be empty: a join with it is
    planned away, where an empty RDD would still shuffle the other side."""
    fields = spark.createDataFrame([], schema).schema.fields
    return spark.range(1).filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (file sizes for scans, an upper bound
    carried through filters and aggregates); no job is run."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size) if isinstance(size, int) else int(size.toString())


def small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its estimated size is under ``max_bytes``.

    State tables (watermarks, registry, manifest) are tiny files, so their
    estimate is small and they are broadcast. A side whose estimate is large
    (e.g. derived from the full data) is left to AQE, which re-plans the join
    from the sizes measured at run time.
    """
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def measured(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that its size is known before the
    join that reads it is planned (an estimate of a derived table is that of
    its inputs, and the large side would be shuffled for nothing)."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_per_key(table: DataFrame, keys: list[Column], pick: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``pick(table)``, which leaves one row per key, of a table that is cheap to scan
    again. Only rows that share their key go through ``pick``; the others, alone with
    theirs, are neither sorted nor shuffled. Keys are compared by a 64-bit hash: rows
    whose hashes meet by chance go through ``pick`` as well. All rows do if too many
    keys have several rows to be broadcast."""
    key = F.xxhash64(*keys).alias("_key")
    several = measured(table.select(key).groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_key"), "several")
    if estimated_bytes(several) > SEVERAL_MAX_BYTES:
        return pick(table)
    keyed, several = table.select("*", key), F.broadcast(several)
    shared = keyed.join(several, "_key", "left_semi").drop("_key")
    return keyed.join(several, "_key", "left_anti").drop("_key").unionByName(pick(shared))


_DATE_LIKE = ("timestamp_ntz", "timestamp", "date")


def observed(df: DataFrame, name: str, columns: list[Column]) -> tuple[DataFrame, dict]:
    """``measured(df)`` and the aggregates ``columns`` over it, gathered while it is
    written: they cost no pass and no job of their own. Timestamps come as datetimes."""
    types = dict(df.select(*columns).dtypes)
    dates = [n for n, t in types.items() if t in _DATE_LIKE]
    names = list(types)
    seen = Observation()
    kept = measured(df.observe(seen, *[c.cast("string").alias(n) if n in dates else c for n, c in zip(names, columns)]), name)
    values = dict(seen.get)
    return kept, {n: datetime.fromisoformat(v) if n in dates and (v := values[n]) is not None else values[n] for n in names}
