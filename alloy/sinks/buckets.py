"""Silver bucketed by its match key, and tables of the session's catalog.

    <root>/silver_buckets/v=NNNNNNNNNN/keyed/   Parquet, bucketed and sorted by the match key
    <root>/silver_buckets/v=NNNNNNNNNN/loose/   Parquet, rows that no merge can match
    <root>/silver_bucket_list/v=NNNNNNNNNN/     JSON lines, the commit record: version, buckets

A merge joins the buckets where they lie: only the source is shuffled, to as many
partitions as there are buckets, and since a joined row stays in its bucket, each task
writes the one file of its bucket of the next version. The number of buckets is
that of the table's first version; it should be near the number of tasks that a merge
of the whole table wants.

Bucketing is known to the catalog only, so a table is entered there (external, at its
folder) by whoever reads or writes it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from alloy.operators import silver as S
from alloy.sinks import store

BUCKETS = 64
BUCKET_LIST_SCHEMA = "version bigint, buckets int"


def _name(root: str, version: int) -> str:
    return f"alloy_silver_{hashlib.md5(root.encode()).hexdigest()[:12]}_v{version}"


def committed(spark: SparkSession, root: str) -> tuple[int, int] | None:
    """(version, buckets) of the newest commit record."""
    path = store._newest(spark, f"{root}/silver_bucket_list")
    if path is None:
        return None
    row = spark.read.schema(BUCKET_LIST_SCHEMA).option("mode", "FAILFAST").json(path).first()
    return row["version"], row["buckets"]


def read_bucketed(spark: SparkSession, root: str) -> DataFrame:
    """Newest committed silver (with its match key ``_mk``), or an empty table."""
    known = committed(spark, root)
    schema = S.SILVER_SCHEMA + ", _mk string"
    if known is None:
        return spark.createDataFrame([], schema)
    version, n = known
    path = f"{root}/silver_buckets/v={version:010d}"
    keys = ", ".join(S.MATCH_KEYS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(root, version)} ({schema}) USING parquet "
              f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {n} BUCKETS LOCATION '{path}/keyed'")
    return spark.table(_name(root, version)).unionByName(spark.read.schema(schema).parquet(f"{path}/loose"))


def merged(spark: SparkSession, root: str, source: DataFrame, null_safe_keys: bool = False) -> tuple[DataFrame, DataFrame]:
    """(keyed, loose) rows of MERGE(silver, source). The keyed target is read as it is
    bucketed; loose rows are passed by it, or with ``null_safe_keys`` merged apart, by
    the few columns that they do have."""
    known = committed(spark, root)
    if known is None:
        return S.split_keyed(S.upsert(S.empty_silver(spark), source, null_safe_keys=null_safe_keys))
    read_bucketed(spark, root)  # enters the table
    version, _ = known
    keyed = spark.table(_name(root, version))
    loose = spark.read.schema(keyed.schema).parquet(f"{root}/silver_buckets/v={version:010d}/loose")
    new_keyed, new_loose = S.split_keyed(source)
    both = S.upsert(loose, new_loose, null_safe_keys=null_safe_keys)
    return S.match_keyed(keyed, new_keyed), S.split_keyed(both)[1]


def upsert_bucketed(spark: SparkSession, root: str, source: DataFrame, null_safe_keys: bool = False, buckets: int = BUCKETS) -> int:
    """MERGE ``source`` into the bucketed silver table as its next version; the commit
    record is written last, and before it readers see the version before."""
    known = committed(spark, root)
    n = known[1] if known else buckets
    keyed, loose = merged(spark, root, source, null_safe_keys)
    path = store._next_version(spark, f"{root}/silver_buckets")
    version = int(path.rsplit("=", 1)[1])
    (keyed.write.mode("errorifexists").format("parquet").bucketBy(n, *S.MATCH_KEYS).sortBy(*S.MATCH_KEYS)
     .option("path", f"{path}/keyed").saveAsTable(_name(root, version)))
    loose.write.mode("errorifexists").parquet(f"{path}/loose")
    store.write_state_at(spark.createDataFrame([(version, n)], BUCKET_LIST_SCHEMA), f"{root}/silver_bucket_list")
    return version


# --- catalog tables ------------------------------------------------------------------

def create_table(spark: SparkSession, name: str, schema: str, partitions: tuple[str, ...] = (), path: str | None = None) -> None:
    """A typed Parquet table by DDL, at ``path`` or in the warehouse."""
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    at = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet{by}{at}")


def fill_table(df: DataFrame, name: str, mode: str = "append") -> None:
    """Rows of ``df`` into the table ``name``, columns by name (what the frame lacks is
    NULL, what the table lacks is an error). ``append``, ``replace`` all rows, or ``fail``
    if it has any."""
    if mode not in store.MODES:
        raise ValueError(f"mode must be one of {store.MODES}")
    spark = df.sparkSession
    table = spark.table(name)
    if extra := [c for c in df.columns if c not in table.columns]:
        raise ValueError(f"{name} has no columns {extra}")
    if mode == "fail" and not table.isEmpty():
        raise ValueError(f"{name} has rows")
    columns = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema]
    rows = df.select(*columns)
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if partitions:  # rows of one partition go to few tasks and so to few files
        rows = rows.hint("rebalance", *partitions)
    writer = rows.write.mode("overwrite" if mode == "replace" else "append").option("partitionOverwriteMode", "static")
    writer.insertInto(name)


def table_from_frame(df: DataFrame, name: str, partitions: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """A table made from a frame: created by DDL with the frame's columns (partition
    columns last), filled, and given back by name."""
    fields = [f for f in df.schema if f.name not in partitions] + [df.schema[p] for p in partitions]
    create_table(df.sparkSession, name, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), partitions, path)
    fill_table(df, name)
    return df.sparkSession.table(name)
