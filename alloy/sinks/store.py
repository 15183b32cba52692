"""Table layout on a shared filesystem, written only through Spark writers.

    <root>/bronze/date=YYYYMMDD/run_key=YYYYMMDDHH/load_id=RUN/day=YYYY-MM-DD/  Parquet, day: of the session
    <root>/quarantine/date=YYYYMMDD/run_key=YYYYMMDDHH/load_id=RUN/  Parquet, raw bad rows
    <root>/parked/v=NNNNNNNNNN/, <root>/headers/v=.../  Parquet, by micro-batch: grid rows
                                                          without a header yet, headers seen
    <root>/silver/v=NNNNNNNNNN/                          Parquet snapshot
    <root>/silver_days/v=NNNNNNNNNN/tanggal=DAY/         Parquet, the days that a version rewrote
    <root>/silver_day_list/v=NNNNNNNNNN/                 JSON lines, the commit record of a version:
                                                          of each day, the version that holds it
    <root>/state/<name>/v=NNNNNNNNNN/                    JSON lines (watermark, manifest, runs, batches),
                                                          or one document (watermark, manifest)
    <root>/state/<name>.json                             a document of an earlier system, read
                                                          until there is a version
    <root>/fixes/date=YYYYMMDD/run_key=YYYYMMDDHH/load_id=RUN/       JSON lines

Every write is one Spark job with the standard commit protocol, so a failed
task or a lost executor is retried and a half-written folder never has a
``_SUCCESS`` marker. Partitioned sinks use dynamic partition overwrite down to
the run's id: a retry of a run replaces its own rows, and two runs of one hour
keep theirs. Silver snapshots and state are never overwritten in place: each
write makes the next version, and readers take the newest committed one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from alloy.constants import WHITESPACE
from alloy.operators.bronze import RunInfo
from alloy.operators.common import empty


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def committed_children(spark: SparkSession, path: str, prefix: str, committed: bool = True) -> list[str]:
    """Values of sub-folders ``prefix=...`` of ``path``; with ``committed`` only
    those holding ``_SUCCESS`` (a finished Spark write)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix + "="):
            if not committed or fs.exists(st.getPath().suffix("/_SUCCESS")):
                out.append(name.split("=", 1)[1])
    return sorted(out)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files of a flat folder."""
    fs, p = _fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return [n for n in names if not n.startswith(("_", "."))]


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


# --- partitioned data sinks ----------------------------------------------------

MODES = ("append", "replace", "fail")


def _with_run_keys(df: DataFrame, run: RunInfo) -> DataFrame:
    return df.withColumns({"date": F.lit(run.today_key), "run_key": F.lit(run.run_key), "load_id": F.lit(run.load_id)})


BRONZE_PARTITIONS = ("date", "run_key", "load_id", "day")


def _write_by_run(df: DataFrame, path: str, run: RunInfo, partitions=BRONZE_PARTITIONS[:3]) -> None:
    (_with_run_keys(df, run).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


def by_session_day(bronze: DataFrame) -> DataFrame:
    """Bronze rows with their partition ``day``; the rows of one day go to few tasks
    and so to few files (Spark splits a large day)."""
    day = F.col("tanggal").cast("date") if "tanggal" in bronze.columns else F.lit(None).cast("date")
    return bronze.withColumn("day", day).hint("rebalance", "day")


def write_bronze(df: DataFrame, root: str, run: RunInfo, mode: str = "append") -> int:
    """This run's bronze rows: ``append`` them (a retry of the run replaces what
    it wrote before), ``replace`` the table by them, or ``fail`` if it exists. Their
    number, counted while they are written."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    seen = Observation()
    df = by_session_day(df).observe(seen, F.count(F.lit(1)).alias("n"))
    if mode == "append":
        # A retry may find fewer days than the run's first attempt, so the run's folder goes as a whole.
        _remove(df.sparkSession, f"{root}/bronze/date={run.today_key}/run_key={run.run_key}/load_id={run.load_id}")
        _write_by_run(df, f"{root}/bronze", run, BRONZE_PARTITIONS)
        return seen.get["n"]
    (_with_run_keys(df, run).write.mode("overwrite" if mode == "replace" else "errorifexists")
     .option("partitionOverwriteMode", "static")
     .partitionBy(*BRONZE_PARTITIONS).parquet(f"{root}/bronze"))
    return seen.get["n"]


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def read_bronze(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame | None:
    """The bronze table, or None before the first write. With ``schema`` its columns
    are read from every load that has them, without looking at the files first;
    without, the columns of all loads are merged."""
    path = f"{root}/bronze"
    if not exists(spark, path):
        return None
    if schema:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def of_run(run: RunInfo) -> Column:
    """The condition on the partition columns of the rows that ``run`` wrote."""
    return (F.col("date") == run.today_key) & (F.col("run_key") == run.run_key) & (F.col("load_id") == run.load_id)


def of_days(table: DataFrame, days: list, column: str = "day") -> DataFrame:
    """``table`` on ``days`` (dates, or None for rows without one): a filter on the
    partition column, so that no other day's file is read."""
    found = F.col(column).isin([d for d in days if d is not None])
    return table.filter(found | F.col(column).isNull() if None in days else found)


def distinct_days(df: DataFrame, column: str) -> list:
    """The days of a frame, a row each on the driver (no more than the calendar has)."""
    return [r[0] for r in df.select(F.col(column).cast("date").alias("d")).distinct().collect()]


def write_quarantine(df_error: DataFrame, root: str, run: RunInfo, check_empty: bool = True) -> bool:
    """Raw bad rows plus reason; nothing is written when there are none."""
    if check_empty and df_error.isEmpty():
        return False
    _write_by_run(df_error, f"{root}/quarantine", run)
    return True


def quarantine_path(run: RunInfo) -> str:
    return f"quarantine/date={run.today_key}/run_key={run.run_key}"


# --- versions: silver, state, parked rows ------------------------------------------

def versions(spark: SparkSession, path: str) -> list[int]:
    return [int(v) for v in committed_children(spark, path, "v")]


def _next_version(spark: SparkSession, path: str) -> str:
    """The number follows every existing version folder, committed or not, so a
    write that died half-way never blocks (or is mistaken for) the next one."""
    every = [int(v) for v in committed_children(spark, path, "v", committed=False)]
    return f"{path}/v={(max(every) + 1) if every else 1:010d}"


def _newest(spark: SparkSession, path: str) -> str | None:
    vs = versions(spark, path)
    return f"{path}/v={vs[-1]:010d}" if vs else None


def silver_versions(spark: SparkSession, root: str) -> list[int]:
    return versions(spark, f"{root}/silver")


def read_silver(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Newest committed silver snapshot, or an empty table of ``schema``."""
    path = _newest(spark, f"{root}/silver")
    return spark.read.schema(schema).parquet(path) if path else empty(spark, schema)


def write_silver(df: DataFrame, root: str, spark: SparkSession) -> int:
    """Write the next silver version; the previous one stays readable."""
    path = _next_version(spark, f"{root}/silver")
    df.write.mode("errorifexists").parquet(path)
    return int(path.rsplit("=", 1)[1])


def write_state_at(df: DataFrame, path: str) -> None:
    """The next version of a small table of JSON lines."""
    df.coalesce(1).write.mode("errorifexists").json(_next_version(df.sparkSession, path))


def write_state(df: DataFrame, root: str, name: str, form: str = "records", order: list[str] | None = None) -> None:
    """The next version of a state, as ``records`` (JSON lines) or as a ``document``
    sorted by ``order``."""
    path = _next_version(df.sparkSession, f"{root}/state/{name}")
    if form == "document":
        write_document(df, path, DOCUMENT_KEYS[name], order or df.columns[:1])
    elif form == "records":
        df.write.mode("errorifexists").json(path)
    else:
        raise ValueError(f"unknown state form {form!r}")


def has_state(spark: SparkSession, root: str, name: str) -> bool:
    return bool(versions(spark, f"{root}/state/{name}")) or exists(spark, f"{root}/state/{name}.json")


def state_version(spark: SparkSession, root: str, name: str) -> int:
    """Number of the latest committed state of ``name``; 0 if there is none."""
    return max(versions(spark, f"{root}/state/{name}"), default=0)


def read_state(spark: SparkSession, root: str, name: str, schema: str, version: int | None = None) -> DataFrame:
    """Latest committed state of ``name`` (or an earlier ``version`` of it). Before the
    first version it is the document ``<name>.json`` of an earlier system, if there
    is one, else an empty table. Damage fails the read."""
    base = f"{root}/state/{name}"
    path = _newest(spark, base) if version is None else f"{base}/v={version:010d}" if version else None
    if path is None:
        earlier = f"{base}.json"
        if name in DOCUMENT_KEYS and exists(spark, earlier):
            return read_records(spark, earlier, DOCUMENT_KEYS[name], schema, True).drop("_ord")
        return spark.createDataFrame([], schema)
    if any(n.endswith(".txt") for n in data_files(spark, path)):
        return read_records(spark, path, DOCUMENT_KEYS[name], schema, True).drop("_ord")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_batch(df: DataFrame, root: str, name: str, epoch: int) -> None:
    """What a micro-batch leaves for the next ones; a retry of the batch replaces it."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/{name}/v={epoch:010d}")


def read_batch(spark: SparkSession, root: str, name: str, epoch: int, schema: str) -> DataFrame:
    """What the newest micro-batch before ``epoch`` left."""
    before = [v for v in versions(spark, f"{root}/{name}") if v < epoch]
    return (spark.read.schema(schema).parquet(f"{root}/{name}/v={before[-1]:010d}") if before
            else spark.createDataFrame([], schema))


def write_fixes(df: DataFrame, root: str, run: RunInfo) -> None:
    df.write.mode("overwrite").json(f"{root}/fixes/date={run.today_key}/run_key={run.run_key}/load_id={run.load_id}")


def read_fixes(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All fix records, with the run's keys."""
    if not exists(spark, f"{root}/fixes"):
        return spark.createDataFrame([], schema + ", date string, run_key string, load_id string")
    return spark.read.schema(schema + ", date string, run_key string, load_id string").option("mode", "FAILFAST").json(f"{root}/fixes")


# --- state in any of its forms ----------------------------------------------------

#: The key under which a state's document holds its records.
DOCUMENT_KEYS = {"watermark": "sheets", "manifest": "errors", "fixes": "fixes"}


def read_records(spark: SparkSession, path: str, key: str, schema: str, document: bool) -> DataFrame:
    """State records at ``path`` with ``_ord`` = position. Either ``document``s, one a
    file, ``{"<key>": [{...}, ...]}`` on one line or many; or lines, a record each.

    Both are read as VARIANT values, so a record may lack fields (old forms have no
    creds) or hold a number for a text. Whatever is not such a value fails the read:
    broken JSON, a document without ``key``, a record that is no object, a field that
    cannot be cast. Damage must not be taken for "nothing known".
    """
    text = spark.read.text(path, wholetext=document).filter(F.btrim("value", F.lit(WHITESPACE)) != "")
    value = text.select(F.parse_json("value").alias("v"))
    if document:
        found = F.variant_get("v", f"$.{key}", "array<variant>")
        missing = F.raise_error(F.lit(f"a state document without {key}"))
        value = value.select(F.posexplode(F.coalesce(found, missing.cast("array<variant>"))).alias("_ord", "v"))
    else:
        value = value.withColumn("_ord", F.monotonically_increasing_id())
    fields = [f.strip().split(" ", 1) for f in re.split(r",(?![^<(]*[>)])", schema)]
    whole = F.schema_of_variant("v").startswith("OBJECT")
    record = F.when(whole, F.col("v")).otherwise(F.raise_error(F.lit("a state record that is no object")).cast("variant"))
    return value.select(record.alias("v"), "_ord").select(*[F.variant_get("v", f"$.{name}", kind).alias(name) for name, kind in fields], "_ord")


def write_document(df: DataFrame, path: str, key: str, order: list[str]) -> None:
    """``df`` as one document ``{"<key>": [rows by order]}`` in the folder ``path``: a
    line a record, sorted, written as they stream by. One file needs one task, but
    no row holds more than a record, so any number of them may be written."""
    columns = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    rows = df.select(F.lit(1).alias("part"), F.row_number().over(Window.orderBy(*order)).alias("n"), columns.alias("value"))
    rows = rows.withColumn("value", F.concat(F.when(F.col("n") > 1, F.lit(",")).otherwise(F.lit("")), F.col("value")))
    ends = df.sparkSession.createDataFrame([(0, 0, f'{{"{key}": ['), (2, 0, "]}")], "part int, n int, value string")
    rows.unionByName(ends).coalesce(1).sortWithinPartitions("part", "n").select("value").write.mode("errorifexists").text(path)


# --- silver partitioned by business day ------------------------------------------

DAY_LIST_SCHEMA = "day date, version bigint"


def day_list(spark: SparkSession, root: str) -> dict:
    """The newest commit record: of each day (None: no day) the version that holds it.
    A row a business day, so it fits the driver, which plans the scan from it."""
    path = _newest(spark, f"{root}/silver_day_list")
    if path is None:
        return {}
    rows = spark.read.schema(DAY_LIST_SCHEMA).option("mode", "FAILFAST").json(path).collect()
    return {r["day"]: r["version"] for r in rows}


def _day_folder(root: str, day, version: int) -> str:
    name = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
    return f"{root}/silver_days/v={version:010d}/tanggal={name}"


def read_silver_by_day(spark: SparkSession, root: str, schema: str, days: list | None = None) -> DataFrame:
    """Silver as of its newest commit record (or an empty table of ``schema``), only the
    folders of ``days`` if given. What a writer has not committed is never seen, and a
    reader that has resolved the record keeps its files."""
    known = day_list(spark, root)
    folders = [_day_folder(root, d, v) for d, v in known.items() if days is None or d in days]
    if not folders:
        return empty(spark, schema)
    return spark.read.schema(f"{schema}, v string").option("basePath", f"{root}/silver_days").parquet(*sorted(folders)).drop("v")


def stage_days(merged: DataFrame, root: str) -> int:
    """Write ``merged`` as the next version's day folders; nothing reads them yet."""
    path = _next_version(merged.sparkSession, f"{root}/silver_days")
    # Rows of one day go to few tasks and so to few files; Spark splits a large day.
    merged.hint("rebalance", "tanggal").write.mode("errorifexists").partitionBy("tanggal").parquet(path)
    return int(path.rsplit("=", 1)[1])


def commit_days(spark: SparkSession, root: str, version: int, days: list) -> None:
    """The commit record of ``version``: its ``days`` and the other days as they were.
    One small file set with its own marker, written last: before it readers see all
    days as before, after it all as merged."""
    rows = [(d, version) for d in days] + [(d, v) for d, v in day_list(spark, root).items() if d not in days]
    write_state_at(spark.createDataFrame(rows, DAY_LIST_SCHEMA), f"{root}/silver_day_list")


def merge_days(spark: SparkSession, root: str, source: DataFrame, schema: str, null_safe_keys: bool = False) -> tuple[DataFrame, list]:
    """(MERGE of ``source`` into the days that it touches, those days): only their
    folders are read."""
    from alloy.operators import silver as S

    days = distinct_days(source, "tanggal")
    return S.upsert(read_silver_by_day(spark, root, schema, days), source, null_safe_keys=null_safe_keys), days


def upsert_silver_by_day(spark: SparkSession, root: str, source: DataFrame, schema: str,
                         null_safe_keys: bool = False) -> int:
    """MERGE ``source`` into the day-partitioned silver table, rewriting only the days
    that it touches: as new folders, which the commit record then puts in the place
    of the old ones, all at once. Returns the number of touched days."""
    merged, days = merge_days(spark, root, source, schema, null_safe_keys)
    if days:
        commit_days(spark, root, stage_days(merged, root), days)
    return len(days)
