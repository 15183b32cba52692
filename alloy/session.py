"""Session helpers: a tuned local/cluster session and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Skip per-call Python call-site capture (several JVM round trips per
    # Column function); plans are built from many expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # The JVM does not compile methods above this size; Spark then splits the row's code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(master: str | None = None, app: str = "alloy", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on, the UI off and UTC session time."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if (master or "").startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("ALLOY_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compiled_methods(spark: SparkSession) -> SparkSession:
    """Let a session that was made elsewhere split its rows' code, too, before a method
    is too large for the JVM to compile: such a method is interpreted for every row. A
    limit that the deployment has set is kept."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, DEFAULT_CONF[name])
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set by the deployment and is only read here. When it
    is unset (local tests) a private folder under the system temp dir is made.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="alloy-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/alloy/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
