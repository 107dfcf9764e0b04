"""Session helpers: a tuned local session for tests and benches, and the
shared scratch folder every job that materialises data must use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # ~128 MB input splits: one task per split of NDJSON at any scale.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_spark(master: str | None = None, app: str = "rectext", shuffle_partitions: int = 8,
              extra: dict | None = None) -> SparkSession:
    """Local session for tests / bench. On a cluster, use the session you are given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    return None


def work_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or an already set
    checkpoint dir). Only a local-mode session without one gets its own
    folder, as in tests; a cluster session without a shared folder is an
    error, because executor-local temp folders are not shared.
    """
    base = _checkpoint_dir(spark)
    if base is None:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
        base = tempfile.mkdtemp(prefix="rectext-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    sub = f"{name}-{uuid.uuid4().hex[:12]}"
    return base.rstrip("/") + "/" + sub


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme so Python can inspect a local-mode folder (tests only)."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


def spread(df, min_partitions: int | None = None):
    """Round-robin a *scan* over the cluster's cores when its files give
    fewer partitions (a small file of one row group). For readers only: the
    operators never call it, since asking a frame with a shuffle below for
    its partitions would run that shuffle."""
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in df._jdf.queryExecution().sparkPlan().toString() or df.isStreaming:
        raise ValueError("spread() takes a plain scan")
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def path_exists(spark: SparkSession, uri: str) -> bool:
    """Whether a file or folder exists, asked of the cluster's file system
    (metadata only; works for HDFS and object stores alike)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(path))
