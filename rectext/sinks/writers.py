"""Sinks (K1-K6): per-source CSV, per-collection JSON lines, a feature table
rewritten per source file, insert-ignore and drop-and-reload.

Paths are URIs (local, HDFS or object store alike): object-store upload (K6)
is the same writer with an ``s3a://`` path, and no file is renamed on the
driver. Nothing here shuffles by a data key except the insert-ignore
de-duplication, which aggregates map-side first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEATURE_SCHEMA = T.StructType([
    T.StructField("text_representation", T.StringType(), True),
    T.StructField("timestamp", T.DoubleType(), True),
    T.StructField("label", T.StringType(), True),
    T.StructField("source_file", T.StringType(), True),
])


def rebalanced(df: DataFrame, key: str, rebalance: bool = True) -> DataFrame:
    """Group rows of one key into few output files without a hot task.

    The ``rebalance`` hint shuffles by ``key`` and lets AQE coalesce small
    keys into one task each and split a key above the advisory partition
    size across several tasks. Without it, every task writes a file for
    every key it holds (tasks x keys small files). Needs AQE (Spark's
    default): without it the hint would be a plain hash repartition, one task
    for a hot key, so the write then stays shuffle-free instead."""
    aqe = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    return df.hint("rebalance", key) if rebalance and aqe else df


CSV_PARTITION = "source_key"


def write_csv_by_key(df: DataFrame, path: str, key: str = "source_file", mode: str = "overwrite",
                     rebalance: bool = True) -> None:
    """K1: CSV with header, one folder per ``key`` value (the input file).

    Every file keeps all columns, ``source_file`` included (the folder is
    named by a copy of it, ``source_key``), so a single CSV reads like one
    written per input. No ``coalesce(1)``: rows are rebalanced by key
    (``rebalanced``), so a small input gets about one file and an input
    holding a third of all rows is still written by many tasks. Spark's
    default quoting / escaping is kept (it reads back exactly with
    ``multiLine``)."""
    out = df.withColumn(CSV_PARTITION, F.col(key))
    (rebalanced(out, CSV_PARTITION, rebalance).write.mode(mode).partitionBy(CSV_PARTITION)
     .option("header", True)
     # the CSV writer trims values by default; keep texts exactly
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("partitionOverwriteMode", "dynamic")
     .csv(path))


def read_csv_by_key(spark: SparkSession, path: str, schema: T.StructType = FEATURE_SCHEMA) -> DataFrame:
    """Read back what K1 wrote. The given schema fixes the types (no
    inference pass)."""
    full = T.StructType(schema.fields + [T.StructField(CSV_PARTITION, T.StringType(), True)])
    return (spark.read.schema(full).option("header", True).option("multiLine", True)
            .csv(path).select(*[f.name for f in schema.fields]))


def write_collections(records: DataFrame, path: str, value: str = "value", collection: str = "collection",
                      mode: str = "overwrite") -> None:
    """K2 (+K5 / K6): records as JSON lines (their text as given), one
    folder per collection.

    ``partitionOverwriteMode=dynamic`` replaces exactly the collections in
    this batch and keeps the others (drop-and-reload per collection)."""
    out = records.select(F.col(value).alias("value"), F.col(collection).alias("collection"))
    (rebalanced(out, "collection").write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("collection").text(path))


def read_collections(spark: SparkSession, path: str) -> DataFrame:
    """All documents of all collections: ``collection, value`` (JSON
    text), ``source_file``. An empty collection simply has no rows."""
    from rectext.sources.json_files import file_path
    return (spark.read.schema("value string, collection string").text(path)
            .select("collection", "value", file_path("_metadata.file_path").alias("source_file")))


def load_by_source(features: DataFrame, table_path: str, key: str = "source_file",
                   rebalance: bool = True) -> None:
    """K3: write features to a Parquet table partitioned by ``source_file``,
    replacing only the source files present in this batch (dynamic partition
    overwrite): loading a file twice leaves the table unchanged. Rows are
    rebalanced by source file first (few files per source, no hot task)."""
    (rebalanced(features, key, rebalance).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(key).parquet(table_path))


def read_table(spark: SparkSession, table_path: str, schema: T.StructType = FEATURE_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(table_path).select(*[f.name for f in schema.fields])


def insert_ignore(batch: DataFrame, existing: DataFrame | None, key: str | list[str] = "_id") -> DataFrame:
    """K4: the rows of ``batch`` to append so that ``key`` stays unique.

    * rows without a key (null in one of its columns) are always new (they never collide);
    * inside the batch, the first row of each key by its other columns, so the
      pick doesn't depend on the run;
    * keys already in ``existing`` are ignored.

    Rows without a key bypass the join, so a null-key hot spot never lands
    in one shuffle partition; the de-duplication aggregates map-side first."""
    keys = [key] if isinstance(key, str) else list(key)
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(f"`{k}`").isNotNull()
    rest = [c for c in batch.columns if c not in keys]
    keyed = (batch.filter(has_key).groupBy(*keys).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_first"))
             .select(*keys, *[F.col(f"_first.`{c}`").alias(c) for c in rest]) if rest else batch.filter(has_key).distinct())
    unkeyed = batch.filter(~has_key)
    if existing is not None:
        keyed = keyed.join(existing.select(*keys).filter(has_key), keys, "left_anti")
    return keyed.select(*batch.columns).unionByName(unkeyed)


def clear_partitions(spark: SparkSession, path: str, column: str, values: list[str]) -> None:
    """Delete the folders ``column=value`` of a partitioned table: what a
    replacing load does with sources that have no rows left."""
    jvm = spark.sparkContext._jvm
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for value in values:
        folder = jvm.org.apache.hadoop.fs.Path(path, f"{column}={escape(value)}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def append_ignore(spark: SparkSession, batch: DataFrame, table_path: str, key: str = "_id",
                  partition_by: list[str] | None = None) -> DataFrame:
    """K4 against a Parquet table: compute the new rows and append them.
    Single-writer contract (no concurrent appenders). Returns the (lazy) rows
    that were appended."""
    from rectext.session import path_exists
    existing = spark.read.parquet(table_path) if path_exists(spark, table_path) else None
    new_rows = insert_ignore(batch, existing, key)
    writer = new_rows.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(table_path)
    return new_rows


def drop_reload(batch: DataFrame, table_path: str, collection: str = "collection") -> None:
    """K5: replace the collections present in ``batch`` (drop, then load),
    keeping every other collection of the table (rebalanced by collection:
    few files per collection, no hot task)."""
    (rebalanced(batch, collection).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(collection).parquet(table_path))
