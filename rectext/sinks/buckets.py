"""K3 with a fixed number of folders: the feature table in hash buckets of
the source file.

Replacing source files rewrites their buckets in one dynamic overwrite: the
batch's rows and all rows of other source files. Nothing is deleted by the
driver, and the number of folders doesn't grow with that of the files. A
bucket that is rewritten always gets one row without a source file, so that
one that loses all rows is replaced too; ``read_buckets`` leaves those out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rectext.session import path_exists, work_dir
from rectext.sinks.writers import FEATURE_SCHEMA, rebalanced

BUCKETS = 64


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _all_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(path)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType = FEATURE_SCHEMA, key: str = "source_file", sources: list[str] | None = None,
                 buckets: int = BUCKETS) -> DataFrame:
    """The table's rows; with ``sources`` only those of these source files,
    read from their buckets alone."""
    rows = _all_rows(spark, path, schema)
    if sources is not None:
        wanted = spark.createDataFrame([(s,) for s in sources], "s string").select(bucket_of(F.col("s"), buckets).alias("b")).distinct().collect()
        rows = rows.filter(F.col("bucket").isin([r["b"] for r in wanted]) & F.col(key).isin(sources))
    return rows.filter(F.col(key).isNotNull()).select(*[f.name for f in schema.fields])


def load_buckets(features: DataFrame, path: str, sources: DataFrame | None = None, key: str = "source_file", buckets: int = BUCKETS, rebalance: bool = True) -> None:
    """Replaces the rows of ``sources`` (one column of source files, by
    default those of ``features``) by ``features``. A source file without a
    row in ``features`` is emptied. All loads of a table take the same number
    of ``buckets``. Rows without a source file aren't stored."""
    spark = features.sparkSession
    names = features.columns
    new = features.filter(F.col(key).isNotNull())
    exists = path_exists(spark, path)
    if exists and sources is None:
        # Read twice below: written once to the shared folder.
        base = work_dir(spark, "bucket-batch")
        new.write.parquet(base)
        new = spark.read.schema(features.schema).parquet(base)
    rows = new
    if exists or sources is not None:
        gone = (new.select(F.col(key)) if sources is None else sources.select(F.col(sources.columns[0]).alias(key))).filter(F.col(key).isNotNull()).distinct()
        touched = gone.select(bucket_of(F.col(key), buckets).alias("bucket")).distinct()
        if exists:
            numbers = [r["bucket"] for r in touched.collect()]             # as many as there are buckets, at most
            kept = _all_rows(spark, path, features.schema).filter(F.col("bucket").isin(numbers) & F.col(key).isNotNull()).drop("bucket").join(gone, key, "left_anti")
            base = work_dir(spark, "bucket-kept")
            kept.select(*names).write.parquet(base)                        # the folder itself is about to be replaced
            rows = new.unionByName(spark.read.schema(features.schema).parquet(base))
        marks = touched.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in features.schema], "bucket")
        rows = rows.withColumn("bucket", bucket_of(F.col(key), buckets)).unionByName(marks)
    else:
        rows = rows.withColumn("bucket", bucket_of(F.col(key), buckets))
    (rebalanced(rows, "bucket", rebalance).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))
