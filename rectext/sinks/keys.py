"""K4 without the documents: the stored keys beside a table of collections.

``<table>.keys/keys`` holds each collection's keys in hash buckets, and
``<table>.keys/bits`` a Bloom filter of all of them, as 64-bit words whose
bits Spark adds up (``bit_or``). An import asks the filter first; only keys
that it may have seen are joined, and only with their buckets. The filter has
a fixed size: with more keys than it is made for it lets more of them through
to the join, never fewer.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rectext.session import path_exists

BUCKETS, HASHES = 16, 4
#: Bits of the filter (8 MB, the size of the broadcast); one in a hundred unseen keys passes at about 7 million keys.
BITS = 1 << 26


def _folder(table: str) -> str:
    return table.rstrip("/") + ".keys"


def _positions(collection: Column, key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(collection, key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def has_keys(spark: SparkSession, table: str) -> bool:
    return path_exists(spark, _folder(table) + "/keys")


def add_keys(keys: DataFrame, table: str, bits: int = BITS) -> None:
    """Appends ``collection, key`` (rows without a key are left out)."""
    keys = keys.select(F.col("collection"), F.col("key").cast("string").alias("key")).filter("collection is not null and key is not null")
    at = keys.select(F.explode(F.array(*_positions(F.col("collection"), F.col("key"), bits))).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    # The filter first: a key in it that isn't stored is harmless.
    words.write.mode("append").parquet(_folder(table) + "/bits")
    keys.withColumn("bucket", _bucket(F.col("key"))).write.mode("append").partitionBy("collection", "bucket").parquet(_folder(table) + "/keys")


def stored_keys(spark: SparkSession, table: str, buckets: list[int] | None = None) -> DataFrame:
    rows = spark.read.schema("key string, collection string, bucket int").parquet(_folder(table) + "/keys")
    return (rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))).select("collection", "key")


def may_be_stored(spark: SparkSession, table: str, collection: Column, key: Column, bits: int = BITS) -> Column:
    """False only for keys that aren't stored."""
    words = spark.read.schema("word long, bits long").parquet(_folder(table) + "/bits").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    dense = np.zeros(bits >> 6, np.uint64)
    dense[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    sent = spark.sparkContext.broadcast(dense)

    @F.pandas_udf("boolean")
    def seen(*at: pd.Series) -> pd.Series:
        out = np.ones(len(at[0]), bool)
        for x in at:
            x = x.to_numpy(np.int64)
            out &= (sent.value[x >> 6] >> (x & 63).astype(np.uint64)) & np.uint64(1) != 0
        return pd.Series(out)

    return seen(*_positions(collection, key, bits))


def without_stored(batch: DataFrame, table: str, key: str, bits: int = BITS) -> DataFrame:
    """The rows of ``batch`` (``collection``, ``key`` and others) whose key
    isn't stored in their collection; rows without a key all stay. ``batch``
    is read twice, so give a table."""
    spark = batch.sparkSession
    k = F.col(f"`{key}`").cast("string")
    keyed = batch.filter(F.col("collection").isNotNull() & k.isNotNull())
    marked = keyed.withColumn("_maybe", may_be_stored(spark, table, F.col("collection"), k, bits))
    # A filter column of its own, so that Spark doesn't run the check below the projection once more.
    buckets = [r["b"] for r in marked.filter("_maybe").select(_bucket(k).alias("b")).distinct().collect()]         # BUCKETS at most
    maybe = marked.filter("_maybe").drop("_maybe")
    stored = stored_keys(spark, table, buckets).select(F.col("collection").alias("_c"), F.col("key").alias("_k"))
    old_out = maybe.join(stored, (F.col("collection") == F.col("_c")) & (k == F.col("_k")), "left_anti")
    new = marked.filter(~F.col("_maybe")).drop("_maybe")
    unkeyed = batch.filter(F.col("collection").isNull() | k.isNull())
    return old_out.unionByName(new).unionByName(unkeyed)


def replace_keys(keys: DataFrame, table: str, collections: list[str], bits: int = BITS) -> None:
    """The keys of ``collections`` become ``keys``."""
    from rectext.sinks.writers import clear_partitions
    clear_partitions(keys.sparkSession, _folder(table) + "/keys", "collection", collections)
    add_keys(keys, table, bits)
