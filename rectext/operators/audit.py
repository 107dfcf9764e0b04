"""Aggregates (A1-A5): corrupt counts, batch audit, import summary,
collection counts. All are grouped counts: partial aggregation per task, so
one file or collection holding a third of all rows costs one row per task
in the shuffle, not its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rectext.operators.records import CORRUPT_COL


def corrupt_count(records: DataFrame, key: str = "source_file") -> DataFrame:
    """A2: corrupt record candidates per file."""
    return records.groupBy(key).agg(F.count_if(F.col(CORRUPT_COL).isNotNull()).alias("n_corrupt"))


def batch_audit(rendered: DataFrame, key: str = "source_file") -> DataFrame:
    """A5 (with P3, P13, T8): per file, from record candidates rendered with
    ``featurize_records(..., with_error=True)`` over *all* candidates:
    valid records, corrupt candidates, error rows, rows without timestamp,
    and whether the file had no valid record at all."""
    valid = F.col("v").isNotNull()
    err = F.coalesce(F.col("is_error"), F.lit(False))
    return (rendered.groupBy(key).agg(
        F.count_if(valid).alias("n_records"),
        F.count_if(F.col(CORRUPT_COL).isNotNull()).alias("n_corrupt"),
        F.count_if(valid & err).alias("n_errors"),
        F.count_if(valid & ~err & F.col("timestamp").isNull()).alias("n_without_timestamp"))
        .withColumn("is_empty", F.col("n_records") == 0))


def collection_count(docs: DataFrame, collection: str = "collection") -> DataFrame:
    """A4: documents per collection."""
    return docs.groupBy(collection).agg(F.count(F.lit(1)).alias("n_documents"))


def import_summary(files: DataFrame, attempted: DataFrame, inserted: DataFrame, totals: DataFrame) -> DataFrame:
    """A3: a row for every file, with or without records: ``file,
    collection, attempted, inserted, total_in_collection, time``.

    ``files``: ``source_file, file, collection``; ``attempted`` and
    ``inserted``: a row for each document with its ``source_file``;
    ``totals``: ``collection, n_documents`` of the target after the load. All
    joins are between one row per file or collection."""
    count = lambda df, name: df.groupBy("source_file").agg(F.count(F.lit(1)).alias(name))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    return (files.join(count(attempted, "attempted"), "source_file", "left")
            .join(count(inserted, "inserted"), "source_file", "left")
            .join(totals.withColumnRenamed("n_documents", "total_in_collection"), "collection", "left")
            .select("file", "collection", zero("attempted"), zero("inserted"), zero("total_in_collection"),
                    F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("time")))
