"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rectext.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read
    back: cuts the lineage, survives lost executors, and is computed once."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of Arrow data that are dealt with at once.
BLOCK = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from here on hands Python Arrow batches of about
    ``BLOCK`` bytes (one row at least), unless it has a setting of its own.
    Spark's default of 64 MB takes several times as much off the heap, once
    for each core: the JVM doubles a buffer by copying it, and Python holds
    the batch again. Both keep it through all later stages."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH, None) is None:
        conf.set(_BATCH, str(BLOCK))
    return df


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(T._parse_datatype_string(ddl))


def columns(batch: pa.RecordBatch) -> list[list]:
    """Columns of a batch as Python lists; texts as UTF-8 bytes (no decoding)."""
    text = (pa.types.is_string, pa.types.is_large_string)
    return [(c.cast(pa.large_binary()) if any(t(c.type) for t in text) else c).to_pylist()
            for c in batch.columns]


def parts(rows, block: int = BLOCK):
    """An Arrow batch or array in parts of about ``block`` bytes (one row at
    least), so that only these become Python objects at once. Between them
    Arrow gives back what it has freed: Python workers outlive their tasks,
    and would else keep it through all later stages."""
    step = max(1, len(rows) * block // max(1, rows.nbytes))
    for at in range(0, len(rows), step):
        pa.default_memory_pool().release_unused()
        yield rows.slice(at, step)
    pa.default_memory_pool().release_unused()


def map_rows(df: DataFrame, ddl: str, start) -> DataFrame:
    """``mapInArrow`` where ``start()`` runs once per task and returns
    ``f(*columns) -> dict of output columns``; ``f`` takes each row by itself.
    Rows stream through in Arrow batches (``in_batches``), so memory holds a
    few MB, not a partition."""
    out = arrow_schema(ddl)

    def run(batches):
        f = start()
        for batch in batches:
            for part in parts(batch):
                yield pa.RecordBatch.from_pydict(f(*columns(part)), schema=out)

    return in_batches(df).mapInArrow(run, ddl)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
