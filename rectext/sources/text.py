"""Text-line sources (S9, S10) and the line count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the sample line text, ``Line 1`` .. ``Line n``.
SAMPLE_LINE_FORMAT = "Line %d"


def read_text(spark: SparkSession, path) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def sample_lines(numbers: Column) -> Column:
    """``Line <n>`` for a column of line numbers (``spark.range(1, n + 1)``
    or numbers taken from a table)."""
    return F.format_string(SAMPLE_LINE_FORMAT, numbers)


def line_count(lines: DataFrame) -> DataFrame:
    """A1: number of lines, one row ``n_lines`` (partial counts per task, one final sum)."""
    return lines.agg(F.count(F.lit(1)).alias("n_lines"))
