"""Parse text lines into records and clean them.

Input is any DataFrame with a string column of JSON text (one line per row);
other columns (``source_file``, keys) ride along. All work is per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rectext.functions.render import as_list, as_object

CORRUPT_COL = "_corrupt_record"


def is_record(v: Column) -> Column:
    """A valid record is a JSON object with at least one key. Duplicate
    keys and broken text already parse to null."""
    return F.coalesce(F.size(as_object(v)) > 0, F.lit(False))


def parse_lines(lines: DataFrame, value_col: str = "value", keep_raw: bool = False) -> DataFrame:
    """One row per record candidate.

    * blank lines are dropped;
    * a line holding a JSON array yields one row per item;
    * every other line yields one row.

    Output: the input columns but ``value_col``, then ``v`` (the record, null
    when corrupt) and ``_corrupt_record`` (the raw line when corrupt, else null);
    with ``keep_raw`` also ``_raw``: the line of a valid record that had a
    line of its own (not an array item), so it can be stored as written.
    """
    line = F.col(value_col)
    others = [c for c in lines.columns if c != value_col]
    parsed = (lines.filter(line.rlike(r"\S"))
              .select(*others, line.alias("_line"), F.try_parse_json(line).alias("_p")))
    # only a line starting with '[' can hold an array: a failed variant cast
    # is costly, so objects never attempt it
    arr = as_list(F.col("_p"))
    items = F.when(F.col("_line").rlike(r"^[ \t\r]*\["),
                   F.coalesce(arr, F.array(F.col("_p")))).otherwise(F.array(F.col("_p")))
    if keep_raw:
        parsed = parsed.withColumn("_own", ~F.col("_line").rlike(r"^[ \t\r]*\[") | arr.isNull())
    exploded = parsed.select(*others, "_line", *(["_own"] if keep_raw else []),
                             F.explode(items).alias("_item"))
    ok = is_record(F.col("_item"))
    return exploded.select(
        *others,
        F.when(ok, F.col("_item")).alias("v"),
        F.when(~ok, F.col("_line")).alias(CORRUPT_COL),
        *([F.when(ok & F.col("_own"), F.col("_line")).alias("_raw")] if keep_raw else []))


def drop_corrupt(records: DataFrame) -> DataFrame:
    """P1 + P2: keep valid records and drop the corrupt-text column."""
    return records.filter(F.col("v").isNotNull()).drop(CORRUPT_COL)


def drop_all_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows whose columns are all null (``dropna(how='all')``)."""
    return df.na.drop(how="all", subset=columns)


def _nan_to_null(c: Column, dtype) -> Column:
    from pyspark.sql import types as T
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(c, F.lit(None).cast(dtype))
    return c


def prune_nulls_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """P5 on a typed DataFrame: the record as JSON text without its null / NaN
    fields (``to_json`` leaves null fields out)."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    return F.to_json(F.struct(*[_nan_to_null(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
                                for f in fields]))


def prune_nulls_variant(v: Column) -> Column:
    """P5 on a variant record: the record without its top-level null fields,
    as JSON text (keys in ascending order)."""
    kept = F.map_filter(as_object(v), lambda k, x: ~F.is_variant_null(x))
    return F.to_json(kept)


def stringify_ids(text: Column, id_key: str = "$oid") -> Column:
    """In JSON text, replace every extended-JSON object id
    ``{"$oid": "..."}`` by its string, at any depth (inside lists and objects
    alike). Everything else keeps its exact text, so numbers such as
    ``100.0`` keep their form (re-serialising a parsed record would not).

    An object id is an object whose only key is ``$oid``; inside JSON strings
    quotes are escaped, so text that merely looks like one is not touched."""
    pattern = r'\{\s*"' + _re_escape(id_key) + r'"\s*:\s*("[^"\\]*+(?:\\.[^"\\]*+)*+")\s*\}'
    return F.regexp_replace(text, pattern, "$1")


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)
