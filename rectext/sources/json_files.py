"""JSON sources (S1-S7, S11): discover files, read NDJSON lines, read
whole-file arrays, and pick the format per file.

Every reader returns ``source_file`` (the full file URI from ``_metadata``),
so one scan serves all files of a batch: no driver loop over files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rectext.operators.records import CORRUPT_COL, parse_lines
from rectext.sources.json_arrays import array_items, is_one_value

# The file name patterns of JSON inputs (case-insensitive).
JSON_GLOB = "*.{[jJ][sS][oO][nN],[nN][dD][jJ][sS][oO][nN]}"
FLAT_JSON_GLOB = "*.[jJ][sS][oO][nN]"
CHECKPOINT_FOLDER = ".ipynb_checkpoints"
# Characters that a path pattern gives a meaning.
_GLOB_CHARS = re.compile(r"([\[\]{}*?\\])")


def file_path(uri) -> F.Column:
    """A file URI as Spark reports it (``_metadata.file_path``, ``binaryFile``
    paths: percent-encoded, ``a%20b.json``) decoded back to the path text
    (``a b.json``). Only %-escapes are decoded: a literal ``+`` stays."""
    c = F.col(uri) if isinstance(uri, str) else uri
    return F.coalesce(F.try_url_decode(F.regexp_replace(c, r"\+", "%2B")), c)


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def discover_files(spark: SparkSession, root, recursive: bool = True,
                   glob: str = JSON_GLOB) -> DataFrame:
    """The JSON files under ``root`` (a file or a folder).

    Listing only: the ``binaryFile`` source does not read file contents
    when the ``content`` column is not selected. Returns ``path, length,
    modification_time``. Hidden folders (``.ipynb_checkpoints``) are skipped
    by Spark's file index; the filter states it anyway."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(_paths(root))
    return (df.select(file_path("path").alias("path"), F.col("length"),
                      F.col("modificationTime").alias("modification_time"))
            .filter(~F.col("path").contains("/" + CHECKPOINT_FOLDER + "/")))


def listed_files(spark: SparkSession, root, recursive: bool = True, glob: str = JSON_GLOB) -> DataFrame:
    """``source_file`` of every file that ``discover_files`` would list, and
    of files of 0 bytes, which a scan leaves out. The names are those that
    Spark's file index holds on the driver."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    names = spark.createDataFrame([(x,) for x in reader.load(_paths(root)).inputFiles()], "source_file string")
    # such a listing writes file:///a for what a scan calls file:/a
    one_slash = F.regexp_replace("source_file", r"^([A-Za-z0-9+.-]+):///", "$1:/")
    return (names.select(file_path(one_slash).alias("source_file"))
            .filter(~F.col("source_file").contains("/" + CHECKPOINT_FOLDER + "/")))


def read_lines(spark: SparkSession, root, recursive: bool = True, glob: str | None = JSON_GLOB,
               wholetext: bool = False, ignore_corrupt_files: bool = False,
               with_file_size: bool = False) -> DataFrame:
    """Text lines (or whole files) with their file: ``value, source_file``.

    Files are split into ~``spark.sql.files.maxPartitionBytes`` pieces, so a
    single huge NDJSON file is read by many tasks. ``root`` may be a file, a
    folder or a glob pattern (``s3a://bucket/x*.json``). With
    ``ignore_corrupt_files`` an unreadable file (a broken compressed file)
    is skipped instead of failing the batch (P13)."""
    reader = spark.read
    if ignore_corrupt_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.text(_paths(root), wholetext=wholetext)
    extra = [F.col("_metadata.file_size").alias("file_size")] if with_file_size else []
    return df.select(F.col("value"), file_path("_metadata.file_path").alias("source_file"), *extra)


def scan_ndjson(spark: SparkSession, root, recursive: bool = True, glob: str | None = JSON_GLOB,
                with_file_size: bool = False, keep_raw: bool = False) -> DataFrame:
    """Permissive NDJSON scan. One row per record candidate:
    ``source_file, v`` (variant, null when corrupt) and ``_corrupt_record``."""
    lines = read_lines(spark, root, recursive, glob, with_file_size=with_file_size)
    return parse_lines(lines, keep_raw=keep_raw)


def _whole_files(spark: SparkSession, paths: list[str], ignore_corrupt_files: bool = False) -> DataFrame:
    """``source_file, items``: each file read whole, its JSON array cut into
    the items' own texts (a file holding one object is one item); null if it
    is neither. The paths are taken literally. A file that is too large for
    one row (2 GB) is an error, never skipped."""
    if not paths:
        return spark.createDataFrame([], "source_file string, items array<string>")
    reader = spark.read.option("ignoreCorruptFiles", "true") if ignore_corrupt_files else spark.read
    whole = reader.text([_GLOB_CHARS.sub(r"\\\1", x) for x in paths], wholetext=True)
    items = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", "array<string>")) \
        .when(F.try_parse_json("value").isNotNull() & F.col("value").rlike(r"^\s*\{"), F.array("value"))
    return whole.select(file_path("_metadata.file_path").alias("source_file"), items.alias("items"))


def scan_json_array(spark: SparkSession, paths, keep_raw: bool = False) -> DataFrame:
    """Each file is one JSON array of records (or a single record).

    A file is one task and one row, as in any whole-document reader, but each
    record is parsed by itself, so the limit on a parsed value holds for a
    record and not for the file, and a number such as 100.0 keeps its form."""
    files = _whole_files(spark, _paths(paths))
    return parse_lines(files.select("source_file", F.explode("items").alias("value")), keep_raw=keep_raw)


def array_candidates(spark: SparkSession, root, recursive: bool = True, glob: str | None = JSON_GLOB,
                     ignore_corrupt_files: bool = False) -> list[str]:
    """Files whose first line that isn't blank begins an array or an object
    without being a JSON value itself. Only the first split of a file is
    looked at, and only the paths of such files, which Spark's listing holds on
    the driver anyway, come back."""
    reader = spark.read
    if ignore_corrupt_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    first = (reader.text(_paths(root)).select("value", file_path("_metadata.file_path").alias("source_file"),
                                              F.col("_metadata.file_block_start").alias("at"))
             .filter((F.col("at") == 0) & F.col("value").rlike(r"\S"))
             .withColumn("n", F.monotonically_increasing_id())
             .groupBy("source_file").agg(F.min_by("value", "n").alias("line")))
    line = F.trim(F.col("line"))
    found = first.filter((F.col("line").rlike(r"^\s*\[") & F.try_parse_json(line).isNull()) | (line == "{") | (line == "["))
    return [r["source_file"] for r in found.select("source_file").collect()]


def scan_json_records(spark: SparkSession, root, recursive: bool = True, glob: str | None = JSON_GLOB,
                      ignore_corrupt_files: bool = False, keep_raw: bool = False) -> DataFrame:
    """Record candidates of all files, each in its own format:
    ``source_file, v`` (null when corrupt), ``_corrupt_record, format`` (and
    ``_raw``). A file that begins like an array over several lines (or an
    indented object) and of which every item parses is one; it is read by as
    many tasks as it has splits. All others are read line by line."""
    candidates = array_candidates(spark, root, recursive, glob, ignore_corrupt_files)
    lines = read_lines(spark, root, recursive, glob, ignore_corrupt_files=ignore_corrupt_files)
    if not candidates:
        return parse_lines(lines, keep_raw=keep_raw).withColumn("format", F.lit("ndjson"))
    items = array_items(spark, candidates, ignore_corrupt_files)
    damaged = items.filter(~is_one_value(F.col("value"))).select("source_file").distinct()
    names = spark.createDataFrame([(x,) for x in candidates], "source_file string").join(damaged, "source_file", "left_anti")
    ndjson = parse_lines(lines.join(names, "source_file", "left_anti"), keep_raw=keep_raw)
    whole = parse_lines(items.join(names, "source_file", "left_semi"), keep_raw=keep_raw)
    return ndjson.withColumn("format", F.lit("ndjson")).unionByName(whole.withColumn("format", F.lit("array")))


def scan_json_auto(spark: SparkSession, root, recursive: bool = True, glob: str | None = JSON_GLOB,
                   keep_raw: bool = False) -> DataFrame:
    """The valid records of ``scan_json_records``."""
    return scan_json_records(spark, root, recursive, glob, keep_raw=keep_raw).filter(F.col("v").isNotNull()).drop(CORRUPT_COL)
