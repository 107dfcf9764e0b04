"""JSON arrays over many lines, read by many tasks.

A JSON string never spans lines, so what a line adds to the bracket depth
doesn't depend on any other line. A first pass adds that up for each split of
a file; the sums of the splits before give every split the depth at which it
begins. A second pass walks each split's lines from there and cuts items at
the commas of depth one. Items within a split come out whole; the two ends of
a split (and splits that lie inside one item) are put together afterwards,
which is the only shuffle: two pieces a split, whatever the file's size.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rectext.operators.records import parse_lines

#: Splits whose depths are sent to all tasks at once (about 100 bytes each); more of them go in turns, by file.
MAX_SPLITS = 200_000

# A JSON string, for Java (no repeated group that could overflow its stack) and for Python.
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[\[\]{},]')

# What a piece of text is: an item, or of an item its last part, its first part, a part inside it;
# text of a file that holds one object; text outside of the array.
WHOLE, LAST, FIRST, INSIDE, OBJECT, STRAY = range(6)
PIECE = "source_file string, block long, kind int, comma boolean, text string"


def _count(c: Column, chars: str) -> Column:
    return F.length(c) - F.length(F.translate(c, chars, ""))


def _literal(paths: list[str]) -> list[str]:
    """Paths in which no character has a meaning as a pattern."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", x) for x in paths]


def _lines(spark: SparkSession, paths: list[str], ignore_corrupt_files: bool) -> DataFrame:
    from rectext.sources.json_files import file_path
    reader = spark.read.option("ignoreCorruptFiles", "true") if ignore_corrupt_files else spark.read
    bare = F.regexp_replace("value", STRING, "")
    return (reader.text(_literal(paths))
            .select("value", file_path("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), bare.alias("bare"))
            .select("value", "source_file", "block", _count(F.col("bare"), "[{").alias("opened"), _count(F.col("bare"), "]}").alias("closed")))


def split_depths(lines: DataFrame) -> DataFrame:
    """``source_file, block, depth, is_array``: the depth at which each split
    begins, and whether the file's first mark opens an array."""
    n = F.monotonically_increasing_id()
    first = F.substring(F.ltrim(F.regexp_replace("value", r"^[ \t\r]+", "")), 1, 1)
    sums = (lines.withColumns({"n": n, "mark": first}).groupBy("source_file", "block")
            .agg(F.sum(F.col("opened") - F.col("closed")).alias("balance"), F.min(F.when(F.col("mark") != "", F.col("n"))).alias("any"),
                 F.min(F.when(F.col("mark") == "[", F.col("n"))).alias("array")))
    before = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.first(F.when(F.col("any").isNotNull(), F.col("any").eqNullSafe(F.col("array"))), ignorenulls=True).over(
        Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return sums.select("source_file", "block", F.coalesce(F.sum("balance").over(before), F.lit(0)).alias("depth"), F.coalesce(opens, F.lit(False)).alias("is_array"))


class Cutter:
    """Walks one split's lines; ``pieces`` gets ``(kind, comma, text)``.
    ``comma``: the item follows one (else the opening bracket)."""

    def __init__(self, depth: int, is_array: bool):
        self.depth, self.is_array = depth, is_array
        self.begun = False                         # the current item's beginning was seen in this split
        self.comma, self.text, self.pieces = False, [], []

    def line(self, value: str, opened: int, closed: int) -> None:
        if not self.is_array or self.depth - closed > 1:       # can't come to depth one
            self.text.append(value.strip(" \t\r"))
            self.depth += opened - closed
            return
        at = 0
        for m in _TOKEN.finditer(value):
            c = m[0]
            if c == ",":
                if self.depth == 1:
                    self._end(value[at:m.start()], True)
                    at = m.end()
            elif c in "[{":
                self.depth += 1
                if self.depth == 1:                # the array begins
                    self._stray(value[at:m.start()])
                    self.begun, self.comma, at = True, False, m.end()
            elif c in "]}":
                self.depth -= 1
                if self.depth == 0:                # and ends
                    self._end(value[at:m.start()], False)
                    at = m.end()
        if self.depth > 0:
            self.text.append(value[at:].strip(" \t\r"))
        else:
            self._stray(value[at:])

    def _end(self, rest: str, comma: bool) -> None:
        self.text.append(rest.strip(" \t\r"))
        self.pieces.append((WHOLE if self.begun else LAST, self.comma if self.begun else comma, "".join(self.text)))
        self.begun, self.comma, self.text = True, comma, []

    def _stray(self, rest: str) -> None:
        if rest.strip():
            self.pieces.append((STRAY, False, rest))

    def finish(self) -> list[tuple]:
        if not self.is_array:
            self.pieces.append((OBJECT, False, "".join(self.text)))
        elif self.depth > 0:
            self.pieces.append((FIRST if self.begun else INSIDE, self.comma, "".join(self.text)))
        return self.pieces


def _pieces(lines: DataFrame, depths: dict) -> DataFrame:
    sent = lines.sparkSession.sparkContext.broadcast(depths)
    schema = to_arrow_schema(T._parse_datatype_string(PIECE))

    def run(batches):
        key = cutter = None
        rows: list[tuple] = []

        def finished():
            rows.extend((*key, *p) for p in (cutter.finish() if cutter else ()))

        for batch in batches:
            for value, file, block, opened, closed in zip(*[c.to_pylist() for c in batch.columns]):
                if key != (file, block):           # a split's lines come in order, one split after the other
                    finished()
                    key, cutter = (file, block), Cutter(*sent.value[file, block])
                cutter.line(value, opened, closed)
            rows.extend((*key, *p) for p in cutter.pieces) if cutter else None
            if cutter:
                cutter.pieces = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(map(list, zip(*rows)), schema)], schema=schema)
                rows = []
        finished()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(map(list, zip(*rows)), schema)], schema=schema)

    return lines.select("value", "source_file", "block", "opened", "closed").mapInArrow(run, PIECE)


def _together(pieces: DataFrame) -> DataFrame:
    """Whole items of the ends of splits. An item without its first or its
    last part, of a file that breaks off, has no text."""
    ends = pieces.filter(F.col("kind").isin(LAST, FIRST, INSIDE, OBJECT))
    order = F.when(F.col("kind") == LAST, 0).otherwise(1)
    w = Window.partitionBy("source_file").orderBy("block", "order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = ends.withColumn("order", order).withColumn("item", F.sum(F.when(F.col("kind") == FIRST, 1).otherwise(0)).over(w))
    parts = numbered.groupBy("source_file", "item").agg(
        F.array_sort(F.collect_list(F.struct("block", "order", "text"))).alias("parts"), F.max(F.when(F.col("kind") == FIRST, F.col("comma"))).alias("comma"),
        F.bool_or(F.col("kind") == OBJECT).alias("object"), F.bool_or(F.col("kind") == FIRST).alias("first"), F.bool_or(F.col("kind") == LAST).alias("last"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    return parts.select("source_file", F.coalesce("comma", F.lit(False)).alias("comma"), F.when(F.col("object") | F.col("first") & F.col("last"), text).alias("text"))


def array_items(spark: SparkSession, paths: list[str], ignore_corrupt_files: bool = False) -> DataFrame:
    """``source_file, value``: the items' own texts, each on one line, of
    files that hold a JSON array (one object: one item). A value is null where
    a file has text outside its array, breaks off, or has nothing between two
    commas. Blank files have no row."""
    if not paths:
        return spark.createDataFrame([], "source_file string, value string")
    lines = _lines(spark, paths, ignore_corrupt_files)
    depths = split_depths(lines)
    group = lambda n: F.pmod(F.xxhash64("source_file"), F.lit(n))
    groups, out = max(1, -(-depths.count() // MAX_SPLITS)), None
    for g in range(groups):
        held = {(r["source_file"], r["block"]): (r["depth"], r["is_array"]) for r in depths.filter(group(groups) == g).collect()}
        pieces = _pieces(lines.filter(group(groups) == g), held)
        out = pieces if out is None else out.unionByName(pieces)
    # Written once: whole items and ends are both taken from it.
    from rectext.session import work_dir
    base = work_dir(spark, "array-pieces")
    out.write.parquet(base)
    pieces = spark.read.schema(out.schema).parquet(base)
    items = pieces.filter(F.col("kind") == WHOLE).select("source_file", "comma", "text").unionByName(_together(pieces))
    nothing = ~F.col("text").rlike(r"\S")
    found = items.filter(F.coalesce(~nothing | F.col("comma"), F.lit(True))).select("source_file", F.when(~nothing, F.col("text")).alias("value"))
    return found.unionByName(pieces.filter(F.col("kind") == STRAY).select("source_file", F.lit(None).cast("string").alias("value")))


def is_one_value(text: Column) -> Column:
    """Whether a text is one JSON value and nothing else (a parser of values
    stops after the first)."""
    return F.coalesce(F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")) == 1, F.lit(False))


def scan_json_array_split(spark: SparkSession, paths, keep_raw: bool = False, ignore_corrupt_files: bool = False) -> DataFrame:
    """S6 for files of any size: the records of JSON array files (or of files
    of one object), each file read by as many tasks as it has splits. Items
    that aren't records are corrupt rows, and so is a file's damage (text
    outside the array, a missing end), as an empty ``_corrupt_record``: other
    items of the file stay."""
    from rectext.operators.records import CORRUPT_COL
    items = array_items(spark, [paths] if isinstance(paths, str) else list(paths), ignore_corrupt_files)
    items = items.withColumn("good", is_one_value(F.col("value")))
    records = parse_lines(items.filter("good").drop("good"), keep_raw=keep_raw)
    damage = items.filter("not good").select("source_file", F.coalesce("value", F.lit("")).alias(CORRUPT_COL))
    return records.unionByName(damage, allowMissingColumns=True)
