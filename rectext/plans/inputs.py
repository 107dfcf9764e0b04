"""Inputs derived from the generated tables by Spark (no made-up rows).

The reference consumes JSON security-log records; these builders turn the
``events`` / ``documents`` / ``customer`` tables into such records, so every
query's work grows with the tables. Each builder is lazy except the file
writers, which run one small action.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rectext.session import spread
from rectext.sinks.files import write_named_lines

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def json_scalar(c: Column) -> Column:
    """JSON text of one value (string quoted and escaped, number as is)."""
    j = F.to_json(F.array(c))
    return j.substr(F.lit(2), F.length(j) - 2)


# Every generated input file is bounded: keys are cut into spans, and a
# source with keys beyond the first span gets numbered files
# (``<stem>-<n>.<ext>``), so no file -- one writer task by nature -- grows
# with the table.
EVENT_FILES = 4
EVENT_SPAN = 4_000_000      # 4 event files per span: at most 1,000,000 lines a file
CUSTOMER_SPAN = 1_000_000   # 25 nations: about 40,000 records per array file
DOCUMENT_SPAN = 5_000       # documents per file of one source


def chunked(stem: Column, ext: str, key: Column, span: int) -> Column:
    """``stem + ext`` for keys in the first span, ``stem-<n> + ext`` after."""
    n = F.floor(key / F.lit(span)).cast("bigint")
    return F.concat(stem, F.when(n == 0, F.lit("")).otherwise(F.concat(F.lit("-"), n.cast("string"))),
                    F.lit(ext))


def chunked_sql(stem: str, ext: str, key: str, span: int) -> str:
    """The same file name in SQL."""
    return (f"{stem} || CASE WHEN {key} // {span} = 0 THEN '' "
            f"ELSE '-' || CAST({key} // {span} AS VARCHAR) END || '{ext}'")


def event_source(event_id: Column) -> Column:
    """``events_<id % 4>.json`` (numbered past the first span): the input
    file an event line belongs to."""
    stem = F.concat(F.lit("events_"), (event_id % EVENT_FILES).cast("string"))
    return chunked(stem, ".json", event_id, EVENT_SPAN)


EVENT_SOURCE_SQL = chunked_sql(f"'events_' || CAST(event_id % {EVENT_FILES} AS VARCHAR)", ".json",
                               "event_id", EVENT_SPAN)


def event_lines(spark: SparkSession, sf_dir: str, kind: str | tuple = "plain") -> DataFrame:
    """Each event as one JSON line: ``event_id, value, source_file``.

    Keys are written in a non-sorted order on purpose (user_id, event_id,
    value, props, @timestamp, label): the renderer sorts them. The line is
    assembled from JSON pieces (``props`` already is JSON text).

    kinds (one or several):
      * ``plain``: as above;
      * ``nested_ts``: even ids carry ``props.timestamps = [id * 10]``; ids
        divisible by 5 carry ``props.@timestamp = "x<id>"`` (plain text);
        ids divisible by 3 carry a top-level ``"timestamps": null``;
      * ``bad_iso``: ids divisible by 9 have ``@timestamp`` without fraction;
      * ``damaged``: lines of ids ending in 7 are cut by 5 characters.
    """
    kinds = {kind} if isinstance(kind, str) else set(kind)
    ev = spread(table(spark, sf_dir, "events"))
    eid = F.col("event_id")
    iso = F.date_format("ts", ISO_FORMAT)
    if "bad_iso" in kinds:
        iso = F.when(eid % 9 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(iso)
    props = F.col("props")
    head = F.lit("{")
    if "nested_ts" in kinds:
        ts_member = F.when(eid % 2 == 0, F.concat(F.lit('"timestamps":['), (eid * 10).cast("string"), F.lit("]")))
        at_member = F.when(eid % 5 == 0, F.concat(F.lit('"@timestamp":"x'), eid.cast("string"), F.lit('"')))
        extra = F.concat_ws(",", ts_member, at_member)
        props = F.when(extra == "", props).otherwise(
            F.concat(F.lit("{"), extra, F.lit(","), F.substring(props, 2, 1 << 30)))
        head = F.when(eid % 3 == 0, F.lit('{"timestamps":null,')).otherwise(head)
    line = F.concat(head, F.lit('"user_id":'), F.col("user_id").cast("string"),
                    F.lit(',"event_id":'), eid.cast("string"),
                    F.lit(',"value":'), F.col("value").cast("string"),
                    F.lit(',"props":'), props,
                    F.lit(',"@timestamp":"'), iso,
                    F.lit('","label":'), json_scalar(F.col("event_type")), F.lit("}"))
    if "damaged" in kinds:
        cut = F.expr("substring(_line, 1, length(_line) - 5)")
        staged = ev.select(eid, line.alias("_line"), event_source(eid).alias("source_file"))
        return staged.select(eid, F.when(eid % 10 == 7, cut).otherwise(F.col("_line")).alias("value"),
                             "source_file")
    return ev.select(eid, line.alias("value"), event_source(eid).alias("source_file"))


def timestamp_form_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 / R11 input: ``timestamps`` in six forms by ``event_id % 6``:
    0 ``[value, user_id]``, 1 ``user_id``, 2 ``"<value>"`` (a string),
    3 ``[]``, 4 ``["<value>"]``, 5 ``["x<id>"]`` (not a number: error row)."""
    ev = spread(table(spark, sf_dir, "events"))
    eid, val, uid = F.col("event_id"), F.col("value"), F.col("user_id")
    k = eid % 6
    ts = (F.when(k == 0, F.to_json(F.array(val, uid.cast("double"))))
          .when(k == 1, uid.cast("string"))
          .when(k == 2, json_scalar(val.cast("string")))
          .when(k == 3, F.lit("[]"))
          .when(k == 4, F.to_json(F.array(val.cast("string"))))
          .otherwise(F.to_json(F.array(F.concat(F.lit("x"), eid.cast("string"))))))
    line = F.concat(F.lit('{"timestamps":'), ts, F.lit(',"event_id":'), eid.cast("string"),
                    F.lit(',"label":'), json_scalar(F.col("event_type")),
                    F.lit("}"))
    return ev.select(eid, line.alias("value"), event_source(eid).alias("source_file"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a JSON record ``{doc_id, text, lang, n_chars}`` with
    its ``source`` as collection: ``doc_id, value, collection``."""
    docs = spread(table(spark, sf_dir, "documents"))
    rec = F.struct("doc_id", "text", "lang", "n_chars")
    return docs.select("doc_id", F.to_json(rec).alias("value"), F.col("source").alias("collection"))


def pretty_record(df: DataFrame, indent: int = 4) -> Column:
    """A flat record as pretty-printed JSON text (one member per line, as an
    indented JSON dump writes it), built column by column."""
    pad = " " * indent
    members = []
    for f in df.schema.fields:
        members.append(F.concat(F.lit(f'{pad}{pad}"{f.name}": '), json_scalar(F.col(f.name))))
    return F.concat(F.lit(pad + "{\n"), F.concat_ws(",\n", *members), F.lit("\n" + pad + "}"))


def write_array_files(df: DataFrame, root: str, name: Column, order: str) -> DataFrame:
    """Write rows as pretty-printed JSON array files, one per ``name``:
    ``[`` line, records separated by ``,``, ``]`` line. Returns the small
    per-file summary (lazy: run an action to write)."""
    recs = df.select(name.alias("name"), F.col(order).alias("_o"), pretty_record(df).alias("value"))
    return write_named_lines(recs, root, "name", "value", ["_o"],
                             header="[\n", separator=",\n", footer="\n]\n")


# Inputs whose file names aren't what a query is about: Spark's own text writer, one folder a name.
LINES_GLOB = "*.txt"


def write_lines(named: DataFrame, root: str, order: str) -> None:
    """``name, value`` as text files below ``root/name=<name>/``, the lines of
    a name in one file, in ``order``; written and committed by Spark."""
    (named.repartition("name").sortWithinPartitions("name", order).select("value", "name")
     .write.mode("append").partitionBy("name").text(root))


def write_arrays(df: DataFrame, root: str, name: Column, order: str) -> None:
    """Rows as indented JSON arrays, one below each ``root/name=<name>/``."""
    w = Window.partitionBy("name").orderBy("_o")
    recs = df.select(name.alias("name"), F.col(order).alias("_o"), pretty_record(df).alias("value"))
    first, last = F.lag("_o").over(w).isNull(), F.lead("_o").over(w).isNull()
    write_lines(recs.withColumn("value", F.concat(F.when(first, F.lit("[\n")).otherwise(""), F.col("value"), F.when(last, F.lit("\n]")).otherwise(","))), root, "_o")


def name_of(source_file: str = "source_file") -> Column:
    """The name under which ``write_lines`` wrote a file."""
    return F.regexp_extract(F.col(source_file), r"/name=([^/]+)/", 1)
