"""The query set: one entry per operator of the inventory, each reading the
generated tables (or files Spark writes from them), and the DuckDB SQL that
states the expected result over the same tables.

Queries that write files use a fresh folder below the session's shared
checkpoint folder (``work_dir``), so runs never collide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rectext.functions.names import base_name, safe_name
from rectext.functions.pytext import py_text_of_json
from rectext.functions.render import format_list, iso_epoch, typed_text
from rectext.functions.shapes import common_shapes
from rectext.operators.audit import collection_count, corrupt_count
from rectext.operators.embed import embed_inputs, embed_text, map_batches, map_batches_isolated
from rectext.operators.features import (FEATURE_COLUMNS, encode_label, featurize, featurize_records,
                                        featurize_typed, tokens, truncate_tokens)
from rectext.operators.ids import stringify_typed_ids
from rectext.operators.subwords import SPECIAL, subword_inputs
from rectext.operators.records import (CORRUPT_COL, drop_all_null, drop_corrupt, parse_lines, prune_nulls_json,
                                       stringify_ids)
from rectext.plans import jobs
from rectext.plans.inputs import (CUSTOMER_SPAN, DOCUMENT_SPAN, EVENT_SOURCE_SQL, EVENT_SPAN, ISO_FORMAT, LINES_GLOB, chunked,
                                  chunked_sql, document_lines, event_lines, event_source, json_scalar, name_of, table,
                                  timestamp_form_lines,
                                  write_array_files, write_arrays, write_lines)
from rectext.session import spread, work_dir
from rectext.sinks.buckets import load_buckets, read_buckets
from rectext.sinks.files import write_named_lines
from rectext.sinks.writers import (append_ignore, drop_reload, load_by_source, read_collections,
                                   read_csv_by_key, read_table, write_collections, write_csv_by_key)
from rectext.sources.json_files import (discover_files, read_lines, scan_json_array, scan_json_auto,
                                        scan_ndjson)
from rectext.sources.json_arrays import scan_json_array_split
from rectext.sources.text import sample_lines
from rectext.streaming.incremental import featurize_stream

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ------------------------------------------------------------------ shared SQL pieces

EVENT_TEXT_SQL = ("'[event_id] ' || CAST(event_id AS VARCHAR) || ' [props] {[k] ' || (props::JSON ->> 'k')"
                  " || '} [user_id] ' || CAST(user_id AS VARCHAR) || ' [value] ' || CAST(value AS VARCHAR)")
EVENT_TS_SQL = "epoch_us(ts) / 1e6"

FEATURIZE_SQL = f"""
SELECT {EVENT_TEXT_SQL} AS text_representation, {EVENT_TS_SQL} AS "timestamp",
       event_type AS label, {EVENT_SOURCE_SQL} AS source_file
FROM events"""


def _basename(col: str) -> F.Column:
    return base_name(F.col(col))


# ------------------------------------------------------------------ J1 / T2-T7

@query("featurize", FEATURIZE_SQL)
def q_featurize(spark: SparkSession, sf: str) -> DataFrame:
    """J1 core: event records (JSON lines) -> feature rows."""
    return featurize(event_lines(spark, sf)).select(*FEATURE_COLUMNS)


@query("featurize_typed", FEATURIZE_SQL)
def q_featurize_typed(spark, sf):
    """J1 fast path on typed records: the events table as typed columns
    (``props`` parsed with its declared schema), same output as ``featurize``."""
    ev = table(spark, sf, "events")
    typed = ev.select(
        F.date_format("ts", ISO_FORMAT).alias("@timestamp"), "event_id",
        F.col("event_type").alias("label"),
        F.from_json("props", "k bigint").alias("props"), "user_id", "value",
        event_source(F.col("event_id")).alias("source_file"))
    return featurize_typed(typed).select(*FEATURE_COLUMNS)


@query("record_text", f"SELECT {EVENT_TEXT_SQL} AS text_representation FROM events")
def q_record_text(spark, sf):
    """Text only."""
    return featurize(event_lines(spark, sf)).select("text_representation")


def _typed_sql(cols: list[tuple[str, str]], tbl: str) -> str:
    parts = []
    for name, kind in cols:
        parts.append(f"'[{name}] ' || CAST({name} AS VARCHAR)")
    return f"SELECT {' || \' \' || '.join(parts)} AS text_representation FROM {tbl}"


LINEITEM_COLS = [("l_orderkey", "i"), ("l_partkey", "i"), ("l_suppkey", "i"), ("l_linenumber", "i"),
                 ("l_quantity", "d"), ("l_extendedprice", "d"), ("l_discount", "d"), ("l_tax", "d"),
                 ("l_returnflag", "s"), ("l_linestatus", "s"), ("l_shipdate", "t")]
ORDERS_COLS = [("o_orderkey", "i"), ("o_custkey", "i"), ("o_orderstatus", "s"), ("o_totalprice", "d"),
               ("o_orderdate", "t"), ("o_orderpriority", "s")]


@query("record_text_wide", _typed_sql(LINEITEM_COLS, "lineitem"))
def q_record_text_wide(spark, sf):
    """T2 on a typed table: lineitem, 11 columns in declared order."""
    li = spread(table(spark, sf, "lineitem"))
    return li.select(typed_text(li).alias("text_representation"))


@query("record_text_orders", _typed_sql(ORDERS_COLS, "orders"))
def q_record_text_orders(spark, sf):
    """T2 on a typed table: orders."""
    o = spread(table(spark, sf, "orders"))
    return o.select(typed_text(o).alias("text_representation"))


WORDS_SQL = r"string_split_regex(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+')"


@query("format_list", f"SELECT doc_id, array_to_string({WORDS_SQL}, ', ') AS words FROM documents")
def q_format_list(spark, sf):
    """A list of items (all words of a document) joined by ', '."""
    d = spread(table(spark, sf, "documents"))
    return d.select("doc_id", format_list(tokens(F.col("text"))).alias("words"))


@query("timestamp_precedence", f"""
SELECT '[event_id] ' || CAST(event_id AS VARCHAR) || ' [props] {{'
       || CASE WHEN event_id % 5 = 0 THEN '[@timestamp] x' || CAST(event_id AS VARCHAR) || ' ' ELSE '' END
       || '[k] ' || (props::JSON ->> 'k') || '}} [user_id] ' || CAST(user_id AS VARCHAR)
       || ' [value] ' || CAST(value AS VARCHAR) AS text_representation,
       CASE WHEN event_id % 3 = 0 THEN NULL
            WHEN event_id % 2 = 0 THEN CAST(event_id * 10 AS DOUBLE)
            ELSE {EVENT_TS_SQL} END AS "timestamp",
       event_type AS label
FROM events""")
def q_timestamp_precedence(spark, sf):
    """Nested ``timestamps`` wins over an earlier ``@timestamp``;
    a later top-level ``timestamps: null`` resets; nested ``@timestamp`` is text."""
    return featurize(event_lines(spark, sf, "nested_ts")).select("text_representation", "timestamp", "label")


@query("iso_epoch", """
SELECT event_id,
       CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) / 1e6 ELSE ((epoch_us(ts) // 1000) * 1000) / 1e6 END AS epoch
FROM events""")
def q_iso_epoch(spark, sf):
    """ISO text with 6 (even ids) or 3 (odd ids) fraction digits -> epoch seconds."""
    ev = table(spark, sf, "events")
    iso = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", ISO_FORMAT)) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    return ev.select("event_id", iso_epoch(iso).alias("epoch"))


@query("first_timestamp", """
SELECT CASE WHEN event_id % 6 = 5 THEN '' ELSE '[event_id] ' || CAST(event_id AS VARCHAR) END AS text_representation,
       CASE event_id % 6 WHEN 0 THEN value WHEN 1 THEN CAST(user_id AS DOUBLE) WHEN 4 THEN value END AS "timestamp",
       CASE WHEN event_id % 6 = 5 THEN NULL ELSE event_type END AS label
FROM events""")
def q_first_timestamp(spark, sf):
    """List, number, string, empty list, numeric string, bad string."""
    return featurize(timestamp_form_lines(spark, sf)).select("text_representation", "timestamp", "label")


@query("row_errors", f"""
SELECT CASE WHEN event_id % 9 = 0 THEN '' ELSE {EVENT_TEXT_SQL} END AS text_representation,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE {EVENT_TS_SQL} END AS "timestamp",
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_type END AS label,
       {EVENT_SOURCE_SQL} AS source_file
FROM events""")
def q_row_errors(spark, sf):
    """A bad ``@timestamp`` gives the row ``('', null, null)``; the job goes on."""
    return featurize(event_lines(spark, sf, "bad_iso")).select(*FEATURE_COLUMNS)


@query("custom_map", f"""
SELECT text_representation, CAST(length(text_representation) AS BIGINT) AS n_chars,
       CAST(len(string_split(text_representation, ' ')) AS BIGINT) AS n_words
FROM ({FEATURIZE_SQL}) f""")
def q_custom_map(spark, sf):
    """A user function over Arrow batches of the feature rows."""
    feats = featurize(event_lines(spark, sf)).select("text_representation")

    def count_text(pdf):
        t = pdf["text_representation"].fillna("")
        return pdf.assign(n_chars=t.str.len().astype("int64"),
                          n_words=t.str.split(" ").str.len().astype("int64"))
    return map_batches(feats, count_text, "text_representation string, n_chars long, n_words long")


# ------------------------------------------------------------------ files: S1-S6, P1, A2, A5

def _write_event_files(spark, sf, root, kinds=("damaged",), extra_bad_file=False):
    lines = event_lines(spark, sf, kinds)
    named = lines.select(F.col("source_file").alias("name"), "value", "event_id")
    if extra_bad_file:
        bad = lines.filter(F.col("event_id") % 10 == 7).select(
            chunked(F.lit("events_bad"), ".ndjson", F.col("event_id"), EVENT_SPAN).alias("name"),
            "value", "event_id")
        named = named.unionByName(bad)
    write_lines(named, root, "event_id")


@query("custom_map_isolated", """
SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '' ELSE '[user_id] ' || CAST(user_id AS VARCHAR) || ' [type] ' || event_type END AS text_representation,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE epoch_us(ts) / 1e6 END AS "timestamp",
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_type END AS label, event_id % 9 = 0 AS is_error,
       CASE WHEN event_id % 9 = 0 THEN 'ValueError: no text for event ' || CAST(event_id AS VARCHAR) END AS reason
FROM events""")
def q_custom_map_isolated(spark, sf):
    """U1 + P12: a user's renderer that raises on every ninth event; those
    rows become error rows with the reason, all others their text."""
    def render(pdf):
        import pandas as pd

        ids = pdf["event_id"].to_numpy()
        bad = ids[ids % 9 == 0]
        if len(bad):
            raise ValueError(f"no text for event {bad[0]}")
        text = [None if pd.isna(t) else f"[user_id] {u} [type] {t}" for u, t in zip(pdf["user_id"].astype(str).tolist(), pdf["event_type"].tolist())]
        return pd.DataFrame({"event_id": pdf["event_id"], "text_representation": text, "timestamp": pdf["seconds"], "label": pdf["event_type"]})

    ev = spread(table(spark, sf, "events")).select("event_id", "user_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("seconds"))
    return map_batches_isolated(ev, render, "event_id long, text_representation string, timestamp double, label string",
                                {"text_representation": ""}, keep=["event_id"])


@query("featurize_stream", FEATURIZE_SQL)
def q_featurize_stream(spark, sf):
    """J1 as Structured Streaming: event records written as NDJSON files, one
    ``availableNow`` run of the file stream into the feature table
    (checkpointed), the table read back."""
    base = work_dir(spark, "stream")
    _write_event_files(spark, sf, base + "/in", kinds=("plain",))
    featurize_stream(spark, base + "/in", base + "/table", base + "/checkpoint", glob=LINES_GLOB).awaitTermination()
    t = read_table(spark, base + "/table")
    return t.select("text_representation", "timestamp", "label", name_of().alias("source_file"))


@query("scan_ndjson", f"""
SELECT {EVENT_SOURCE_SQL} AS source,
       CASE WHEN event_id % 10 = 7 THEN NULL ELSE event_id END AS event_id,
       event_id % 10 = 7 AS is_corrupt
FROM events""")
def q_scan_ndjson(spark, sf):
    """Permissive NDJSON scan of files with cut lines."""
    root = work_dir(spark, "scan_ndjson")
    _write_event_files(spark, sf, root)
    recs = scan_ndjson(spark, root, glob=LINES_GLOB)
    return recs.select(name_of().alias("source"),
                       F.try_variant_get("v", "$.event_id", "bigint").alias("event_id"),
                       F.col(CORRUPT_COL).isNotNull().alias("is_corrupt"))


@query("drop_corrupt", f"""
SELECT {EVENT_TEXT_SQL} AS text_representation, {EVENT_TS_SQL} AS "timestamp",
       event_type AS label, {EVENT_SOURCE_SQL} AS source_file
FROM events WHERE event_id % 10 <> 7""")
def q_drop_corrupt(spark, sf):
    """P1 / P2 + J1: corrupt lines dropped, the rest featurized."""
    root = work_dir(spark, "drop_corrupt")
    _write_event_files(spark, sf, root)
    recs = drop_corrupt(scan_ndjson(spark, root, glob=LINES_GLOB))
    feats = featurize_records(recs, keep=["source_file"])
    return feats.select("text_representation", "timestamp", "label",
                        name_of().alias("source_file"))


@query("corrupt_count", f"""
SELECT {EVENT_SOURCE_SQL} AS source, CAST(count(*) FILTER (WHERE event_id % 10 = 7) AS BIGINT) AS n_corrupt
FROM events GROUP BY 1""")
def q_corrupt_count(spark, sf):
    """A2: corrupt lines per file."""
    root = work_dir(spark, "corrupt_count")
    _write_event_files(spark, sf, root)
    cc = corrupt_count(scan_ndjson(spark, root, glob=LINES_GLOB))
    return cc.select(name_of().alias("source"), "n_corrupt")


@query("batch_audit", f"""
SELECT {EVENT_SOURCE_SQL} AS source,
       CAST(count(*) FILTER (WHERE event_id % 10 <> 7) AS BIGINT) AS n_records,
       CAST(count(*) FILTER (WHERE event_id % 10 = 7) AS BIGINT) AS n_corrupt,
       CAST(count(*) FILTER (WHERE event_id % 10 <> 7 AND event_id % 9 = 0) AS BIGINT) AS n_errors,
       CAST(count(*) FILTER (WHERE event_id % 10 <> 7 AND event_id % 9 <> 0 AND event_id % 3 = 0) AS BIGINT)
         AS n_without_timestamp,
       false AS is_empty
FROM events GROUP BY 1
UNION ALL
SELECT {chunked_sql("'events_bad'", ".ndjson", "event_id", EVENT_SPAN)}, 0, CAST(count(*) AS BIGINT), 0, 0, true
FROM events WHERE event_id % 10 = 7 GROUP BY 1""")
def q_batch_audit(spark, sf):
    """Per-file audit, including a file with no valid line."""
    root = work_dir(spark, "batch_audit")
    _write_event_files(spark, sf, root, kinds=("bad_iso", "nested_ts", "damaged"), extra_bad_file=True)
    _, audit, _ = jobs.featurize_files(spark, root, glob=LINES_GLOB)
    return audit.select(name_of().alias("source"), "n_records", "n_corrupt", "n_errors",
                        "n_without_timestamp", "is_empty")


CUSTOMER_ARRAY_SQL = chunked_sql("'customers_' || CAST(c_nationkey AS VARCHAR)", ".json", "c_custkey",
                                 CUSTOMER_SPAN)


def _write_customer_arrays(spark, sf, root):
    cust = table(spark, sf, "customer")
    name = chunked(F.concat(F.lit("customers_"), F.col("c_nationkey").cast("string")), ".json",
                   F.col("c_custkey"), CUSTOMER_SPAN)
    write_arrays(cust, root, name, "c_custkey")


@query("scan_json_array", f"""
SELECT {CUSTOMER_ARRAY_SQL} AS source, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def q_scan_json_array(spark, sf):
    """Pretty-printed JSON array files (one per nation)."""
    root = work_dir(spark, "scan_json_array")
    _write_customer_arrays(spark, sf, root)
    files = [r["path"] for r in discover_files(spark, root, glob=LINES_GLOB).select("path").collect()]
    recs = scan_json_array(spark, files).filter(F.col("v").isNotNull())
    v = F.col("v")
    return recs.select(name_of().alias("source"),
                       F.try_variant_get(v, "$.c_custkey", "bigint").alias("c_custkey"),
                       F.try_variant_get(v, "$.c_name", "string").alias("c_name"),
                       F.try_variant_get(v, "$.c_nationkey", "int").alias("c_nationkey"),
                       F.try_variant_get(v, "$.c_acctbal", "double").alias("c_acctbal"),
                       F.try_variant_get(v, "$.c_mktsegment", "string").alias("c_mktsegment"))


@query("scan_json_array_split", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_scan_json_array_split(spark, sf):
    """S6 by splits: all customers as one indented array a million of them,
    each file read by as many tasks as it has splits."""
    root = work_dir(spark, "scan_json_array_split")
    cust = table(spark, sf, "customer")
    write_arrays(cust, root, chunked(F.lit("customers"), ".json", F.col("c_custkey"), CUSTOMER_SPAN), "c_custkey")
    recs = scan_json_array_split(spark, [r["path"] for r in discover_files(spark, root, glob=LINES_GLOB).select("path").collect()])
    v = F.col("v")
    return recs.filter(v.isNotNull()).select(*[F.try_variant_get(v, f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
                                               for f in cust.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment").schema])


@query("scan_json_auto", f"""
SELECT {CUSTOMER_ARRAY_SQL} AS source, 'array' AS format, 'c' || CAST(c_custkey AS VARCHAR) AS record_key
FROM customer
UNION ALL
SELECT {EVENT_SOURCE_SQL}, 'ndjson', 'e' || CAST(event_id AS VARCHAR) FROM events""")
def q_scan_json_auto(spark, sf):
    """NDJSON files and array files in one folder, format per file."""
    root = work_dir(spark, "scan_json_auto")
    _write_customer_arrays(spark, sf, root)
    _write_event_files(spark, sf, root, kinds=("plain",))
    recs = scan_json_auto(spark, root, glob=LINES_GLOB)
    v = F.col("v")
    key = F.coalesce(F.concat(F.lit("c"), F.try_variant_get(v, "$.c_custkey", "string")),
                     F.concat(F.lit("e"), F.try_variant_get(v, "$.event_id", "string")))
    return recs.select(name_of().alias("source"), "format", key.alias("record_key"))


# file layout for discovery, by source number n: n % 5 ->
#   0 "srcN.json" (plus a copy under .ipynb_checkpoints/), 1 "srcN.JSON",
#   2 "sub/srcN.ndjson", 3 "sub/deep/srcN.Json", 4 "srcN.txt" (not JSON);
# a source past DOCUMENT_SPAN documents continues in "srcN-1.json", ...
_DISCOVER_SQL_NAME = f"""CASE CAST(substr(source, 4) AS INTEGER) % 5
    WHEN 0 THEN {chunked_sql("source", ".json", "doc_id", DOCUMENT_SPAN)}
    WHEN 1 THEN {chunked_sql("source", ".JSON", "doc_id", DOCUMENT_SPAN)}
    WHEN 2 THEN {chunked_sql("'sub/' || source", ".ndjson", "doc_id", DOCUMENT_SPAN)}
    WHEN 3 THEN {chunked_sql("'sub/deep/' || source", ".Json", "doc_id", DOCUMENT_SPAN)} END"""


def _discover_name(source: F.Column) -> F.Column:
    n = F.substring(source, 4, 1 << 20).cast("int") % 5
    doc = F.col("doc_id")
    return (F.when(n == 0, chunked(source, ".json", doc, DOCUMENT_SPAN))
            .when(n == 1, chunked(source, ".JSON", doc, DOCUMENT_SPAN))
            .when(n == 2, chunked(F.concat(F.lit("sub/"), source), ".ndjson", doc, DOCUMENT_SPAN))
            .when(n == 3, chunked(F.concat(F.lit("sub/deep/"), source), ".Json", doc, DOCUMENT_SPAN))
            .otherwise(chunked(source, ".txt", doc, DOCUMENT_SPAN)))


@query("discover_files", f"""
SELECT {_DISCOVER_SQL_NAME} AS rel_path, CAST(count(*) AS BIGINT) AS n_lines
FROM documents WHERE CAST(substr(source, 4) AS INTEGER) % 5 <> 4 GROUP BY 1""")
def q_discover_files(spark, sf):
    """Recursive, case-insensitive discovery of .json / .ndjson
    files (checkpoint folders skipped), with the lines each holds."""
    root = work_dir(spark, "discover") + "/in"
    docs = document_lines(spark, sf)
    name = _discover_name(F.col("collection"))
    n = F.substring(F.col("collection"), 4, 1 << 20).cast("int") % 5
    ckpt = docs.filter(n == 0).select(F.concat(F.lit(".ipynb_checkpoints/"), name).alias("name"), "value", "doc_id")
    write_named_lines(docs.select(name.alias("name"), "value", "doc_id").unionByName(ckpt),
                      root, "name", "value", ["doc_id"]).collect()
    found = discover_files(spark, root).select(F.col("path").alias("source_file"))
    counts = read_lines(spark, root).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_lines"))
    rel = F.regexp_extract(F.col("source_file"), r"/in/(.*)$", 1)
    return found.join(counts, "source_file", "left").select(
        rel.alias("rel_path"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


# ------------------------------------------------------------------ collections: S7, K2, A4, A3

def _write_document_collections(spark, sf, root):
    write_collections(document_lines(spark, sf), root)


@query("collection_scan", "SELECT source AS collection, doc_id FROM documents")
def q_collection_scan(spark, sf):
    """Every document of every collection, with its collection name."""
    root = work_dir(spark, "collections")
    _write_document_collections(spark, sf, root)
    docs = read_collections(spark, root)
    return docs.select("collection",
                       F.try_variant_get(F.try_parse_json("value"), "$.doc_id", "bigint").alias("doc_id"))


@query("collection_count",
       "SELECT source AS collection, CAST(count(*) AS BIGINT) AS n_documents FROM documents GROUP BY 1")
def q_collection_count(spark, sf):
    """A4: documents per collection."""
    root = work_dir(spark, "collections")
    _write_document_collections(spark, sf, root)
    return collection_count(read_collections(spark, root))


@query("json_roundtrip",
       "SELECT doc_id, text, lang, n_chars, source AS collection FROM documents")
def q_json_roundtrip(spark, sf):
    """K2 then S7: documents (quotes, newlines, any script) survive JSON lines."""
    root = work_dir(spark, "json_roundtrip")
    _write_document_collections(spark, sf, root)
    v = F.try_parse_json("value")
    return read_collections(spark, root).select(
        F.try_variant_get(v, "$.doc_id", "bigint").alias("doc_id"),
        F.try_variant_get(v, "$.text", "string").alias("text"),
        F.try_variant_get(v, "$.lang", "string").alias("lang"),
        F.try_variant_get(v, "$.n_chars", "bigint").alias("n_chars"),
        "collection")


@query("import_summary", f"""
SELECT {chunked_sql("source", ".json", "doc_id", DOCUMENT_SPAN)} AS file,
       {chunked_sql("source", "", "doc_id", DOCUMENT_SPAN)} AS collection,
       CAST(count(*) AS BIGINT) AS attempted, CAST(count(*) AS BIGINT) AS inserted,
       CAST(count(*) AS BIGINT) AS total_in_collection
FROM documents GROUP BY 1, 2""")
def q_import_summary(spark, sf):
    """One file per source (every fifth source a pretty JSON array,
    the rest NDJSON) imported into collections, then summarised."""
    base = work_dir(spark, "import")
    src, target = base + "/in", base + "/collections"
    d = table(spark, sf, "documents")
    n = F.substring(F.col("source"), 4, 1 << 20).cast("int")
    as_array = d.filter(n % 5 == 1).select("doc_id", "text", "lang", "source", "n_chars")
    file_name = chunked(F.col("source"), ".json", F.col("doc_id"), DOCUMENT_SPAN)
    write_array_files(as_array, src, file_name, "doc_id").collect()
    lines = d.filter(n % 5 != 1).select(
        file_name.alias("name"),
        F.to_json(F.struct("doc_id", "text", "lang", "source", "n_chars")).alias("value"), "doc_id")
    write_named_lines(lines, src, "name", "value", ["doc_id"]).collect()
    summary = jobs.import_documents(spark, src, target)
    return summary.select("file", "collection", "attempted", "inserted", "total_in_collection")


@query("import_insert_ignore", f"""
SELECT {EVENT_SOURCE_SQL} AS file, regexp_replace({EVENT_SOURCE_SQL}, '\\.json$', '') AS collection,
       CAST(2 * count(*) AS BIGINT) AS attempted, CAST(count(DISTINCT event_id // 8) AS BIGINT) AS inserted,
       CAST(count(DISTINCT event_id // 8) AS BIGINT) AS total_in_collection
FROM events GROUP BY 1, 2""")
def q_import_insert_ignore(spark, sf):
    """Files that hold every ``_id`` several times, the same ids in
    each file: unique per collection, not over all collections."""
    base = work_dir(spark, "import_ids")
    ev = event_lines(spark, sf)
    rec = ev.select(F.col("source_file").alias("name"), F.concat(F.lit('{"_id":"'), F.floor(F.col("event_id") / 8).cast("string"), F.lit('",'),
                    F.expr("substring(value, 2)")).alias("value"), "event_id")
    write_named_lines(rec.unionByName(rec), base + "/in", "name", "value", ["event_id"]).collect()
    summary = jobs.import_documents(spark, base + "/in", base + "/collections", drop_existing=False)
    return summary.select("file", "collection", "attempted", "inserted", "total_in_collection")


FEATURIZE_FILES_SQL = f"""
SELECT '[c_acctbal] ' || CAST(c_acctbal AS VARCHAR) || ' [c_custkey] ' || CAST(c_custkey AS VARCHAR) || ' [c_mktsegment] ' || c_mktsegment
       || ' [c_name] ' || c_name || ' [c_nationkey] ' || CAST(c_nationkey AS VARCHAR) AS text_representation,
       CAST(NULL AS DOUBLE) AS "timestamp", CAST(NULL AS VARCHAR) AS label, {CUSTOMER_ARRAY_SQL} AS source_file
FROM customer
UNION ALL
SELECT {EVENT_TEXT_SQL}, {EVENT_TS_SQL}, event_type, {EVENT_SOURCE_SQL} FROM events WHERE event_id % 10 <> 7"""


@query("featurize_files", FEATURIZE_FILES_SQL)
def q_featurize_files(spark, sf):
    """J1 over a folder of indented array files and NDJSON files with cut lines."""
    root = work_dir(spark, "featurize_files")
    _write_customer_arrays(spark, sf, root)
    _write_event_files(spark, sf, root)
    features, _, _ = jobs.featurize_files(spark, root, glob=LINES_GLOB)
    return features.select("text_representation", "timestamp", "label", name_of().alias("source_file"))


@query("featurize_files_typed", FEATURIZE_FILES_SQL)
def q_featurize_files_typed(spark, sf):
    """S4 + J1: the same folder, its common record shapes inferred from a
    sample and rendered by compiled expressions."""
    root = work_dir(spark, "featurize_files_typed")
    _write_customer_arrays(spark, sf, root)
    _write_event_files(spark, sf, root)
    features, _, _ = jobs.featurize_files(spark, root, glob=LINES_GLOB, by_shape=True)
    return features.select("text_representation", "timestamp", "label", name_of().alias("source_file"))


@query("featurize_shaped", FEATURIZE_SQL)
def q_featurize_shaped(spark, sf):
    """S4 + J1 core: event lines without a declared schema, rendered by the shapes of a sample."""
    records = drop_corrupt(parse_lines(event_lines(spark, sf).select("value", "source_file")))
    return featurize_records(records, keep=["source_file"], shapes=common_shapes(records)).select(*FEATURE_COLUMNS)


# ------------------------------------------------------------------ cleaning: P4-P8

NULLED_SQL = """
SELECT event_id,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE user_id END AS a,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_type END AS b,
       CASE WHEN event_id % 12 = 0 THEN NULL ELSE value END AS c
FROM events"""


def _nulled_events(spark, sf):
    ev = table(spark, sf, "events")
    eid = F.col("event_id")
    return ev.select(
        eid,
        F.when(eid % 4 == 0, None).otherwise(F.col("user_id")).alias("a"),
        F.when(eid % 6 == 0, None).otherwise(F.col("event_type")).alias("b"),
        F.when(eid % 12 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("c"))


@query("drop_all_null", f"SELECT * FROM ({NULLED_SQL}) t WHERE coalesce(CAST(a AS VARCHAR), b, CAST(c AS VARCHAR)) IS NOT NULL")
def q_drop_all_null(spark, sf):
    """Rows whose fields are all null (NaN counts as null) are dropped."""
    df = drop_all_null(_nulled_events(spark, sf), ["a", "b", "c"])
    return df.select("event_id", "a", "b", F.nanvl("c", F.lit(None).cast("double")).alias("c"))


@query("prune_nulls", f"""
SELECT event_id, '{{' || concat_ws(',',
         CASE WHEN a IS NOT NULL THEN '"a":' || CAST(a AS VARCHAR) END,
         CASE WHEN b IS NOT NULL THEN '"b":"' || b || '"' END,
         CASE WHEN c IS NOT NULL THEN '"c":' || CAST(c AS VARCHAR) END) || '}}' AS record
FROM ({NULLED_SQL}) t""")
def q_prune_nulls(spark, sf):
    """P5: null and NaN fields are left out of each record."""
    df = _nulled_events(spark, sf)
    return df.select("event_id", prune_nulls_json(df, ["a", "b", "c"]).alias("record"))


@query("stringify_ids", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 24, '0') AS _id, c_name,
       lpad(CAST(c_nationkey AS VARCHAR), 24, '0') AS owner,
       lpad(CAST(c_custkey AS VARCHAR), 24, '0') || ',' || lpad(CAST(c_nationkey AS VARCHAR), 24, '0') AS refs
FROM customer""")
def q_stringify_ids(spark, sf):
    """Object ids ``{"$oid": ...}`` at the top, nested and inside lists become strings."""
    c = table(spark, sf, "customer")
    oid = lambda col: F.struct(F.lpad(F.col(col).cast("string"), 24, "0").alias("$oid"))
    rec = F.to_json(F.struct(oid("c_custkey").alias("_id"), F.col("c_name"),
                             F.struct(oid("c_nationkey").alias("owner")).alias("meta"),
                             F.array(oid("c_custkey"), oid("c_nationkey")).alias("refs")))
    v = F.parse_json(stringify_ids(rec))
    return c.select(F.try_variant_get(v, "$._id", "string").alias("_id"), "c_name",
                    F.try_variant_get(v, "$.meta.owner", "string").alias("owner"),
                    F.array_join(F.try_variant_get(v, "$.refs", "array<string>"), ",").alias("refs"))


@query("stringify_ids_typed", ORACLE["stringify_ids"])
def q_stringify_ids_typed(spark, sf):
    """P6 on typed columns: the same ids at three depths, by the schema."""
    c = table(spark, sf, "customer")
    oid = lambda col: F.struct(F.lpad(F.col(col).cast("string"), 24, "0").alias("$oid"))
    rec = c.select(oid("c_custkey").alias("_id"), "c_name", F.struct(oid("c_nationkey").alias("owner")).alias("meta"),
                   F.array(oid("c_custkey"), oid("c_nationkey")).alias("refs"))
    return stringify_typed_ids(rec).select("_id", "c_name", F.col("meta.owner").alias("owner"), F.array_join("refs", ",").alias("refs"))


@query("python_text", """
SELECT event_id, '{''id'': ' || CAST(event_id AS VARCHAR) || ', ''tags'': [''' || event_type || ''', None, True], ''v'': [{''value'': '
       || CAST(value AS VARCHAR) || ', ''props'': {''k'': ' || (props::JSON ->> 'k') || '}}], ''q'': "it''s"}' AS text_representation
FROM events""")
def q_python_text(spark, sf):
    """Nested lists and objects as Python prints them."""
    ev = spread(table(spark, sf, "events"))
    nested = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"tags":['), json_scalar(F.col("event_type")), F.lit(',null,true],"v":[{"value":'),
                      F.col("value").cast("string"), F.lit(',"props":'), F.col("props"), F.lit('}],"q":"it\'s"}'))
    return ev.select("event_id", py_text_of_json(nested).alias("text_representation"))


@query("safe_name", r"""
SELECT page_id, coalesce(nullif(regexp_replace(
         CASE WHEN regexp_full_match(regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^(.*?)(\.[^.]*)?$', 1), '\.*')
              THEN regexp_extract(url, '([^/]*)$', 1)
              ELSE regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^(.*?)(\.[^.]*)?$', 1) END,
         '[^\p{L}\p{N}._-]', '_', 'g'), ''), 'imported_collection') AS collection
FROM pages""")
def q_safe_name(spark, sf):
    """Collection name from the last path part of each page URL."""
    p = table(spark, sf, "pages")
    return p.select("page_id", safe_name(F.col("url")).alias("collection"))


# ------------------------------------------------------------------ sinks: K1, S8, K3-K5

DOC_FEATURE_SQL = """
SELECT '[doc_id] ' || CAST(doc_id AS VARCHAR) || ' [text] ' || text AS text_representation,
       CAST(NULL AS DOUBLE) AS "timestamp", lang AS label, source || '.json' AS source_file
FROM documents"""


def _document_features(spark, sf):
    d = table(spark, sf, "documents")
    lines = d.select(F.to_json(F.struct("doc_id", "text", F.col("lang").alias("label"))).alias("value"),
                     F.concat(F.col("source"), F.lit(".json")).alias("source_file"))
    return featurize(lines)


@query("csv_roundtrip", DOC_FEATURE_SQL)
def q_csv_roundtrip(spark, sf):
    """K1 then S8: document features written as CSV per source file, read back."""
    root = work_dir(spark, "csv")
    write_csv_by_key(_document_features(spark, sf), root)
    return read_csv_by_key(spark, root)


@query("load_by_source", f"""
SELECT {EVENT_TEXT_SQL} AS text_representation, {EVENT_TS_SQL} AS "timestamp",
       CASE WHEN event_id % 4 = 1 THEN upper(event_type) ELSE event_type END AS label,
       {EVENT_SOURCE_SQL} AS source_file
FROM events""")
def q_load_by_source(spark, sf):
    """K3: a full load, then a reload of one source file only; the other
    source files keep their rows, the reloaded one is replaced."""
    tbl = work_dir(spark, "features_table")
    feats = featurize(event_lines(spark, sf)).select(*FEATURE_COLUMNS)
    load_by_source(feats, tbl)
    again = feats.filter(F.col("source_file").rlike("^events_1[.-]")).withColumn("label", F.upper("label"))
    load_by_source(again, tbl)
    return read_table(spark, tbl)


LOAD_SQL = ORACLE["load_by_source"]


@query("load_buckets", LOAD_SQL + " WHERE event_id % 4 <> 3")
def q_load_buckets(spark, sf):
    """K3 in hash buckets: a full load, then one load that replaces the rows
    of one source file and empties another."""
    tbl = work_dir(spark, "features_buckets")
    feats = featurize(event_lines(spark, sf)).select(*FEATURE_COLUMNS)
    load_buckets(feats, tbl)
    again = feats.filter(F.col("source_file").rlike("^events_1[.-]")).withColumn("label", F.upper("label"))
    sources = feats.select("source_file").filter(F.col("source_file").rlike("^events_[13][.-]")).distinct()
    load_buckets(again, tbl, sources)
    return read_buckets(spark, tbl)


@query("insert_ignore", """
SELECT 'c' || CAST(c_custkey AS VARCHAR) AS _id, c_name, 'A' AS batch FROM customer
UNION ALL
SELECT 'c' || CAST(b.c_custkey * 2 AS VARCHAR), b.c_name, 'B' FROM customer b
WHERE b.c_mktsegment <> 'BUILDING'
  AND NOT EXISTS (SELECT 1 FROM customer a WHERE a.c_custkey = b.c_custkey * 2)
UNION ALL
SELECT NULL, c_name, 'B' FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT NULL, c_name, 'B' FROM customer WHERE c_mktsegment = 'BUILDING'""")
def q_insert_ignore(spark, sf):
    """K4: batch A holds every customer under id ``c<key>``; batch B holds
    every customer twice under id ``c<2 * key>``, except BUILDING customers,
    who come without id. Ids already present keep their first row, repeated
    ids in a batch insert once, rows without id always insert."""
    tbl = work_dir(spark, "insert_ignore")
    c = table(spark, sf, "customer")
    a = c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("_id"), "c_name",
                 F.lit("A").alias("batch"))
    append_ignore(spark, a, tbl)
    b_id = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("c"), (F.col("c_custkey") * 2).cast("string")))
    b = c.select(b_id.alias("_id"), "c_name", F.lit("B").alias("batch"))
    append_ignore(spark, b.unionByName(b), tbl)
    return spark.read.parquet(tbl).select("_id", "c_name", "batch")


@query("drop_reload", """
SELECT c_mktsegment AS collection,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'b' ELSE 'c' END || CAST(c_custkey AS VARCHAR) AS _id,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' ELSE 'A' END AS batch
FROM customer""")
def q_drop_reload(spark, sf):
    """K5: every customer loaded into a collection per market segment; then
    the BUILDING collection is dropped and reloaded with new ids, the other
    collections stay as they were."""
    tbl = work_dir(spark, "drop_reload")
    c = table(spark, sf, "customer")
    first = c.select(F.col("c_mktsegment").alias("collection"),
                     F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("_id"), F.lit("A").alias("batch"))
    drop_reload(first, tbl)
    second = c.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_mktsegment").alias("collection"),
        F.concat(F.lit("b"), F.col("c_custkey").cast("string")).alias("_id"), F.lit("B").alias("batch"))
    drop_reload(second, tbl)
    return spark.read.schema("_id string, batch string, collection string").parquet(tbl).select(
        "collection", "_id", "batch")


# ------------------------------------------------------------------ lines: S9, S10, A1 / J3

@query("line_count", "SELECT CAST(count(*) AS BIGINT) AS n_lines FROM events")
def q_line_count(spark, sf):
    """S9 + A1 (J3): write one line per event, count the lines of the folder."""
    root = work_dir(spark, "lines")
    event_lines(spark, sf).select("value").write.text(root)
    return jobs.count_lines(spark, root)


@query("sample_lines", "SELECT 'Line ' || CAST(event_id + 1 AS VARCHAR) AS value FROM events")
def q_sample_lines(spark, sf):
    """``Line <n>`` for n = 1 .. number of events."""
    ev = table(spark, sf, "events")
    return ev.select(sample_lines(F.col("event_id") + 1).alias("value"))


# ------------------------------------------------------------------ ML features: M1-M3

LABEL_RENAME_SQL = """CASE WHEN event_id % 10 = 3 THEN 'unknown_kind' ELSE
    CASE event_type WHEN 'click' THEN 'benign' WHEN 'view' THEN 'dirb' WHEN 'purchase' THEN 'wpscan'
                    WHEN 'signup' THEN 'reverse_shell' WHEN 'error' THEN 'cracking' END END"""


@query("encode_label", f"""
SELECT event_id, label,
       CAST(CASE label WHEN 'benign' THEN 0 WHEN 'dirb' THEN 1 WHEN 'wpscan' THEN 2
            WHEN 'reverse_shell' THEN 7 WHEN 'cracking' THEN 10 END AS INTEGER) AS label_code
FROM (SELECT event_id, {LABEL_RENAME_SQL} AS label FROM events) t""")
def q_encode_label(spark, sf):
    """M1: attack label names to codes; other names give null."""
    ev = table(spark, sf, "events")
    renamed = F.create_map(*[F.lit(x) for kv in [("click", "benign"), ("view", "dirb"), ("purchase", "wpscan"),
                                                   ("signup", "reverse_shell"), ("error", "cracking")] for x in kv])
    label = F.when(F.col("event_id") % 10 == 3, F.lit("unknown_kind")).otherwise(
        F.try_element_at(renamed, F.col("event_type")))
    return ev.select("event_id", label.alias("label")).select(
        "event_id", "label", encode_label(F.col("label")).alias("label_code"))


@query("truncate_tokens", f"""
SELECT doc_id, CAST(len({WORDS_SQL}) AS INTEGER) AS n_tokens,
       CAST(len(list_slice({WORDS_SQL}, 1, 510)) AS INTEGER) AS n_kept,
       array_to_string(list_slice({WORDS_SQL}, 1, 510), ' ') AS kept_text
FROM documents""")
def q_truncate_tokens(spark, sf):
    """M3: texts cut to 510 whitespace tokens (512 with the two special tokens)."""
    d = spread(table(spark, sf, "documents"))
    kept = truncate_tokens(F.col("text"))
    return d.select("doc_id", F.size(tokens(F.col("text"))).alias("n_tokens"),
                    F.size(kept).alias("n_kept"), F.array_join(kept, " ").alias("kept_text"))


@query("embed_text", f"""
WITH t AS (SELECT doc_id, [('0x' || substr(md5(w), 1, 8))::BIGINT % 64 FOR w IN list_slice({WORDS_SQL}, 1, 510) IF w <> ''] AS b FROM documents),
c AS (SELECT doc_id, [len(list_filter(b, lambda x: x = k)) FOR k IN range(64)] AS n FROM t),
s AS (SELECT doc_id, n, sqrt(list_sum([x * x FOR x IN n])::DOUBLE) AS norm FROM c)
SELECT doc_id, [CASE WHEN norm > 0 THEN (x / norm)::FLOAT ELSE 0::FLOAT END FOR x IN n] AS embedding FROM s""")
def q_embed_text(spark, sf):
    """M2: one embedding per document (hashed bag of its first 510 tokens,
    L2-normalised, 64 floats)."""
    d = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return embed_text(d, "text").select("doc_id", "embedding")


# ------------------------------------------------------------------ M3 / M2 by subwords

# Vocabulary by rule: the special tokens, beginnings (to 4 letters) and inner parts (to 3) of the words of `benchmark`.
SUBWORD_SQL = r"""
WITH RECURSIVE bw AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark),
tokens AS (
    SELECT substr(w, 1, l) AS t FROM bw, range(1, 5) r(l) WHERE l <= len(w)
    UNION SELECT '##' || substr(w, p, l) FROM bw, range(2, 60) q(p), range(1, 4) r(l) WHERE p + l - 1 <= len(w)),
vocabulary AS (SELECT t, (row_number() OVER (ORDER BY t) + 3)::INTEGER AS id FROM tokens),
words AS (
    SELECT doc_id, unnest(x) AS w, generate_subscripts(x, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(lower(strip_accents(text)), '[\p{P}$+<=>^`|~]|[^\s\p{P}$+<=>^`|~]+') AS x FROM documents)),
matched(w, pos, ids) AS (
    SELECT w, 1::BIGINT, []::INTEGER[] FROM (SELECT DISTINCT w FROM words) WHERE len(w) <= 100
    UNION ALL
    SELECT w, (pos + l)::BIGINT, list_append(ids, id)
    FROM (SELECT m.w, m.pos, m.ids, l, v.id, row_number() OVER (PARTITION BY m.w ORDER BY l DESC) AS best
          FROM matched m, range(1, 5) r(l), vocabulary v
          WHERE m.pos + l - 1 <= len(m.w) AND v.t = (CASE WHEN m.pos = 1 THEN '' ELSE '##' END) || substr(m.w, m.pos, l))
    WHERE best = 1),
whole AS (SELECT w, ids FROM matched WHERE pos = len(w) + 1),
cut AS (
    SELECT doc_id, list_slice(flatten(list(coalesce(ids, [0]) ORDER BY i)), 1, 510) AS ids
    FROM words LEFT JOIN whole USING (w) GROUP BY doc_id)
SELECT doc_id, list_concat([1], coalesce(ids, []), [2])::INTEGER[] AS input_ids, (len(coalesce(ids, [])) + 2)::INTEGER AS n_ids
FROM documents LEFT JOIN cut USING (doc_id)"""


def _benchmark_vocabulary(spark, sf) -> list[str]:
    words = (table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("w")).distinct())
    n = F.length("w")
    begins = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.least(n, F.lit(4))), lambda i: F.substring("w", F.lit(1), i))).alias("t"))
    inner = words.filter(n > 1).select(F.explode(F.flatten(F.transform(F.sequence(F.lit(2), n), lambda p: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(3), n - p + 1)), lambda k: F.concat(F.lit("##"), F.substring(F.col("w"), p, k)))))).alias("t"))
    # At most 26 + 26^2 + 26^3 + 26^4 beginnings and 26 + 26^2 + 26^3 inner parts; the size is checked where it is sent.
    return [*SPECIAL.values(), *[r["t"] for r in begins.union(inner).distinct().orderBy("t").collect()]]


@query("subword_inputs", SUBWORD_SQL)
def q_subword_inputs(spark, sf):
    """M3: documents as subword ids with special tokens, cut to 512, and the number of unmasked ones."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    out = subword_inputs(docs, F.col("text"), _benchmark_vocabulary(spark, sf))
    return out.select("doc_id", "input_ids", F.aggregate("attention_mask", F.lit(0), lambda s, x: s + x).alias("n_ids"))


@query("embed_subwords", f"""
SELECT doc_id, [(list_sum([(x * j) % 97 FOR x IN input_ids])::DOUBLE / n_ids)::FLOAT FOR j IN range(1, 9)] AS embedding
FROM ({SUBWORD_SQL}) t""")
def q_embed_subwords(spark, sf):
    """M2 by a model on subword ids: batches of equal lengths, padded to their
    longest. The model here is a fixed one: its first token takes the mean
    over all unmasked tokens of (id x j) mod 97, j = 1..8."""
    def make_predict_fn():
        def predict(tokens, mask):
            states = (tokens[:, :, None] * range(1, 9)) % 97 * mask[:, :, None]
            return states.sum(1) / mask.sum(1)[:, None]
        return predict

    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    inputs = subword_inputs(docs, F.col("text"), _benchmark_vocabulary(spark, sf))
    return embed_inputs(inputs, make_predict_fn, ["doc_id"], pad_id=3).select("doc_id", "embedding")


# ------------------------------------------------------------------ J4

@query("featurize_load", f"""
SELECT '[_id] ' || lpad(CAST(event_id AS VARCHAR), 24, '0') || ' ' || {EVENT_TEXT_SQL} AS text_representation,
       {EVENT_TS_SQL} AS "timestamp", event_type AS label, {EVENT_SOURCE_SQL} AS source_file
FROM events""")
def q_featurize_load(spark, sf):
    """Event records with object ids stored as collections (one per
    input file), then extract (S7), stringify ids (P6), featurize (J1) and
    load by source file (K3); the table is read back."""
    base = work_dir(spark, "e2e")
    lines = event_lines(spark, sf)
    oid = F.concat(F.lit('{"_id":{"$oid":"'), F.lpad(F.col("event_id").cast("string"), 24, "0"), F.lit('"},'))
    recs = lines.select(F.concat(oid, F.expr("substring(value, 2)")).alias("value"),
                        F.regexp_replace("source_file", r"\.json$", "").alias("collection"))
    write_collections(recs, base + "/collections")
    return jobs.extract_featurize_load(spark, base + "/collections", base + "/table")
