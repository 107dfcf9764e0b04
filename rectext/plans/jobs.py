"""Composite jobs (J1-J4): one Spark plan each over all input files.

The reference loops over files on the driver and runs several jobs per
file; here each job is one scan of every file, one narrow projection and one
write, plus optional aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rectext.functions.names import base_name, safe_name
from rectext.functions.render import as_object
from rectext.functions.shapes import common_shapes
from rectext.operators.audit import batch_audit, collection_count, import_summary
from rectext.operators.features import featurize_records
from rectext.operators.records import CORRUPT_COL, drop_corrupt, parse_lines, stringify_ids
from rectext.sinks.writers import (CSV_PARTITION, FEATURE_SCHEMA, clear_partitions, insert_ignore, load_by_source, read_collections, read_table,
                                   write_collections, write_csv_by_key)
from rectext.sinks.buckets import load_buckets
from rectext.sinks.keys import add_keys, has_keys, replace_keys, without_stored
from rectext.sources.json_files import FLAT_JSON_GLOB, JSON_GLOB, listed_files, scan_json_auto, scan_json_records
from rectext.session import path_exists, work_dir
from rectext.sources.text import line_count, read_text


def featurize_files(spark: SparkSession, root, out: str | None = None, fmt: str = "csv",
                    recursive: bool = True, glob: str = JSON_GLOB, ignore_corrupt_files: bool = False,
                    by_shape: bool = False):
    """All JSON files under ``root`` -> feature rows, written per source
    file (``fmt`` = ``csv`` for K1, ``table`` for K3, ``buckets`` for K3 in a
    fixed number of folders). A load replaces the rows of all these files,
    also of a file that has no record left.

    Returns ``(features, audit, metrics)``: the lazy feature frame, the lazy
    per-file audit (A5; a second pass, run only if asked) and an
    ``Observation`` with batch totals filled in by the write itself (no
    extra pass). ``by_shape``: look at a bounded sample of either format
    first and render records of its common shapes by compiled expressions (same
    rows, less time on long inputs)."""
    records = scan_json_records(spark, root, recursive, glob, ignore_corrupt_files)
    valid, shapes = records.filter(F.col("v").isNotNull()), []
    if by_shape:
        shapes = [s for f in ("ndjson", "array") for s in common_shapes(valid.filter(F.col("format") == f))]
    records = records.drop("format")
    rendered = featurize_records(valid.drop("format"), keep=["source_file"], with_error=True, shapes=list(dict.fromkeys(shapes)))
    metrics = Observation("featurize")
    features = rendered.observe(
        metrics,
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.col("is_error")).alias("n_errors"),
        F.count_if(F.col("timestamp").isNull() & ~F.col("is_error")).alias("n_without_timestamp"),
    ).select("text_representation", "timestamp", "label", "source_file")
    files = listed_files(spark, root, recursive, glob)
    if out is not None and fmt == "buckets":
        load_buckets(features, out, files)
    elif out is not None:
        write, folder = (write_csv_by_key, CSV_PARTITION) if fmt == "csv" else (load_by_source, "source_file")
        if path_exists(spark, out):
            # Rendered once into the shared folder: the rows to load, and the files that gave any, come from there.
            base = work_dir(spark, "features")
            features.write.parquet(base)
            batch = spark.read.schema(features.schema).parquet(base)
            write(batch, out)
            emptied = files.join(batch.select("source_file").distinct(), "source_file", "left_anti")
            clear_partitions(spark, out, folder, [r["source_file"] for r in emptied.collect()])
        else:
            write(features, out)
    audit = batch_audit(featurize_records(records, keep=["source_file", "v", CORRUPT_COL], with_error=True))
    # From the listing, so that an empty, blank or unreadable (skipped) file has its row.
    counts = ["n_records", "n_corrupt", "n_errors", "n_without_timestamp"]
    audit = (files.join(audit, "source_file", "left")
             .select("source_file", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts], F.coalesce("is_empty", F.lit(True)).alias("is_empty")))
    return features, audit, metrics


def import_documents(spark: SparkSession, folder: str, target: str, drop_existing: bool = True,
                     key: str = "_id") -> DataFrame:
    """Every ``*.json`` file of ``folder`` (not recursive) into the
    collection named after it (P7), NDJSON or array (S5), all-null rows
    dropped (P4), null fields pruned (P5). ``key`` stays unique in each
    collection (K4); with ``drop_existing`` the collections of all files are
    replaced (K5), also of a file that has no record left, else only new keys
    are added. Returns the summary (A3), a row for every file: ``attempted``
    records, ``inserted`` ones and the collection's total.

    The input is parsed once: the new documents are written to the shared
    folder first, and table and counts come from there. Stored keys are kept
    beside the table (``sinks.keys``), so adding to it doesn't read its
    documents. The documents are written before their keys: after a job that
    died in between, delete the key folder (``<target>.keys``), and the next
    import makes it anew."""
    files = (listed_files(spark, folder, recursive=False, glob=FLAT_JSON_GLOB)
             .withColumn("collection", safe_name(F.col("source_file"))))
    recs = scan_json_auto(spark, folder, recursive=False, glob=FLAT_JSON_GLOB, keep_raw=True)
    pruned = recs.select(
        "source_file", "_raw", F.size(as_object(F.col("v"))).alias("_n"),
        F.map_filter(as_object(F.col("v")), lambda k, x: ~F.is_variant_null(x)).alias("_m"))
    # a record with nothing to prune keeps its own text (numbers such as 1.0
    # stay as written); pruned records are re-serialised
    kept_text = F.when((F.size("_m") == F.col("_n")) & F.col("_raw").isNotNull(), F.col("_raw")) \
        .otherwise(F.to_json("_m"))
    docs = (pruned.filter(F.size("_m") > 0)                                  # P4
            .select(safe_name(F.col("source_file")).alias("collection"),
                    F.get_json_object(kept_text, "$." + key).alias(key),
                    F.col("source_file"), kept_text.alias("value")))         # P5
    base = work_dir(spark, "import")
    docs.write.parquet(base + "/parsed")
    docs = spark.read.schema(docs.schema).parquet(base + "/parsed")
    candidates = insert_ignore(docs, None, ["collection", key])
    if not drop_existing and path_exists(spark, target):
        if not has_keys(spark, target):            # a table from before it had keys: its documents are read, once
            add_keys(read_collections(spark, target).select("collection", F.get_json_object(F.col("value"), "$." + key).alias("key")), target)
        candidates.write.parquet(base + "/candidates")
        candidates = without_stored(spark.read.schema(docs.schema).parquet(base + "/candidates"), target, key)
    candidates.select(*docs.columns).write.parquet(base + "/new")
    new_docs = spark.read.schema(docs.schema).parquet(base + "/new")
    new_keys = new_docs.select("collection", F.col(key).alias("key"))
    if drop_existing:
        write_collections(new_docs, target)
        if path_exists(spark, target):
            emptied = files.join(new_docs.select("collection").distinct(), "collection", "left_anti").select("collection").distinct()
            clear_partitions(spark, target, "collection", [r["collection"] for r in emptied.collect()])
        if has_keys(spark, target):
            replace_keys(new_keys, target, [r["collection"] for r in files.select("collection").distinct().collect()])
    else:
        new_docs.select("value", "collection").write.mode("append").partitionBy("collection").text(target)
        add_keys(new_keys, target)
    totals = (collection_count(read_collections(spark, target)) if path_exists(spark, target)
              else spark.createDataFrame([], "collection string, n_documents long"))
    return import_summary(files.withColumn("file", base_name(F.col("source_file"))), docs, new_docs, totals)


def count_lines(spark: SparkSession, path) -> DataFrame:
    """Number of lines of a text file (or folder)."""
    return line_count(read_text(spark, path))


def extract_featurize_load(spark: SparkSession, collections: str, table: str) -> DataFrame:
    """Every collection (S7) with object ids made strings (P6),
    featurized (J1) with ``source_file = <collection>.json`` and loaded into
    the feature table, replacing those source files only (K3). Returns the
    table read back."""
    docs = read_collections(spark, collections)
    lines = docs.select(stringify_ids(F.col("value")).alias("value"),
                        F.concat(F.col("collection"), F.lit(".json")).alias("source_file"))
    records = drop_corrupt(parse_lines(lines))
    features = featurize_records(records, keep=["source_file"])
    load_by_source(features, table)
    return read_table(spark, table, FEATURE_SCHEMA)
