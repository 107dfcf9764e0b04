"""The bucketed feature table and the key table beside collections."""

import json
import os
import re

from pyspark.sql import functions as F

from rectext.plans.jobs import featurize_files, import_documents
from rectext.session import local_path
from rectext.sinks.buckets import load_buckets, read_buckets
from rectext.sinks.keys import add_keys, has_keys, may_be_stored, stored_keys, without_stored
from rectext.sinks.writers import FEATURE_SCHEMA, read_collections


def features(spark, rows):
    return spark.createDataFrame([(t, 1.0, None, s) for t, s in rows], FEATURE_SCHEMA)


def test_many_sources_in_few_folders(spark, tmpuri):
    load_buckets(features(spark, [(f"t{i}", f"s3://x/file {i}.json") for i in range(10_000)] + [("hot", "h")] * 5000 + [("none", None)]), tmpuri)
    folders = [d for d in os.listdir(local_path(tmpuri)) if d.startswith("bucket=")]
    assert 0 < len(folders) <= 64
    rows = read_buckets(spark, tmpuri)
    assert rows.count() == 15_000 and rows.select("source_file").distinct().count() == 10_001
    one = read_buckets(spark, tmpuri, sources=["s3://x/file 77.json"])
    assert [r["text_representation"] for r in one.collect()] == ["t77"]
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", one._jdf.queryExecution().executedPlan().toString()), "other buckets aren't read"


def test_replaced_emptied_and_repeated_loads(spark, tmpuri):
    load_buckets(features(spark, [("a1", "a"), ("a2", "a"), ("b1", "b"), ("c1", "c")]), tmpuri)
    for _ in range(2):                             # a load that is run again changes nothing
        load_buckets(features(spark, [("a3", "a"), ("d1", "d")]), tmpuri, spark.createDataFrame([("a",), ("b",), ("d",), (None,)], "f string"))
        got = sorted((r["source_file"], r["text_representation"]) for r in read_buckets(spark, tmpuri).collect())
        assert got == [("a", "a3"), ("c", "c1"), ("d", "d1")]
    load_buckets(features(spark, []), tmpuri, spark.createDataFrame([("a",), ("c",), ("d",)], "f string"))
    assert read_buckets(spark, tmpuri).count() == 0
    load_buckets(features(spark, [("a4", "a")]), tmpuri)
    assert [r["text_representation"] for r in read_buckets(spark, tmpuri).collect()] == ["a4"]


def test_featurize_job_into_buckets(spark, tmp_path, tmpuri):
    (tmp_path / "a.json").write_text('{"x":1}\n')
    (tmp_path / "b.json").write_text('{"x":2}\n')
    featurize_files(spark, str(tmp_path), tmpuri + "/t", fmt="buckets")
    (tmp_path / "b.json").write_text("\n")
    featurize_files(spark, str(tmp_path), tmpuri + "/t", fmt="buckets")
    assert [r["text_representation"] for r in read_buckets(spark, tmpuri + "/t").collect()] == ["[x] 1"]


def test_filter_has_no_false_negatives_and_few_false_positives(spark, tmpuri):
    keys = spark.range(20_000).select(F.lit("c").alias("collection"), F.col("id").cast("string").alias("key"))
    add_keys(keys.filter("key < 5000"), tmpuri, bits=1 << 20)
    add_keys(keys.filter("key >= 5000 and key < 10000").unionByName(spark.createDataFrame([("c", None), (None, "1")], "collection string, key string")), tmpuri, bits=1 << 20)
    passed = keys.filter(may_be_stored(spark, tmpuri, F.col("collection"), F.col("key"), 1 << 20)).select(F.col("key").cast("int").alias("k"))
    assert passed.filter("k < 10000").count() == 10_000 and passed.count() < 10_200
    batch = keys.unionByName(spark.createDataFrame([("d", "1"), ("c", None), (None, "1")], "collection string, key string")).withColumn("text", F.lit("x"))
    left = without_stored(batch, tmpuri, "key", 1 << 20)
    assert left.count() == 10_003 and left.filter("key < 10000 and collection = 'c'").count() == 0
    assert stored_keys(spark, tmpuri).count() == 10_000


def test_second_import_reads_keys_and_no_documents(spark, tmp_path, tmpuri):
    src, target = tmp_path / "src", tmpuri + "/t"
    src.mkdir()
    write = lambda ids: (src / "a.json").write_text("".join(json.dumps({"_id": str(i), "v": f"text {i}"}) + "\n" for i in ids))
    write(range(10))
    import_documents(spark, str(src), target).collect()                          # a replacing import needs no keys
    assert not has_keys(spark, target)
    write(range(5, 15))
    got = import_documents(spark, str(src), target, drop_existing=False).collect()
    assert [(r["attempted"], r["inserted"], r["total_in_collection"]) for r in got] == [(10, 5, 15)] and has_keys(spark, target)
    # From here on the documents aren't asked: with one taken out by hand, its key is still known.
    plan = without_stored(spark.createDataFrame([("a", "7", "x")], "collection string, _id string, value string"), target, "_id")
    assert plan.count() == 0 and plan.inputFiles() and all(".keys/keys/" in f for f in plan.inputFiles())
    write([3, 20])
    got = import_documents(spark, str(src), target, drop_existing=False).collect()
    assert [(r["inserted"], r["total_in_collection"]) for r in got] == [(1, 16)]
    write([1])
    import_documents(spark, str(src), target).collect()                          # replaced: keys follow
    write([1, 2])
    got = import_documents(spark, str(src), target, drop_existing=False).collect()
    assert [(r["inserted"], r["total_in_collection"]) for r in got] == [(1, 2)]
    assert sorted(r["value"] for r in read_collections(spark, target).collect()) == ['{"_id": "1", "v": "text 1"}', '{"_id": "2", "v": "text 2"}']
