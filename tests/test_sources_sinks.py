"""Sources S1-S9 and sinks K1-K5 on small hand-made folders."""

import os

from pyspark.sql import functions as F

from rectext.functions.names import safe_name
from rectext.session import local_path
from rectext.sinks.writers import (FEATURE_SCHEMA, append_ignore, drop_reload, insert_ignore,
                                   load_by_source, read_collections, read_csv_by_key, read_table,
                                   write_collections, write_csv_by_key)
from rectext.sources.json_files import discover_files, scan_json_array, scan_json_auto, scan_ndjson
from rectext.sources.text import line_count, read_text, sample_lines


def _write(root, rel, text):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)


PRETTY = '[\n    {\n        "a": 1,\n        "b": {}\n    },\n    {\n        "a": 2\n    }\n]\n'


def test_discover_files(spark, tmp_path):
    root = str(tmp_path)
    for rel in ["a.json", "b.JSON", "sub/c.ndjson", "sub/deep/d.Json", "e.txt", "f.jsonl",
                ".ipynb_checkpoints/g.json"]:
        _write(root, rel, '{"x":1}\n')
    found = sorted(os.path.relpath(local_path(r["path"]), root)
                   for r in discover_files(spark, root).collect())
    assert found == ["a.json", "b.JSON", "sub/c.ndjson", "sub/deep/d.Json"]
    flat = discover_files(spark, root, recursive=False, glob="*.[jJ][sS][oO][nN]").collect()
    assert sorted(os.path.basename(r["path"]) for r in flat) == ["a.json", "b.JSON"]


def test_scan_ndjson_keeps_file(spark, tmp_path):
    root = str(tmp_path)
    _write(root, "x.json", '{"a":1}\n{bad\n\n{"a":2}\n')
    rows = scan_ndjson(spark, root).collect()
    assert len(rows) == 3
    assert all(r["source_file"].endswith("/x.json") for r in rows)
    assert sum(r["_corrupt_record"] is not None for r in rows) == 1


def test_scan_json_array_and_auto(spark, tmp_path):
    root = str(tmp_path)
    _write(root, "arr.json", PRETTY)
    _write(root, "nd.json", '{"a":3}\n{"a":4}\n')
    _write(root, "compact.json", '[{"a":5},{"a":6}]\n')
    _write(root, "junk.json", "not json at all\n")
    arr = scan_json_array(spark, [os.path.join(root, "arr.json")]).filter("v is not null")
    assert sorted(r[0] for r in arr.select(F.try_variant_get("v", "$.a", "int")).collect()) == [1, 2]
    auto = scan_json_auto(spark, root).select(
        F.regexp_extract("source_file", r"([^/]+)$", 1).alias("f"), "format",
        F.try_variant_get("v", "$.a", "int").alias("a")).collect()
    got = sorted((r["f"], r["format"], r["a"]) for r in auto)
    assert got == [("arr.json", "array", 1), ("arr.json", "array", 2), ("compact.json", "ndjson", 5),
                   ("compact.json", "ndjson", 6), ("nd.json", "ndjson", 3), ("nd.json", "ndjson", 4)]


def test_collections_roundtrip_and_reload(spark, tmpuri):
    df = spark.createDataFrame([('{"a":1.0}', "c1"), ('{"a":"x\\ny \\"q\\""}', "c2"), ('{"b":2}', "123")],
                               "value string, collection string")
    write_collections(df, tmpuri)
    back = sorted((r["collection"], r["value"]) for r in read_collections(spark, tmpuri).collect())
    assert back == sorted((r["collection"], r["value"]) for r in df.collect())
    write_collections(spark.createDataFrame([('{"z":0}', "c1")], "value string, collection string"), tmpuri)
    back = sorted((r["collection"], r["value"]) for r in read_collections(spark, tmpuri).collect())
    assert back == [("123", '{"b":2}'), ("c1", '{"z":0}'), ("c2", '{"a":"x\\ny \\"q\\""}')]


def test_csv_roundtrip_keeps_text(spark, tmpuri):
    rows = [("a \"quoted\"\nline ", 1.5, "x", "s1.json"), (" lead", None, None, "s1.json"),
            ("back\\slash", 2.0, "y", "dir/s2.json")]
    df = spark.createDataFrame(rows, FEATURE_SCHEMA)
    write_csv_by_key(df, tmpuri)
    back = sorted(map(tuple, read_csv_by_key(spark, tmpuri).collect()), key=lambda r: r[0])
    assert back == sorted(rows, key=lambda r: r[0])


def test_load_by_source_is_idempotent_and_replaces(spark, tmpuri):
    rows = [("t1", 1.0, "a", "s1"), ("t2", 2.0, "b", "s2")]
    df = spark.createDataFrame(rows, FEATURE_SCHEMA)
    load_by_source(df, tmpuri)
    load_by_source(df, tmpuri)
    assert sorted(map(tuple, read_table(spark, tmpuri).collect())) == sorted(rows)
    load_by_source(spark.createDataFrame([("t3", 3.0, "c", "s2")], FEATURE_SCHEMA), tmpuri)
    assert sorted(map(tuple, read_table(spark, tmpuri).collect())) == [("t1", 1.0, "a", "s1"),
                                                                       ("t3", 3.0, "c", "s2")]


def test_insert_ignore(spark, tmpuri):
    a = spark.createDataFrame([("1", "a"), ("2", "a")], "_id string, tag string")
    b = spark.createDataFrame([("2", "b"), ("3", "b"), ("3", "b"), (None, "b"), (None, "b")],
                              "_id string, tag string")
    assert sorted(map(tuple, insert_ignore(b, a).collect()), key=str) == \
        sorted([("3", "b"), (None, "b"), (None, "b")], key=str)
    append_ignore(spark, a, tmpuri)
    append_ignore(spark, b, tmpuri)
    append_ignore(spark, a, tmpuri)
    got = sorted(map(tuple, spark.read.parquet(tmpuri).collect()), key=str)
    assert got == sorted([("1", "a"), ("2", "a"), ("3", "b"), (None, "b"), (None, "b")], key=str)


def test_drop_reload_keeps_other_collections(spark, tmpuri):
    first = spark.createDataFrame([("x", 1), ("y", 2)], "collection string, n int")
    drop_reload(first, tmpuri)
    drop_reload(spark.createDataFrame([("x", 3)], "collection string, n int"), tmpuri)
    got = sorted(map(tuple, spark.read.parquet(tmpuri).select("collection", "n").collect()))
    assert got == [("x", 3), ("y", 2)]


def test_safe_name(spark):
    paths = ["/d/a b.json", "/d/ü-1.x.json", "/d/.json", "/d/", "/d/..x", "/d/a.b.c", "/d/.env"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(safe_name(F.col("p"))).collect()]
    assert got == ["a_b", "ü-1.x", ".json", "imported_collection", "..x", "a.b", ".env"]


def test_sample_lines_and_count(spark, tmpuri):
    lines = spark.range(1, 11).select(sample_lines(F.col("id")).alias("value"))
    assert [r[0] for r in lines.orderBy(F.col("value").substr(6, 3).cast("int")).collect()][:2] == ["Line 1", "Line 2"]
    lines.write.text(tmpuri)
    assert line_count(read_text(spark, tmpuri)).first()["n_lines"] == 10


def test_glob_path_and_corrupt_file_skip(spark, tmp_path):
    import gzip
    from rectext.sources.json_files import read_lines
    root = str(tmp_path)
    _write(root, "x1.json", '{"a":1}\n')
    _write(root, "x2.json", '{"a":2}\n')
    _write(root, "y.json", '{"a":3}\n')
    rows = read_lines(spark, os.path.join(root, "x*.json"), recursive=False).collect()
    assert sorted(r["value"] for r in rows) == ['{"a":1}', '{"a":2}']
    with open(os.path.join(root, "z.json.gz"), "wb") as f:
        f.write(gzip.compress(b'{"a":4}\n')[:-8])         # truncated: unreadable
    kept = read_lines(spark, root, glob="*", ignore_corrupt_files=True).collect()
    assert {'{"a":1}', '{"a":2}', '{"a":3}'} <= {r["value"] for r in kept}


def test_import_empty_folder_and_summary(spark, tmp_path, tmpuri):
    from rectext.plans.jobs import import_documents
    empty = tmp_path / "empty"
    empty.mkdir()
    assert import_documents(spark, str(empty), tmpuri + "/a").count() == 0
    src = tmp_path / "in"
    src.mkdir()
    (src / "a b.json").write_text('{"_id":"1","x":null,"y":2}\n{"x":null,"z":null}\n')
    (src / "arr.json").write_text(PRETTY)
    rows = {r["file"]: r for r in import_documents(spark, str(src), tmpuri + "/b").collect()}
    assert (rows["a b.json"]["collection"], rows["a b.json"]["inserted"]) == ("a_b", 1)
    assert (rows["arr.json"]["collection"], rows["arr.json"]["total_in_collection"]) == ("arr", 2)


def test_source_file_is_decoded_path(spark, tmp_path):
    from rectext.sources.json_files import discover_files, read_lines
    root = str(tmp_path)
    _write(root, "a b+c%.json", '{"a":1}\n')
    (line,) = read_lines(spark, root).collect()
    assert line["source_file"].endswith("/a b+c%.json")
    (f,) = discover_files(spark, root).collect()
    assert f["path"] == line["source_file"]


def test_featurize_files_job_metrics_and_table(spark, tmp_path, tmpuri):
    from rectext.plans.jobs import featurize_files
    root = str(tmp_path)
    _write(root, "a.json", '{"m":"x","label":"benign","timestamps":[1]}\n{bad\n'
                           '{"m":"y","@timestamp":"nope"}\n{"m":"z"}\n')
    _write(root, "sub/b.ndjson", '{"m":"w","timestamps":[2]}\n')
    feats, audit, metrics = featurize_files(spark, root, out=tmpuri, fmt="table")
    m = metrics.get
    assert (m["n_records"], m["n_errors"], m["n_without_timestamp"]) == (4, 1, 1)
    table_rows = sorted((r["text_representation"], r["label"]) for r in read_table(spark, tmpuri).collect())
    assert table_rows == [("", None), ("[m] w", None), ("[m] x", "benign"), ("[m] z", None)]
    aud = {os.path.basename(r["source_file"]): r for r in audit.collect()}
    assert (aud["a.json"]["n_records"], aud["a.json"]["n_corrupt"], aud["a.json"]["n_errors"]) == (3, 1, 1)
    assert aud["b.ndjson"]["is_empty"] is False


def test_import_insert_ignore_twice(spark, tmp_path, tmpuri):
    from rectext.plans.jobs import import_documents
    src = tmp_path / "in"
    src.mkdir()
    (src / "c.json").write_text('{"_id":"1","v":1}\n{"_id":"2","v":2}\n{"v":3}\n')
    first = {r["file"]: r for r in import_documents(spark, str(src), tmpuri, drop_existing=False).collect()}
    assert (first["c.json"]["inserted"], first["c.json"]["total_in_collection"]) == (3, 3)
    again = {r["file"]: r for r in import_documents(spark, str(src), tmpuri, drop_existing=False).collect()}
    # keyed rows are ignored the second time, the row without _id is new again
    assert (again["c.json"]["inserted"], again["c.json"]["total_in_collection"]) == (1, 4)


def test_named_files_and_arrays(spark, tmpuri):
    import json

    from rectext.plans.inputs import write_array_files
    from rectext.sinks.files import write_named_lines
    df = spark.range(0, 30).select(F.col("id"), (F.col("id") % 3).cast("string").alias("g"),
                                   F.concat(F.lit('x"'), F.col("id").cast("string")).alias("s"))
    summary = write_array_files(df.select("id", "s", "g"), tmpuri, F.concat(F.lit("sub/a"), F.col("g"), F.lit(".json")),
                                "id").collect()
    assert sorted((r["name"], r["n_lines"]) for r in summary) == [("sub/a0.json", 10), ("sub/a1.json", 10),
                                                                  ("sub/a2.json", 10)]
    with open(os.path.join(local_path(tmpuri), "sub", "a1.json")) as f:
        recs = json.load(f)
    assert [r["id"] for r in recs] == list(range(1, 30, 3)) and recs[0]["s"] == 'x"1'
    write_named_lines(df.select(F.lit("l.txt").alias("name"), F.col("s").alias("value"), "id"),
                      tmpuri, order_cols=["id"]).collect()
    with open(os.path.join(local_path(tmpuri), "l.txt")) as f:
        assert f.read().splitlines() == [f'x"{i}' for i in range(30)]


def test_import_keeps_unpruned_record_text(spark, tmp_path, tmpuri):
    from rectext.plans.jobs import import_documents
    src = tmp_path / "in"
    src.mkdir()
    (src / "n.json").write_text('{"a":1.0,"b":"x"}\n{"a":2.0,"z":null}\n[{"a":3.0}]\n')
    import_documents(spark, str(src), tmpuri).collect()
    texts = sorted(r["value"] for r in read_collections(spark, tmpuri).collect())
    assert texts == ['{"a":1.0,"b":"x"}', '{"a":2}', '{"a":3}']


def test_missing_folder_is_an_error(spark, tmp_path, tmpuri):
    import pytest
    from pyspark.errors import AnalysisException

    from rectext.plans.jobs import import_documents
    with pytest.raises(AnalysisException):
        import_documents(spark, str(tmp_path / "nope"), tmpuri)
    with pytest.raises(AnalysisException):
        discover_files(spark, str(tmp_path / "nope")).collect()


def test_rebalance_only_with_aqe(spark):
    from rectext.sinks.writers import rebalanced
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    assert "RebalancePartitions" in rebalanced(df, "k")._jdf.queryExecution().analyzed().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert rebalanced(df, "k") is df
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_featurize_files_clears_emptied_sources(spark, tmp_path, tmpuri):
    from rectext.plans.jobs import featurize_files
    root = str(tmp_path)
    for fmt, read in (("csv", read_csv_by_key), ("table", read_table)):
        for name in "abcd":
            _write(root, f"{name} 1.json", f'{{"m":"{name}"}}\n')
        out = f"{tmpuri}/{fmt}"
        featurize_files(spark, root, out=out, fmt=fmt)
        assert sorted(r[0] for r in read(spark, out).collect()) == ["[m] a", "[m] b", "[m] c", "[m] d"]
        _write(root, "a 1.json", '{"m":"new"}\n')
        _write(root, "b 1.json", "")                   # 0 bytes
        _write(root, "c 1.json", "{broken\n")
        os.remove(os.path.join(root, "d 1.json"))      # not in the batch: its rows stay
        _, _, metrics = featurize_files(spark, root, out=out, fmt=fmt)
        assert sorted(r[0] for r in read(spark, out).collect()) == ["[m] d", "[m] new"]
        assert metrics.get["n_records"] == 1


def test_audit_names_files_without_records(spark, tmp_path):
    import gzip

    from rectext.plans.jobs import featurize_files
    root = str(tmp_path)
    _write(root, "a.json", '{"a":1}\n')
    _write(root, "sub/blank.json", "\n \n")
    _write(root, "none.json", "")
    with open(os.path.join(root, "cut.json.gz"), "wb") as f:
        f.write(gzip.compress(b'{"a":4}\n' * 1000)[:20])         # unreadable
    _, audit, _ = featurize_files(spark, root, glob="*", ignore_corrupt_files=True)
    rows = {os.path.basename(r["source_file"]): (r["n_records"], r["is_empty"]) for r in audit.collect()}
    assert rows == {"a.json": (1, False), "blank.json": (0, True), "none.json": (0, True), "cut.json.gz": (0, True)}


def test_named_lines_join_a_few_mb_at_once(spark, tmpuri, monkeypatch):
    from rectext.sinks import files
    assert files.WRITE_BYTES <= 8 << 20            # what a writer copies, whatever a batch holds
    rows = [(i, f"d/{i % 3}.txt", None if i == 7 else "é" * (i * 37 % 400)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, name string, value string").repartition(4)
    files_before = files.WRITE_BYTES
    for size in (files_before, 100):
        monkeypatch.setattr(files, "WRITE_BYTES", size)
        root = f"{tmpuri}/{size}"
        done = files.write_named_lines(df, root, order_cols=["id"], header="<", footer=">", separator=",").collect()
        assert sorted(map(tuple, done)) == [("d/0.txt", 67), ("d/1.txt", 67), ("d/2.txt", 66)]
        for k in range(3):
            with open(os.path.join(local_path(root), "d", f"{k}.txt"), encoding="utf-8") as f:
                assert f.read() == "<" + ",".join(v or "" for _, n, v in rows if n == f"d/{k}.txt") + ">"
    # rows without a name belong to no file
    some = df.withColumn("name", F.when(F.col("id") % 2 == 0, F.col("name")))
    done = files.write_named_lines(some, tmpuri + "/some", order_cols=["id"]).collect()
    assert sorted(map(tuple, done)) == [("d/0.txt", 34), ("d/1.txt", 33), ("d/2.txt", 33)]
    assert files.write_named_lines(df.withColumn("name", F.lit(None).cast("string")), tmpuri + "/none").collect() == []
