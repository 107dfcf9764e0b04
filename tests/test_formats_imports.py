"""Array files, formats by first line, keys per collection, replacing loads."""

import json

from pyspark.sql import functions as F

from rectext.operators.features import featurize
from rectext.plans.jobs import featurize_files, import_documents
from rectext.sinks.writers import read_collections
from rectext.sources.json_files import scan_json_array, scan_json_auto


def _values(df, path="$.id"):
    return sorted(r[0] for r in df.select(F.try_variant_get("v", path, "int")).collect())


def test_indented_array_with_one_line_objects_inside(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n  {"id": 1, "in": [\n    {"q":10},\n    {"q":11}\n  ]},\n  {"id": 2,\n   "in": []}\n]\n')
    recs = scan_json_auto(spark, str(tmp_path))
    assert _values(recs) == [1, 2]
    assert {r["format"] for r in recs.select("format").collect()} == {"array"}


def test_mixed_one_line_and_indented_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"id":1},\n{\n"id":2\n}]')
    (tmp_path / "b.json").write_text('{\n  "id": 3\n}')
    (tmp_path / "c.json").write_text('{"id":4}\n[{"id":5},{"id":6}]\nbroken\n')
    assert _values(scan_json_auto(spark, str(tmp_path))) == [1, 2, 3, 4, 5, 6]


def test_file_names_with_pattern_characters(spark, tmp_path):
    (tmp_path / "a[1].json").write_text('[\n{"id":1}\n]')
    (tmp_path / "a1.json").write_text('{"id":2}\n')
    (tmp_path / "b{x}.json").write_text('[\n{"id":3}\n]')
    assert _values(scan_json_auto(spark, str(tmp_path))) == [1, 2, 3]


def test_large_array_keeps_every_record(spark, tmp_path):
    pad = "x" * 1_000_000
    with open(tmp_path / "big.json", "w") as f:
        f.write("[\n" + ",\n".join(json.dumps({"id": i, "p": pad}) for i in range(140)) + "\n]\n")
    assert _values(scan_json_auto(spark, str(tmp_path))) == list(range(140))


def test_array_items_keep_number_form(spark, tmp_path):
    p = tmp_path / "n.json"
    p.write_text('[{"id":1,"x":100.0},{"id":2,"x":2.50}]')
    raw = [r["_raw"] for r in scan_json_array(spark, str(p), keep_raw=True).select("_raw").collect()]
    assert raw == ['{"id":1,"x":100.0}', '{"id":2,"x":2.5}']


def test_featurize_files_takes_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n    {\n        "a": 1\n    },\n    {\n        "a": 2\n    }\n]')
    features, audit, _ = featurize_files(spark, str(tmp_path))
    assert sorted(r[0] for r in features.select("text_representation").collect()) == ["[a] 1", "[a] 2"]
    assert [(r["n_records"], r["n_corrupt"]) for r in audit.collect()] == [(2, 0)]


def test_ids_are_unique_per_collection(spark, tmp_path, tmpuri):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.json").write_text('{"_id":"1","x":2}\n{"_id":"1","x":1}\n{"x":9}\n{"x":9}\n')
    (src / "b.json").write_text('{"_id":"1","x":3}\n')
    for drop in (True, False):
        got = {r["file"]: (r["attempted"], r["inserted"], r["total_in_collection"])
               for r in import_documents(spark, str(src), f"{tmpuri}/{drop}", drop_existing=drop).collect()}
        assert got == {"a.json": (4, 3, 3), "b.json": (1, 1, 1)}
        stored = sorted((r["collection"], r["value"]) for r in read_collections(spark, f"{tmpuri}/{drop}").collect())
        assert stored == [("a", '{"_id":"1","x":1}'), ("a", '{"x":9}'), ("a", '{"x":9}'), ("b", '{"_id":"1","x":3}')]


def test_emptied_file_clears_its_collection(spark, tmp_path, tmpuri):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.json").write_text('{"x":1}\n')
    (src / "b.json").write_text('{"x":2}\n')
    import_documents(spark, str(src), tmpuri + "/t").collect()
    (src / "a.json").write_text("\n")
    got = {r["file"]: (r["attempted"], r["inserted"], r["total_in_collection"]) for r in import_documents(spark, str(src), tmpuri + "/t").collect()}
    assert got == {"a.json": (0, 0, 0), "b.json": (1, 1, 1)}
    assert [r["collection"] for r in read_collections(spark, tmpuri + "/t").collect()] == ["b"]


def test_building_featurize_over_a_shuffle_starts_no_job(spark):
    lines = spark.range(100).select(F.concat(F.lit('{"a":'), F.col("id").cast("string"), F.lit("}")).alias("value"), F.lit("f").alias("source_file"))
    shuffled = lines.groupBy("value", "source_file").count().drop("count")
    sc = spark.sparkContext
    sc.setJobGroup("building", "building")
    try:
        df = featurize(shuffled)
        assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
        assert df.count() == 100
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_format_list_of_booleans_and_doubles(spark):
    from rectext.functions.render import format_list
    df = spark.createDataFrame([([True, None, False], [1e-5, 12345678.0])], "b array<boolean>, d array<double>")
    assert tuple(df.select(format_list(F.col("b")), format_list(F.col("d"))).first()) == ("True, None, False", "1e-05, 12345678.0")
