"""Label codes (M1), token cut (M3), embedding (M2), the batch hook
and plan properties of the featurize job."""

import math

import pytest
from pyspark.sql import functions as F

from rectext.operators.embed import embed_text, map_batches
from rectext.operators.features import encode_label, featurize, truncate_tokens
from rectext.plans.inputs import event_lines


def test_encode_label(spark):
    df = spark.createDataFrame([("benign",), ("reverse_shell",), ("cracking",), ("other",), (None,)], "l string")
    assert [r[0] for r in df.select(encode_label(F.col("l"))).collect()] == [0, 7, 10, None, None]


def test_truncate_tokens(spark):
    text = " ".join(f"w{i}" for i in range(600))
    df = spark.createDataFrame([("\n " + text + " \t",), ("a  b",)], "t string")
    got = [r[0] for r in df.select(truncate_tokens(F.col("t"))).collect()]
    assert len(got[0]) == 510 and got[0][0] == "w0" and got[0][-1] == "w509"
    assert got[1] == ["a", "b"]


def test_embed_text_default(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "zzz yyy")], "id long, text string")
    rows = {r["id"]: r["embedding"] for r in embed_text(df, "text", dim=16).collect()}
    assert len(rows[1]) == 16
    assert rows[1] == rows[2]
    assert rows[1] != rows[3]
    assert math.isclose(sum(x * x for x in rows[3]), 1.0, rel_tol=1e-5)


def test_embed_text_custom_model(spark):
    import numpy as np

    def make_predict_fn():
        def predict(texts):
            return np.array([[len(t), t.count(" ")] for t in texts], dtype=np.float32)
        return predict

    df = spark.createDataFrame([(1, "a b c"), (2, "x")], "id long, text string")
    rows = {r["id"]: r["embedding"] for r in embed_text(df, "text", make_predict_fn=make_predict_fn).collect()}
    assert rows == {1: [5.0, 2.0], 2: [1.0, 0.0]}


def test_map_batches(spark):
    df = spark.range(10).select(F.col("id"))
    out = map_batches(df, lambda pdf: pdf.assign(sq=pdf["id"] ** 2), "id long, sq long")
    assert sorted(r["sq"] for r in out.collect()) == [i * i for i in range(10)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_featurize_plan_is_narrow_and_jvm_only(spark):
    """No Python worker anywhere, and no exchange once the input already has
    enough partitions (the normal case at scale)."""
    lines = event_lines(spark, "/root/testdata/sf0.001").select("value", "source_file")
    many = lines.repartition(spark.sparkContext.defaultParallelism * 2)
    base_exchanges = _plan(many).count("Exchange")
    plan = _plan(featurize(many))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonUDF"):
        assert node not in plan
    assert plan.count("Exchange") == base_exchanges


def test_featurize_source_file_scan_pushes_nothing_extra(spark, tmpuri):
    """Text scan reads only the value column and the file path."""
    from rectext.sources.json_files import read_lines
    spark.createDataFrame([('{"a":1}',)], "value string").write.text(tmpuri)
    plan = _plan(featurize(read_lines(spark, tmpuri)))
    assert "FileScan text" in plan


@pytest.mark.parametrize("kind", ["plain", "bad_iso", "nested_ts", "damaged"])
def test_event_line_kinds_parse(spark, kind):
    lines = event_lines(spark, "/root/testdata/sf0.001", kind)
    n = lines.count()
    feats = featurize(lines).count()
    assert n == 1000 and feats == (900 if kind == "damaged" else 1000)


def test_chunked_names_agree_with_sql(spark):
    import duckdb

    from rectext.plans.inputs import chunked, chunked_sql
    ids = list(range(0, 50, 3))
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    got = sorted(r[0] for r in df.select(chunked(F.lit("f"), ".json", F.col("k"), 10)).collect())
    sql = f"SELECT {chunked_sql(chr(39) + 'f' + chr(39), '.json', 'k', 10)} FROM range(0, 50, 3) t(k)"
    want = sorted(r[0] for r in duckdb.sql(sql).fetchall())
    assert got == want and "f.json" in got and "f-4.json" in got


def test_spread_only_when_too_few_partitions(spark):
    from rectext.session import spread
    n = spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, numPartitions=n * 2)
    assert spread(many) is many
    one = spark.range(0, 100, numPartitions=1)
    spread_one = spread(one)
    assert spread_one.rdd.getNumPartitions() == n
    assert sorted(r[0] for r in spread_one.collect()) == list(range(100))
