"""The typed fast path of J1 follows the same rules as the variant path."""

import pytest
from pyspark.sql import functions as F

from rectext.operators.features import featurize, featurize_typed

SCHEMA = ("id long, `@timestamp` string, m string, label string, "
          "sub struct<a: long, label: string, timestamps: array<double>>, timestamps array<string>")

ROWS = [
    # id, @timestamp, m, label, sub, timestamps
    (1, "2024-01-02T03:04:05.678Z", "x", "benign", (1, "k", None), None),
    (2, "bad", "x", "dirb", (1, "k", None), None),
    (3, "2024-01-02T03:04:05.5Z", "y", None, (2, None, [9.0]), ["2.5"]),
    (4, "2024-01-02T03:04:05.5Z", "y", "z", (2, None, [9.0]), ["x"]),
    (5, "2024-01-02T03:04:05.5Z", None, "z", None, []),
]


@pytest.fixture(scope="module")
def typed(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return {r["id"]: r for r in featurize_typed(df, keep=["id"]).collect()}


def test_declared_order_and_nested(typed):
    assert typed[1]["text_representation"] == "[m] x [sub] {[a] 1}"
    assert typed[1]["timestamp"] is None          # the last candidate (timestamps) is null
    assert typed[1]["label"] == "benign"


def test_bad_iso_is_error_row(typed):
    r = typed[2]
    assert (r["text_representation"], r["timestamp"], r["label"]) == ("", None, None)


def test_last_candidate_and_numeric_string(typed):
    assert typed[3]["timestamp"] == 2.5
    assert typed[3]["text_representation"] == "[m] y [sub] {[a] 2}"
    assert (typed[4]["text_representation"], typed[4]["timestamp"]) == ("", None)
    assert typed[5]["timestamp"] is None
    assert typed[5]["text_representation"] == "[m] None [sub] None"


def test_typed_equals_variant_on_complete_records(spark):
    lines = [
        '{"a":1,"b":"x","label":"l1","s":{"c":true,"timestamps":[3]},"t":1.5}',
        '{"a":2,"b":"y","label":"l2","s":{"c":false,"timestamps":[4]},"t":100.0}',
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    variant = sorted(map(tuple, featurize(df.withColumn("source_file", F.lit("f"))).drop("source_file").collect()))
    typed_df = df.select(F.from_json("value", "a long, b string, label string, "
                                              "s struct<c: boolean, timestamps: array<double>>, t double").alias("r")
                         ).select("r.*")
    typed = sorted(map(tuple, featurize_typed(typed_df).collect()))
    assert typed == variant
