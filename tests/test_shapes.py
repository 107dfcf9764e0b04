"""Rendering by shape gives what the walk over the fields gives."""

import json
import random

from pyspark.sql import functions as F

from rectext.functions.render import render_records
from rectext.functions.shapes import common_shapes, parse_shape, render_shaped, renderable, shape_of


def scalar(rnd):
    return rnd.choice([None, True, False, 0, -7, 2**40, 10**25, 1.0, 100.0, 2.5, 1e-7, 1e300, 123456789.125, "", "text", "ä \"q\" \\", "2024-01-02T03:04:05.678Z", "17"])


def record(rnd):
    names = ["a", "B", "label", "Label", "timestamps", "@timestamp", "@TIMESTAMP", "obj", "x y", "d.ot", "back`tick", "quo'te", "co: lon, <x>", "é"]
    out = {}
    for n in rnd.sample(names, rnd.randrange(1, 7)):
        k = rnd.randrange(6)
        if n.lower() == "@timestamp" and rnd.random() < 0.7:
            out[n] = "2024-01-02T03:04:05.678Z"
        elif k < 3:
            out[n] = scalar(rnd)
        elif k == 3:
            out[n] = [scalar(rnd) for _ in range(rnd.randrange(3))]
        else:
            out[n] = {m: rnd.choice([scalar(rnd), [1, "x"], {"deep": [None]}]) for m in rnd.sample(["timestamps", "label", "k", "z`", "@timestamp"], rnd.randrange(4))}
    return out


def rows(df):
    return sorted(map(repr, df.collect()))


def test_shaped_equals_walked(spark):
    rnd = random.Random(8)
    texts = [json.dumps(record(rnd), ensure_ascii=False) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "i long, t string").select("i", F.try_parse_json("t").alias("v")).repartition(4)
    want = rows(render_records(df, keep=["i"], with_error=True))
    every = [r[0] for r in df.select(shape_of(F.col("v"))).distinct().orderBy(shape_of(F.col("v"))).collect()]
    usable = [s for s in every if renderable(s)]
    assert len(usable) > 300
    for at in (0, 200):                            # a few shapes at a time, all others by the walk
        assert rows(render_shaped(df, usable[at:at + 3], keep=["i"], with_error=True)) == want
    assert rows(render_shaped(df, [], keep=["i"], with_error=True)) == want


def test_common_shapes_of_a_batch(spark):
    texts = ['{"a":1,"x":1.5}'] * 30 + ['{"a":2,"x":22.25}'] * 30 + ['{"a":null}'] * 20 + ['{"a":1,"b":2}'] * 5 + ["{}", "3", "bad"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.try_parse_json("t").alias("v"))
    assert common_shapes(df) == ["OBJECT<a: BIGINT, x: DOUBLE>", "OBJECT<a: VOID>", "OBJECT<a: BIGINT, b: BIGINT>"]
    assert common_shapes(df.limit(0)) == []


def test_parse_shape():
    assert parse_shape("OBJECT<`@t`: STRING, a: OBJECT<`x, y`: ARRAY<BIGINT>, z: DECIMAL(4,1)>, `b``c: <`: VOID>") == [
        ("@t", "STRING"), ("a", "OBJECT<`x, y`: ARRAY<BIGINT>, z: DECIMAL(4,1)>"), ("b`c: <", "VOID")]
    assert parse_shape("BIGINT") is None and parse_shape("OBJECT<>") == []
