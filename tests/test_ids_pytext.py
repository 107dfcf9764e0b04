"""Typed object ids against a walk in Python, and Python's text of nested values."""

import json
import random

from pyspark.sql import functions as F

from rectext.functions.pytext import py_repr, py_text, py_text_of_json
from rectext.operators.ids import stringify_typed_ids


def strings(x):
    if isinstance(x, dict):
        return x["$oid"] if set(x) == {"$oid"} else {k: strings(y) for k, y in x.items()}
    return [strings(y) for y in x] if isinstance(x, list) else x


def test_ids_of_any_depth(spark):
    oid = lambda i: {"$oid": f"{i:024d}"}
    rows = [{"_id": oid(i), "n": i, "refs": [oid(i + 1), None, oid(i + 2)], "deep": {"a": {"b": [[oid(5)], []], "c": [{"x": oid(6), "$oid": "own"}]}}, "none": None if i % 2 else oid(7)} for i in range(20)]
    rows.append({"_id": None, "n": None, "refs": None, "deep": {"a": None}, "none": None})
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "t string")
    schema = ("_id struct<`$oid`:string>, n long, refs array<struct<`$oid`:string>>, none struct<`$oid`:string>, "
              "deep struct<a:struct<b:array<array<struct<`$oid`:string>>>,c:array<struct<x:struct<`$oid`:string>,`$oid`:string>>>>")
    typed = df.select(F.from_json("t", schema).alias("r")).select("r.*")
    out = stringify_typed_ids(typed)
    got = [json.loads(r[0]) for r in out.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()]
    want = [strings(r) for r in rows]
    assert got == want
    assert out.schema["deep"].dataType.simpleString() == "struct<a:struct<b:array<array<string>>,c:array<struct<x:string,$oid:string>>>>"
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    maps = spark.sql("select map('k', named_struct('$oid', 'v'), 'n', null) m, 1 `a.b`")
    assert [tuple(r) for r in stringify_typed_ids(maps).collect()] == [({"k": "v", "n": None}, 1)]


def value(rnd, depth=0):
    kind = rnd.randrange(9 if depth < 4 else 5)
    if kind < 2:
        return rnd.choice([0, -3, 10**30, 1.0, 100.0, 2.5, 1e-7, -0.0, 1e16, 123456.789, True, False, None])
    if kind < 5:
        return "".join(rnd.choice("ab'\"\\\n\t\r\x07\x7f\xa0\xad\u200b\u2028 é日,:{}[]\U0001F600") for _ in range(rnd.randrange(8)))
    if kind < 7:
        return {f"k'{i}\""[:rnd.randrange(1, 5)] + str(i): value(rnd, depth + 1) for i in range(rnd.randrange(4))}
    return [value(rnd, depth + 1) for _ in range(rnd.randrange(4))]


def test_python_text_of_nested_values(spark):
    rnd = random.Random(9)
    values = [value(rnd) for _ in range(400)] + [{"a": [{"b": {"c": [None, True, "x'y", 'q"r', "both'\""]}}]}, [], {}, [[]], "it's"]
    for ascii_only in (False, True):
        df = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=ascii_only)) for i, v in enumerate(values)], "i long, t string").repartition(3)
        got = dict(map(tuple, df.select("i", py_text_of_json(F.col("t"))).collect()))
        for i, v in enumerate(values):
            assert got[i] == repr(v), (v, got[i])
    assert spark.createDataFrame([("{bad",), (None,)], "t string").select(py_text_of_json(F.col("t")).alias("x")).filter("x is not null").count() == 0


def test_python_text_of_variants_and_strings(spark):
    df = spark.createDataFrame([('{"b": [1, {"c": "d"}], "a": null}',)], "t string")
    assert df.select(py_text(F.parse_json("t"))).first()[0] == "{'a': None, 'b': [1, {'c': 'd'}]}"
    assert df.select(py_repr(F.lit("a\\'"))).first()[0] == repr("a\\'")
