"""Line parsing (R1-R3), cleaning (P1, P4-P6) and their properties."""

import random

from pyspark.sql import functions as F

from rectext.operators.features import featurize
from rectext.operators.records import (CORRUPT_COL, drop_all_null, drop_corrupt, parse_lines,
                                       prune_nulls_json, prune_nulls_variant, stringify_ids)

EVENT = '{"@timestamp":"2024-01-02T03:04:05.678Z","event_id":1,"label":"dirb","m":"x"}'
CORRUPT = ["{bad", "3", '"x": 1', "{}", '{"a":1,"a":2}', EVENT[:-5]]


def _lines(spark, values):
    return spark.createDataFrame([(v, "f.json") for v in values], "value string, source_file string")


def test_corrupt_lines(spark):
    rows = parse_lines(_lines(spark, CORRUPT)).collect()
    assert len(rows) == len(CORRUPT)
    assert all(r["v"] is None for r in rows)
    assert sorted(r[CORRUPT_COL] for r in rows) == sorted(CORRUPT)


def test_accepted_blank_and_array_lines(spark):
    vals = ['{"a":1} junk', "", "   ", '[{"_id":"c"},{"_id":"d"}]', EVENT]
    rows = parse_lines(_lines(spark, vals)).collect()
    assert len(rows) == 4                       # blanks dropped, array exploded into two
    assert all(r["v"] is not None for r in rows)
    ids = sorted(r["v"].toJson() for r in rows)
    assert '{"_id":"c"}' in ids and '{"_id":"d"}' in ids and '{"a":1}' in ids


def test_valid_plus_corrupt_equals_nonblank_lines(spark):
    rnd = random.Random(7)
    vals = [rnd.choice([EVENT, *CORRUPT, "", '{"k":[1,2]}']) for _ in range(300)]
    recs = parse_lines(_lines(spark, vals))
    n_valid = recs.filter(F.col("v").isNotNull()).count()
    n_corrupt = recs.filter(F.col(CORRUPT_COL).isNotNull()).count()
    assert n_valid + n_corrupt == sum(1 for v in vals if v.strip())
    assert drop_corrupt(recs).count() == n_valid
    assert CORRUPT_COL not in drop_corrupt(recs).columns


def test_permuting_lines_keeps_output_multiset(spark):
    rnd = random.Random(3)
    vals = [f'{{"n":{i},"label":"x{i % 3}","timestamps":[{i}.5],"s":{{"a":{i}}}}}' for i in range(200)]
    shuffled = vals[:]
    rnd.shuffle(shuffled)
    a = featurize(_lines(spark, vals)).collect()
    b = featurize(_lines(spark, shuffled).repartition(5)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert not any("[label]" in r["text_representation"] for r in a)


def test_drop_all_null_treats_nan_as_null(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, float("nan")), (3, "x", None)],
                               "id long, a string, b double")
    kept = drop_all_null(df, ["a", "b"]).select("id").collect()
    assert sorted(r["id"] for r in kept) == [3]


def test_prune_nulls(spark):
    df = spark.createDataFrame([(None, 1.5, "x"), (2, float("nan"), None)], "a long, b double, c string")
    got = [r[0] for r in df.select(prune_nulls_json(df)).collect()]
    assert got == ['{"b":1.5,"c":"x"}', '{"a":2}']
    v = spark.createDataFrame([('{"a":null,"b":1,"c":{"d":null}}',)], "j string")
    out = v.select(prune_nulls_variant(F.parse_json("j"))).first()[0]
    assert out == '{"b":1,"c":{"d":null}}'      # top-level only, as the import cleans records


def test_stringify_ids(spark):
    src = ('{"_id":{"$oid":"abc"},"l":[{"$oid":"d"},{"x":{"$oid":"e"}}],'
           '"s":"{\\"$oid\\":\\"f\\"}","n":100.0,"o":{"$oid":"g","more":1}}')
    df = spark.createDataFrame([(src,)], "j string")
    out = df.select(stringify_ids(F.col("j"))).first()[0]
    assert out == ('{"_id":"abc","l":["d",{"x":"e"}],"s":"{\\"$oid\\":\\"f\\"}","n":100.0,'
                   '"o":{"$oid":"g","more":1}}')


def test_long_ids_and_runs_of_blanks_take_linear_time(spark):
    import time
    from pyspark.sql import functions as F
    from rectext.operators.features import tokens, truncate_tokens
    from rectext.operators.records import stringify_ids
    n = 100_000
    rows = [('{"a": {"$oid": "' + "x" * n + '"}}',), ('{"a": {"$oid": "' + '\\"' * n + '"}}',), ('{"a": {"$oid": "' + "x" * n,)]
    began = time.time()
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(stringify_ids(F.col("t"))).collect()]
    assert got == ['{"a": "' + "x" * n + '"}', '{"a": "' + '\\"' * n + '"}', rows[2][0]]
    blanks = spark.createDataFrame([("a" + " " * n + "b",), (" " * n + "a" + "\n" * n,), (" " * n,)], "t string")
    got = blanks.select(tokens(F.col("t")), truncate_tokens(F.col("t"), 1)).collect()
    assert [tuple(r) for r in got] == [(["a", "b"], ["a"]), (["a"], ["a"]), ([""], [""])]
    assert time.time() - began < 15
