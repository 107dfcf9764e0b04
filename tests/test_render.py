"""Hand-written records and their expected feature rows (rules R1-R12, T1-T7)."""

import pytest
from pyspark.sql import functions as F

from rectext.operators.features import featurize

# (record line, text_representation, timestamp, label)
CASES = [
    ('{"b":"x","a":1,"label":"benign"}', "[a] 1 [b] x", None, "benign"),
    ('{"ids":["p","q"],"timestamps":[1.5,2]}', "[ids] p, q", 1.5, None),
    ('{"@timestamp":"2024-01-02T03:04:05.678Z","m":"x"}', "[m] x", 1704164645.678, None),
    ('{"sub":{"b":true,"a":null,"label":"k","timestamps":[9]},"z":"x"}', "[sub] {[a] None [b] True} [z] x", 9.0, None),
    ('{"Label":"k","label":"dirb","n":100.0}', "[n] 100.0", None, "dirb"),
    ('{"emp":{},"l":[],"nul":null}', "[emp] {} [l]  [nul] None", None, None),
    ('{"@timestamp":"bad","m":"x","label":"dirb"}', "", None, None),
    ('{"@timestamp":"2024-01-02T03:04:05Z","m":"x"}', "", None, None),
    ('{"@timestamp":"2024-01-02T03:04:05.0Z","timestamps":[7]}', "", 7.0, None),
    ('{"sub":{"@timestamp":"t"},"timestamps":"5"}', "[sub] {[@timestamp] t}", None, None),
    ('{"timestamps":["2.5"],"m":1}', "[m] 1", 2.5, None),
    ('{"timestamps":["x"],"m":1}', "", None, None),
    ('{"timestamps":[],"m":1}', "[m] 1", None, None),
    ('{"a":{"timestamps":[3]},"timestamps":null}', "[a] {}", None, None),
    ('{"timestamps":5,"label":7}', "", 5.0, "7"),
    ('{"n":12345678901234567890}', "[n] 12345678901234567890", None, None),
    ('{"l":[{"q":1}]}', '[l] {"q":1}', None, None),
    # extra cases
    ('{"f":6.55,"z":-0.0,"t":false,"s":"a b"}', "[f] 6.55 [s] a b [t] False [z] 0.0", None, None),
    ('{"x":[1,null,true,"s",[2]]}', "[x] 1, None, True, s, [2]", None, None),
    ('{"@TIMESTAMP":"2024-01-02t03:04:05.5z","k":1}', "[k] 1", 1704164645.5, None),
    ('{"@timestamp":null,"k":1}', "", None, None),
    ('{"@timestamp":"2024-02-30T03:04:05.5Z","k":1}', "", None, None),
    ('{"a":{"x":{"y":1}},"b":1e-05,"c":1e20,"d":12345678.5}',
     '[a] {[x] {"y":1}} [b] 1e-05 [c] 1e+20 [d] 12345678.5', None, None),
    ('{"a":0.00001,"b":2.50,"c":12345678901234567.5,"d":0.1234567890123456789,"e":100000000000000000.0}',
     "[a] 1e-05 [b] 2.5 [c] 1.2345678901234568e+16 [d] 0.12345678901234568 [e] 1e+17", None, None),
    ('{"timestamps":[null,1]}', "", None, None),
    ('{"timestamps":[true]}', "", 1.0, None),
    ('{"timestamps":[{"a":1}],"k":1}', "", None, None),
    ('{"m":{"timestamps":[4]},"n":{"timestamps":[5]},"o":1}', "[m] {} [n] {} [o] 1", 5.0, None),
    ('{"label":{"a":1},"k":"v"}', "[k] v", None, '{"a":1}'),
]


@pytest.fixture(scope="module")
def rendered(spark):
    df = spark.createDataFrame([(i, line, "f.json") for i, (line, *_r) in enumerate(CASES)],
                               "id long, value string, source_file string")
    out = featurize(df, keep=["id", "source_file"]).orderBy("id").collect()
    return {r["id"]: r for r in out}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(rendered, i):
    line, text, ts, label = CASES[i]
    r = rendered[i]
    assert r["text_representation"] == text, line
    if ts is None:
        assert r["timestamp"] is None, line
    else:
        assert r["timestamp"] == pytest.approx(ts, abs=1e-9), line
    assert r["label"] == label, line
    assert r["source_file"] == "f.json"
