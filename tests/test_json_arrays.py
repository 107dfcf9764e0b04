"""Array files cut by many tasks, against Python's own reader."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rectext.operators.records import CORRUPT_COL
from rectext.sources.json_arrays import FIRST, INSIDE, LAST, WHOLE, Cutter, array_items, scan_json_array_split
from rectext.sources.json_files import scan_json_array, scan_json_auto


def value(rnd, depth=0):
    kind = rnd.randrange(8 if depth < 3 else 5)
    if kind == 0:
        return rnd.choice([1, -2.5, True, None, 10**15])
    if kind < 5:
        return "".join(rnd.choice('ab]}[{,:"\\\n\té ') for _ in range(rnd.randrange(12)))
    if kind < 7:
        return {f"k{i}{rnd.choice('[]{}, ')}": value(rnd, depth + 1) for i in range(rnd.randrange(4))}
    return [value(rnd, depth + 1) for _ in range(rnd.randrange(4))]


def items_of(df):
    return sorted(json.dumps(json.loads(r["value"]), sort_keys=True) for r in df.collect())


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed", range(4))
def test_items_of_all_layouts(spark, tmp_path, small_splits, seed):
    rnd, want = random.Random(seed), []
    for f in range(6):
        items = [{f"id{f}": i, "v": value(rnd)} for i in range(rnd.choice([0, 1, 7, 120]))]
        if f == 3:
            items = [{"big": [value(rnd) for _ in range(900)]}, *items]           # one item over many splits
        text = [json.dumps(items, indent=4), json.dumps(items, indent=1, ensure_ascii=False), "[\n" + ",\n".join(map(json.dumps, items)) + "\n]",
                json.dumps(items, indent=4), " \n\n[" + "\n,\n".join(json.dumps(x, indent=2) for x in items) + "]\n \n", json.dumps({"one": items}, indent=4)][f]
        (tmp_path / f"f{f}.json").write_text(text)
        want += [{"one": items}] if f == 5 else items
    paths = [str(tmp_path / f"f{f}.json") for f in range(6)]
    assert items_of(array_items(spark, paths)) == sorted(json.dumps(x, sort_keys=True) for x in want)
    assert spark.read.text(paths).rdd.getNumPartitions() > 6


def test_split_scan_equals_whole_file_scan(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "x": 100.0, "t": "a\nb"} for i in range(300)], indent=4))
    split, whole = scan_json_array_split(spark, str(tmp_path / "a.json")), scan_json_array(spark, str(tmp_path / "a.json"))
    text = lambda df: sorted(r[0] for r in df.select(F.to_json("v")).collect())
    assert text(split) == text(whole) and len(text(split)) == 300
    assert split.filter(F.col(CORRUPT_COL).isNotNull()).count() == 0


@pytest.mark.parametrize("text, n, damage", [("[\n1,\n{\"a\":1}\n", 0, 1), ("[\n{\"a\":1},\n]", 1, 1), ("[\n{\"a\":1}\n] tail", 1, 1), ("[\n{\"a\":1},,\n{\"a\":2}]", 2, 1), ("[\n]", 0, 0), ("\n \n", 0, 0)])
def test_damage_is_told_and_other_items_stay(spark, tmp_path, text, n, damage):
    (tmp_path / "a.json").write_text(text)
    got = scan_json_array_split(spark, str(tmp_path / "a.json")).collect()
    assert sum(r["v"] is not None for r in got) == n and sum(r["v"] is None and r[CORRUPT_COL] == "" for r in got) == damage


def test_damaged_arrays_are_read_line_by_line_by_the_auto_scan(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"id":1}\n{"id":2}\n]')
    (tmp_path / "b.json").write_text('[\n{"id":3},\n{"id":4}\n]')
    got = sorted((r["format"], r["i"]) for r in scan_json_auto(spark, str(tmp_path)).select("format", F.try_variant_get("v", "$.id", "int").alias("i")).collect())
    assert got == [("array", 3), ("array", 4), ("ndjson", 1), ("ndjson", 2)]


def test_pieces_of_a_split():
    c = Cutter(2, True)
    c.line('  "a": "]}, {" },', 0, 1)
    c.line('  {"b": 1}, {"c": [', 3, 1)
    c.line("    1, 2", 0, 0)
    assert c.finish() == [(LAST, True, '"a": "]}, {" }'), (WHOLE, True, '{"b": 1}'), (FIRST, True, '{"c": [1, 2')]
    c = Cutter(3, True)
    c.line("1,", 0, 0)
    assert c.finish() == [(INSIDE, False, "1,")]
