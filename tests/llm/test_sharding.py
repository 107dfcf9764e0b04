"""Proportional stratified interleaving against a plain ranking."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rectext.llm import sharding


def plain(rows, shards):
    """``(doc_id, shard, slot)`` by sorting everything at once."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    by = {}
    for d, t, s in rows:
        by.setdefault("0" if s is None else "1" + s, []).append((md5(f"0|{'' if d is None else d}|{t or ''}"), d))
    order = sorted((((r + int(md5(s)[:8], 16) / 2.0**32) / len(x), s, k, d) for s, x in by.items() for r, (k, d) in enumerate(sorted(x, key=lambda y: y[0]))),
                   key=lambda y: y[:3])
    out, seen = [], Counter()
    for i, (*_, d) in enumerate(order):
        shard = i * shards // len(order)
        out.append((d, shard, seen[shard]))
        seen[shard] += 1
    return out


@pytest.mark.parametrize("ranges", [1, 85, None])
def test_interleave_matches_a_plain_ranking(spark, ranges):
    rnd = random.Random(3)
    # One source with a third of the rows, two middling ones, many of one row, a null one.
    rows = [(i, f"text {i}", "hot" if i % 3 == 0 else rnd.choice(["a", "b", None]) if i % 3 == 1 else f"only {i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    keyed = docs.withColumn("key", sharding.shuffle_key(F.col("doc_id"), F.col("text"), 0))
    got = sharding.interleave(keyed, 24, ranges=ranges).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == sorted(plain(rows, 24))
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    hot = Counter(r.shard for r in got if r.source == "hot")
    # A third of the rows are sources of one row each, at random places: cuts move by their square root.
    assert all(abs(hot[s] - 200 / 24) <= 5 for s in range(24))


def test_every_shard_has_the_mixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    of, n = Counter(r.source for r in docs.collect()), docs.count()
    got = Counter((r.shard, r.source) for r in sharding.place_documents(docs, 24).collect())
    assert all(abs(got[s, source] - of[source] / 24) <= 1 + len(of) / n * of[source] for s in range(24) for source in of)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, None, 1, "x", 0.5), (None, "", None, 2, "y", 0.5), (1, "same", "s", 3, "z", None), (1, "same", "s", 4, "z", None), (2, "é" * 70_000, "", 5, None, 1.0)],
        "doc_id long, text string, source string, shard int, src string, fraction double")
    got = sharding.place_documents(docs, 24).collect()
    assert len(got) == 5 and len({(r.shard, r.slot) for r in got}) == 5
    assert sorted(r.size for r in got) == [8, 8, 12, 12, 140_008]
    assert {r.text_crc32 for r in got if r.size == 8} == {0} and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    whole = sharding.shard_documents(docs.withColumn("key", F.lit("k")), 2)
    assert whole.columns == ["doc_id", "text", "source", "src", "key", "shard", "slot", "fraction"]
    assert sorted(r.src or "" for r in whole.collect()) == ["", "x", "y", "z", "z"] and {r.key for r in whole.collect()} == {"k"}
    assert sharding.place_documents(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.interleave(docs, 0)


def test_written_shards_hold_their_rows_in_order(spark, tmpuri):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sharding.write_shards(sharding.shard_documents(docs, 5), tmpuri)
    back = spark.read.parquet(tmpuri)
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [40] * 5
    assert back.join(docs, ["doc_id", "text"]).count() == 200
    for (slots,) in spark.read.parquet(f"{tmpuri}/shard=3").select("slot", F.input_file_name().alias("f")).groupBy("f").agg(F.collect_list("slot").alias("s")).select("s").collect():
        assert slots == list(range(slots[0], slots[0] + len(slots)))
