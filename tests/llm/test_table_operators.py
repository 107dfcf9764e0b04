"""Operators over whole tables against brute force on small fixtures."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rectext.llm import lang_id, line_dedup, near_dedup, quotations, vp_search
from rectext.llm.components import components

WORDS = [f"w{i}" for i in range(3000)]


def classes_of(rows):
    """Smallest reachable id by links of exact word sets, of (id, text)."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if both and 100 * both >= 75 * len(sets[i] | sets[j]) or same and sets[i] and sets[j]:
                parent[root(i)] = root(j)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(x for x in (least[root(i)], d) if x is not None)
    return [(d, len(s), (least[root(i)] if s else d) if least[root(i)] is not None else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def test_near_duplicates_match_brute_force(spark):
    rnd = random.Random(5)
    rows, n = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "ONE two"), (5, "two one")], 6
    for size, edits in ((12, 2), (9, 8), (40, 5), (3, 1), (2, 0)):
        base = [rnd.choice(WORDS) for _ in range(rnd.choice([60, 170, 400]))]
        for _ in range(size):
            w = list(base)
            for _ in range(edits):
                w[rnd.randrange(len(w))] = rnd.choice(WORDS)
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n, rows[20][1]), (n, "another text of the same document id that stands twice here"), (None, rows[21][1]), (rows[30][0], rows[30][1])]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, component_id int, node string").repartition(4)
    for block, k in ((512, 128), (3, 32)):
        got = near_dedup.near_duplicates(df, k=k, block=block).collect()
        key = lambda r: tuple((x is None, x or 0) for x in r)
        assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=key) == sorted(classes_of(rows), key=key)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), 200: 200, 201: 200}


def test_line_dedup_removes_repeated_chunks(spark):
    rnd = random.Random(7)
    line = lambda n=14: " ".join(rnd.choice(WORDS) for _ in range(n))
    passage = "\n".join(line() for _ in range(14))
    one_line = " ".join(f"{line(9)}." for _ in range(8))
    own = {i: [line() for _ in range(6)] for i in range(8)}
    texts = {i: "\n".join([*own[i][:3], passage if i % 2 else one_line, *own[i][3:]]) for i in range(8)}
    texts |= {8: texts[1], 9: None, 10: "", 11: "alone"}
    df = spark.createDataFrame([(i, t, i, "k") for i, t in texts.items()] + [(11, "alone", 11, "k"), (None, texts[1], 0, "k")],
                               "doc_id long, text string, n_removed int, _key string").repartition(3)
    out = line_dedup.line_dedup(df)
    assert out.columns == ["doc_id", "text", "n_removed", "_key", "removed_bytes"] and out.count() == df.count()
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[0] == texts[0] and got[1] == texts[1] and got[9] is None and got[10] == "" and got[11] == "alone"
    for i in range(2, 8):
        assert all(x in got[i] for x in own[i]), "own lines stay"
        if i % 2:   # chunks that reach over the passage's ends stay
            assert sum(x not in got[i] for x in passage.split("\n")) >= 7
        else:
            assert one_line not in got[i] and not any(x in got[i] for x in one_line.split(". "))
    assert got[8] == "" and got[None] == ""
    assert line_dedup.line_dedup(df.limit(0)).count() == 0


def test_vantage_point_trees_are_exact_at_factor_one(spark):
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(1500, 8)) * rnd.uniform(0.2, 3, size=(1500, 1))
    x[200:260] = x[40]
    rows = [(int(i), [float(v) for v in r], i % 3) for i, r in enumerate(x)]
    bad = [(2000, None, 0), (2020, [0.0] * 8, 0), (2040, [float("nan")] * 8, 0), (2060, [1.0, None] + [0.0] * 6, 0), (2080, [1.0, 2.0], 0), (None, [1.0] * 8, 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, rank int").repartition(5)
    scores = vp_search.products(x[::20], x)
    want = {}
    for q, s in zip(range(0, 1500, 20), scores):
        s[q] = -np.inf
        want[q] = [int(i) for i in np.lexsort((np.arange(1500), -s))[:20]]
    got = defaultdict(list)
    for r in vp_search.nearest(df, shard_rows=300, block=30).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert got == want
    loose = defaultdict(list)
    for r in vp_search.nearest(df, shard_rows=300, block=30, factor=0.8).collect():
        loose[r["query_id"]].append(r["vec_id"])
    assert np.mean([len(set(loose[q]) & set(w)) / 20 for q, w in want.items()]) >= 0.9
    assert vp_search.nearest(df.limit(0)).count() == 0
    assert vp_search.nearest(df.filter("vec_id < 5")).count() == 4


def test_vantage_point_search_recall_on_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    good = df.collect()
    x, ids = np.array([r["embedding"] for r in good], float), np.array([r["vec_id"] for r in good])
    hits = total = 0
    found = defaultdict(set)
    for r in vp_search.nearest(df).collect():
        found[r["query_id"]].add(r["vec_id"])
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        hits += len(found[ids[i]] & set(ids[np.argsort(-s)[:20]].tolist()))
        total += 20
    assert hits / total >= 0.99


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en"), (10**6 + 1, "", "en"), (10**6 + 2, "12 ... 34", "fr"), (None, "the and of", None)], "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").unionByName(odd).withColumn("score", F.lit("clash"))
    got = lang_id.identify(both).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in got if r["doc_id"] and r["doc_id"] >= 10**6} == {"und"}
    assert {(r["lang_pred"], r["score"]) for r in lang_id.identify(both.withColumn("lang", F.lit(None).cast("string"))).collect()} == {("und", 0.0)}
    assert lang_id.identify(both.limit(0)).count() == 0


MAILS = [
    ("t", 0, "Shall we meet on Monday?\nI am free all day."),
    ("t", 1, "A wrote:\n> Shall we meet on Monday?\n> I am free all day.\n\nMonday is fine with me."),
    ("t", 2, "B wrote:\n> A wrote:\n>> Shall we meet on   monday?\n>> I am free all day.\n>\n> Monday is fine with me.\n\nThen at noon."),
    ("t", 3, "> Shall we meet on Monday?\n\nNo, I am away."),
    ("t", 4, None), ("t", 5, ""), ("t", 6, "> Never written anywhere before"), ("u", 0, "> Then at noon.\nother thread"),
    (None, 1, "> Then at noon."), ("t", None, "Then at noon."),
]


def test_quotation_links_and_reply_order(spark):
    df = spark.createDataFrame([(a, b, c, "x") for a, b, c in MAILS], "conv_id string, turn long, text string, depth string").repartition(3)
    got = {(r["conv_id"], r["turn"]): r for r in quotations.link_quotations(df).collect()}
    assert len(got) == len(MAILS)
    tree = {k[1]: (r["parent_order"], r["root_order"], r["depth"]) for k, r in got.items() if k[0] == "t" and k[1] is not None}
    assert tree == {0: (None, 0, 0), 1: (0, 0, 1), 2: (1, 0, 2), 3: (0, 0, 1), 4: (None, 4, 0), 5: (None, 5, 0), 6: (None, 6, 0)}
    assert got["t", 1]["own_text"] == "Monday is fine with me." and got["t", 2]["own_text"] == "Then at noon." and got["t", 4]["own_text"] == ""
    assert got["t", 2]["max_level"] == 2 and got["t", 2]["n_quoted"] == 2 and got["t", 2]["n_linked"] == 2
    assert got["u", 0]["n_linked"] == 0 and got["u", 0]["own_text"] == "other thread" and got[None, 1]["parent_order"] is None
    assert quotations.link_quotations(df.limit(0)).count() == 0


def test_mail_form_quotes_over_block_edges(spark):
    rows = [("c", i, "u", f"t{i}") for i in range(6)] + [(None, 1, "u", "x"), ("c", None, "u", "y"), ("d", 5, "u", None), ("d", 7, "u", "z")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = {(r["conv_id"], r["turn"]): r["mail"] for r in quotations.as_replies(df, block=2).collect()}
    assert len(got) == len(rows) and got["c", 0] == "t0" and got["c", 1] == "Turn 0 wrote:\n> t0\n\nt1"
    for i in range(2, 6):
        assert got["c", i] == f"Turn {i - 1} wrote:\n> Turn {i - 2} wrote:\n> > t{i - 2}\n> \n> t{i - 1}\n\nt{i}"
    assert (got[None, 1], got["c", None], got["d", 5], got["d", 7]) == ("x", "y", "", "z")


def test_quotation_plan_has_no_python(spark):
    df = spark.createDataFrame([(a, b, c) for a, b, c in MAILS], "conv_id string, turn long, text string")
    plan = quotations.link_quotations(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_pipeline_matches_its_stages(spark, sf):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == start.columns
        docs = spark.createDataFrame(after.toPandas(), after.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    keys = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    want = sorted(map(tuple, pieces.select(keys).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).select(keys).collect())) == want and want
    kept = classes_of([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert all(d == c for d, _, c in kept), "one document of each class"


def test_line_dedup_removes_short_passages_like_brute_force(spark):
    rnd = random.Random(11)
    line = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    passages = ["\n".join(line(rnd.randrange(9, 30)) + rnd.choice(["", ".", "!"]) for _ in range(n)) + "." for n in range(2, 7)]
    passages += [" ".join(line(16) + "." for _ in range(n)) for n in (3, 4, 5)] + [line(60) + ".", line(130) + "."]
    rows, own = [], {}
    for p, passage in enumerate(passages):
        for c in range(4):                         # on its own lines, and in the middle of a paragraph
            a, b = f"{line(11)}. {line(13)}.", f"{line(12)}. {line(15)}."
            gap = " " if c % 2 else "\n"
            own[len(rows)] = (c, a + gap + b)
            rows.append((len(rows), a + gap + passage + gap + b))
    rows += [(len(rows), "Yes.\nNo.\n\nOf course."), (len(rows) + 1, "Yes.\nNo.\n\nOf course."), (len(rows) + 2, "a b c. " * 9)]
    how, digest = line_dedup.Chunking(), __import__("xxhash").xxh3_64_intdigest
    seen, want = set(), {}
    for i, t in rows:                              # every run of every length, in order
        raw, gone = t.encode(), set()
        u = line_dedup.units(raw, how, digest)
        assert b" ".join(raw[s:e] for s, e, _ in u).split() == raw.split(), "units leave out white space only"
        for a in range(len(u)):
            for b in range(a, len(u)):
                words = sum(x[2] for x in u[a:b + 1])
                if words >= (how.long_line if a == b else how.min_words):
                    run = raw[u[a][0]:u[b][1]]
                    gone |= set(range(a, b + 1)) if run in seen else set()
                    seen.add(run)
        want[i] = [raw[s:e] for k, (s, e, _) in enumerate(u) if k not in gone]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for r in line_dedup.line_dedup(df).collect():
        got, i = r["text"].encode(), r["doc_id"]
        assert b" ".join(got.split()) == b" ".join(b" ".join(want[i]).split())
        if i in own:
            assert r["text"] == (own[i][1] if own[i][0] else rows[i][1]), "the whole passage goes, own text stays"
            assert r["n_removed"] == (own[i][0] > 0)


def test_pipeline_leaves_one_row_of_each_class(spark):
    import corpus_pipeline
    rnd = random.Random(13)
    texts = [" ".join(rnd.choice(WORDS) for _ in range(60)) for _ in range(4)]
    near = texts[0] + " tail"
    rows = [(1, texts[0]), (2, near), (None, texts[0]), (None, near), (1, texts[0]), (3, texts[1]), (3, texts[1]), (3, texts[1]),
            (None, texts[2]), (None, texts[2]), (4, texts[3])]
    df = spark.createDataFrame([(d, t, "en", f"s{i}", len(t)) for i, (d, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    left = corpus_pipeline.one_of_near_copies(spark, df, "")
    assert left.columns == df.columns
    got = sorted(((r["doc_id"] or 0, r["text"], r["source"]) for r in left.collect()))
    assert got == sorted([(1, texts[0], "s0"), (3, texts[1], "s5"), (0, texts[2], "s8"), (4, texts[3], "s10")])
