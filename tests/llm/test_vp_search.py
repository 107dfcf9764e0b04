"""Vantage-point search: repeated ids, hot vectors, share of work and recall."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rectext.llm import vp_search


def plain(rows, every=20, k=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = []
    for q in sorted({int(i) for i in ids if i % every == 0}):
        pool = []
        for at in np.flatnonzero(ids == q):
            s = vp_search.products(x[at:at + 1], x)[0]
            pool += [(-s[j], int(ids[j])) for j in np.flatnonzero(ids != q)]
        out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(sorted(pool)[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(int(i), [float(y) for y in v], 0.5) for i, v in rows], "vec_id long, embedding array<double>, score double").repartition(5)


def clustered(n, dim, spread, seed=1):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(40, dim))
    return [(i, centres[i % 40] + rnd.normal(size=dim) * spread) for i in range(n)]


@pytest.mark.parametrize("shard_rows, block", [(200, 16), (8192, 16384)])
def test_repeated_ids_and_hot_vectors(spark, shard_rows, block):
    rows = clustered(900, 6, 0.2) + [(5000 + i, [1.0, 2, 3, 4, 5, 6]) for i in range(450)]
    rows += [(40, [50.0, 50, 0, 0, 0, 0]), (40, [0.0, 0, 9, 9, 9, 9]), (41, [60.0, 0, 0, 0, 0, 0]), (41, [60.0, 0, 0, 0, 0, 0])]
    shares = []
    got = vp_search.nearest(frame(spark, rows), shard_rows=shard_rows, block=block, shares=shares).collect()
    assert sorted(map(tuple, got)) == plain(rows)
    assert all(0 < s <= 1.05 for s in shares)


def test_pruning_halves_the_work_on_clustered_vectors(spark):
    rows = [(i, v / np.linalg.norm(v)) for i, v in clustered(6000, 16, 0.05)]
    exact, loose = [], []
    want = plain(rows)
    got = vp_search.nearest(frame(spark, rows), shard_rows=500, shares=exact).collect()
    assert sorted(map(tuple, got)) == want and max(exact) < 0.5, exact
    found, true = defaultdict(set), defaultdict(set)
    for q, _, i, _ in map(tuple, vp_search.nearest(frame(spark, rows), shard_rows=500, factor=0.5, shares=loose).collect()):
        found[q].add(i)
    for q, _, i, _ in want:
        true[q].add(i)
    recall = np.mean([len(found[q] & true[q]) / 20 for q in true])
    assert recall >= 0.9 and max(loose) <= max(exact), (recall, loose, exact)


def test_trees_hold_every_point_and_true_ranges():
    x = np.random.default_rng(3).normal(size=(2000, 4))
    x[500:1100] = x[3]
    u = vp_search.on_sphere(x, float(np.linalg.norm(x, axis=1).max()) * 1.01)
    order, nodes = vp_search.tree_order(u, 50)
    assert sorted(order) == list(range(2000))
    p = u[order]
    for start, end, middle, a, b, c, d in nodes:
        start, end, middle = int(start), int(end), int(middle)
        near, far = (vp_search.between(p[i:j], p[start:start + 1])[:, 0] for i, j in ((start + 1, middle), (middle, end)))
        assert np.allclose([a, b, c, d], [near.min(), near.max(), far.min(), far.max()])


def test_same_result_from_sql_on_repeated_ids(spark):
    import duckdb
    from rectext.llm.queries import ORACLE
    rows = clustered(300, 5, 0.5) + [(20, [9.0, 9, 9, 9, 9]), (21, [9.0, 9, 9, 9, 9]), (21, [8.0, 9, 9, 9, 9])]
    embeddings = frame(spark, rows).select("vec_id", "embedding").toPandas()
    want = duckdb.sql(ORACLE["op4_vantage_point_search"]).fetchall()
    got = vp_search.nearest(spark.createDataFrame(embeddings)).select("query_id", "rank", "vec_id", "score").collect()
    short = lambda rows: sorted((q, r, i, round(s, 9)) for q, r, i, s in rows)
    assert short(want) == short(map(tuple, got))


def test_first_rows_give_queries_a_bound(monkeypatch):
    rnd = np.random.default_rng(5)
    x, ids = rnd.normal(size=(2000, 8)), np.arange(2000)
    x[50:90] = x[3]                                # ties: the smaller ids win
    scored, plain_products = [], vp_search.pair_products
    monkeypatch.setattr(vp_search, "pair_products", lambda a, b: scored.append(len(a)) or plain_products(a, b))
    found = vp_search.Nearest(vp_search.queries_of(ids[:4], x[:4]), 20)
    found.offer(np.arange(4), x[:4] @ x.T, ids, x, np.full(4, 1e-9))
    assert sum(scored) <= 4 * 20 + 41, scored
    for q in range(4):
        s = vp_search.products(x[q:q + 1], x)[0]
        want = sorted((-s[j], j) for j in range(2000) if j != q)[:20]
        assert [(-a, int(b)) for a, b in zip(found.score[found.slot == q], found.ids[found.slot == q])] == want
