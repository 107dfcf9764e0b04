"""The multiway hyperplane tree against plain scoring of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rectext.llm import hard_negatives as hn


def plain(rows, anchors, positives=5, negatives=3, low=50, high=95):
    """``rows`` = [(id, label, whole vector)]; ``anchors`` says of an id whether it is one."""
    rows = [r for r in rows if None not in r]
    size = max((len(v) for *_, v in rows), default=0)
    x = np.array([list(v) + [0] * (size - len(v)) for *_, v in rows], dtype=object).reshape(len(rows), size)
    out = []
    for i, (d, label, _) in enumerate(rows):
        if not anchors(d):
            continue
        s = [(-sum(int(a) * int(b) for a, b in zip(x[i], y)), rows[j][0], j) for j, y in enumerate(x) if j != i]
        for p, pid, _ in sorted(y for y in s if rows[y[2]][1] == label)[:positives]:
            fit = sorted(y for y in s if rows[y[2]][1] != label and low * -p <= 100 * -y[0] <= high * -p)
            out += [(d, pid, r + 1, nid, -p, -n) for r, (n, nid, _) in enumerate(fit[:negatives])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(d, k, v, "x", 7) for d, k, v in rows], "vec_id long, label long, vector array<long>, row string, cell int").repartition(6)


def clustered(n, dim=12, spread=8, seed=1):
    rnd = np.random.default_rng(seed)
    centres = rnd.integers(-120, 120, (9, dim))
    which = rnd.integers(0, 9, n)
    return [(i, int((c + (i % 3 == 0)) % 4), [int(v) for v in centres[c] + rnd.integers(-spread, spread, dim)]) for i, c in enumerate(which)]


@pytest.mark.parametrize("page_rows", [150, 4096])
def test_mine_matches_all_pairs(spark, page_rows):
    rows = clustered(1200)
    rows += [(2000 + i, i % 2, [50] * 12) for i in range(400)]                     # a third of the rows are one vector
    rows += [(10, 1, [1] * 12), (10, 1, [1] * 12), (20, 2, [0] * 12), (None, 1, [1] * 12), (30, None, [1] * 12), (3000, 1, None), (3010, 1, [90, 80]), (3020, 5, [1] * 12)]
    shares = []
    got = hn.mine(frame(spark, rows), F.col("vec_id") % 10 == 0, page_rows=page_rows, shares=shares).collect()
    assert sorted(map(tuple, got)) == plain(rows, lambda d: d % 10 == 0)
    assert got[0].asDict().keys() == {"anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"}
    assert len(shares) == 2 and all(0 < s < 1 for s in shares)


def test_ranges_eliminate_subtrees_of_clustered_vectors(spark):
    rows = clustered(6000, dim=8, spread=4)
    shares = []
    got = hn.mine(frame(spark, rows), F.col("vec_id") % 50 == 0, page_rows=512, shares=shares).collect()
    assert sorted(map(tuple, got)) == plain(rows, lambda d: d % 50 == 0)
    assert max(shares) < 0.5, shares


def test_many_blocks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_BYTES", 12 * 8 * 20)
    rows = clustered(400)
    assert sorted(map(tuple, hn.mine(frame(spark, rows), F.col("vec_id") % 7 == 0).collect())) == plain(rows, lambda d: d % 7 == 0)


def test_large_components_stay_exact(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, i % 3, [int(v) for v in rnd.integers(-(1 << 29), 1 << 29, 6)]) for i in range(300)]
    assert sorted(map(tuple, hn.mine(frame(spark, rows), F.col("vec_id") % 20 == 0).collect())) == plain(rows, lambda d: d % 20 == 0)


def test_empty_tables_and_unusable_vectors(spark):
    rows = clustered(30)
    assert hn.mine(frame(spark, rows).limit(0), F.lit(True)).count() == 0
    assert hn.mine(frame(spark, rows), F.lit(None).cast("boolean")).count() == 0
    df = spark.createDataFrame([([1.0, -0.001],), ([1.0, None],), ([float("nan"), 1.0],), ([float("inf")],), (None,), ([],)], "e array<float>")
    assert [r[0] for r in df.select(hn.whole_vector("e")).collect()] == [[256, math.floor(256 * float(np.float32(-0.001)))], None, None, None, None, []]


def test_page_tree_covers_every_point_once():
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(3000, 5))
    x[1000:2000] = x[0]
    u = x / np.linalg.norm(x, axis=1)[:, None]
    order, nodes, ranges = hn.grow(u)
    assert sorted(order) == list(range(3000))
    p = u[order]
    for node, span in zip(nodes, ranges):
        start, m, ends = node[0], node[1], node[2:]
        first = start + m
        for j in range(m):
            if ends[j] > first:
                d = hn.between(p[start:start + m], p[first:ends[j]])
                assert np.allclose(d.min(1), span[:m, j, 0]) and np.allclose(d.max(1), span[:m, j, 1])
            first = ends[j]
