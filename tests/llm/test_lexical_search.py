"""Dense blocked lexical search against a plain loop."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rectext.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=20):
    held = [(d, Counter(w), len(w)) for d, t in docs if (w := words(t))]
    n_docs, total = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(words(t))
    out = []
    for i, terms in asked.items():
        found = []
        for d, c, n in held:
            m = 100 - 25 + 25 * n * n_docs // total
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, q in terms.items() if t in c)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:k])]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def tables(spark):
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(80)] + ["Été", "x y", "naïve", "a'b", "Ünder_score", "１２", "one9two"]
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    docs = [(i, text(rnd.choice([1, 3, 20, 90]))) for i in range(150)]
    docs += [(200 + i, "common w1 w2") for i in range(70)] + [(7, "common w1 w2"), (7, None), (None, "common w1 w2"), (None, "common w1 w2"), (300, ""), (301, " -- ")]
    docs += [(302, "w3 " * 50_000), (303, "W4\x00w5\tW5\n" + "z" * 300_000)]
    items = [(i, text(rnd.choice([1, 5, 40]))) for i in range(30)] + [(40, "common"), (41, None), (42, ""), (43, "unknown words"), (44, "w3 " * 3000), (5, "common w9"), (None, "w1")]
    return (docs, items, spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, score int, terms string").repartition(7),
            spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, rank int"))


def test_search_matches_a_plain_loop(spark):
    docs, items, d, i = tables(spark)
    got = ls.search(d, i).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain(docs, items), key=key)
    assert [t for t, _ in got[0].asDict().items()] == ["item_id", "rank", "doc_id", "score"]
    assert ls.search(d.limit(0), i).count() == 0 and ls.search(d, i.limit(0)).count() == 0


def test_many_blocks_and_small_tiles_change_nothing(spark, monkeypatch):
    docs, items, d, i = tables(spark)
    monkeypatch.setattr(ls, "BLOCK_PAIRS", 200)
    monkeypatch.setattr(ls, "BLOCK_ITEMS", 12)
    assert ls.item_blocks(ls.item_terms(i)) > 1
    assert sorted(map(tuple, ls.search(d, i, k=5).collect()), key=key) == sorted(plain(docs, items, 5), key=key)


@pytest.mark.parametrize("exact", [1 << 40, 900])
def test_tiles_hold_all_weights_within_their_bound(exact):
    rnd = np.random.default_rng(2)
    n = 3000
    item, term = rnd.integers(0, 20, n), rnd.integers(0, 500, n)
    weight = rnd.integers(0, 2500, n)
    want, got = np.zeros((500, 20), np.int64), np.zeros((500, 20), np.int64)
    np.add.at(want, (term, item), weight)
    for first, many, tiles in ls.item_tiles(item, term, weight, 20, 500, items=6, width=64, exact=exact):
        for column, weights in tiles:
            assert weights.shape[1] == many and weights.shape[0] <= 64 and weights.sum(0).max() <= exact
            used = np.flatnonzero(column >= 0)
            got[used, first:first + many] += weights[column[used]].astype(np.int64)
    assert (got == want).all()


def test_ties_at_the_last_place_go_to_the_smaller_ids():
    rnd = np.random.default_rng(4)
    best, seen = ls.Best(3, 5), []
    for _ in range(30):
        scores, ids = rnd.integers(0, 4, (40, 3)), rnd.integers(0, 1000, 40)
        best.offer(0, scores, ids, np.zeros(40, bool))
        seen += [(i, -s, d) for d, row in zip(ids, scores) for i, s in enumerate(row) if s > 0]
        want = [x for i in range(3) for x in sorted(y for y in seen if y[0] == i)[:5]]
        assert sorted(zip(best.item, -best.score, best.ids)) == want


def test_length_factor_is_exact_for_large_corpora():
    assert ls.length_factor(10**9, 10**12, 10**15) == 75 + 25 * 10**6
