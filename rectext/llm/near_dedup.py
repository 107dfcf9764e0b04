"""Near-duplicate classes by bottom-k sketches.

One hash function orders all shingles. A text's sketch holds its ``k``
smallest hash values; the k smallest of a union are then known from the two
sketches, and the share of them that lies in both texts estimates the Jaccard
similarity. Steps:

1. texts with equal sets are one class, represented by the smallest id;
2. inverted lists: sketch values that occur in two or more sketches, each
   list with the representatives that hold the value. Two sets that reach the
   similarity share at least ``overlap(n)`` sketch values, so they meet in
   the list of one of the rarest ``size - overlap + 1`` values of each
   sketch, and only those enter the lists. Common passages stay out this way;
3. lists with the same pivot form a cluster; its members are compared with
   the pivot only, and links give components;
4. clusters whose members are still apart go on with their full sets: the
   same rarest-first lists, now exact, leave out a text of which too few
   shingles occur in any other one. What stays is compared with further
   pivots, and at last, block by block, members outside a cluster's largest
   component with those of other components; a block gives only its links.
   So no list gives all its pairs, and no link between classes is lost;
5. each comparison with a pivot: the union sketch drops pairs far below the similarity,
   exact Jaccard on the full sets confirms the others.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rectext.llm.common import map_rows, saved
from rectext.llm.components import components

WORDS = 5
# Odd multipliers of a shingle's words, and of short texts' length.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_LENGTH = 0xE7037ED1A0B428DB


class Shingler:
    """``hashes(raw)``: sorted distinct 64-bit hashes of a text's shingles."""

    def __init__(self, words: int = WORDS, cache: int = 500_000):
        import xxhash

        class Hashes(dict):
            def __missing__(self, word):
                if len(self) >= cache:
                    self.clear()
                self[word] = h = xxhash.xxh64_intdigest(word)
                return h

        self.words, self.of = words, Hashes()
        self.factors = np.array(_FACTORS[:words], np.uint64)

    def hashes(self, raw: bytes | None) -> np.ndarray:
        words = (raw or b"").lower().split()
        n = len(words)
        if not n:
            return np.empty(0, np.int64)
        w = np.fromiter(map(self.of.__getitem__, words), np.uint64, n)
        if n < self.words:
            h = (w * self.factors[:n]).sum(keepdims=True, dtype=np.uint64) + np.array([n * _LENGTH % 2**64], np.uint64)
        else:
            m = n - self.words + 1
            h = w[:m] * self.factors[0]
            for i in range(1, self.words):
                h = h + w[i:i + m] * self.factors[i]
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return np.unique((h ^ (h >> np.uint64(31))).view(np.int64))


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_key, sketch`` of ``doc_id, text``:
    a hash of the text, set size, 128-bit key of the whole set (null if
    empty) and its ``k`` smallest hashes, ascending."""
    ddl = "doc_id long, text_key long, n_shingles long, set_key binary, sketch array<long>"

    def start():
        import xxhash
        shingler = Shingler()

        def f(ids, keys, texts):
            sets = [shingler.hashes(t) for t in texts]
            return {"doc_id": ids, "text_key": keys, "n_shingles": [len(s) for s in sets],
                    "set_key": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "sketch": [s[:k] for s in sets]}

        return f

    return map_rows(docs.select("doc_id", F.xxhash64("text"), "text"), ddl, start)


def classes(sets: DataFrame) -> DataFrame:
    """Texts with equal sets: ``set_key, node, rep, text_key, n, sketch``;
    ``rep`` is the smallest id and ``text_key`` tells its text. ``node``
    names the class: ``rep``, or where one id has several texts and so is
    the smallest of several classes, a hash for all but one of them."""
    c = (sets.filter("set_key is not null and doc_id is not null").groupBy("set_key")
         .agg(F.min(F.struct("doc_id", "text_key")).alias("x"), F.min("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
         .select("set_key", F.col("x.doc_id").alias("rep"), F.col("x.text_key").alias("text_key"), "n", "sketch"))
    c = saved(c, "classes")
    own = saved(c.groupBy("rep").agg(F.min("set_key").alias("own"), F.count(F.lit(1)).alias("sets")).filter("sets > 1").select("rep", "own"), "several")
    return (c.join(own, "rep", "left")
            .withColumn("node", F.when(F.col("own").isNull() | (F.col("own") == F.col("set_key")), F.col("rep"))
                        .otherwise(F.xxhash64("set_key"))).drop("own"))


def overlap(k: int, percent: int) -> int:
    """Least number of common values of two full sketches of similar sets:
    of the k smallest values of the union, each lies in both sets with the
    similarity's probability; five standard deviations below the mean."""
    t = percent / 100
    return max(1, math.floor(k * t - 5 * math.sqrt(k * t * (1 - t))))


def _rarest(postings: DataFrame, least) -> DataFrame:
    """``list, node, n``: of ``node, n, m, value`` (m values of each node),
    for each node its ``m - least + 1`` rarest values that another node has
    too. A value that no other node has comes first in the order, so those
    only fill places."""
    shared = postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    held = (postings.join(shared, "value").groupBy("node")
            .agg(F.first("n").alias("n"), F.first("m").alias("m"),
                 F.sort_array(F.collect_list(F.struct("df", "value"))).alias("rare")))
    room = (F.col("m") - least + 1) - (F.col("m") - F.size("rare"))
    return (held.filter(room > 0).select("node", "n", F.explode(F.slice("rare", 1, room.cast("int"))).alias("x"))
            .select(F.col("x.value").alias("list"), "node", "n"))


def sketch_lists(nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Inverted lists of sketch values."""
    postings = nodes.select("node", "n", F.size("sketch").alias("m"), F.explode("sketch").alias("value"))
    # A set of up to k shingles is its own sketch. It shares at least percent
    # of its size with any similar one, but no more than k - (100 - percent)
    # / percent * k of them need be in a larger partner's sketch.
    small = F.least(F.ceil(F.col("m") * percent / 100), F.lit(max(1, k - math.ceil(k * (100 - percent) / percent))))
    return _rarest(postings, F.when(F.col("n") <= k, F.greatest(small, F.lit(1))).otherwise(overlap(k, percent)))


def full_sets(texts: DataFrame) -> DataFrame:
    """``node, hashes`` of ``node, text``."""
    def start():
        shingler = Shingler()
        return lambda ids, raws: {"node": ids, "hashes": [shingler.hashes(t) for t in raws]}

    return map_rows(texts.select("node", "text"), "node long, hashes array<long>", start)


def full_lists(sets: DataFrame, percent: int) -> DataFrame:
    """Inverted lists of full sets: exact."""
    postings = sets.select("node", F.size("hashes").alias("n"), F.size("hashes").alias("m"), F.explode("hashes").alias("value"))
    return _rarest(postings, F.ceil(F.col("m") * percent / 100))


def clusters(lists: DataFrame) -> DataFrame:
    """``list, node, n, ln``: lists that have the same pivot as one, named by
    it (``ln``: its size). The pivot is the member first by a hash of its id,
    so the lists of similar texts mostly choose the same one."""
    pivot = (lists.groupBy("list").agg(F.min(F.struct(F.xxhash64("node").alias("h"), "node", "n")).alias("x"), F.count(F.lit(1)).alias("c"))
             .filter("c > 1").select("list", F.col("x.node").alias("p"), F.col("x.n").alias("ln")))
    return lists.join(pivot, "list").select(F.col("p").alias("list"), "node", "n", "ln").distinct()


def _fit(percent: int):
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent


def _pairs(p: DataFrame, percent: int) -> DataFrame:
    """Distinct ``a < b`` whose sizes allow the similarity."""
    return (p.filter((F.col("a") != F.col("b")) & _fit(percent))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def mixed(groups: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of clusters whose members are in several components so far, with
    each member's ``component`` and ``main``, the cluster's largest one."""
    own = (groups.select("list", "node", "n").join(found, "node", "left")
           .withColumn("component", F.coalesce("component", "node")))
    most = (own.groupBy("list", "component").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("list").agg(F.max(F.struct("c", "component")).alias("x"), F.count(F.lit(1)).alias("parts"))
            .filter("parts > 1").select("list", F.col("x.component").alias("main")))
    return own.join(most, "list")


def pivot_pairs(groups: DataFrame, percent: int, pivots: int, seed: int) -> DataFrame:
    """Members of mixed clusters with ``pivots`` members of each, chosen by hashes."""
    first = [F.min(F.struct(F.xxhash64("node", F.lit(seed + i)).alias("h"), "node", "n", "component")) for i in range(pivots)]
    chosen = (groups.groupBy("list").agg(F.array_distinct(F.array(*first)).alias("p"))
              .select("list", F.explode("p").alias("p")).select("list", F.col("p.node").alias("a"), F.col("p.n").alias("na"), F.col("p.component").alias("ca")))
    met = groups.select("list", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb")).join(chosen, "list")
    return _pairs(met.filter("ca <> cb"), percent)


def remaining_links(groups: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """``a, b``: links between members outside a mixed cluster's largest
    component and its members in other components. Both sides are dealt to
    blocks of about ``block`` members, and each pair of blocks is one group:
    it counts common shingles with an index of its members' sets."""
    deal = lambda seed, n: F.pmod(F.xxhash64("node", F.lit(seed)), F.ceil(F.col(n) / block)).cast("int")
    over = lambda n: F.explode(F.sequence(F.lit(0), F.ceil(F.col(n) / block).cast("int") - 1))
    sizes = groups.groupBy("list").agg(F.count(F.lit(1)).alias("members"), F.count_if(F.col("component") != F.col("main")).alias("others"))
    rows = groups.join(sizes, "list").join(sets, "node")
    one = rows.filter("component <> main").select("list", deal(1, "others").alias("x"), over("members").alias("y"), "node", "component", "hashes")
    two = rows.filter("others > 0").select(F.col("list").alias("l2"), over("others").alias("x2"), deal(2, "members").alias("y2"),
                                           F.col("node").alias("node2"), F.col("component").alias("component2"), F.col("hashes").alias("hashes2"))

    def compare(left, right):
        import pandas as pd
        found: list = []
        if len(left) and len(right):
            sizes = np.array([len(h) for h in right["hashes2"]])
            values, owner = np.concatenate(list(right["hashes2"])), np.repeat(np.arange(len(right)), sizes)
            by = np.argsort(values, kind="stable")
            values, owner = values[by], owner[by]
            nodes, parts = right["node2"].to_numpy(), right["component2"].to_numpy()
            for node, part, h in zip(left["node"], left["component"], left["hashes"]):
                first, last = np.searchsorted(values, h, "left"), np.searchsorted(values, h, "right")
                hits = np.concatenate([owner[i:j] for i, j in zip(first, last) if j > i] or [owner[:0]])
                both = np.bincount(hits, minlength=len(right))
                near = (100 * both >= percent * (len(h) + sizes - both)) & (parts != part)
                found += [(node, int(x)) for x in nodes[near]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return one.groupBy("list", "x", "y").cogroup(two.groupBy("l2", "x2", "y2")).applyInPandas(compare, "a long, b long").distinct()


def union_sketch_filter(pairs: DataFrame, nodes: DataFrame, percent: int, k: int = 64) -> DataFrame:
    """Pairs whose estimate from the ``k`` smallest values of the union is
    not five standard deviations below the similarity."""
    s = nodes.select("node", F.slice("sketch", 1, k).alias("s"))
    x = (pairs.join(s.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
         .join(s.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    common = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    t = percent / 100
    return x.filter(common >= F.size(union) * t - 5 * F.sqrt(F.size(union) * t * (1 - t))).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity. ``texts``: one
    row ``node, text`` for each class."""
    x = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
         .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))

    def start():
        shingler = Shingler()
        kept: dict = {}

        def of(i, raw):
            if i not in kept:
                if len(kept) >= 64:
                    kept.clear()
                kept[i] = shingler.hashes(raw)
            return kept[i]

        def similar(a, b, ta, tb):
            p, q = of(a, ta), of(b, tb)
            both = len(np.intersect1d(p, q, assume_unique=True))
            return 100 * both >= percent * (len(p) + len(q) - both)

        def f(a, b, ta, tb):
            yes = [similar(*row) for row in zip(a, b, ta, tb)]
            return {"a": [x for x, y in zip(a, yes) if y], "b": [x for x, y in zip(b, yes) if y]}

        return f

    return map_rows(x, "a long, b long", start)


def near_duplicates(docs: DataFrame, percent: int = 75, k: int = 128, pivots: int = 8, block: int = 512, doc_id: str = "doc_id", text: str = "text",
                    with_key: bool = False, exact: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id,
    kept`` (and ``text_key``, ``xxhash64`` of the text, if asked). Texts are linked if 100 * intersection >= percent * union of
    their sets of 5-word shingles (A-Z lower-cased; a shorter text is one
    shingle); ``component_id`` is the smallest id reachable over links.

    A null or blank text has an empty set and is linked with nothing. Rows
    with the same id are one document with several texts. A row with a null
    id takes the class of equal texts that have an id (and isn't kept then);
    without one its ``component_id`` is null and it is kept. Other columns
    are not read; an empty table gives no rows.

    The sketches' bounds lie five standard deviations out. ``exact`` does
    without them: all classes go through the lists of full sets, every pair
    is compared on full sets (several times the work)."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = saved(sketches(named, k), "sketches")
    nodes = classes(sets)
    keyed = named.withColumn("text_key", F.xxhash64("text"))

    def texts_of(wanted):
        x = nodes.join(wanted, "node").select("node", F.col("rep").alias("doc_id"), "text_key")
        return (keyed.join(x, ["doc_id", "text_key"]).groupBy("doc_id", "text_key")
                .agg(F.first("node").alias("node"), F.first("text").alias("text")).select("node", "text"))

    def links(pairs):
        near = pairs.select("a", "b") if exact else saved(union_sketch_filter(pairs, nodes, percent), "near")
        ends = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
        return saved(confirmed(near, texts_of(ends), percent), "links")

    groups = saved(clusters(sketch_lists(nodes.select("node", "n", "sketch"), k, percent)), "clusters")
    found = links(saved(_pairs(groups.select(F.col("list").alias("a"), F.col("node").alias("b"), F.col("ln").alias("na"), F.col("n").alias("nb")), percent), "pairs"))
    joined = components(found)
    full = saved(full_sets(texts_of(nodes.select("node") if exact else mixed(groups, joined).select("node").distinct())), "sets")
    groups = saved(clusters(full_lists(full, percent)), "clusters")
    found = found.unionByName(links(saved(pivot_pairs(mixed(groups, joined), percent, pivots, 1), "pairs")))
    rest = saved(mixed(groups, components(found)), "mixed")
    found = found.unionByName(saved(remaining_links(rest, full, percent, block), "links"))
    ids = sets.filter("set_key is not null and doc_id is not null").select("doc_id", "set_key").distinct()
    # An id with several texts links their classes, each to the smallest.
    several = (ids.join(ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("doc_id"), "doc_id")
               .join(nodes.select("set_key", "node"), "set_key"))
    several = several.join(several.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").select("a", F.col("node").alias("b"))
    joined = components(found.unionByName(several))
    of_node = nodes.select("set_key", "node", "rep").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of_set = of_node.join(of_node.groupBy("component").agg(F.min("rep").alias("smallest")), "component").select("set_key", "smallest")
    out = sets.select("doc_id", "text_key", "n_shingles", "set_key").join(of_set, "set_key", "left")
    component = F.coalesce("smallest", "doc_id")
    return out.select("doc_id", *["text_key"] * with_key, "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.col("smallest").isNull()).alias("kept"))


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The first document of each class of near-duplicates, and of rows with
    equal id and text the smallest (by all columns that have an order).

    Null and blank texts are linked with nothing and stay, one row of each id.
    A row without an id goes if its text is that of a document with one, else
    one row of its text stays. Columns stay as they are, whatever their names;
    an empty table stays empty."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{doc_id}`").cast("long").alias("id"),
                       F.xxhash64(F.col(f"`{text}`").cast("string")).alias("key"))
    # The verdict is the same for rows of equal id and text, so it is joined by both.
    others = (near_duplicates(docs, doc_id=doc_id, text=text, with_key=True).filter(~F.col("kept"))
              .select(F.col("doc_id").alias("other"), F.col("text_key").alias("other_key")).distinct())
    left = rows.join(others, F.col("id").eqNullSafe(F.col("other")) & F.col("key").eqNullSafe(F.col("other_key")), "left_anti")
    order = F.struct(*[F.col(f"row.`{f.name}`") for f in docs.schema if _orderable(f.dataType)])
    return left.groupBy("id", "key").agg(F.min_by("row", order).alias("row")).select("row.*")
