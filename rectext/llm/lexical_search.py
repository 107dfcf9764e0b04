"""Ranked lexical search by dense blocked matrix products.

Each item's terms have weights; each document gives a term an impact. A score
is the sum of weight times impact, so the scores of a tile of documents
against a tile of items are a matrix product: documents x vocabulary times
vocabulary x items, in float64, over the compact vocabulary of the item tile
alone. Vocabulary tiles are cut so that no item's sum within one can reach
2^53: every product is then an exact whole number in whatever order BLAS adds,
and tiles are added up as 64-bit integers.

The corpus is read once for a block of items: one pass keeps of each document
its number of terms and its counts of the block's terms; document frequencies
come from that table, and so do the products. Each task keeps the best ``k``
documents of each item; ties at the ``k``-th place are settled by id before
anything is dropped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rectext.llm.common import arrow_schema, columns, map_rows, saved

#: Bounds of one block of items (broadcast): distinct (item, term) pairs and items. An item with more pairs is a block of its own.
BLOCK_PAIRS, BLOCK_ITEMS = 400_000, 4096
#: Sizes of a tile.
DOCUMENTS, ITEMS, TERMS = 1024, 128, 2048
#: No impact reaches this, so an item's weights in one vocabulary tile may add up to ``2^53 // MOST`` at most.
MOST = 1_000_000
EXACT = (1 << 53) // MOST

# A-Z become lower case, digits, letters and all bytes above ASCII stay, every other byte becomes a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms(raw: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    return raw.translate(_FOLD).split()


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def length_factor(n: int, docs: int, total: int) -> int:
    """100 - 25 + 25 n N div L, in whole numbers of any size."""
    return 75 + 25 * n * docs // total


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, term, qtf``: rows of one id are one item, their terms
    added up. Items without a term (null text too) have no row."""
    def start():
        def f(ids, texts):
            rows = [(i, t) for i, raw in zip(ids, texts) if raw for t in terms(raw)]
            return {"item_id": [i for i, _ in rows], "term": [t for _, t in rows]}
        return f

    pairs = map_rows(items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")), "item_id long, term binary", start)
    return pairs.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("qtf"))


def item_blocks(pairs: DataFrame) -> int:
    """Number of blocks, dealt by a hash of the item, so that each is within
    its bounds or one single item."""
    sizes, blocks = saved(pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")), "search-sizes"), 1
    while blocks < 1 << 24:
        of = sizes.groupBy(block_of(blocks).alias("b")).agg(F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("items"))
        over = of.filter((F.col("items") > 1) & ((F.col("pairs") > BLOCK_PAIRS) | (F.col("items") > BLOCK_ITEMS))).limit(1).count()
        if not over:
            return blocks
        blocks *= 2
    raise ValueError("items can't be dealt to blocks")


def block_of(blocks: int):
    return F.pmod(F.xxhash64("item_id"), F.lit(blocks))


def item_tiles(item: np.ndarray, term: np.ndarray, weight: np.ndarray, n_items: int, n_terms: int, items: int = ITEMS, width: int = TERMS,
               exact: int = EXACT) -> list:
    """``(first item, items, [(column of each term or -1, weights)])``: for
    each tile of items its vocabulary tiles. A weight above ``exact`` is
    spread over several of them."""
    out = []
    for first in range(0, n_items, items):
        mine = (item >= first) & (item < first + items) & (weight > 0)
        many, tiles = min(items, n_items - first), []
        own_terms, at = np.unique(term[mine], return_inverse=True)
        dense = np.zeros((len(own_terms), many), np.int64)
        np.add.at(dense, (at, item[mine] - first), weight[mine])
        entries = []                               # (term, weights) of one column
        for t, row in zip(own_terms, dense):
            while row.max() > exact:
                entries.append((t, np.minimum(row, exact)))
                row = row - entries[-1][1]
            entries.append((t, row))
        start, held, seen = 0, np.zeros(many, np.int64), set()
        for i, (t, row) in enumerate([*entries, (None, None)]):
            if t is not None and i - start < width and t not in seen and (held + row <= exact).all():
                held, _ = held + row, seen.add(t)
                continue
            if i > start:
                column = np.full(n_terms, -1, np.int32)
                column[[x for x, _ in entries[start:i]]] = np.arange(i - start)
                tiles.append((column, np.array([r for _, r in entries[start:i]], np.float64)))
            if t is not None:
                start, held, seen = i, row.copy(), {t}
        out.append((first, many, tiles))
    return out


def best_of(score: np.ndarray, ids: np.ndarray, no_id: np.ndarray, group: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group: highest score, then smallest
    id, rows without an id last."""
    by = np.lexsort((ids, no_id, -score, group))
    g = group[by]
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.r_[start, len(g)]))
    return by[rank < k]


class Best:
    """The best ``k`` documents of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)         # a score must reach ``least``
        self.item, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.no_id = np.zeros(0, bool)

    def offer(self, first: int, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """``scores``: documents x items from ``first`` on."""
        n, m = scores.shape
        own = slice(first, first + m)
        least = self.least[own]
        if n >= self.k:                            # all that equal the tile's k-th score stay
            least = np.maximum(least, np.partition(scores, n - self.k, axis=0)[n - self.k])
        d, i = np.nonzero(scores >= least)
        if not len(d):
            return
        item, score = np.r_[self.item, i + first], np.r_[self.score, scores[d, i]]
        ids, no_id = np.r_[self.ids, ids[d]], np.r_[self.no_id, no_id[d]]
        keep = best_of(score, ids, no_id, item, self.k)
        self.item, self.score, self.ids, self.no_id = item[keep], score[keep], ids[keep], no_id[keep]
        full = np.bincount(self.item, minlength=len(self.least)) >= self.k
        low = np.full(len(self.least), np.iinfo(np.int64).max)
        np.minimum.at(low, self.item, self.score)
        self.least = np.where(full, np.maximum(low, 1), 1)


def matched(docs: DataFrame, vocabulary, doc_id: str, text: str, flush: int = 1 << 20) -> DataFrame:
    """``doc_id, n, terms, counts``: of every document with a term the number
    of its terms, and the numbers and counts of those in ``vocabulary`` (a
    broadcast {term: number})."""
    ddl = "doc_id long, n long, terms array<int>, counts array<int>"
    schema = arrow_schema(ddl)

    def table_of(ids, n, sizes, found):
        width = np.int64(1 << 32)
        key, counts = np.unique(np.repeat(np.arange(len(n)), sizes) * width + np.array(found, np.int64), return_counts=True)
        at = np.searchsorted(key, np.arange(len(n) + 1) * width).astype(np.int32)
        lists = [pa.ListArray.from_arrays(at, (x).astype(np.int32)) for x in (key % width, counts)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), *[x.cast(f.type) for x, f in zip(lists, list(schema)[2:])]], schema=schema)

    def run(batches):
        get = vocabulary.value.get
        for batch in batches:
            ids, n, sizes, found = [], [], [], []
            for i, raw in zip(*columns(batch)):
                words = terms(raw) if raw else ()
                if words:
                    before = len(found)
                    found += [x for x in map(get, words) if x is not None]
                    ids.append(i), n.append(len(words)), sizes.append(len(found) - before)
                if len(found) > flush:
                    yield table_of(ids, n, sizes, found)
                    ids, n, sizes, found = [], [], [], []
            if ids:
                yield table_of(ids, n, sizes, found)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, ddl)


def scored(rows: DataFrame, model, k: int) -> DataFrame:
    """``item, doc_id, score``: of each task of ``rows`` (``matched``) the
    best ``k`` documents of each item (by its number in the block)."""
    ddl = "item int, doc_id long, score long"
    schema = arrow_schema(ddl)

    def run(batches):
        m = model.value
        best = Best(m["items"], k)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS):
                part = batch.slice(at, DOCUMENTS)
                doc, n, term_lists, count_lists = part.columns
                no_id = np.array(doc.is_null())
                ids = np.array(doc.fill_null(0))
                sizes = np.array(term_lists.value_lengths())
                where, term, tf = np.repeat(np.arange(part.num_rows), sizes), np.array(term_lists.flatten()), np.array(count_lists.flatten(), np.int64)
                factor = np.array([length_factor(x, m["N"], m["L"]) for x in n.to_pylist()], np.int64)
                value = impact(tf, factor[where]).astype(np.float64)
                for first, many, tiles in m["tiles"]:
                    scores = np.zeros((part.num_rows, many), np.int64)
                    for column, weights in tiles:
                        c = column[term]
                        here = c >= 0
                        dense = np.zeros((part.num_rows, len(weights)))
                        dense[where[here], c[here]] = value[here]
                        scores += (dense @ weights).astype(np.int64)
                    best.offer(first, scores, ids, no_id)
        if len(best.item):
            yield pa.RecordBatch.from_arrays([pa.array(best.item, pa.int32()), pa.array(best.ids, pa.int64(), mask=best.no_id), pa.array(best.score, pa.int64())], schema=schema)

    return rows.mapInArrow(run, ddl)


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item its ``k`` documents
    with the highest score above 0, ties by smaller id.

    Every row of ``docs`` is a document: repeated rows are ranked each by
    itself, a null id comes after all others of its score, null and empty
    texts have no term. Rows of one item id (or without one) are one item. No
    document with a term, or no item with one, gives no rows. Other columns
    are not read, whatever their names."""
    spark = docs.sparkSession
    pairs = saved(item_terms(items, item_id, item_text), "search-items")
    blocks = item_blocks(pairs)
    results = None
    for b in range(blocks):
        # Bounded by item_blocks.
        rows = pairs.filter(block_of(blocks) == b).collect()
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
        block_items = list({r["item_id"]: None for r in rows})
        known = spark.sparkContext.broadcast(vocabulary)
        held = saved(matched(docs, known, doc_id, text), "search-matched")
        total = held.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
        df = dict(map(tuple, held.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()))
        number = {x: i for i, x in enumerate(block_items)}
        weight = {t: math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * n + 1))) for t, n in df.items()}
        entries = [(number[r["item_id"]], t, weight[t] * r["qtf"]) for r in rows if (t := vocabulary[bytes(r["term"])]) in weight]
        item, term, w = (np.array(x, np.int64) for x in (zip(*entries) if entries else ([], [], [])))
        model = spark.sparkContext.broadcast({"N": total["n"], "L": max(total["l"], 1), "items": len(block_items),
                                              "tiles": item_tiles(item, term, w, len(block_items), len(vocabulary))})
        names = spark.createDataFrame([(i, x) for i, x in enumerate(block_items)], "item int, item_id long")
        # First among a part of the documents, then among the parts' best, so that no task sees what all tasks sent.
        some = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(64))).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        all_of = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        first = scored(held, model, k).withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
        best = first.withColumn("rank", F.row_number().over(all_of)).filter(F.col("rank") <= k).join(names, "item")
        best = saved(best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "search-found")
        results = best if results is None else results.union(best)
    return results
