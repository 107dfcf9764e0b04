"""Hard-negative mining with a multiway hyperplane tree (GNAT).

Scores are inner products of whole-number vectors. With one more coordinate,
sqrt(M^2 - |x|^2) for the largest norm M, all vectors lie on a sphere and a
score s of an anchor q stands for the angle arccos(s / (M |q|)), a metric. A
node has up to ``FAN`` split points; every other point belongs to the nearest
one, and the node keeps, for each split point and each sibling subtree, the
least and largest angle between the point and the subtree's members. A window
of scores is an annulus around the anchor; a subtree whose range from any
split point can't meet the annulus is eliminated. Leaves are scored exactly,
by a matrix product.

The top of the tree is made from a bounded sample and sent to all tasks; every
row falls into one of its cells, and a cell is dealt to pages of about
``page_rows`` rows, each of which continues the tree on its own and knows its
ranges from all split points above it. A page is one row of a table in the
shared folder. Anchors come in blocks of bounded size, each block against all
pages that the ranges leave: first the positives, which begin at what the
anchor's own page has, then the negatives in the windows that follow.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rectext.llm.common import arrow_schema, saved

#: Split points of a node, rows of a leaf, cells at most; rows and components of the sample that the top of the tree is made from.
FAN, LEAF, CELLS, SAMPLE, SAMPLE_VALUES = 12, 192, 2048, 8192, 1 << 20
#: Bytes of anchors' vectors that one block sends to all tasks.
BLOCK_BYTES = 32 << 20
#: Room for rounding in angles.
ROOM = 1e-6
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def whole_vector(vector: str, factor: int = 256) -> Column:
    """Components times ``factor``, rounded down; null for a vector that is
    null or has a null, infinite or NaN component."""
    v = F.col(vector).cast("array<double>")
    good = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(v, lambda x: F.floor(x * factor)))


class Space:
    """How vectors are stored and multiplied: ``dim`` (shorter vectors are
    filled up with zeros), ``kind`` (4 or 8 bytes a component), ``exact``
    (products in float64 are whole) and the largest norm."""

    def __init__(self, dim: int, most: int, norm2: int):
        self.dim, self.kind, self.exact = dim, "<i4" if most < 1 << 31 else "<i8", dim * most * most < 1 << 53
        self.norm = float(max(norm2, 1)) ** 0.5 * (1 + 1e-12)

    def read(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.kind).reshape(-1, self.dim).astype(np.float64 if self.exact else np.int64)

    def write(self, x: np.ndarray) -> bytes:
        return np.ascontiguousarray(x, self.kind).tobytes()

    def products(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        return (q @ x.T).astype(np.int64)

    def on_sphere(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        lift = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0))
        return np.column_stack([x, lift]) / self.norm

    def angles(self, scores: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Of scores of queries with these norms (one a row); a zero query is at a right angle to all."""
        with np.errstate(divide="ignore", invalid="ignore"):
            c = scores / (norms[:, None] * self.norm)
        return np.arccos(np.clip(np.where(norms[:, None] > 0, c, 0.0), -1, 1))


def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Angles between points on the sphere."""
    return np.arccos(np.clip(a @ b.T, -1, 1))


def split_points(points: np.ndarray, fan: int) -> list[int]:
    """Each farthest from those before it, the first farthest from point 0;
    fewer if points coincide."""
    out, near = [], between(points, points[:1])[:, 0]
    for _ in range(fan):
        far = int(np.argmax(near))
        if out and near[far] <= ROOM:
            break
        d = between(points, points[far:far + 1])[:, 0]
        near = np.minimum(near, d) if out else d
        out.append(far)
    return out


def top_tree(points: np.ndarray, rows_each: float, page_rows: int, fan: int = FAN, cells: int = CELLS) -> list[tuple[np.ndarray, list[int]]]:
    """Nodes ``(split points, children)`` from a sample of which each point
    stands for ``rows_each`` rows; a child is a node's number or ``-1 - cell``.
    Cells of about ``page_rows`` rows, ``cells`` at most; no node (one cell) if
    all fit a page."""
    nodes, todo, n_cells = [], [(points, None)], 1
    while todo:
        todo.sort(key=lambda x: len(x[0]))         # the fullest first, until there are enough
        own, parent = todo.pop()
        if len(own) * rows_each <= page_rows or len(own) < 2 * fan or n_cells + fan > cells:
            continue
        at = split_points(own, fan)
        if len(at) < 2:
            continue
        nearest = between(own, own[at]).argmin(1)
        nodes.append((own[at], [None] * len(at)))
        if parent:
            nodes[parent[0]][1][parent[1]] = len(nodes) - 1
        n_cells += len(at) - 1
        todo += [(own[nearest == j], (len(nodes) - 1, j)) for j in range(len(at))]
    cell = 0
    for _, children in nodes:
        for j, c in enumerate(children):
            if c is None:
                children[j], cell = -1 - cell, cell + 1
    return nodes


def cell_paths(nodes: list) -> dict[int, list[int]]:
    """For each cell the nodes above it."""
    out, todo = {}, [(0, [0])] if nodes else []
    while todo:
        at, path = todo.pop()
        for c in nodes[at][1]:
            if c < 0:
                out[-1 - c] = path
            else:
                todo.append((c, [*path, c]))
    return out or {0: []}


def cells_of(points: np.ndarray, nodes: list) -> np.ndarray:
    out = np.zeros(len(points), np.int64)
    todo = [(0, np.arange(len(points)))] if nodes else []
    while todo:
        at, own = todo.pop()
        splits, children = nodes[at]
        nearest = between(points[own], splits).argmin(1)
        for j, c in enumerate(children):
            mine = own[nearest == j]
            if c < 0:
                out[mine] = -1 - c
            elif len(mine):
                todo.append((c, mine))
    return out


def grow(points: np.ndarray, fan: int = FAN, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A page's tree: ``order`` of its points, ``nodes`` (first place, split
    points, then the end of each child) and ``ranges`` (node, split point,
    child, least and largest angle). A node's split points stand first, then
    its children one after the other; a child of ``leaf`` points or fewer, or
    of points that coincide, is a leaf and has no node."""
    order, nodes, ranges, todo = np.arange(len(points)), [], [], [(0, len(points))]
    while todo:
        start, end = todo.pop()
        if end - start <= leaf:
            continue
        own = order[start:end]
        at = split_points(points[own], fan)
        if len(at) < 2:
            continue
        splits, rest = own[at], np.delete(own, at)
        d = between(points[rest], points[splits])
        nearest = d.argmin(1)
        by = np.argsort(nearest, kind="stable")
        order[start:end] = np.r_[splits, rest[by]]
        ends = start + len(at) + np.searchsorted(nearest[by], np.arange(fan), "right")
        span = np.full((fan, fan, 2), [np.inf, -np.inf])
        for j in range(len(at)):
            if (mine := nearest == j).any():
                span[:len(at), j] = np.column_stack([d[mine].min(0), d[mine].max(0)])
        nodes.append([start, len(at), *ends])
        ranges.append(span)
        todo += zip([start + len(at), *ends[:len(at) - 1]], ends[:len(at)])
    return order, np.array(nodes, np.int32).reshape(-1, fan + 2), np.array(ranges, np.float64).reshape(-1, fan, fan, 2)


def reachable(angle: np.ndarray, least: np.ndarray, largest: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
    """Whether a query's annulus can hold a member of a subtree: ``angle``
    (queries x split points) to the split points, ``least`` and ``largest`` of
    the subtree from them. Any split point can rule it out."""
    near = np.maximum(angle - largest, least - angle).max(1)       # no member is nearer to the query
    far = (angle + largest).min(1)                                 # or farther away
    return (near <= outer + ROOM) & (far >= inner - ROOM)


class Positives:
    """Best ``k`` rows of an anchor's own label, the anchor's row left out."""

    def __init__(self, anchors: dict, k: int):
        self.k, self.label, self.row = k, anchors["label"], anchors["row"]
        n = len(self.label)
        self.low, self.high = anchors["least"].copy(), np.full(n, HIGHEST)
        self.slot, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def offer(self, who: np.ndarray, scores: np.ndarray, page: dict, at: slice) -> None:
        q, x = np.nonzero((scores >= self.low[who][:, None]) & (page["label"][at] == self.label[who][:, None]) & (page["row"][at] != self.row[who][:, None]))
        if len(q):
            self._keep(who[q], scores[q, x], page["id"][at][x])
            full = np.bincount(self.slot, minlength=len(self.low)) >= self.k
            low = np.full(len(self.low), HIGHEST)
            np.minimum.at(low, self.slot, self.score)
            self.low = np.where(full, np.maximum(low, self.low), self.low)

    def _keep(self, slot, score, ids) -> None:
        slot, score, ids = np.r_[self.slot, slot], np.r_[self.score, score], np.r_[self.ids, ids]
        by = np.lexsort((ids, -score, slot))
        s = slot[by]
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        by = by[np.arange(len(s)) - np.repeat(first, np.diff(np.r_[first, len(s)])) < self.k]
        self.slot, self.score, self.ids = slot[by], score[by], ids[by]


class Negatives(Positives):
    """Best ``k`` rows of other labels in each window of an anchor; slot =
    anchor x windows + window. An unused window has its low end above its high end."""

    def __init__(self, anchors: dict, k: int):
        super().__init__(anchors, k)
        self.lows, self.highs = anchors["low"].copy(), anchors["high"]           # anchors x windows
        self.low, self.high = np.where(self.lows <= self.highs, self.lows, HIGHEST).min(1), self.highs.max(1)

    def offer(self, who: np.ndarray, scores: np.ndarray, page: dict, at: slice) -> None:
        q, x = np.nonzero((scores >= self.low[who][:, None]) & (scores <= self.high[who][:, None]) & (page["label"][at] != self.label[who][:, None]))
        if not len(q):
            return
        s, a, windows = scores[q, x], who[q], self.lows.shape[1]
        n, w = np.nonzero((s[:, None] >= self.lows[a]) & (s[:, None] <= self.highs[a]))
        if not len(n):
            return
        self._keep(a[n] * windows + w, s[n], page["id"][at][x[n]])
        full = np.bincount(self.slot, minlength=self.lows.size) >= self.k
        low = np.full(self.lows.size, HIGHEST)
        np.minimum.at(low, self.slot, self.score)
        self.lows = np.where(full, low, self.lows.ravel()).reshape(self.lows.shape)
        self.low = np.where(self.lows <= self.highs, self.lows, HIGHEST).min(1)


def search_page(page: dict, who: np.ndarray, anchors: dict, found: Positives, space: Space) -> int:
    """Offers ``found`` all rows of a page that can be in the anchors'
    windows; returns how many products that took."""
    q, norms, work = anchors["vector"], anchors["norm"], 0
    node_at = {int(n[0]): i for i, n in enumerate(page["nodes"])}
    todo = [(0, len(page["id"]), who)]
    while todo:
        start, end, who = todo.pop()
        node = node_at.get(start)
        if node is None or not len(who):
            if len(who) and end > start:
                found.offer(who, space.products(q[who], page["vector"][start:end]), page, slice(start, end))
                work += len(who) * (end - start)
            continue
        m, ends = int(page["nodes"][node][1]), page["nodes"][node][2:]
        scores = space.products(q[who], page["vector"][start:start + m])
        found.offer(who, scores, page, slice(start, start + m))
        work += len(who) * m
        angle = space.angles(scores, norms[who])
        bounds = space.angles(np.column_stack([found.high[who], found.low[who]]).astype(np.float64), norms[who])
        zero = norms[who] == 0
        inner, outer = np.where(zero, 0, bounds[:, 0]), np.where(zero, np.pi, bounds[:, 1])
        span = page["ranges"][node][:m]
        for j in range(m):
            first, last = (start + m if j == 0 else int(ends[j - 1])), int(ends[j])
            if last > first:
                todo.append((first, last, who[reachable(angle, span[:, j, 0], span[:, j, 1], inner, outer)]))
    return work


def pages_for(anchors: dict, found: Positives, nodes: list, space: Space):
    """``f(page) -> anchors`` that a page can concern, by its ranges from the split points above it."""
    angle = [np.arccos(np.clip((anchors["vector"] @ p[:, :-1].T) / np.maximum(anchors["norm"], 1e-300)[:, None], -1, 1)) for p, _ in nodes]
    paths, norms = cell_paths(nodes), anchors["norm"]

    def f(page: dict) -> np.ndarray:
        bounds = space.angles(np.column_stack([found.high, found.low]).astype(np.float64), norms)
        ok, at = found.low <= found.high, 0
        for node in paths[page["cell"]]:
            m = len(nodes[node][0])
            span = page["above"][at:at + m]
            ok &= reachable(angle[node], span[:, 0], span[:, 1], bounds[:, 0], bounds[:, 1]) | (norms == 0)
            at += m
        return np.flatnonzero(ok)

    return f


PAGE = "cell int, rows binary, ids binary, labels binary, vectors binary, nodes binary, ranges binary, above binary, anchors binary, least binary"


def read_page(r: dict, space: Space) -> dict:
    return {"cell": r["cell"], "row": np.frombuffer(r["rows"], "<i8"), "id": np.frombuffer(r["ids"], "<i8"), "label": np.frombuffer(r["labels"], "<i8"),
            "vector": space.read(r["vectors"]), "nodes": np.frombuffer(r["nodes"], "<i4").reshape(-1, FAN + 2),
            "ranges": np.frombuffer(r["ranges"]).reshape(-1, FAN, FAN, 2), "above": np.frombuffer(r["above"]).reshape(-1, 2)}


def build_index(rows: DataFrame, space: Space, n: int, page_rows: int, positives: int) -> tuple[DataFrame, list]:
    """The table of pages (``PAGE``) of ``row, vec_id, label, vector, anchor``
    (saved rows), and the top of the tree. Every row is in one page."""
    spark = rows.sparkSession
    sample = rows.select("vector").orderBy(F.xxhash64("row"), "row").limit(max(64, min(SAMPLE, SAMPLE_VALUES // space.dim))).collect()
    points = np.zeros((len(sample), space.dim))
    for i, r in enumerate(sample):
        points[i, :len(r["vector"])] = r["vector"]
    nodes = top_tree(space.on_sphere(points), n / max(len(sample), 1), page_rows)
    sent = spark.sparkContext.broadcast((nodes, space))
    ddl = "row long, vec_id long, label long, anchor boolean, vector binary, cell int"
    schema = arrow_schema(ddl)

    def to_cells(batches):
        nodes, space = sent.value
        for batch in batches:
            if batch.num_rows:
                v = batch.column("vector")
                sizes = np.array(v.value_lengths())
                x = np.zeros((batch.num_rows, space.dim), np.int64)
                at = np.repeat(np.arange(batch.num_rows), sizes)
                x[at, np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.array(v.flatten())
                raw = [space.write(y) for y in x]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("row", "vec_id", "label", "anchor")], pa.array(raw, pa.binary()),
                                                  pa.array(cells_of(space.on_sphere(x), nodes), pa.int32())], schema=schema)

    placed = saved(rows.select("row", "vec_id", "label", "anchor", "vector").mapInArrow(to_cells, ddl), "hard-negatives-cells")
    sizes = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}      # CELLS at most
    parts = F.create_map(*[F.lit(y) for c, k in sizes.items() for y in (c, -(-k // page_rows))]) if sizes else F.create_map(F.lit(0), F.lit(1))
    page = F.pmod(F.xxhash64("row", F.lit(1)), F.element_at(parts, F.col("cell"))).cast("int")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, space = sent.value
        pdf = pdf.sort_values("row")
        x = space.read(b"".join(pdf["vector"]))
        u = space.on_sphere(x)
        order, tree, ranges = grow(u)
        cell = int(pdf["cell"].iloc[0])
        above = [between(u, nodes[k][0]) for k in cell_paths(nodes)[cell]]
        above = np.concatenate([np.column_stack([a.min(0), a.max(0)]) for a in above]) if above else np.zeros((0, 2))
        pdf, x = pdf.iloc[order], x[order]
        out = {"cell": cell, "rows": pdf["row"].to_numpy("<i8").tobytes(), "ids": pdf["vec_id"].to_numpy("<i8").tobytes(),
               "labels": pdf["label"].to_numpy("<i8").tobytes(), "vectors": space.write(x), "nodes": tree.astype("<i4").tobytes(),
               "ranges": ranges.tobytes(), "above": above.tobytes()}
        # The page's own anchors begin with what the page itself has.
        mine = np.flatnonzero(pdf["anchor"].to_numpy(bool))
        own = read_page(out, space)
        anchors = anchors_of(own["row"][mine], own["label"][mine], own["vector"][mine])
        found = Positives(anchors, positives)
        search_page(own, np.arange(len(mine)), anchors, found, space)
        return pd.DataFrame([out | {"anchors": mine.astype("<i4").tobytes(), "least": found.low.astype("<i8").tobytes()}])

    pages = placed.withColumn("page", page).groupBy("cell", "page").applyInPandas(build, PAGE)
    return saved(pages, "hard-negatives-pages"), nodes


def anchors_of(row: np.ndarray, label: np.ndarray, vector: np.ndarray, least: np.ndarray | None = None) -> dict:
    norm = np.sqrt((vector.astype(np.float64) ** 2).sum(1))
    return {"row": row, "label": label, "vector": vector, "norm": norm, "least": np.full(len(row), LOWEST) if least is None else least}


def anchor_table(pages: DataFrame, space: Space) -> DataFrame:
    """``row, vec_id, label, least, vector`` of all anchors."""
    ddl = "row long, vec_id long, label long, least long, vector binary"
    schema = arrow_schema(ddl)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                p, at = read_page(r, space), np.frombuffer(r["anchors"], "<i4")
                if len(at):
                    yield pa.RecordBatch.from_pydict({"row": p["row"][at], "vec_id": p["id"][at], "label": p["label"][at], "least": np.frombuffer(r["least"], "<i8"),
                                                      "vector": [space.write(v) for v in p["vector"][at]]}, schema=schema)

    return pages.mapInArrow(run, ddl)


def _hits(pages: DataFrame, anchors, nodes, space, kind, k: int) -> DataFrame:
    """``slot, id, score, work, rows``: each task's best of its pages; the
    last two, with slot -1, say how many products of how many it computed."""
    ddl = "slot long, id long, score long"
    schema = arrow_schema(ddl)

    def run(batches):
        who, tree = anchors.value, nodes.value[0]
        found = kind(who, k)
        chosen = pages_for(who, found, tree, space)
        work = rows = 0
        for batch in batches:
            for i in range(batch.num_rows):
                page = read_page({c: batch.column(c)[i].as_py() for c in ("cell", "rows", "ids", "labels", "vectors", "nodes", "ranges", "above")}, space)
                work += search_page(page, chosen(page), who, found, space)
                rows += len(page["id"])
        yield pa.RecordBatch.from_pydict({"slot": np.r_[found.slot, -1], "id": np.r_[found.ids, rows * len(who["row"])], "score": np.r_[found.score, work]}, schema=schema)

    return pages.mapInArrow(run, ddl)


def _best(hits: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return hits.filter("slot >= 0").withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, page_rows: int = 4096,
         vec_id: str = "vec_id", label: str = "label", vector: str = "vector", shares: list | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``. ``vectors``: whole-number vectors (``whole_vector``);
    ``anchors``: which rows are anchors. An anchor's positives are its first
    ``positives`` other rows of its label by inner product (ties: smaller id);
    with each come the first ``negatives`` rows of other labels whose score is
    from ``low`` to ``high`` percent of the positive's.

    Rows without id, label or vector take no part; an empty table gives no
    rows, nor does a positive without a row in its window (a negative positive
    score has none). Shorter vectors are filled up with zeros, zero vectors
    take part. Repeated rows count each; of two positives with one id each has
    its negatives. Other columns are not read. ``shares`` gets the share of
    all products that each block's two searches computed."""
    spark = vectors.sparkSession
    rows = saved(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                                F.coalesce(anchors, F.lit(False)).alias("anchor"), F.col(vector).cast("array<long>").alias("vector"))
                 .filter("vec_id is not null and label is not null and vector is not null"), "hard-negatives-rows")
    norm2 = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    n, n_anchors, dim, most, norm2 = rows.agg(F.count(F.lit(1)), F.count_if("anchor"), F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs))),
                                              F.max(norm2)).first()
    space = Space(max(dim or 0, 1), most or 0, norm2 or 0)
    pages, nodes = build_index(rows, space, n, page_rows, positives)
    sent = spark.sparkContext.broadcast((nodes, None))
    # Blocks dealt by a hash: an anchor's place in its block is its number there.
    asked = saved(anchor_table(pages, space), "hard-negatives-anchors")
    blocks = max(1, -(-n_anchors * space.dim * 8 // BLOCK_BYTES))
    results = []
    for b in range(blocks):
        got = asked.filter(F.pmod(F.xxhash64("row", F.lit(2)), F.lit(blocks)) == b).orderBy("row").collect()
        vecs = space.read(b"".join(r["vector"] for r in got))
        who = anchors_of(*[np.array([r[c] for r in got], np.int64) for c in ("row", "label")], vecs, np.array([r["least"] for r in got], np.int64))
        first = saved(_hits(pages, spark.sparkContext.broadcast(who), sent, space, Positives, positives), "hard-negatives-near")
        best = saved(_best(first, positives), "hard-negatives-positives")
        lows, highs = np.full((len(got), positives), HIGHEST), np.full((len(got), positives), LOWEST)
        for r in best.collect():                   # ``positives`` a row of the block
            lows[r["slot"], r["rank"] - 1], highs[r["slot"], r["rank"] - 1] = -(-low * r["score"] // 100), high * r["score"] // 100
        windows = spark.sparkContext.broadcast(who | {"low": lows, "high": highs})
        second = saved(_hits(pages, windows, sent, space, Negatives, negatives), "hard-negatives-far")
        names = spark.createDataFrame([(i, r["vec_id"]) for i, r in enumerate(got)], "slot long, anchor_id long")
        pairs = (best.join(names, "slot").select((F.col("slot") * positives + F.col("rank") - 1).alias("slot"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
        results.append(pairs.join(_best(second, negatives), "slot")
                       .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
        if shares is not None:
            for x in (first, second):
                done = x.filter("slot < 0").agg(F.sum("score"), F.sum("id")).first()
                shares.append(done[0] / max(done[1] or 0, 1))
    out = results[0]
    for x in results[1:]:
        out = out.union(x)
    return out
