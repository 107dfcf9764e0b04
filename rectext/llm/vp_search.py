"""Nearest neighbours by largest inner product with vantage-point trees.

With one more coordinate, sqrt(M^2 - |x|^2) for the largest norm M, all
vectors lie on a sphere, and a product s of a query q stands for the angle
arccos(s / (M |q|)), a metric: the largest product is the smallest angle. A
node of a tree has a vantage point; the half of its points that are nearest
to it and the other half are its children, and it keeps the least and largest
angle of either. By the triangle inequality no point of a half is nearer to
the query than the query's distance from that range; a half is passed if this
bound exceeds ``factor`` times the angle of the k-th best found so far. Factor
one never passes a better point, so the result is exact; smaller factors look
at less.

The top of the tree comes from a bounded sample: it deals every row to a cell,
and a cell to shards of about ``shard_rows`` rows, each with a tree of its own
and its ranges from the vantage points above it. Queries first search their
own shard, where they are indexed; then blocks of bounded size go to all tasks,
and each task searches those of its shards that the bounds leave. Leaves are
multiplied as matrices; what comes near the k-th best is computed again in the
order of the components, which is the score that counts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rectext.llm.common import arrow_schema, saved
from rectext.llm.hard_negatives import between

#: Points of a leaf at least (or a quarter of a shard), cells at most; rows and components of the sample that the top of the tree is made from.
LEAF, CELLS, SAMPLE, SAMPLE_VALUES = 128, 2048, 8192, 1 << 20
#: Room for rounding: in angles, and of products relative to the norms.
ROOM, NEAR = 1e-6, 1e-9


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``row, vec_id, vector, norm2``: vectors without null, infinite or NaN
    components that aren't zero, and that have the commonest length (the
    shorter of equally common ones: products need equal lengths). Every such
    row, also those that share an id."""
    x = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
         .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
                 & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)))
    x = saved(x.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector", F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v).alias("norm2")), "vp-rows")
    usual = x.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").head()
    return x.filter(F.size("vector") == (usual["d"] if usual else 0))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in the order of the
    components, so equal vectors give equal results wherever they stand."""
    out = q[:, :1] * x[:, 0]
    for i in range(1, q.shape[1]):
        out += q[:, i:i + 1] * x[:, i]
    return out


def pair_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The same of rows of ``q`` and ``x`` that belong together."""
    out = q[:, 0] * x[:, 0]
    for i in range(1, q.shape[1]):
        out += q[:, i] * x[:, i]
    return out


def on_sphere(x: np.ndarray, norm: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(norm**2 - (x * x).sum(1), 0))]) / norm


def halves(points: np.ndarray, own: np.ndarray) -> tuple[int, np.ndarray, np.ndarray] | None:
    """Vantage point (the point farthest from the first), nearer and farther
    half of the others, with their angles; None if all points coincide."""
    far = int(own[np.argmax(between(points[own], points[own[:1]])[:, 0])])
    rest = own[own != far]
    d = between(points[rest], points[far:far + 1])[:, 0]
    if d.max() <= ROOM:
        return None
    by = np.argsort(d, kind="stable")
    return far, rest[by], d[by]


def top_tree(points: np.ndarray, rows_each: float, shard_rows: int, cells: int = CELLS) -> list[tuple]:
    """Nodes ``(vantage point, radius, near child, far child)`` from a sample
    of which a point stands for ``rows_each`` rows; a child is a node's number
    or ``-1 - cell``. No node if all rows fit one shard."""
    nodes, todo, n_cells = [], [(np.arange(len(points)), None)], 1
    while todo:
        todo.sort(key=lambda x: len(x[0]))
        own, parent = todo.pop()
        if len(own) * rows_each <= shard_rows or len(own) < 8 or n_cells >= cells or not (cut := halves(points, own)):
            continue
        far, rest, d = cut
        half = len(rest) // 2
        nodes.append([points[far], float(d[half - 1]), None, None])
        if parent:
            nodes[parent[0]][parent[1]] = len(nodes) - 1
        n_cells += 1
        todo += [(rest[:half], (len(nodes) - 1, 2)), (rest[half:], (len(nodes) - 1, 3))]
    cell = 0
    for node in nodes:
        for j in (2, 3):
            if node[j] is None:
                node[j], cell = -1 - cell, cell + 1
    return [tuple(n) for n in nodes]


def cells_of(points: np.ndarray, nodes: list) -> np.ndarray:
    out, todo = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))] if nodes else []
    while todo:
        at, own = todo.pop()
        vantage, radius, near, far = nodes[at]
        inside = between(points[own], vantage[None])[:, 0] <= radius
        for child, mine in ((near, own[inside]), (far, own[~inside])):
            if child < 0:
                out[mine] = -1 - child
            elif len(mine):
                todo.append((child, mine))
    return out


def cell_paths(nodes: list) -> dict[int, list[int]]:
    """For each cell the nodes above it."""
    out, todo = {}, [(0, [0])] if nodes else []
    while todo:
        at, path = todo.pop()
        for c in nodes[at][2:]:
            if c < 0:
                out[-1 - c] = path
            else:
                todo.append((c, [*path, c]))
    return out or {0: []}


def tree_order(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Order of a shard's points, and its nodes: ``(place of the vantage
    point, end, begin of the far half, least and largest angle of the near
    half, and of the far one)``. Behind the vantage point come the near half
    and the far half; a half of ``leaf`` points, or of points that coincide, is
    a leaf and has no node."""
    order, nodes, todo = np.arange(len(points)), [], [(0, len(points))]
    while todo:
        start, end = todo.pop()
        if end - start <= leaf or not (cut := halves(points, order[start:end])):
            continue
        far, rest, d = cut
        half = len(rest) // 2
        order[start:end] = np.r_[far, rest]
        middle = start + 1 + half
        nodes.append((start, end, middle, d[0], d[half - 1], d[half], d[-1]))
        todo += [(start + 1, middle), (middle, end)]
    return order, np.array(nodes, np.float64).reshape(-1, 7)


class Nearest:
    """The best ``k`` of each query so far, by score in the order of the
    components, ties by smaller id."""

    def __init__(self, queries: dict, k: int):
        n = len(queries["id"])
        self.q, self.k = queries, k
        self.low = queries.get("low", np.full(n, -np.inf)).copy()              # a score must reach it
        self.slot, self.ids, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def offer(self, who: np.ndarray, s: np.ndarray, ids: np.ndarray, x: np.ndarray, slack: np.ndarray) -> None:
        """``s``: products of queries ``who`` and rows ``x`` (with ``ids``), to within ``slack``."""
        least = self.low[who] - slack[who]
        new = np.flatnonzero(np.isinf(least))
        if len(ids) > self.k and len(new):         # the k-th best of these rows is a bound for queries without one
            own = np.where(ids[None] == self.q["id"][who[new]][:, None], -np.inf, s[new])
            least[new] = np.partition(own, len(ids) - self.k, axis=1)[:, len(ids) - self.k] - 2 * slack[who[new]]
        a, b = np.nonzero(s >= least[:, None])
        other = ids[b] != self.q["id"][who[a]]
        a, b = a[other], b[other]
        if not len(a):
            return
        slot, score = who[a], pair_products(self.q["vector"][who[a]], x[b])
        stay = score >= self.low[slot]
        slot, score, ids = np.r_[self.slot, slot[stay]], np.r_[self.score, score[stay]], np.r_[self.ids, ids[b][stay]]
        by = np.lexsort((ids, -score, slot))
        at = slot[by]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
        by = by[np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)])) < self.k]
        self.slot, self.score, self.ids = slot[by], score[by], ids[by]
        full = np.bincount(self.slot, minlength=len(self.low)) >= self.k
        low = np.full(len(self.low), np.inf)
        np.minimum.at(low, self.slot, self.score)
        self.low = np.where(full, np.maximum(low, self.low), self.low)

    def reach(self, who: np.ndarray, norm: float, factor: float) -> np.ndarray:
        """The angle of the k-th best so far, times ``factor``; before there are k all is in reach."""
        with np.errstate(invalid="ignore"):
            angle = np.arccos(np.clip(self.low[who] / (self.q["norm"][who] * norm), -1, 1))
        return np.where(np.isinf(self.low[who]), np.inf, angle * factor) + ROOM


def search_shard(shard: dict, who: np.ndarray, found: Nearest, norm: float, factor: float) -> int:
    """Offers ``found`` what a shard has for the queries ``who``; returns how many products that took."""
    q, norms, work = found.q["vector"], found.q["norm"], 0
    slack = NEAR * norms * norm
    node_at = {int(n[0]): n for n in shard["nodes"]}
    # What remains waits with its bound; halves in which a query lies come first.
    todo = [(0, len(shard["id"]), who, np.zeros(len(who)))]
    while todo:
        start, end, who, bound = todo.pop()
        who = who[bound <= found.reach(who, norm, factor)]
        if not len(who) or end <= start:
            continue
        node = node_at.get(start)
        if node is None or node[1] != end:
            s = q[who] @ shard["vector"][start:end].T
            work += s.size
            found.offer(who, s, shard["id"][start:end], shard["vector"][start:end], slack)
            continue
        s = q[who] @ shard["vector"][start:start + 1].T
        work += s.size
        found.offer(who, s, shard["id"][start:start + 1], shard["vector"][start:start + 1], slack)
        angle = np.arccos(np.clip(s[:, 0] / (norms[who] * norm), -1, 1))
        middle, (a, b, c, d) = int(node[2]), node[3:]
        near, far = np.maximum(np.maximum(angle - b, a - angle), 0), np.maximum(np.maximum(angle - d, c - angle), 0)
        first = near <= far
        for m in (first, ~first):
            if m.any():
                ends = [(start + 1, middle, who[m], near[m]), (middle, end, who[m], far[m])]
                todo += ends[::-1] if m is first else ends
    return work


SHARD = "cell int, ids binary, vectors binary, nodes binary, above binary, asked binary, low binary"


def read_shard(r: dict, dim: int) -> dict:
    return {"cell": r["cell"], "id": np.frombuffer(r["ids"], "<i8"), "vector": np.frombuffer(r["vectors"]).reshape(-1, dim),
            "nodes": np.frombuffer(r["nodes"]).reshape(-1, 7), "above": np.frombuffer(r["above"]).reshape(-1, 2)}


def queries_of(ids: np.ndarray, vectors: np.ndarray) -> dict:
    return {"id": ids, "vector": vectors, "norm": np.sqrt((vectors * vectors).sum(1))}


def build_index(rows: DataFrame, n: int, dim: int, norm: float, shard_rows: int, every: int, k: int, factor: float) -> tuple[DataFrame, list]:
    """The table of shards (``SHARD``) and the top of the tree. A shard's
    queries have searched it: ``low`` is what their k-th best reaches there."""
    spark = rows.sparkSession
    sample = rows.select("vector").orderBy(F.xxhash64("row"), "row").limit(max(64, min(SAMPLE, SAMPLE_VALUES // max(dim, 1)))).collect()
    points = on_sphere(np.array([r["vector"] for r in sample], float).reshape(len(sample), dim), norm)
    nodes = top_tree(points, n / max(len(sample), 1), shard_rows) if len(sample) else []
    sent = spark.sparkContext.broadcast(nodes)
    ddl = "row long, vec_id long, vector binary, cell int"
    schema = arrow_schema(ddl)

    def to_cells(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column("vector").flatten()).reshape(-1, dim)
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), pa.array([v.tobytes() for v in x], pa.binary()),
                                                  pa.array(cells_of(on_sphere(x, norm), sent.value), pa.int32())], schema=schema)

    placed = saved(rows.select("row", "vec_id", "vector").mapInArrow(to_cells, ddl), "vp-cells")
    sizes = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}          # CELLS at most
    parts = F.create_map(*[F.lit(y) for c, m in (sizes or {0: 1}).items() for y in (c, -(-m // shard_rows))])
    shard = F.pmod(F.xxhash64("row", F.lit(1)), F.element_at(parts, F.col("cell"))).cast("int")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        x = np.frombuffer(b"".join(pdf["vector"])).reshape(-1, dim)
        u = on_sphere(x, norm)
        order, tree = tree_order(u, max(LEAF, shard_rows // 4))
        cell = int(pdf["cell"].iloc[0])
        above = np.array([(d.min(), d.max()) for d in (between(u, sent.value[i][0][None]) for i in cell_paths(sent.value)[cell])]).reshape(-1, 2)
        own = {"cell": cell, "ids": pdf["vec_id"].to_numpy("<i8")[order].tobytes(), "vectors": x[order].tobytes(), "nodes": tree.tobytes(), "above": above.tobytes()}
        read = read_shard(own, dim)
        asked = np.flatnonzero(read["id"] % every == 0)
        found = Nearest(queries_of(read["id"][asked], read["vector"][asked]), k)
        search_shard(read, np.arange(len(asked)), found, norm, factor)
        return pd.DataFrame([own | {"asked": asked.astype("<i4").tobytes(), "low": found.low.tobytes()}])

    return saved(placed.withColumn("shard", shard).groupBy("cell", "shard").applyInPandas(build, SHARD), "vp-shards"), nodes


def asked_table(shards: DataFrame, dim: int) -> DataFrame:
    ddl = "vec_id long, low double, vector binary"
    schema = arrow_schema(ddl)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                at = np.frombuffer(r["asked"], "<i4")
                if len(at):
                    s = read_shard(r, dim)
                    yield pa.RecordBatch.from_pydict({"vec_id": s["id"][at], "low": np.frombuffer(r["low"]), "vector": [v.tobytes() for v in s["vector"][at]]}, schema=schema)

    return shards.mapInArrow(run, ddl)


def hits(shards: DataFrame, nodes: list, queries: dict, dim: int, norm: float, k: int, factor: float) -> DataFrame:
    """``query_id, vec_id, score`` of one block: the best ``k`` of each task's
    shards; a row without ``vec_id`` says how many products (``score``) of
    how many (``query_id``) the task computed."""
    sent = shards.sparkSession.sparkContext.broadcast((nodes, queries))
    ddl = "query_id long, vec_id long, score double"
    schema = arrow_schema(ddl)

    def run(batches):
        nodes, queries = sent.value
        found, paths, work, rows = Nearest(queries, k), cell_paths(nodes), 0, 0
        angle = [np.arccos(np.clip(queries["vector"] @ n[0][:-1] / queries["norm"], -1, 1)) for n in nodes]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = read_shard({c: batch.column(c)[i].as_py() for c in ("cell", "ids", "vectors", "nodes", "above")}, dim)
                bound = np.zeros(len(queries["id"]))
                for node, (a, b) in zip(paths[shard["cell"]], shard["above"]):
                    bound = np.maximum(bound, np.maximum(angle[node] - b, a - angle[node]))
                who = np.flatnonzero(bound <= found.reach(np.arange(len(bound)), norm, factor))
                work += search_shard(shard, who, found, norm, factor)
                rows += len(shard["id"])
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[queries["id"][found.slot], rows * len(queries["id"])]), pa.array([*found.ids.tolist(), None], pa.int64()),
                                          pa.array(np.r_[found.score, float(work)])], schema=schema)

    return shards.select("cell", "ids", "vectors", "nodes", "above").mapInArrow(run, ddl)


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, factor: float = 1.0, shard_rows: int = 8192, block: int = 16384,
            vec_id: str = "vec_id", vector: str = "embedding", shares: list | None = None) -> DataFrame:
    """Each row whose id is divisible by ``every`` against all rows but those
    of its own id: ``query_id, rank, vec_id, score``, the ``k`` with the
    largest inner product (ties: smaller id).

    Unusable vectors (see ``usable``) and null ids take no part; an empty
    table gives no rows. Rows that share an id are all searched, each with its
    own vector; where queries share one, the best of all of them are ranked
    together. Other columns are not read. Shards hold about ``shard_rows``
    vectors, blocks about ``block`` queries. ``shares`` gets each block's share
    of all products that was computed (beside the searches in the queries' own shards)."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, vector)
    n, asked, largest2, dim = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0), F.max("norm2"), F.max(F.size("vector"))).first()
    norm = math.sqrt(float(largest2 or 1.0)) * (1 + 1e-12)
    shards, nodes = build_index(rows, n, dim or 1, norm, shard_rows, every, k, factor)
    table = saved(asked_table(shards, dim or 1), "vp-asked")
    blocks, out = max(1, -(-asked // block)), None
    for b in range(blocks):
        got = table.filter(F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)) == b).orderBy("vec_id", "vector").collect()
        queries = queries_of(np.array([r["vec_id"] for r in got], np.int64), np.frombuffer(b"".join(r["vector"] for r in got)).reshape(len(got), dim or 1))
        queries["low"] = np.array([r["low"] for r in got], float)
        found = saved(hits(shards, nodes, queries, dim or 1, norm, k, factor), "vp-hits")
        if shares is not None:
            done = found.filter("vec_id is null").agg(F.sum("score"), F.sum("query_id")).first()
            shares.append(done[0] / max(done[1] or 0, 1))
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        best = (found.filter("vec_id is not null").withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))
        out = best if out is None else out.unionByName(best)
    return out
