"""Exact top-k inner products by best-first search in an M-tree.

The tree is loaded in bulk. A node with too many vectors picks some of its own as routing objects
and deals its vectors to the nearest; every routing object keeps its covering radius and the
distance to its parent's. Nodes of at most ``Bounds.node`` vectors are paged: pages of
``Bounds.page`` entries, sorted by their stored distance to the page's routing object.

A query looks for the largest inner products. By the triangle inequality no vector ``x`` below a
routing object ``p`` exceeds ``<q,p> + |q| d(p,x)``: with the covering radius for ``d`` that bounds a
node, with the stored distance an entry; and ``<q,p> <= <q,parent> + |q| d(p,parent)`` bounds a node
before its product is computed. A query first searches its own node, whose k-th score is then its
threshold on the way down the tree: level by level the nodes that may reach it remain. In every
node that remains, pages wait in a priority queue by their bound, and the search ends at the first
that can't reach the threshold.

Levels, nodes and query blocks are joins on the node, with the queries of a busy node dealt out in
blocks. Vectors are integers and all scores exact; bounds leave room for rounding.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialise, with_columns_of

EXACT = float(1 << 53)   # integers below this are exact as doubles
FITS = float(1 << 62)    # squared length of a vector; scores of such vectors fit a long


@dataclass(frozen=True)
class Bounds:
    """Vectors of a node that is paged, entries of a page, most routing objects of a node, queries of
    a task, rounds of splitting (what is too large after them is cut by hash)."""

    node: int = 8192
    page: int = 256
    routing: int = 64
    queries: int = 1024
    rounds: int = 24


def quantised(embedding: Column, factor: int = 1024) -> Column:
    """``floor(factor * x)`` of every component as a double; NULL for vectors that take no part."""
    scaled = F.transform(embedding, lambda x: F.floor(x.cast("double") * factor))
    length = F.aggregate(embedding, F.lit(0.0), lambda s, x: s + F.pow(F.abs(x.cast("double")) * factor + 1, F.lit(2)))
    usable = embedding.isNotNull() & ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(usable & (length < FITS), scaled)


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    flat = pa.chunked_array(column.chunks if isinstance(column, pa.ChunkedArray) else [column]).combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(n, -1) if len(values) else np.zeros((n, 0), np.int64)


def _inner(x: np.ndarray, y: np.ndarray, most: float) -> np.ndarray:
    """Exact products of integer rows whose absolute sums stay under ``most``."""
    if most < EXACT:
        return (x.astype(np.float64) @ y.T.astype(np.float64)).astype(np.int64)
    return x @ y.T


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))


def _nearest(x: np.ndarray, routing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of and distance to the nearest routing object."""
    best, far = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
    for j, r in enumerate(routing.astype(np.float64)):
        d = np.sqrt(((x - r) ** 2).sum(axis=1))
        best[d < far], far = j, np.minimum(d, far)
    return best, far


def _deal(key, table, routing):
    """Vectors of a part of a node to its nearest routing objects."""
    routing = routing.sort_by("r")
    x, r = _matrix(table.column("v"), len(table)), _matrix(routing.column("p"), len(routing))
    best, far = _nearest(x, r)
    names = np.array(routing.column("child").to_pylist(), object)
    return pa.table({"k": table.column("k"), "v": table.column("v"), "ids": table.column("ids"),
                     "node": pa.array(names[best], pa.string()), "far": pa.array(far, pa.float64())})


def _paged(x: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(routing object, places, distances) of the pages of ``x``; routing objects are picked evenly."""
    work = [np.arange(len(x))]
    while work:
        own = work.pop()
        if len(own) <= size:
            at = own[0]
            yield at, own, np.sqrt(((x[own] - x[at].astype(np.float64)) ** 2).sum(axis=1))
            continue
        picked = own[np.linspace(0, len(own) - 1, min(16, 1 + -(-len(own) // size))).astype(int)]
        best, _ = _nearest(x[own], x[picked])
        parts = [own[best == j] for j in range(len(picked))]
        if max(map(len, parts)) > 0.9 * len(own):  # no routing object attracts enough: cut as they come
            parts = [own[i:i + size] for i in range(0, len(own), size)]
        work.extend(p for p in parts if len(p))


def _page_rows(size: int):
    def run(key, table):
        """Pages of one node."""
        table = table.sort_by("k").combine_chunks()
        x = _matrix(table.column("v"), len(table))
        pivot = table.column("pivot")[0].as_py()
        rows: dict[str, list] = {c: [] for c in ("page", "dim", "p", "radius", "up", "v", "far", "k", "ids")}
        for n, (at, own, far) in enumerate(_paged(x, size)):
            order = np.argsort(far, kind="stable")
            own, far = own[order], far[order]
            up = None if pivot is None else float(np.sqrt(((x[at].astype(np.float64) - np.array(pivot, float)) ** 2).sum()))
            ks, ids = table.column("k").take(pa.array(own)).to_pylist(), table.column("ids").take(pa.array(own)).to_pylist()
            for c, value in zip(rows, (n, x.shape[1], x[at], float(far[-1]), up, x[own].reshape(-1), far, ks, ids)):
                rows[c].append(value)
        longs, doubles = pa.list_(pa.int64()), pa.list_(pa.float64())
        kinds = (pa.int32(), pa.int32(), longs, pa.float64(), pa.float64(), longs, doubles, longs, pa.list_(longs))
        return pa.table({"node": pa.array([key[0].as_py()] * len(rows["page"]), pa.string()),
                         **{c: pa.array(v, t) for (c, v), t in zip(rows.items(), kinds)}})
    return run


class _Best:
    """The k best (score, id) of one query and the score that others must reach."""

    def __init__(self, k: int, least: int | None):
        self.k, self.found, self.least = k, [], least

    def offer(self, scores: np.ndarray, classes: list, lists: list, own: int, own_id: int) -> None:
        if len(scores) > self.k + 1:  # a class may hold nothing but the query, k + 1 suffice, and their ties
            cut = np.partition(scores, len(scores) - self.k - 1)[len(scores) - self.k - 1]
            keep = np.flatnonzero(scores >= cut)
        else:
            keep = np.arange(len(scores))
        if self.least is not None:
            keep = keep[scores[keep] >= self.least]
        if not len(keep):
            return
        for j in keep:
            ids = list(lists[j])
            if classes[j] == own and own_id in ids:
                ids.remove(own_id)
            self.found.extend((-int(scores[j]), i) for i in ids)
        self.found = sorted(self.found)[:self.k]
        if len(self.found) == self.k:
            worst = -self.found[-1][0]
            self.least = worst if self.least is None else max(self.least, worst)


def _search(k: int):
    def run(key, queries, pages):
        """Best-first search of one node's pages for a block of queries."""
        out: dict[str, list] = {c: [] for c in ("query_id", "own", "vec_id", "score")}
        pages = pages.combine_chunks()
        many = len(pages)
        if many and len(queries):
            p = _matrix(pages.column("p"), many)
            dim = p.shape[1]
            radius, up = pages.column("radius").to_numpy(), pages.column("up").to_numpy()
            vectors = [np.asarray(v.values, np.int64).reshape(-1, dim) if dim else np.zeros((len(f), 0), np.int64)
                       for v, f in zip(pages.column("v"), pages.column("far"))]
            far = [np.asarray(f.values) for f in pages.column("far")]
            classes, lists = pages.column("k").to_pylist(), pages.column("ids").to_pylist()
            longest = float((_lengths(p) + radius).max()) + 1
            asked = _matrix(queries.column("v"), len(queries))
            ids, own = queries.column("query_id").to_pylist(), queries.column("own").to_pylist()
            least, near = queries.column("least").to_pylist(), queries.column("near").to_pylist()
            for q, size, one, cls, least_, near_ in zip(asked, _lengths(asked), ids, own, least, near):
                best, room = _Best(k, least_), 1e-9 * size * longest + 1e-6
                todo = np.arange(many)
                if near_ is not None and least_ is not None:  # by the parent's product alone
                    todo = todo[near_ + size * (up + radius) + room >= least_]
                products = _inner(p[todo], q[None, :], size * longest)[:, 0] if len(todo) else []
                queue = [(-(ip + size * radius[j] + room), j, ip) for j, ip in zip(todo, products)]
                heapq.heapify(queue)
                while queue:
                    bound, j, ip = heapq.heappop(queue)
                    if best.least is not None and -bound < best.least:
                        break
                    first = 0
                    if best.least is not None and size > 0:  # entries too near to the routing object to score enough
                        first = int(np.searchsorted(far[j], (best.least - ip - room) / size))
                    if first < len(far[j]):
                        scores = _inner(vectors[j][first:], q[None, :], size * longest)[:, 0]
                        best.offer(scores, classes[j][first:], lists[j][first:], cls, one)
                for score, other in best.found:
                    out["query_id"].append(one)
                    out["own"].append(cls)
                    out["vec_id"].append(other)
                    out["score"].append(-score)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})
    return run


def _children(key, queries, children):
    """Children of one node that queries may have to visit, with the products with their routing objects."""
    out: dict[str, list] = {c: [] for c in ("at", "node", "near")}
    p, asked = _matrix(children.column("pivot"), len(children)), _matrix(queries.column("v"), len(queries))
    radius = children.column("radius").to_numpy()
    up = children.column("up").to_numpy(zero_copy_only=False)
    names = children.column("child").to_pylist()
    longest, sizes = float((_lengths(p) + radius).max(initial=0)) + 1, _lengths(asked)
    least, near = queries.column("least").to_pylist(), queries.column("near").to_pylist()
    for i in range(len(asked)):
        room, todo = 1e-9 * sizes[i] * longest + 1e-6, np.arange(len(p))
        if least[i] is not None and near[i] is not None:
            todo = todo[near[i] + sizes[i] * (up + radius) + room >= least[i]]
        if not len(todo):
            continue
        products = _inner(p[todo], asked[i][None, :], sizes[i] * longest)[:, 0]
        if least[i] is not None:
            fit = products + sizes[i] * radius[todo] + room >= least[i]
            todo, products = todo[fit], products[fit]
        out["at"].extend([i] * len(todo))
        out["node"].extend(names[j] for j in todo)
        out["near"].extend(products.astype(np.float64).tolist())
    at = pa.array(out["at"], pa.int64())
    return pa.table({**{c: queries.column(c).take(at) for c in ("query_id", "own", "home", "v", "least")},
                     "near": pa.array(out["near"], pa.float64()), "node": pa.array(out["node"], pa.string())})


def _blocks(queries: DataFrame, right: DataFrame, size: int):
    """Both sides grouped by node and block: the queries of a node dealt to blocks, ``right`` for each."""
    several = queries.groupBy("node").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    dealt = queries.join(several, "node").withColumn("block", F.pmod(F.xxhash64("query_id", "own"), F.col("blocks")).cast("int"))
    copies = right.join(several, "node").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    return dealt.drop("blocks").groupBy("node", "block"), copies.drop("blocks").groupBy("node", "block")


def build(points: DataFrame, bounds: Bounds = Bounds()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tree over ``points`` (``k, v, ids``; ``v`` distinct): its vectors by final node (``k, node``), its
    routing objects (``parent, node, pivot, radius, up``) and its pages."""
    spark = points.sparkSession
    rows = points.select("k", "v", "ids", F.concat(F.lit("d"), F.size("v").cast("string")).alias("node"),
                         F.lit(None).cast("double").alias("far"))
    settled, routes = [], []
    for n in range(bounds.rounds):
        sizes = materialise(rows.groupBy("node").agg(F.count("*").alias("size")), "mtree-sizes")
        settled.append(rows.join(sizes.where(F.col("size") <= bounds.node), "node", "left_semi"))
        large = sizes.where(F.col("size") > bounds.node)
        if large.isEmpty():
            rows = None
            break
        rows = rows.join(large, "node").withColumn("part", F.pmod(F.hash("k"), F.ceil(F.col("size") / bounds.node)).cast("int"))
        wanted = F.least(F.lit(bounds.routing), 2 + F.ceil(2 * F.col("size") / bounds.node))
        drawn = F.xxhash64("k", F.lit(n)).cast("double") / 2.0**64 + 0.5
        picked = rows.where(drawn * F.col("size") < wanted)
        picked = materialise(picked.withColumn("child", F.concat_ws(".", "node", F.format_string("%d", "k")))
                             .select("node", "child", F.col("k").alias("r"), F.col("v").alias("p"), F.col("far").alias("up"), "size"),
                             "mtree-routing")
        able = picked.groupBy("node").count().where("count > 1").select("node")
        picked = picked.join(able, "node", "left_semi")
        copies = picked.withColumn("part", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("size") / bounds.node) - 1).cast("int"))))
        still = rows.join(able, "node", "left_anti").select("k", "v", "ids", "node", "far")  # drew none: next round
        dealt = (rows.join(able, "node", "left_semi").select("k", "v", "ids", "node", "part").groupBy("node", "part")
                 .cogroup(copies.select("node", "part", "r", "p", "child").groupBy("node", "part"))
                 .applyInArrow(_deal, "k long, v array<long>, ids array<long>, node string, far double"))
        dealt = materialise(dealt, "mtree-dealt")
        cover = dealt.groupBy("node").agg(F.max("far").alias("radius")).withColumnRenamed("node", "child")
        routes.append(picked.join(cover, "child").select(F.col("node").alias("parent"), F.col("child").alias("node"),
                                                         F.col("p").alias("pivot"), "radius", "up"))
        rows = materialise(dealt.unionByName(still), "mtree-rows")
    if rows is not None:
        settled.append(rows)
    leaves = settled[0]
    for more in settled[1:]:
        leaves = leaves.unionByName(more)
    none = spark.createDataFrame([], "parent string, node string, pivot array<long>, radius double, up double")
    for more in routes:
        none = none.unionByName(more)
    routes = materialise(none, "mtree-routes")
    leaves = materialise(leaves, "mtree-leaves")
    # a node that could not be split is paged in parts
    parts = leaves.groupBy("node").agg(F.ceil(F.count("*") / (2 * bounds.node)).cast("int").alias("parts"))
    cut = (leaves.join(parts, "node").withColumn("part", F.pmod(F.hash("k"), F.col("parts")))
           .join(routes.select("node", "pivot"), "node", "left"))
    pages = cut.select("node", "part", "k", "v", "ids", "pivot").groupBy("node", "part").applyInArrow(
        _page_rows(bounds.page), "node string, page int, dim int, p array<long>, radius double, up double, v array<long>, "
        "far array<double>, k array<long>, ids array<array<long>>")
    return leaves.select("k", "node"), routes, materialise(pages, "mtree-pages")


def top_inner_products(vectors: DataFrame, k: int = 10, every: int = 100, factor: int = 1024,
                       bounds: Bounds = Bounds()) -> DataFrame:
    """The ``k`` largest inner products of the rows whose ``vec_id`` ``every`` divides with all other rows:
    ``query_id, rank, vec_id, score``, ties to the smaller id.

    Components are ``floor(factor * x)``. No part take vectors that are NULL, hold NULL or non-finite
    components or are so long (2^31 after scaling) that scores might not fit a long, and rows with a
    NULL id. Vectors meet those of their own dimension; empty ones are a dimension of their own, with
    score 0. Equal vectors under different ids are candidates each; a row that repeats an id is a
    candidate of its own, and queries with the same id and different vectors are answered each.
    Queries that meet no other row have no result; an empty table gives no rows. Other columns are
    ignored, whatever their names.
    """
    rows = with_columns_of(vectors, [("vec_id", "long"), ("embedding", "array<double>")])
    rows = materialise(rows.select("vec_id", quantised(F.col("embedding"), factor).alias("v")).where("vec_id is not null and v is not null"),
                       "mtree-input")
    # one point per vector with its smallest ids, one more than asked for since the query's own may be one
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    points = first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = materialise(points.withColumn("k", F.monotonically_increasing_id()), "mtree-points")
    leaves, routes, pages = build(points, bounds)

    home = points.select("k", "v").join(leaves, "k")
    asked = rows.where(F.col("vec_id") % every == 0).distinct().join(home, "v")
    asked = materialise(asked.select(F.col("vec_id").alias("query_id"), F.col("k").alias("own"), F.col("node").alias("home"), "v"),
                        "mtree-asked")
    null = F.lit(None)
    found_schema = "query_id long, own long, vec_id long, score long"

    def searched(queries: DataFrame, name: str) -> DataFrame:
        left, right = _blocks(queries.select("node", "query_id", "own", "v", "least", "near"), pages, bounds.queries)
        return materialise(left.cogroup(right).applyInArrow(_search(k), found_schema), name)

    near = searched(asked.withColumns({"node": F.col("home"), "least": null.cast("long"), "near": null.cast("double")}), "mtree-home")
    full = near.groupBy("query_id", "own").agg(F.count("*").alias("n"), F.min("score").alias("s"))
    least = full.select("query_id", "own", F.when(F.col("n") >= k, F.col("s")).alias("least"))
    frontier = (asked.join(least, ["query_id", "own"], "left")
                .withColumns({"node": F.concat(F.lit("d"), F.size("v").cast("string")), "near": null.cast("double")}))
    found = near
    child_schema = "query_id long, own long, home string, v array<long>, least long, near double, node string"
    kids = routes.select(F.col("node").alias("child"), F.col("parent").alias("node"), "pivot", "radius", "up")
    frontier = materialise(frontier.join(kids, "node", "left_semi"), "mtree-frontier")
    while not frontier.isEmpty():
        left, right = _blocks(frontier, kids, bounds.queries)
        reached = materialise(left.cogroup(right).applyInArrow(_children, child_schema), "mtree-reached")
        inner = reached.join(kids, "node", "left_semi")
        found = found.unionByName(searched(reached.join(kids, "node", "left_anti").where("node <> home"), "mtree-found"))
        frontier = materialise(inner, "mtree-frontier")
    ranks = Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
