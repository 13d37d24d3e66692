"""Near-duplicate embeddings by a random-projection tree forest.

A tree splits projections on random directions, level by level, near the median where few
vectors lie; vectors within a margin of a split spill into both children, so close pairs are
seldom parted, and several trees make up for those that are. A node that can't be split without
much spill stays a leaf. Splits are fitted on a bounded sample of vectors;
every vector is routed. Pairs are compared within leaves, exactly and in double precision.

Equal vectors are one class with a count. A leaf of any size is cut into blocks and compared
block by block; a pair that shares several leaves counts in the first of them only, so links
are counted without listing pairs, and each block emits a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import connected_components, ids_of_rows, materialise, numbered_rows


@dataclass(frozen=True)
class ForestBounds:
    """Trees, directions tried per node, largest share of a node that may spill, leaf and block size,
    sample of vectors. The margin is ``margin`` times the spread of the projected difference of two
    vectors at the threshold."""

    trees: int = 6
    tries: int = 3
    spill: float = 0.35
    margin: float = 0.5
    leaf: int = 256
    block: int = 1024
    sample: int = 20_000


@dataclass
class Forest:
    """Binary trees with heap-numbered nodes: directions per tree, level and try; per node the try
    (-1: a leaf) and threshold."""

    directions: np.ndarray
    choice: np.ndarray
    thresholds: np.ndarray
    margin: float


def fit_forest(x: np.ndarray, total: int, threshold: float, bounds: ForestBounds, seed: int = 7) -> Forest:
    """Fit on sampled unit vectors of one dimension; ``total``: vectors to be indexed.

    A split goes where least of the node's sample lies within the margin, near the median if it
    can; a node whose sample can't be cut without much spill (a dense group) stays a leaf.
    """
    rng = np.random.default_rng(seed)
    depth = max(0, int(np.ceil(np.log2(max(1.0, total / bounds.leaf)))))
    dim = x.shape[1]
    g = rng.normal(size=(bounds.trees, max(depth, 1), bounds.tries, dim))
    g /= np.linalg.norm(g, axis=3, keepdims=True)
    choice = np.full((bounds.trees, 2 << depth), -1, np.int64)
    thr = np.zeros((bounds.trees, 2 << depth))
    margin = bounds.margin * np.sqrt((2 - 2 * threshold) / dim)
    for t in range(bounds.trees):
        node = np.ones(len(x), np.int64)
        for level in range(depth):
            p = x @ g[t, level].T
            for k in range(1 << level, 2 << level):
                own = p[node == k]
                if len(own) < 32:
                    continue
                for near in (0.25, 0.05):  # quantiles near the median first
                    cuts = np.quantile(own, np.linspace(near, 1 - near, 15), axis=0)
                    spill = (np.abs(own[:, None, :] - cuts[None]) <= margin).mean(0)
                    q, r = np.unravel_index(np.argmin(spill), spill.shape)
                    if spill[q, r] <= bounds.spill:
                        choice[t, k], thr[t, k] = r, cuts[q, r]
                        break
            cut = choice[t, node] >= 0
            d = p[np.arange(len(x)), np.maximum(choice[t, node], 0)] > thr[t, node]
            node = np.where(cut, 2 * node + d, 0)  # rows in a leaf are done
    return Forest(g, choice, thr, margin)


def route(x: np.ndarray, forest: Forest | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of every leaf membership; a code holds tree and leaf. Without a forest: one leaf."""
    if forest is None:
        return np.arange(len(x)), np.ones(len(x), np.int64)
    rows, codes = [], []
    for t in range(len(forest.directions)):
        row, node = np.arange(len(x)), np.ones(len(x), np.int64)
        for level in range(forest.directions.shape[1]):
            live = forest.choice[t, node] >= 0
            rows.append(row[~live])
            codes.append((t << 40) + node[~live])
            row, node = row[live], node[live]
            if not len(row):
                break
            d = (x @ forest.directions[t, level].T)[row, forest.choice[t, node]] - forest.thresholds[t, node]
            both = np.abs(d) <= forest.margin
            row, node = (np.concatenate([row, row[both]]),
                         np.concatenate([2 * node + (d > 0), 2 * node[both] + (d[both] <= 0)]))
        rows.append(row)
        codes.append((t << 40) + node)
    return np.concatenate(rows), np.concatenate(codes)


def _unit(b: pa.RecordBatch, name: str = "v") -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list column."""
    col = b.column(name)
    return col.flatten().to_numpy(), np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy())])


def _by_dim(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) per dimension."""
    flat, off = _unit(b)
    size = np.diff(off)
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        x = flat[off[rows][:, None] + np.arange(d)].astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        yield rows, x / np.linalg.norm(x, axis=1, keepdims=True)


def _route_batches(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forests: dict[int, Forest] = sent.value
        for b in batches:
            for rows, x in _by_dim(b):
                dim = x.shape[1]
                at, code = route(x, forests.get(dim))
                order = np.lexsort((code, at))
                at, code = at[order], code[order]
                n = np.bincount(at, minlength=len(rows))
                take = pa.array(rows)
                yield pa.RecordBatch.from_pydict({
                    "cid": b.column("cid").take(take), "c": b.column("c").take(take),
                    "dim": pa.array(np.full(len(rows), dim, np.int32)),
                    "u": pa.ListArray.from_arrays(np.arange(0, x.size + 1, dim, dtype=np.int32), pa.array(x.reshape(-1))),
                    "codes": pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), pa.array(code))})
    return run


def _compare(threshold: float):
    def run(key, table):
        """One block, or two blocks against each other, of a leaf."""
        code, i, j = key[0].as_py(), key[2].as_py(), key[3].as_py()
        table = table.combine_chunks()
        u = np.stack([np.asarray(v) for v in table.column("u").to_numpy()])
        cid, c = table.column("cid").to_numpy(), table.column("c").to_numpy()
        own = table.column("own").to_numpy()
        lists = table.column("codes").to_pylist()
        before = sorted({x for r in lists for x in r if x < code})
        place = {x: k for k, x in enumerate(before)}
        seen = np.zeros((len(cid), max(1, len(before))), np.float32)
        for r, xs in enumerate(lists):
            seen[r, [place[x] for x in xs if x < code]] = 1
        p, q = np.flatnonzero(own == i), np.flatnonzero(own == j)
        hit = (u[p] @ u[q].T >= threshold) & (seen[p] @ seen[q].T == 0)
        links = np.zeros(len(cid), np.int64)
        if i == j:
            np.fill_diagonal(hit, False)
            links[p] = hit @ c[q]
        else:
            links[p] = hit @ c[q]
            links[q] = c[p] @ hit
        label = cid.copy()
        while hit.any():
            far = np.iinfo(np.int64).max
            down = np.minimum(label[p], np.where(hit, label[q][None, :], far).min(1))
            new = label.copy()
            new[p] = down
            new[q] = np.minimum(new[q], np.where(hit, down[:, None], far).min(0))
            if (new == label).all():
                break
            label = new
        keep = np.flatnonzero(links)
        return pa.table({"cid": pa.array(cid[keep]), "links": pa.array(links[keep]), "label": pa.array(label[keep])})
    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, bounds: ForestBounds = ForestBounds()) -> DataFrame:
    """One row per row of ``vectors`` (``vec_id, embedding``): ``vec_id, n_links, component_id, kept``.

    Vectors that are NULL, empty, zero or hold NULL or non-finite values link with nothing; so do
    vectors of different dimension. Rows with equal vectors link with each other, repeated ids
    included; rows that share an id count their links each and belong to one component. A NULL id gives NULL component and is kept. Other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    numbered = numbered_rows(rows, "vec_id", "vec-rows")
    if numbered is None:
        return _near_duplicates(rows, threshold, bounds)
    found = materialise(_near_duplicates(numbered.select(F.col("row").alias("vec_id"), "embedding"), threshold, bounds), "vec-found")
    by_id = ids_of_rows(numbered.select("vec_id", "row"), found.select(F.col("vec_id").alias("row"), F.col("component_id").alias("label")),
                        "vec_id", "vec-ids")
    known = found.join(by_id, F.col("vec_id") == F.col("row")).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component_id_of").alias("component_id"))
    return known.withColumn("kept", F.expr("vec_id <=> component_id")).unionByName(found.where("vec_id is null"))


def _near_duplicates(rows: DataFrame, threshold: float, bounds: ForestBounds) -> DataFrame:
    """``near_duplicates`` of rows with unique ids."""
    spark, v = rows.sparkSession, F.col("embedding")
    usable = (v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
              & F.exists(v, lambda x: x != 0))
    keys = materialise(rows.select("vec_id", F.coalesce(usable, F.lit(False)).alias("ok"),
                                   F.xxhash64("embedding").alias("k1"), F.hash("embedding").alias("k2")), "vec-keys")
    classes = materialise(keys.where("ok and vec_id is not null").groupBy("k1", "k2")
                          .agg(F.min("vec_id").alias("cid"), F.count("*").alias("c")), "vec-classes")
    total = classes.count()
    one = (rows.where(usable).join(classes, F.col("vec_id") == F.col("cid"))
           .where((F.xxhash64("embedding") == F.col("k1")) & (F.hash("embedding") == F.col("k2")))
           .select("cid", "c", F.col("embedding").alias("v")))
    one = materialise(one, "vec-one")
    sample = one.orderBy(F.xxhash64("cid"), "cid").limit(bounds.sample).select("v").collect()
    forests = {}
    for dim in {len(r["v"]) for r in sample}:  # a dimension that is not in the sample is one leaf
        x = np.array([r["v"] for r in sample if len(r["v"]) == dim], float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        forests[dim] = fit_forest(x / np.linalg.norm(x, axis=1, keepdims=True), total * len(x) // len(sample), threshold, bounds)
    sent = spark.sparkContext.broadcast(forests)
    member = materialise(one.mapInArrow(_route_batches(sent), "cid long, c long, dim int, u array<double>, codes array<long>"),
                         "vec-routed")
    placed = member.withColumn("code", F.explode("codes"))
    sizes = member.select("dim", F.explode("codes").alias("code")).groupBy("code", "dim").agg(
        F.ceil(F.count("*") / bounds.block).cast("int").alias("blocks"))
    sizes = materialise(sizes, "vec-leaves")
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    placed = (placed.join(sizes, ["code", "dim"]).withColumn("own", own)
              .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
              .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}))
    found = materialise(placed.select("code", "dim", "i", "j", "cid", "c", "u", "codes", "own")
                        .groupBy("code", "dim", "i", "j").applyInArrow(_compare(threshold), "cid long, links long, label long"),
                        "vec-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    component = connected_components(found.select(F.col("cid").alias("a"), F.col("label").alias("b")), "vec-cc")
    known = (classes.join(links, "cid", "left").join(component, F.col("cid") == F.col("id"), "left")
             .select("k1", "k2", (F.col("c") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "cid").alias("component_id")))
    return (keys.join(known.withColumn("ok", F.lit(True)), ["k1", "k2", "ok"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"))
            .withColumn("kept", F.expr("vec_id <=> component_id")))
