"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf; runs of ``FAN`` consecutive nodes become their parent, per language and then
over the languages. Nodes carry labels in an order in which children precede their parent (the
last leaf below a node, then its level). A forward sweep visits labels in order: a priority queue
holds the digests on their way to parents, and a node takes what the queue holds for its label,
so no node looks up another one. The reversed sweep visits the same labels backwards and sends
each child what its parent received, with the child's siblings before it: proof suffixes, which
arrive at the leaves whole.

At scale the queue between tasks is Spark's sorted exchange: leaves are numbered by a range sort,
``BLOCK`` consecutive nodes are one task's sweep, and the roots of the blocks are the nodes of the
next layer, log_512(n) layers in all. Texts are hashed in the scan and never shuffled.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialise, with_columns_of

FAN_BITS = 3                 # eight children
LEVELS = 3                   # levels of a block
BLOCK = 1 << (FAN_BITS * LEVELS)
COLUMNS = [("doc_id", "long"), ("source", "string"), ("lang", "string"), ("n_chars", "long"), ("text", "string")]


def _digest(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def levels_over(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n >> FAN_BITS), levels + 1
    return levels


def forward(digests: list[str], levels: int) -> list[tuple[int, int, int, list[str], str]]:
    """Inner nodes above ``digests`` in label order: (last leaf, level, number, children, digest)."""
    last, queue, done = len(digests) - 1, [], []

    def send(level: int, number: int, digest: str) -> None:
        if level < levels:
            parent = number >> FAN_BITS
            end = min(((parent + 1) << (FAN_BITS * (level + 1))) - 1, last)
            heappush(queue, (end, level + 1, parent, number, digest))

    for i, leaf in enumerate(digests):
        send(0, i, leaf)
        while queue and queue[0][0] <= i:
            label, children = queue[0][:3], []
            while queue and queue[0][:3] == label:
                children.append(heappop(queue)[4])
            done.append((*label, children, _digest("".join(children))))
            send(label[1], label[2], done[-1][4])
    return done


def backward(n: int, done: list, above: tuple) -> list[tuple]:
    """Proof suffix of each of the ``n`` nodes below ``done``: chained ``(left, right, rest)`` with the
    siblings' digests on both sides, level by level, then ``above``."""
    if not done:
        return [above] * n
    top, found, queue = done[-1], [above] * n, []
    heappush(queue, (-top[0], -top[1], -top[2], above))
    for end, level, number, children, _ in reversed(done):
        *label, rest = heappop(queue)
        if label != [-end, -level, -number]:
            raise RuntimeError("labels out of order")
        for k in range(len(children)):
            own = (number << FAN_BITS) + k
            suffix = ("".join(children[:k]), "".join(children[k + 1:]), rest)
            if level == 1:
                found[own] = suffix
            else:
                heappush(queue, (-min(((own + 1) << (FAN_BITS * (level - 1))) - 1, n - 1), 1 - level, -own, suffix))
    return found


def _chain(lefts: list[str], rights: list[str]) -> tuple:
    chain: tuple = ()
    for left, right in zip(reversed(lefts), reversed(rights)):
        chain = (left, right, chain)
    return chain


def _walk(chain: tuple):
    while chain:
        yield chain[0], chain[1]
        chain = chain[2]


def _columns(table: pa.Table, *names: str) -> list[list]:
    return [table.column(c).to_pylist() for c in names]


def _block_nodes(table: pa.Table) -> tuple[pa.Table, list[str], list]:
    table = table.sort_by("idx")
    digests = table.column("digest").to_pylist()
    return table, digests, forward(digests, min(LEVELS, levels_over(table.column("n")[0].as_py())))


def _block_root(key, table):
    _, digests, done = _block_nodes(table)
    n = table.column("n")[0].as_py()
    return pa.table({"g": pa.array([key[0].as_py()], pa.string()), "idx": pa.array([key[1].as_py()], pa.int64()),
                     "n": pa.array([-(-n // BLOCK)], pa.int64()),
                     "digest": pa.array([done[-1][4] if done else digests[0]], pa.string())})


def _inner_suffixes(key, table, above):
    """Suffixes of the nodes of one block, from its root's."""
    table, digests, done = _block_nodes(table)
    lefts, rights, root, subroot = (c[0] for c in _columns(above, "lefts", "rights", "root", "subroot"))
    paths = [list(_walk(c)) for c in backward(len(digests), done, _chain(lefts, rights))]
    text, texts = pa.string(), pa.list_(pa.string())
    return pa.table({"g": table.column("g").cast(text), "idx": table.column("idx").cast(pa.int64()),
                     "lefts": pa.array([[a for a, _ in p] for p in paths], texts),
                     "rights": pa.array([[b for _, b in p] for p in paths], texts),
                     "root": pa.array([root] * len(paths), text), "subroot": pa.array([subroot] * len(paths), text),
                     "digest": table.column("digest").cast(text)})


def _leaf_proofs(key, table, above):
    """Proof digest and root folded from the leaf as it is now, of one block of leaves."""
    table, leaves, done = _block_nodes(table)
    ids, now = _columns(table, "doc_id", "now")
    lefts, rights, root, subroot = (c[0] for c in _columns(above, "lefts", "rights", "root", "subroot"))
    proofs, folded, shared = [], [], {}
    for leaf, changed, chain in zip(leaves, now, backward(len(leaves), done, _chain(lefts, rights))):
        node, own = changed or leaf, ""
        if chain:
            own, rest = chain[0] + chain[1], chain[2]
            if id(rest) not in shared:  # the leaves of one run share what follows their siblings
                shared[id(rest)] = "".join(a + b for a, b in _walk(rest))
            own += shared[id(rest)]
        proofs.append(_digest(own))
        for left, right in _walk(chain):
            node = _digest(left + node + right)
        folded.append(node)
    text = pa.string()
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "leaf": pa.array(leaves, text),
                     "subroot": pa.array([subroot] * len(ids), text), "root": pa.array([root] * len(ids), text),
                     "proof_sha256": pa.array(proofs, text), "folded_root": pa.array(folded, text),
                     "verified": pa.array([f == root for f in folded], pa.bool_())})


def _field(name: str, value: Column | None = None) -> Column:
    s = (F.col(name) if value is None else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """SHA-256 of the five fields of a row, NULL as ``-``; ``text`` in place of the column."""
    return F.sha2(F.concat(*[_field(c, text if c == "text" else None) for c, _ in COLUMNS]), 256)


def tampered(every: int = 3) -> Column:
    """Rows whose text the check changes: those whose id's CRC-32 ``every`` divides (never a NULL id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx``, their place from 0 within ``g`` by ``order``, and ``n``, the rows of ``g``.

    A range sort over (g, order) cuts hot groups too; a place is the row's offset within its slice
    plus the sizes of the group's earlier slices (one row per slice and group). Rows equal in all of
    ``order`` are spread as they come.
    """
    spread = rows.withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(spread.repartitionByRange("g", *order, "_at").sortWithinPartitions("g", *order, "_at")
                         .withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33).alias("_part")
    slices = placed.groupBy("g", part).agg(F.min("_at").alias("_from"), F.count("*").alias("_rows"))
    w = Window.partitionBy("g")
    before = F.sum("_rows").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    slices = slices.select("g", "_part", "_from", F.coalesce(before, F.lit(0)).alias("_before"),
                           F.sum("_rows").over(w).alias("n"))
    return (placed.withColumn("_part", part).join(slices, ["g", "_part"])
            .withColumn("idx", F.col("_at") - F.col("_from") + F.col("_before")).drop("_at", "_part", "_from", "_before"))


_NODE = "g string, idx long, n long, digest string"
_SUFFIX = "g string, idx long, lefts array<string>, rights array<string>, root string, subroot string, digest string"


def _layers(bottom: DataFrame, most: int, name: str) -> list[DataFrame]:
    """``bottom`` and the layers of block roots above it, until each ``g`` (of at most ``most`` nodes) has one."""
    layers = [bottom]
    while most > 1:
        nodes = layers[-1].select("g", "idx", "n", "digest", F.expr(f"idx div {BLOCK}").alias("block"))
        layers.append(materialise(nodes.groupBy("g", "block").applyInArrow(_block_root, _NODE), name))
        most = -(-most // BLOCK)
    return layers


def _spread(nodes: DataFrame, above: DataFrame, fn, schema: str) -> DataFrame:
    """Deliver each block of ``nodes`` the suffix of its root."""
    return (nodes.withColumn("block", F.expr(f"idx div {BLOCK}")).groupBy("g", "block")
            .cogroup(above.withColumnRenamed("idx", "block").groupBy("g", "block")).applyInArrow(fn, schema))


def manifest(docs: DataFrame, every: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Leaves of a language ascend by id, NULL first, equal ids by leaf digest, so repeated rows have a
    leaf each (equal leaves, proofs by place); NULL is a language of its own and the first. A NULL
    field counts as ``-``, an empty text as ``0:``. The rows ``tampered`` names have A-Z of their text
    lower-cased before their root is folded again from the original siblings; texts without such
    letters stay verified. Only the five columns are read, missing ones count as NULL; an empty table gives no rows. A tree of one
    leaf is its own root, with the digest of the empty string as proof.
    """
    docs = with_columns_of(docs, COLUMNS)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hashed = materialise(docs.select("doc_id", F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("g"),
                                     leaf_digest().alias("digest"),
                                     F.when(tampered(every) & F.col("text").rlike("[A-Z]"), leaf_digest(lower)).alias("now")),
                         "merkle-leaves")
    leaves = materialise(ranked(hashed, ["doc_id", "digest"], "merkle-sorted"), "merkle-ranked")
    most = leaves.agg(F.max("n")).first()[0] or 0
    trees = _layers(leaves, most, "merkle-nodes")
    subroots = trees[-1].select(F.lit("").alias("g"), F.col("g").alias("lang_key"), "digest")
    subroots = materialise(ranked(subroots, ["lang_key"], "merkle-langs"), "merkle-subroots")
    tops = _layers(subroots, subroots.count(), "merkle-top")

    none = F.array().cast("array<string>")
    above = tops[-1].select("g", "idx", none.alias("lefts"), none.alias("rights"), F.col("digest").alias("root"),
                            F.lit(None).cast("string").alias("subroot"), "digest")
    for nodes in reversed(tops[:-1]):
        above = materialise(_spread(nodes.select("g", "idx", "n", "digest"), above, _inner_suffixes, _SUFFIX), "merkle-down")
    above = subroots.select("idx", "lang_key").join(above, "idx").select(
        F.col("lang_key").alias("g"), F.lit(0).cast("long").alias("idx"), "lefts", "rights", "root",
        F.col("digest").alias("subroot"), "digest")
    for nodes in reversed(trees[1:-1]):
        above = materialise(_spread(nodes, above, _inner_suffixes, _SUFFIX), "merkle-down")
    schema = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean")
    return _spread(trees[0].select("g", "idx", "n", "digest", "doc_id", "now"), above, _leaf_proofs, schema)
