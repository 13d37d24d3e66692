"""N-gram Jaccard join by set-relation skipping.

A text is the set of its distinct k-word shingles (64-bit hashes). Two sets link when
``100 * |x & y| >= percent * |x | y|``. The join is exact and never lists the pairs of a
group of copies:

1. Equal sets fall into one class (set size and two 64-bit digests). Only one set of each
   class enters the index, so exact copies cost one row.
2. Index lists by position. Tokens are ordered by a fixed-size count sketch of all
   documents (rare first) and a set is indexed under its first
   ``n - ceil(percent * n / 100) + 1`` tokens, with position and size. An entry falls into
   a size block, sizes that differ by more than the threshold allows are two blocks or
   more apart and are skipped unread; inside a block the position bound
   ``1 + min(rest of x, rest of y) >= needed overlap`` skips entries.
3. Answers by set relation. Lists of up to ``SHORT`` sets are compared pair by pair. In a
   longer list one set is the pivot; the others are compared with it alone and remember their distance to it. Sets that link get one component, and
   the answers of a member then hold for its whole component: later passes compare only
   sets of different components that share a list, and by the triangle inequality of the
   Jaccard distance only those whose distances to their common pivot differ by no more
   than the threshold. Passes repeat with other pivots while lists with several components
   would give many pairs; a last pass compares every pair that is left.

A pair reaches the exact comparison only if bit maps of its two sets (two to four bits per
element) allow the overlap (the bound is exact: a bit that differs is an element that differs).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .tables import connected_components, drop_table, ids_of_rows, materialise, numbered_rows

#: Least and most cells of the count sketch, and bytes of text per cell: the sketch follows the corpus, so
#: tokens are ordered alike at every size until its bound.
CELLS = (1 << 19, 1 << 24)
TEXT_PER_CELL = 256
SLICES = 32
PASSES = 3
#: Bits of the map that travels with the entries of long lists, and its columns.
SIGN_BITS = 512
SIGNS = [f"z{i}" for i in range(SIGN_BITS // 64)]
SHORT = 8


def _needed(n: str, m: str, percent: int) -> str:
    """SQL: smallest overlap of sets with n and m elements that reaches the threshold."""
    return f"cast(ceil({percent} * ({n} + {m}) / {100 + percent}) as bigint)"


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    for b in batches:
        if b.num_rows:
            yield b.column(0), b.column(1)


def sketch_cells(text: DataFrame) -> int:
    """Cells of the count sketch, a power of two."""
    size = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(CELLS[1], max(CELLS[0], 1 << round(math.log2(max(1, size / TEXT_PER_CELL)))))


def _scan_classes(k: int, cells: int):
    """Per document (id, n, two digests of the set); per task the slices of its count sketch."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts = np.zeros(cells, np.uint32)
        part = TaskContext.get().partitionId()
        schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("s1", pa.int64()),
                            ("s2", pa.int64()), ("slice", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])
        for ids, text in _text_batches(batches):
            n = np.zeros(len(ids), np.int64)
            s1, s2 = np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.uint64)
            for row, s in tokens.shingle_sets(text, k):
                n[row] = len(s)
                s1[row] = np.add.reduce(tokens.mix64(s))
                s2[row] = np.bitwise_xor.reduce(tokens.mix64(s ^ np.uint64(0x5851F42D4C957F2D)))
                counts[(s & np.uint64(cells - 1)).astype(np.int64)] += 1
            m = len(ids)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                 pa.array(np.full(m, -1, np.int32)), pa.array(np.full(m, part, np.int32)), pa.nulls(m, pa.binary())],
                schema=schema)
        if counts.any():
            packed = [zlib.compress(c.astype(np.int64).tobytes(), 1) for c in np.split(counts, SLICES)]
            empty = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [empty, empty, empty, empty, pa.array(np.arange(SLICES, dtype=np.int32)),
                 pa.array(np.full(SLICES, part, np.int32)), pa.array(packed, pa.binary())], schema=schema)
    return scan, "doc_id long, n_shingles long, s1 long, s2 long, slice int, part int, counts binary"


def _sum_slices(sketch: DataFrame) -> np.ndarray:
    """Sum the tasks' sketches (two levels, so a group stays small) and return the counts' powers of two,
    from one: a byte a cell reaches the driver, in SLICES rows."""
    def add(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
        total, first = None, None
        for b in batches:
            for r in b.to_pylist():
                x = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
                total = x.copy() if total is None else total + x
                first = r
        if last:
            total = np.where(total > 0, np.minimum(63, np.log2(np.maximum(total, 1)).astype(np.uint8) + 1), 0).astype(np.uint8)
        yield pa.RecordBatch.from_pydict(
            {"slice": pa.array([first["slice"]], pa.int32()), "part": pa.array([first["part"] // 64], pa.int32()),
             "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    schema = "slice int, part int, counts binary"
    level = sketch.select("slice", "part", "counts")
    level = level.groupBy("slice", F.expr("part div 64")).applyInArrow(lambda t: _table(add(t.to_batches(), False)), schema)
    level = level.groupBy("slice").applyInArrow(lambda t: _table(add(t.to_batches(), True)), schema)
    parts = {r["slice"]: np.frombuffer(zlib.decompress(bytes(r["counts"])), np.uint8) for r in level.collect()}
    return np.concatenate([parts[i] for i in range(SLICES)]) if parts else np.zeros(CELLS[0], np.uint8)


def _table(batches) -> pa.Table:
    return pa.Table.from_batches(list(batches))


def _scan_index(k: int, percent: int, levels):
    """Per document: its first tokens in order and the bit map of its set."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(zlib.decompress(levels.value), np.uint8)
        for ids, text in _text_batches(batches):
            rows, sizes, heads, maps, signs = [], [], [], [], []
            for row, s in tokens.shingle_sets(text, k):
                n = len(s)
                p = n - (percent * n + 99) // 100 + 1
                key = s >> np.uint64(6)
                key |= level[(s & np.uint64(len(level) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(58)
                heads.append(s[np.argsort(key, kind="stable")[:p]].view(np.int64))
                bits = np.zeros(_map_bits(n), np.uint8)
                bits[s & np.uint64(len(bits) - 1)] = 1
                packed = np.packbits(bits, bitorder="little")
                maps.append(packed.tobytes())
                signs.append(_fold(packed, SIGN_BITS).view(np.int64))
                rows.append(row)
                sizes.append(n)
            if rows:
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.take(pa.array(rows)),
                    "n": pa.array(sizes, pa.int64()),
                    "head": pa.ListArray.from_arrays(np.cumsum([0, *map(len, heads)]).astype(np.int32),
                                                     pa.array(np.concatenate(heads))),
                    "map": pa.array(maps, pa.binary()),
                    **{c: pa.array([x[i] for x in signs], pa.int64()) for i, c in enumerate(SIGNS)}})
    return scan, "doc_id long, n long, head array<long>, map binary, " + ", ".join(f"{c} long" for c in SIGNS)


def _map_bits(n: int) -> int:
    """Bits of the map of a set: a power of two, two to four per element, 512 at least."""
    return max(512, 1 << (2 * n - 1).bit_length())


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Map of ``size`` bits from a larger one."""
    return np.bitwise_or.reduce(bits.reshape(-1, size // 8), axis=0)


def _map_filter(percent: int):
    """Pairs whose maps allow the needed overlap: a bit that differs is an element that differs."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.array([i.bit_count() for i in range(256)], np.int64)
        for b in batches:
            n, m = b.column("n").to_numpy(), b.column("m").to_numpy()
            most = n + m - 2 * -(-percent * (n + m) // (100 + percent))
            ok = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                x = np.frombuffer(b.column("x")[i].as_buffer(), np.uint8)
                y = np.frombuffer(b.column("y")[i].as_buffer(), np.uint8)
                size = 8 * min(len(x), len(y))
                ok[i] = count[_fold(x, size) ^ _fold(y, size)].sum() <= most[i]
            yield b.select(["a", "b", "n", "m"]).filter(pa.array(ok))
    return keep


def _scan_sets(k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, text in _text_batches(batches):
            rows, sets = [], []
            for row, s in tokens.shingle_sets(text, k):
                rows.append(row)
                sets.append(s.view(np.int64))
            if rows:
                yield pa.RecordBatch.from_pydict({
                    "cid": ids.take(pa.array(rows)),
                    "n": pa.array([len(x) for x in sets], pa.int64()),
                    "elements": pa.LargeListArray.from_arrays(np.cumsum([0, *map(len, sets)]),
                                                              pa.array(np.concatenate(sets))).cast(pa.list_(pa.int64()))})
    return scan, "cid long, n long, elements array<long>"


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact overlap of the two sorted sets of each row."""
    for b in batches:
        if not b.num_rows:
            continue
        x, y = b.column("x"), b.column("y")
        out = np.zeros(b.num_rows, np.int64)
        for i in range(b.num_rows):
            u, v = x[i].values.to_numpy().view(np.uint64), y[i].values.to_numpy().view(np.uint64)
            if len(u) > len(v):
                u, v = v, u
            at = np.searchsorted(v, u)
            at[at == len(v)] = 0
            out[i] = np.count_nonzero(v[at] == u)
        yield pa.RecordBatch.from_pydict({"a": b.column("a"), "b": b.column("b"), "n": b.column("n"),
                                          "m": b.column("m"), "overlap": pa.array(out)})


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4,
                    percent: int = 85) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, class_id, component_id``.

    ``class_id`` is the smallest id with the same shingle set, ``component_id`` the smallest
    id reachable by links (``100 * overlap >= percent * union``). A NULL or empty text and one
    of white space only have size 0 and are linked with nothing (their own component). Rows that
    repeat an id are one document: its texts share a component. A row with a NULL id gets NULL in
    both id columns. Other columns are ignored. An empty table gives an empty result.
    """
    text = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = numbered_rows(text, "doc_id", "set-rows")
    if rows is None:
        return _classes(text, k, percent)
    # an id with several rows: rows are joined by number, then ids gather their rows' components
    found = materialise(_classes(rows.select(F.col("row").alias("doc_id"), "text"), k, percent), "set-found")
    by_id = ids_of_rows(rows.select("doc_id", "row"), found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("label")),
                        "doc_id", "set-ids")
    first = found.join(by_id.select("row", F.col("id").alias("own")), found.doc_id == F.col("row")).groupBy("class_id").agg(F.min("own").alias("c"))
    known = found.where("doc_id is not null").join(first, "class_id").join(by_id, F.col("doc_id") == F.col("row"))
    return known.select(F.col("id").alias("doc_id"), "n_shingles", F.col("c").alias("class_id"), "component_id_of").withColumnRenamed(
        "component_id_of", "component_id").unionByName(found.where("doc_id is null"))


def _classes(text: DataFrame, k: int, percent: int) -> DataFrame:
    """``jaccard_classes`` of rows with unique ids (``doc_id, text``)."""
    scan, schema = _scan_classes(k, sketch_cells(text))
    scanned = materialise(text.mapInArrow(scan, schema), "sets")
    rows = scanned.where("slice = -1").select("doc_id", "n_shingles", "s1", "s2")
    classes = materialise(rows.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "s1", "s2")
                          .agg(F.min("doc_id").alias("cid")), "classes")
    linked = _component_of_classes(text, scanned, classes, k, percent)
    known = classes.join(linked, F.col("cid") == F.col("id"), "left").select(
        "n_shingles", "s1", "s2", "cid", F.coalesce("component", "cid").alias("component_id"))
    return (rows.join(known, ["n_shingles", "s1", "s2"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("cid", "doc_id")).alias("class_id"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def _component_of_classes(text: DataFrame, scanned: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    spark = text.sparkSession
    levels = _sum_slices(scanned.where("slice >= 0"))
    sent = spark.sparkContext.broadcast(zlib.compress(levels.tobytes(), 1))  # CELLS[1] bytes at most
    scan, schema = _scan_index(k, percent, sent)
    index = materialise(text.mapInArrow(scan, schema), "index").withColumnRenamed("doc_id", "cid")
    one = classes.select("cid", F.col("n_shingles").alias("n"))
    entries = index.select("cid", "n", "head").join(one, ["cid", "n"]).select(
        "cid", "n", F.posexplode("head").alias("pos", "tok"))
    shared = entries.groupBy("tok").agg(F.count("*").alias("df")).where("df > 1")
    entries = materialise(entries.join(shared, "tok"), "entries")
    short = entries.where(f"df <= {SHORT}").withColumn("comp", F.col("cid"))
    lists = entries.where(f"df > {SHORT}").select("tok", "cid", "n", "pos", F.col("cid").alias("comp"))
    pairs = _pivot_pairs(lists, percent, 0).unionByName(_short_pairs(short, percent)).distinct()
    links = tested = first_found = None
    for turn in range(PASSES):
        pairs = materialise(_possible(pairs, index, percent), f"pairs{turn}")
        found = materialise(_overlap(pairs, text, k), f"overlap{turn}")
        first_found = found if first_found is None else first_found
        hit = found.where(f"100 * overlap >= {percent} * (n + m - overlap)").select("a", "b")
        links = hit if links is None else links.unionByName(hit)
        component = connected_components(links, f"join-cc{turn}")
        if turn and last:
            break
        lists = materialise(_live(lists, component, index), f"lists{turn + 1}")
        members, cross = lists.groupBy("tok").agg(F.first("m").alias("m"), F.first("cross").alias("c")).agg(
            F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0))).first()
        if not cross:
            break
        seen = pairs.select("a", "b")
        tested = seen if tested is None else tested.unionByName(seen)
        few = cross <= 256 * members
        last = few or turn + 2 == PASSES
        pairs = _all_pairs(lists, None if few else first_found, percent) if last else _pivot_pairs(lists, percent, turn + 1)
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    return component


def _live(lists: DataFrame, component: DataFrame, index: DataFrame) -> DataFrame:
    """Lists that still hold several components, with members ``m``, pairs ``cross`` across components
    and the folded bit maps of their sets."""
    rows = lists.select("tok", "cid", "n", "pos").join(component, F.col("cid") == F.col("id"), "left").select(
        "tok", "cid", "n", "pos", F.coalesce("component", "cid").alias("comp"))
    per = rows.groupBy("tok", "comp").agg(F.count("*").alias("c"))
    live = (per.groupBy("tok").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("sq"))
            .select("tok", "m", F.expr("(m * m - sq) / 2").alias("cross")).where("cross > 0"))
    return rows.join(live, "tok").join(index.select("cid", "n", *SIGNS), ["cid", "n"])


def _pair_columns(percent: int) -> str:
    """Size and position bounds of a pair of entries p, q of one list."""
    return (f"p.comp != q.comp and 100 * least(p.n, q.n) >= {percent} * greatest(p.n, q.n) and "
            f"1 + least(p.n - 1 - p.pos, q.n - 1 - q.pos) >= {_needed('p.n', 'q.n', percent)}")


def _as_pairs(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.expr("least(p.cid, q.cid)").alias("a"), F.expr("greatest(p.cid, q.cid)").alias("b"),
        F.expr("if(p.cid < q.cid, p.n, q.n)").alias("n"), F.expr("if(p.cid < q.cid, q.n, p.n)").alias("m")
    ).distinct()


def _pivot_pairs(lists: DataFrame, percent: int, turn: int) -> DataFrame:
    """Every member of a list with the list's pivot: the smallest id, then by other orders."""
    order = F.col("cid") if not turn else F.xxhash64("cid", F.lit(turn))
    pivot = lists.groupBy("tok").agg(F.min(F.struct(order.alias("o"), "cid", "n", "pos", "comp")).alias("q"))
    pivot = pivot.select("tok", "q.cid", "q.n", "q.pos", "q.comp")
    return _as_pairs(lists.alias("p").join(pivot.alias("q"), "tok").where(_pair_columns(percent)))


def _short_pairs(short: DataFrame, percent: int) -> DataFrame:
    """All pairs of lists with few members."""
    return _as_pairs(short.alias("p").join(short.alias("q"), "tok")
                     .where(f"p.cid < q.cid and ({_pair_columns(percent)})"))


def _all_pairs(lists: DataFrame, first_found: DataFrame | None, percent: int) -> DataFrame:
    """All pairs across components: a size block meets itself and the next one, and distances
    to the list's first pivot (where measured) must not differ by more than the threshold."""
    width = -1.0001 * math.log(percent / 100)
    if first_found is None:
        none = lists.withColumns({"d": F.lit(None).cast("double"), "block": F.expr(f"cast(floor(ln(n) / {width}) as int)")})
        return _block_pairs(none, percent)
    pivot = lists.groupBy("tok").agg(F.min("cid").alias("pivot"))
    far = first_found.select("a", "b", F.expr("1 - overlap / (n + m - overlap)").alias("d"))
    p = (lists.join(pivot, "tok")
         .withColumns({"a": F.least("cid", "pivot"), "b": F.greatest("cid", "pivot"),
                       "block": F.expr(f"cast(floor(ln(n) / {width}) as int)")})
         .join(far, ["a", "b"], "left").drop("a", "b"))
    return _block_pairs(p, percent)


def _block_pairs(p: DataFrame, percent: int) -> DataFrame:
    q = p.withColumn("own", F.col("block")).withColumn("block", F.explode(F.expr("array(block, block - 1)")))
    differ = " + ".join(f"bit_count(p.{c} ^ q.{c})" for c in SIGNS)
    return _as_pairs(p.alias("p").join(q.alias("q"), ["tok", "block"]).where(
        f"({_pair_columns(percent)}) and {differ} <= p.n + q.n - 2 * {_needed('p.n', 'q.n', percent)} and (p.block < q.own or p.cid < q.cid) and "
        f"(p.d is null or q.d is null or abs(p.d - q.d) <= {1 - percent / 100} + 1e-9)"))


def _possible(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose bit maps allow the needed overlap."""
    x = maps.select(F.col("cid").alias("a"), "n", F.col("map").alias("x"))
    y = maps.select(F.col("cid").alias("b"), F.col("n").alias("m"), F.col("map").alias("y"))
    return pairs.join(x, ["a", "n"]).join(y, ["b", "m"]).select("a", "b", "n", "m", "x", "y").mapInArrow(
        _map_filter(percent), "a long, b long, n long, m long")


def _overlap(pairs: DataFrame, text: DataFrame, k: int) -> DataFrame:
    """Exact overlaps of the pairs, from the whole sets of their documents."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    scan, schema = _scan_sets(k)
    sets = materialise(text.join(ids, "doc_id", "left_semi").mapInArrow(scan, schema), "elements")
    x = sets.select(F.col("cid").alias("a"), "n", F.col("elements").alias("x"))
    y = sets.select(F.col("cid").alias("b"), F.col("n").alias("m"), F.col("elements").alias("y"))
    return pairs.join(x, ["a", "n"]).join(y, ["b", "m"]).mapInArrow(_overlaps, "a long, b long, n long, m long, overlap long")
