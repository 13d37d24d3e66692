"""Toxic spans by a linear-chain conditional random field.

Two tags (clean, toxic) over the words of a whole text (lower-cased, without marks). Emission features of a word are its
hash and the hashes of its first 4, 5 and 6 bytes; transitions are free. Only document
labels exist, so token labels are derived first: among sampled labelled documents, a
feature that is pure and significantly frequent in toxic ones (Dunning's G2) marks its
words as toxic there. The field is then fitted on windows of those documents by gradient
steps on the conditional likelihood (expectations from forward-backward).

Scoring runs forward-backward over each whole text in one chain. The marginals are summed up
as expected toxic words, their density and the largest one; a logistic function of these,
fitted on the same sample, is the document's score. Spans are runs of words tagged toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .tables import materialise, small_batches

LEADS = (4, 5, 6)
FLOOR = 0.05  # marginals below it don't count as expected toxic words
KINDS = 1 + len(LEADS)
SAMPLE_TASKS = 24  # most tasks that write a shuffled table of the bounded sample, whatever the session's shuffle partitions


@dataclass(frozen=True)
class FitBounds:
    """Bounds of the fitting sample: labelled documents per class, features, windows of words."""

    toxic_docs: int = 8000
    clean_docs: int = 16000
    features: int = 1 << 16
    windows: int = 5000
    width: int = 32
    steps: int = 80


@dataclass
class Field:
    """Fitted field: sorted feature hashes with weights, bias, log-transitions, log-start."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    trans: np.ndarray
    start: np.ndarray
    doc: tuple[float, ...] = (-4.0, 0.0, 0.0, 0.0, 0.0)  # bias and weights of STATS


#: Document statistics of the marginals, in SQL over expected, top and n_words.
STATS = ("ln(1 + expected)", "ln(1e-4 + expected / n_words)", "ln((top + 1e-4) / (1 - top + 1e-4))", "ln(1 + n_words)")


def forward_backward(odds: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray,
                     edges: bool = False):
    """Marginals of tag 1 over concatenated chains, exactly, in O(sqrt n) array steps.

    ``odds``: emission odds of tag 1; ``first``: True where a chain begins. The chain of
    2x2 matrices is cut into blocks that run side by side: products of the blocks, then the
    vectors at their borders, then the vectors inside. With ``edges`` also the summed
    pair marginals and the log-partition are returned.
    """
    n = len(odds)
    width = max(1, int(np.sqrt(n)))
    blocks = -(-n // width)
    m = np.empty((2, 2, width, blocks))
    reset = np.zeros(blocks * width, bool)
    reset[:n] = first
    e = np.ones(blocks * width)
    e[:n] = odds
    reset, e = reset.reshape(blocks, width).T, e.reshape(blocks, width).T
    t, s = np.exp(trans), np.exp(start)
    for i in range(2):
        for j in range(2):
            m[i, j] = np.where(reset, s[j], t[i, j]) * (e if j else 1.0)
    pad = blocks * width - n
    if pad:  # identity behind the end
        for i in range(2):
            for j in range(2):
                m[i, j, width - pad:, -1] = float(i == j)
    p = [[np.ones(blocks), np.zeros(blocks)], [np.zeros(blocks), np.ones(blocks)]]
    for x in range(width):
        p = [[p[i][0] * m[0, j, x] + p[i][1] * m[1, j, x] for j in range(2)] for i in range(2)]
        z = p[0][0] + p[0][1] + p[1][0] + p[1][1]
        p = [[p[i][j] / z for j in range(2)] for i in range(2)]
    into, back = np.empty((2, blocks)), np.empty((2, blocks))
    a0, a1 = 0.5, 0.5
    for b in range(blocks):
        into[:, b] = a0, a1
        a0, a1 = a0 * p[0][0][b] + a1 * p[1][0][b], a0 * p[0][1][b] + a1 * p[1][1][b]
        a0, a1 = a0 / (a0 + a1), a1 / (a0 + a1)
    b0, b1 = 0.5, 0.5
    for b in range(blocks - 1, -1, -1):
        back[:, b] = b0, b1
        b0, b1 = p[0][0][b] * b0 + p[0][1][b] * b1, p[1][0][b] * b0 + p[1][1][b] * b1
        b0, b1 = b0 / (b0 + b1), b1 / (b0 + b1)
    alpha, beta = np.empty((2, width, blocks)), np.empty((2, width, blocks))
    norm = np.empty((width, blocks))
    a = into
    for x in range(width):
        a = np.stack([a[0] * m[0, 0, x] + a[1] * m[1, 0, x], a[0] * m[0, 1, x] + a[1] * m[1, 1, x]])
        norm[x] = a[0] + a[1]
        a = a / norm[x]
        alpha[:, x] = a
    b = back
    for x in range(width - 1, -1, -1):
        beta[:, x] = b
        b = np.stack([m[0, 0, x] * b[0] + m[0, 1, x] * b[1], m[1, 0, x] * b[0] + m[1, 1, x] * b[1]])
        b = b / (b[0] + b[1])
    flat = lambda y: y.T.reshape(-1)[:n]
    g0, g1 = flat(alpha[0] * beta[0]), flat(alpha[1] * beta[1])
    marginal = g1 / (g0 + g1)
    if not edges:
        return marginal
    f0, f1 = flat(alpha[0]), flat(alpha[1])
    h0, h1 = flat(beta[0]), flat(beta[1])
    inner = np.flatnonzero(~first[1:]) + 1
    total = np.zeros((2, 2))
    w = np.empty((2, 2, len(inner)))
    for i, f in enumerate((f0, f1)):
        for j, h in enumerate((h0, h1)):
            w[i, j] = f[inner - 1] * t[i, j] * (odds[inner] if j else 1.0) * h[inner]
    w /= w.sum((0, 1))
    total[:] = w.sum(2)
    return marginal, total, float(np.log(flat(norm)).sum())


def _features(w: tokens.Words) -> np.ndarray:
    return np.stack([w.hash, *(w.lead[k] for k in LEADS)])


def _weights_of(features: np.ndarray, field: Field) -> np.ndarray:
    """Emission log-odds of words."""
    score = np.full(features.shape[1], field.bias)
    if len(field.hashes):
        for f in features:
            at = np.searchsorted(field.hashes, f)
            at[at == len(field.hashes)] = 0
            hit = field.hashes[at] == f
            score[hit] += field.weights[at[hit]]
    return np.clip(score, -30, 30)


def held_out(doc_id: str = "doc_id"):
    """Held-out fold: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def labels_by_doc(labels: DataFrame, column: str) -> DataFrame:
    """One label per id outside the held-out fold (rows that repeat an id: the larger label)."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & ~held_out())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(column).cast("int").alias("label")))


def _minhashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Four least shingle hashes (of four orders) per document."""
    for b in batches:
        out = np.zeros((b.num_rows, 4), np.int64)
        for row, s in tokens.shingle_sets(b.column(1), 4):
            out[row] = [tokens.mix64(s ^ tokens._SHINGLE[j]).min().view(np.int64) for j in range(4)]
        yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "mins": pa.array(out.tolist(), pa.list_(pa.int64()))})


def _copy_weights(text: DataFrame) -> DataFrame:
    """Weight of each sampled document, 1 / (copies in the sample), so that the words of copied
    texts don't pass for frequent: the second smallest group among four min-hashes."""
    mins = text.select("doc_id", "text").mapInArrow(_minhashes, "doc_id long, mins array<long>")
    each = materialise(mins.select("doc_id", F.posexplode("mins").alias("j", "m")), "tox-mins")
    size = each.groupBy("j", "m").agg(F.count("*").alias("c"))
    per = each.join(size, ["j", "m"]).groupBy("doc_id").agg(F.sort_array(F.collect_list("c")).alias("c"))
    return per.select("doc_id", (1.0 / F.col("c")[1]).alias("weight"))


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, weight of the documents with it, of them toxic) per batch."""
    for b in batches:
        label = b.column(1).to_numpy(zero_copy_only=False)
        weight = b.column(2).to_numpy(zero_copy_only=False)
        for lo, hi in tokens.pieces_of_rows(b.column(0)):
            w = tokens.words(b.column(0).slice(lo, hi - lo), LEADS, plain=True)
            f = _features(w).reshape(-1)
            doc = np.tile(w.doc, KINDS)
            keep = f != 0
            f, doc = f[keep], doc[keep]
            order = np.lexsort((doc, f))
            f, doc = f[order], doc[order]
            if not len(f):
                continue
            new = np.concatenate([[True], (f[1:] != f[:-1]) | (doc[1:] != doc[:-1])])
            f, x = f[new], weight[lo + doc[new]]
            y = x * label[lo + doc[new]]
            at = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
            yield pa.RecordBatch.from_pydict({
                "feature": pa.array(f[at].view(np.int64)), "docs": pa.array(np.add.reduceat(x, at)),
                "toxic": pa.array(np.add.reduceat(y, at))})


def _windows(seeds, width: int):
    """Labelled windows: tokens of toxic documents that carry a seed feature are toxic."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed = np.frombuffer(seeds.value, np.uint64)
        for b in batches:
            label = b.column(1).to_numpy(zero_copy_only=False)
            for lo, hi in tokens.pieces_of_rows(b.column(0)):
                w = tokens.words(b.column(0).slice(lo, hi - lo), LEADS, plain=True)
                if not len(w.start):
                    continue
                f = _features(w)
                y = (np.isin(f, seed).any(0) & (label[lo + w.doc] == 1)).astype(np.uint8)
                count = np.bincount(w.doc, minlength=hi - lo)
                begin = np.concatenate([[0], np.cumsum(count)])
                rows = []
                for d in np.flatnonzero(count):
                    for s in range(begin[d], begin[d + 1], width):
                        e = min(s + width, begin[d + 1])
                        pick = int(np.bitwise_xor.reduce(tokens.mix64(f[0, s:e])) >> np.uint64(1))
                        has = bool(y[s:e].any())
                        if has or pick % 16 == 0:
                            rows.append((int(has), pick, f[:, s:e].tobytes(), y[s:e].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_pydict({
                        "kind": pa.array([r[0] for r in rows], pa.int32()),
                        "pick": pa.array([r[1] for r in rows], pa.int64()),
                        "f": pa.array([r[2] for r in rows], pa.binary()),
                        "y": pa.array([r[3] for r in rows], pa.binary())})
    return cut


def fit(docs: DataFrame, labels: DataFrame, bounds: FitBounds = FitBounds()) -> Field:
    """Fit the field on a bounded sample of labelled documents outside the held-out fold.

    Without toxic labels the field has no features and every score is near 0.
    """
    spark = docs.sparkSession
    known = labels_by_doc(labels, "toxic")
    pick = lambda y, n: known.where(f"label = {y}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = materialise(pick(1, bounds.toxic_docs).unionByName(pick(0, bounds.clean_docs)), "tox-ids")
    text = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(sample), "doc_id"))  # at most toxic_docs + clean_docs ids
    text = materialise(text.dropDuplicates(["doc_id"]), "tox-train", SAMPLE_TASKS)
    weights = F.broadcast(_copy_weights(text))  # a row per sampled id
    text = materialise(text.join(weights, "doc_id").select("text", "label", "weight"), "tox-weighted")
    size = {r["label"]: r["w"] for r in text.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    n1, n0 = float(size.get(1, 0)), float(size.get(0, 0)) or 1.0
    empty = Field(np.zeros(0, np.uint64), np.zeros(0), -8.0, np.log(np.full((2, 2), 0.5)), np.log(np.full(2, 0.5)))
    if not n1:
        return empty
    counts = (text.select("text", "label", "weight")
              .mapInArrow(_count_features, "feature long, docs double, toxic double").groupBy("feature")
              .agg(F.sum("docs").alias("c"), F.sum("toxic").alias("t")).where("t >= 2")
              .withColumn("o", F.expr("greatest(c - t, 0D)")))
    x = f"(c * {n1 / (n0 + n1)!r}D)"
    xlogx = lambda a, e: f"if({a} < 1e-9, 0D, {a} * ln({a} / {e}))"
    counts = materialise(
        counts.withColumn("g", F.expr(f"2 * ({xlogx('t', x)} + {xlogx('o', f'(c * {n0 / (n0 + n1)!r}D)')})"))
        .withColumn("pure", F.expr(f"(t / {n1!r}D) / (t / {n1!r}D + o / {n0!r}D)")), "tox-counts", SAMPLE_TASKS)
    found = (counts.where("g >= 6 and pure > 0.5").orderBy(F.desc("g"), "feature").limit(bounds.features)
             .select("feature", "t", "g", "pure").toArrow())
    if not len(found):
        return empty
    # a chance of one in two that any feature passes by chance (tail of chi-square, exp(-g / 2))
    least = 2 * float(np.log(2 * counts.count()))
    hashes, g, pure = (found.column(c).to_numpy() for c in ("feature", "g", "pure"))
    hashes = hashes.view(np.uint64)
    seeds = hashes[(pure >= 0.95) & (g >= least)]
    hashes = np.sort(hashes)
    cut = text.select("text", "label").mapInArrow(_windows(spark.sparkContext.broadcast(np.sort(seeds).tobytes()), bounds.width),
                          "kind int, pick long, f binary, y binary")
    cut = materialise(cut, "tox-windows")
    rows = pa.concat_tables([cut.where(f"kind = {kind}").orderBy("pick", "f").limit(bounds.windows).select("f", "y").toArrow()
                             for kind in (0, 1)])
    return _calibrate(_train(rows, hashes, bounds.steps), text)


def _calibrate(field: Field, text: DataFrame) -> Field:
    """Logistic function of the document statistics, fitted on the (bounded) sample by Newton steps."""
    sent = text.sparkSession.sparkContext.broadcast(field)
    stats = (text.select(F.monotonically_increasing_id().alias("doc_id"), "text", "label", "weight")
             .mapInArrow(_tag(sent, carry=("label", "weight")), f"{TAGGED}, label int, weight double")
             .where("n_words > 0").selectExpr(*[f"{x} AS x{i}" for i, x in enumerate(STATS)], "label", "weight"))
    k = len(STATS)
    rows = stats.toArrow()
    x = np.stack([np.ones(len(rows)), *(rows.column(i).to_numpy() for i in range(k))], axis=1)
    y, w = rows.column("label").to_numpy().astype(float), rows.column("weight").to_numpy()
    theta = np.array(Field.doc)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        ridge = np.diag([1e-3] + [0.1] * k)
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (w * (y - p)) - ridge @ theta)
        size = np.abs(step).max()
        theta = theta + step * min(1.0, 3.0 / max(size, 1e-12))
        if size < 1e-6:
            break
    return replace(field, doc=tuple(float(v) for v in theta))


def _train(rows: pa.Table, hashes: np.ndarray, steps: int) -> Field:
    """Gradient ascent (Adam) on the penalised conditional log-likelihood of the windows."""
    feats = [np.frombuffer(x.as_buffer(), np.uint64).reshape(KINDS, -1) for x in rows.column("f")]
    y = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in rows.column("y")]).astype(float)
    first = np.zeros(len(y), bool)
    first[np.concatenate([[0], np.cumsum([f.shape[1] for f in feats])[:-1]]).astype(int)] = True
    f = np.concatenate(feats, axis=1)
    at = np.searchsorted(hashes, f)
    at[at == len(hashes)] = 0
    hit = hashes[at] == f
    kind, token = np.nonzero(hit)
    feature = at[kind, token]
    k = len(hashes)
    theta = np.zeros(k + 1 + 4 + 2)
    theta[k] = -2.0
    tag = y.astype(int)
    inner = np.flatnonzero(~first[1:]) + 1
    seen = np.zeros((2, 2))
    np.add.at(seen, (tag[inner - 1], tag[inner]), 1)
    begins = np.array([np.sum(1 - y[first]), np.sum(y[first])])
    mean, var = np.zeros_like(theta), np.zeros_like(theta)
    n = float(len(y))
    penalty = np.full(len(theta), 2e-6 * n)
    penalty[:k] = 0.01
    for step in range(1, steps + 1):
        score = np.full(len(y), theta[k]) + np.bincount(token, theta[feature], minlength=len(y))
        odds = np.exp(np.clip(score, -30, 30))
        trans, start = theta[k + 1:k + 5].reshape(2, 2), theta[k + 5:]
        p, pairs, _ = forward_backward(odds, first, trans, start, edges=True)
        gap = y - p
        grad = np.concatenate([np.bincount(feature, gap[token], minlength=k), [gap.sum()],
                               (seen - pairs).reshape(-1),
                               begins - np.array([np.sum(1 - p[first]), np.sum(p[first])])])
        grad -= penalty * theta
        mean = 0.9 * mean + 0.1 * grad
        var = 0.99 * var + 0.01 * grad * grad
        theta += 0.25 * (mean / (1 - 0.9 ** step)) / (np.sqrt(var / (1 - 0.99 ** step)) + 1e-8)
    return Field(hashes, theta[:k].copy(), float(theta[k]), theta[k + 1:k + 5].reshape(2, 2).copy(),
                 theta[k + 5:].copy())


SPANS = "array<struct<start:int,end:int,prob:double>>"
TAGGED = f"doc_id long, n_words long, expected double, top double, spans {SPANS}"


def _tag(field, floor: float = FLOOR, carry: tuple[str, ...] = ()):
    """Sums of the marginals and spans (character offsets, end exclusive) of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Field = field.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("prob", pa.float64())]))
        for b in batches:
            for lo, hi in tokens.pieces_of_rows(b.column(1)):
                n_words, expected, top, spans = _tag_piece(b.column(1).slice(lo, hi - lo), hi - lo, model, floor)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n_words), pa.array(expected), pa.array(top),
                     pa.array(spans, kind), *(b.column(c).slice(lo, hi - lo) for c in carry)],
                    names=["doc_id", "n_words", "expected", "top", "spans", *carry])
    return run


def _tag_piece(column: pa.Array, n: int, model: Field, floor: float):
    """Words, expected toxic words, largest marginal and spans of n texts."""
    w = tokens.words(column, LEADS, plain=True)
    expected, top = np.zeros(n), np.zeros(n)
    spans: list[list[dict]] = [[] for _ in range(n)]
    if len(w.start):
        first = np.concatenate([[True], w.doc[1:] != w.doc[:-1]])
        p = forward_backward(np.exp(_weights_of(_features(w), model)), first, model.trans, model.start)
        at = np.flatnonzero(first)
        top[w.doc[at]] = np.maximum.reduceat(p, at)
        high = np.flatnonzero(p >= floor)
        expected = np.bincount(w.doc[high], p[high], minlength=n).astype(float)
        hot = np.flatnonzero(p >= 0.5)
        cuts = np.flatnonzero((np.diff(hot) != 1) | first[hot[1:]]) + 1 if len(hot) else []
        chars = lambda u, v: int(np.count_nonzero((w.buf[u:v] & 0xC0) != 0x80))
        ends = {}
        for part in np.split(hot, cuts) if len(hot) else []:
            d, s, e = int(w.doc[part[0]]), w.start[part[0]], w.end[part[-1]]
            done, at_byte = ends.get(d, (0, w.offsets[d]))
            c = done + chars(at_byte, s)
            ends[d] = (c + chars(s, e), e)
            spans[d].append({"start": c, "end": ends[d][0], "prob": float(p[part].max())})
    return np.bincount(w.doc, minlength=n), expected, top, spans


def _keep(field, column: str, threshold: float):
    """Rows (structs with the text in ``column``) that score below the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Field = field.value
        for b in batches:
            text = pc.struct_field(b.column(0), column).cast(pa.string())
            for lo, hi in tokens.pieces_of_rows(text):
                words, expected, top, _ = _tag_piece(text.slice(lo, hi - lo), hi - lo, model, FLOOR)
                clean = _doc_scores(words, expected, top, model) < threshold
                yield b.slice(lo, hi - lo).filter(pa.array(clean))
    return run


def _doc_scores(words: np.ndarray, expected: np.ndarray, top: np.ndarray, field: Field) -> np.ndarray:
    """Scores as ``_score_sql`` gives them."""
    n = np.maximum(words, 1)
    x = [np.ones(len(n)), np.log(1 + expected), np.log(1e-4 + expected / n), np.log((top + 1e-4) / (1 - top + 1e-4)), np.log(1 + n)]
    z = sum(w * v for w, v in zip(field.doc, x))
    return np.where(words == 0, 0.0, np.round(1 / (1 + np.exp(-np.clip(z, -700, 700))), 6))


def _score_sql(field: Field) -> str:
    z = " + ".join([repr(field.doc[0]), *(f"{w!r}D * {x}" for w, x in zip(field.doc[1:], STATS))])
    return f"round(if(n_words = 0, 0D, 1 / (1 + exp(-({z})))), 6)"


def score(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, score, spans`` of every row; a NULL, empty or blank text has score 0 and no spans."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(field)  # bounded by FitBounds.features
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(_tag(sent), TAGGED).selectExpr("doc_id", f"{_score_sql(field)} AS score", "spans")


def without_toxic(docs: DataFrame, field: Field, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with all their columns and without a shuffle."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(field)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_keep(sent, "text", threshold), f"row {kind}").select("row.*")


def toxic_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
                    bounds: FitBounds = FitBounds()) -> DataFrame:
    """Fit on ``labels`` and score ``docs``: ``doc_id, held_out, score, predicted, spans``.

    Repeated rows are scored each; a NULL id gives a NULL ``held_out``. Other columns of either
    table are ignored; an empty table of labels gives low scores, an empty ``docs`` no rows.
    """
    return score(docs, fit(docs, labels, bounds)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
