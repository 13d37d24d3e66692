"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text gives a vector of transformed statistics (lengths, character classes per
word, repetition). Per class, mean and covariance come from distributed sums over all
labelled documents outside the held-out fold; a covariance is shrunk towards the pooled one
and its diagonal. The score is the logistic of the difference of the two Gaussian
log-densities (Mahalanobis distances through cached Cholesky factors) plus the log-prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .tables import materialise

FEATURES = ("words", "chars_per_word", "char_spread", "distinct", "distinct_pairs", "adjacent", "top_word", "upper",
            "title", "digit", "exclaim", "symbol", "bar", "stop", "comma", "other_punct", "lines", "non_ascii")


@dataclass
class Discriminant:
    """Standardising constants, and per class mean, inverse Cholesky factor, log-determinant, log-prior."""

    center: np.ndarray
    scale: np.ndarray
    mean: np.ndarray
    whiten: np.ndarray
    logdet: np.ndarray
    prior: np.ndarray


def _class_of_byte() -> np.ndarray:
    """Byte classes: 1 upper, 2 digit, 3 '!', 4 symbol, 5 bar, 6 '.?', 7 ',;:', 8 other mark, 9 line feed, 10 non-ASCII."""
    out = np.zeros(256, np.uint8)
    out[ord("A"):ord("Z") + 1] = 1
    out[ord("0"):ord("9") + 1] = 2
    for marks, k in ((b"!", 3), (b"#$%&*@^~+=<>\\", 4), (b"|", 5), (b".?", 6), (b",;:", 7), (b"\"'()-/[]_`{}", 8),
                     (b"\n", 9)):
        out[list(marks)] = k
    out[0xC0:] = 10  # lead bytes: one per character
    return out


def _statistics(w: tokens.Words, n: int) -> np.ndarray:
    """(n, len(FEATURES)) transformed statistics of the rows of a batch."""
    count = np.bincount(w.doc, minlength=n).astype(float)
    per = np.maximum(count, 1)
    size = (w.end - w.start).astype(float)
    mean = np.bincount(w.doc, size, minlength=n) / per
    spread = np.sqrt(np.maximum(np.bincount(w.doc, size * size, minlength=n) / per - mean * mean, 0))
    order = np.lexsort((w.hash, w.doc))
    h, d = w.hash[order], w.doc[order]
    distinct, top = np.zeros(n), np.zeros(n)
    if len(h):
        at = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])]))
        distinct = np.bincount(d[at], minlength=n).astype(float)
        np.maximum.at(top, d[at], np.diff(np.append(at, len(h))).astype(float))
    pairs, rows = tokens.shingles(w, 2)
    order = np.lexsort((pairs, rows))
    p, r = pairs[order], rows[order]
    two = np.bincount(r[np.concatenate([[True], (p[1:] != p[:-1]) | (r[1:] != r[:-1])])], minlength=n) if len(p) else np.zeros(n)
    same = np.zeros(n)
    if len(w.hash) > 1:
        same = np.bincount(w.doc[1:], (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1]), minlength=n)
    kinds = _class_of_byte()[w.buf]
    each = np.zeros((11, n))
    length = np.diff(w.offsets)
    some = np.flatnonzero(length)
    for k in range(1, 11):
        if len(some):
            each[k, some] = np.add.reduceat((kinds == k).astype(np.int32), w.offsets[:-1][some])
    title = np.bincount(w.doc, kinds[w.start] == 1, minlength=n) if len(w.start) else np.zeros(n)
    letters = np.maximum(length - each[2:10].sum(0), 1)
    rate = lambda x: np.log(x / per + 0.01)
    share = lambda x, y: np.log((x + 0.01 * y + 0.05) / (np.maximum(y - x, 0) + 0.01 * y + 0.05))
    return np.stack([
        np.log1p(count), np.log1p(mean), np.log1p(spread), share(distinct, per), share(two, np.maximum(count - 1, 1)),
        share(same, per), share(top, per), share(each[1], letters), share(title, per), rate(each[2]), rate(each[3]),
        rate(each[4]), rate(each[5]), rate(each[6]), rate(each[7]), rate(each[8]), rate(each[9]),
        share(each[10], letters)], axis=1)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi in tokens.pieces_of_rows(b.column(1)):
            n = hi - lo
            x = _statistics(tokens.words(b.column(1).slice(lo, n)), n)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0).slice(lo, n),
                "x": pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.reshape(-1)))})


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` (values of FEATURES) of every row; a NULL text counts as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_scan, "doc_id long, x array<double>")


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and class: count, sum and sum of outer products, one row per coordinate."""
    for b in batches:
        if not b.num_rows:
            continue
        y = b.column("label").to_numpy()
        x = b.column("x").flatten().to_numpy().reshape(len(y), -1)
        x = np.concatenate([np.ones((len(y), 1)), x], axis=1)
        for k in (0, 1):
            z = x[y == k]
            if len(z):
                m = (z.T @ z).reshape(-1)
                yield pa.RecordBatch.from_pydict({"label": pa.array(np.full(len(m), k, np.int32)),
                                                  "at": pa.array(np.arange(len(m), dtype=np.int32)), "value": pa.array(m)})


def held_out(doc_id: str = "doc_id"):
    """Held-out fold: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def fit(stats: DataFrame, labels: DataFrame, shrink: float = 0.1, ridge: float = 0.05) -> Discriminant | None:
    """Fit on all labelled rows outside the held-out fold; None if one class is missing.

    ``shrink`` moves a class covariance towards the pooled one, ``ridge`` towards its diagonal.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("label")))
    sums = (stats.join(known, "doc_id").select("label", "x").mapInArrow(_moments, "label int, at int, value double")
            .groupBy("label", "at").agg(F.sum("value").alias("value")))
    d = len(FEATURES) + 1
    m = np.zeros((2, d * d))
    for r in sums.collect():  # 2 * (1 + features) ** 2 rows
        m[r["label"], r["at"]] = r["value"]
    m = m.reshape(2, d, d)
    n = m[:, 0, 0]
    if n.min() < 2:
        return None
    total = m.sum(0)
    center = total[0, 1:] / n.sum()
    spread = np.diag(total)[1:] / n.sum() - center ** 2
    scale = np.sqrt(np.where(spread > 1e-9, spread, 1.0))  # a constant statistic stays near 0
    mean = m[:, 0, 1:] / n[:, None]
    cov = np.stack([m[k, 1:, 1:] / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)]) / np.outer(scale, scale)
    mean = (mean - center) / scale
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    whiten, logdet = [], []
    for k in (0, 1):
        a = shrink + (1 - shrink) * 40 / (n[k] + 40)  # few rows: closer to the pooled covariance
        s = (1 - a) * cov[k] + a * pooled
        s = (1 - ridge) * s + ridge * np.diag(np.diag(pooled) + 1e-3)
        chol = np.linalg.cholesky(s)
        whiten.append(np.linalg.inv(chol))
        logdet.append(2 * np.log(np.diag(chol)).sum())
    return Discriminant(center, scale, mean, np.stack(whiten), np.array(logdet), np.log(n / n.sum()))


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Discriminant = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            x = (b.column("x").flatten().to_numpy().reshape(b.num_rows, -1) - q.center) / q.scale
            log = [-0.5 * (((x - q.mean[k]) @ q.whiten[k].T) ** 2).sum(1) - 0.5 * q.logdet[k] + q.prior[k] for k in (0, 1)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "score": pa.array(1 / (1 + np.exp(-np.clip(log[1] - log[0], -40, 40))))})
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Fit on ``labels`` and score ``docs``: ``doc_id, held_out, score, predicted``.

    Every row is scored, repeated rows alike; a NULL or empty text has the statistics of an empty
    one. Where a class has fewer than two labelled rows every score is 1 (nothing is rejected). A
    NULL id gives a NULL ``held_out``. Other columns of either table are ignored; an empty ``docs``
    gives no rows.
    """
    stats = materialise(statistics(docs), "quality")
    model = fit(stats, labels)
    if model is None:
        scored = stats.select("doc_id", F.lit(1.0).alias("score"))
    else:
        sent = docs.sparkSession.sparkContext.broadcast(model)  # (features) ** 2 numbers
        scored = stats.mapInArrow(_score(sent), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), F.round("score", 6).alias("score"),
                         (F.round("score", 6) >= threshold).cast("int").alias("predicted"))
