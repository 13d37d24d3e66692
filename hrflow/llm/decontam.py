"""Benchmark decontamination by latent semantic retrieval.

Words are compared lower-cased and without marks. Benchmark items are cut into passages of at most ``BLOCK`` words. Words of the benchmark are
the vocabulary; their document frequencies are counted over all documents. A randomised SVD
(range finder with power steps) of the TF-IDF rows of benchmark passages and of the blocks of all
documents gives a latent space. The documents are read once for it: the counts of their blocks are
kept as a table, of which tasks make A'A (up to ``GRAM_WORDS`` words) or its products with a matrix.
Every document is cut into blocks of ``BLOCK`` words; two neighbouring blocks are
a window, so each passage copied anywhere lies whole in some window. Windows are compared with
all passages by latent cosine and by shared words: a passage of which a window could hold the
share that an item needs is a candidate whatever its cosine, so none is lost, however short the
item or large the benchmark. Candidates are checked by the longest common subsequence of words,
and an item found anywhere in a document is compared with all its windows. An item counts as contained if its passages are covered to ``min_overlap`` and its
answer (its last words, or ``answer``) to ``min_answer``; without an ``answer`` of its own,
coverage of ``WHOLE``, or of every word before the last ones, is enough.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .tables import drop_table, materialise

BLOCK = 32
RANK = 96
POWER_STEPS = 2
#: Words up to which A'A is made once (half a square of them per task); with more, each step reads the blocks.
GRAM_WORDS = 6000
#: Blocks that a task adds up into A'A.
GRAM_BLOCKS = 1 << 20
#: Rows of A'A in a row of the table that holds it.
STRIP = 32
MIN_WORDS = 5
ANSWER_WORDS = 6
#: Coverage at which an item without a given answer counts by itself; its last words are asked for below.
WHOLE = 0.8
#: A passage covered to less than this in a window adds nothing to its item.
LEAST_COVER = 0.4
#: Counts of shared words held at a time.
COUNTS = 1 << 22
#: Items handled at a time: bounds what is broadcast; a larger benchmark takes several rounds.
ITEMS_PER_ROUND = 10_000


class Index:
    """Benchmark passages of one round: vocabulary, weights, latent rows, words, items, answers."""

    def __init__(self, items: list[tuple[int, str, str | None]]):
        w = tokens.words(pa.array([t for _, t, _ in items], pa.large_string()), plain=True)
        count = np.bincount(w.doc, minlength=len(items))
        begin = np.concatenate([[0], np.cumsum(count)])
        self.items, self.sizes, self.asked, parts, of, answers = [], [], [], [], [], []
        for k, (item, _, answer) in enumerate(items):
            own = w.hash[begin[k]:begin[k + 1]]
            if len(own) < MIN_WORDS:
                continue
            n = -(-len(own) // BLOCK)
            for p in np.array_split(own, n):
                parts.append(p)
                of.append(len(self.items))
            given = tokens.words(pa.array([answer or ""], pa.large_string()), plain=True).hash
            answers.append(given if len(given) else own[-ANSWER_WORDS:])
            self.asked.append(len(given) > 0)
            self.items.append(item)
            self.sizes.append(len(own))
        self.of = np.array(of, np.int64)
        self.lengths = np.array([len(p) for p in parts], np.int64)
        self.body = self.lengths.copy()  # words of a passage before its item's last words
        end = np.flatnonzero(np.diff(self.of, append=len(self.items)))
        self.body[end] = np.maximum(self.body[end] - ANSWER_WORDS, 0)
        self.passages = np.zeros((len(parts), BLOCK), np.uint64)
        for k, p in enumerate(parts):
            self.passages[k, :len(p)] = p
        self.answer_lengths = np.array([min(len(a), BLOCK) for a in answers], np.int64)
        self.answers = np.zeros((len(answers), BLOCK), np.uint64)
        for k, a in enumerate(answers):
            self.answers[k, :min(len(a), BLOCK)] = a[-BLOCK:]
        self.vocabulary = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.idf = np.zeros(len(self.vocabulary))
        self.space = np.zeros((len(self.vocabulary), 0))
        self.latent = np.zeros((len(parts), 0), np.float32)
        self.postings = self.begin = self.hits = np.zeros(0, np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are in the vocabulary, and their numbers in it."""
        at = np.flatnonzero(self.maybe[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        k = np.searchsorted(self.vocabulary, hashes[at])
        k[k == len(self.vocabulary)] = 0
        ok = self.vocabulary[k] == hashes[at]
        return at[ok], k[ok]

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        self.idf = np.log((1.0 + n_docs) / (1.0 + df)) + 0.05

    def tally(self, hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of the vocabulary in each row: row, word, times."""
        at, k = self.find(hashes)
        pair, tf = np.unique(row[at] * max(1, len(self.vocabulary)) + k, return_counts=True)
        return *np.divmod(pair, max(1, len(self.vocabulary))), tf

    def unit(self, r: np.ndarray, c: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sparse unit TF-IDF rows: row, word, value."""
        x = (1 + np.log(tf)) * self.idf[c]
        return r, c, x / np.sqrt(np.bincount(r, x * x))[r]

    def post(self, share: float) -> None:
        """Lists of the passages of each word for ``sharing``. Of a passage that needs n of its m words,
        at least c of the rarest m - n + c must be in the window; only those are listed."""
        word, of, self.hits = [], [], np.zeros(len(self.of), np.int64)
        for p, m in enumerate(self.lengths):
            need = int(np.ceil(share * m - 1e-9))
            self.hits[p] = c = max(1, (need + 1) // 2)
            k = np.searchsorted(self.vocabulary, self.passages[p, :m])
            word.append(k[np.argsort(-self.idf[k], kind="stable")][:m - need + c])
            of.append(np.full(len(word[-1]), p, np.int64))
        word, of = np.concatenate(word), np.concatenate(of)
        order = np.argsort(word, kind="stable")
        self.postings, self.begin = of[order], np.searchsorted(word[order], np.arange(len(self.vocabulary) + 1))

    def sharing(self, block: np.ndarray, k: np.ndarray, joined: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Windows and passages that share enough words; ``joined``: blocks followed by one of the same document."""
        size = np.diff(self.begin)
        own, word = np.divmod(_distinct((block * len(size) + k)[size[k] > 0]), len(size))
        step = max(1, COUNTS // len(self.of))
        for s in range(0, len(joined) + 1, step):
            lo, hi = np.searchsorted(own, [s, s + step + 1])
            n = size[word[lo:hi]]
            which = np.repeat(np.arange(lo, hi), n)
            place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + self.begin[word[which]]
            count = np.bincount((own[which] - s) * len(self.of) + self.postings[place], minlength=(step + 1) * len(self.of))
            count = count.reshape(step + 1, -1)
            next_one = np.flatnonzero(joined[s:s + step])
            count[next_one] += count[next_one + 1]
            a, p = _where(count[:step] >= self.hits)
            yield a + s, p

    def own_rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat = np.concatenate([p[:m] for p, m in zip(self.passages, self.lengths)]) if len(self.of) else np.zeros(0, np.uint64)
        return self.unit(*self.tally(flat, np.repeat(np.arange(len(self.of)), self.lengths)))

    def settle(self, space: np.ndarray) -> None:
        """Fix the latent space (words x rank) and place the passages in it."""
        self.space = space.astype(np.float32)
        self.weighted = self.space * self.idf[:, None].astype(np.float32)
        r, c, x = self.own_rows()
        z = np.zeros((len(self.of), space.shape[1]))
        np.add.at(z, r, x[:, None] * space[c])
        norm = np.linalg.norm(z, axis=1, keepdims=True)
        self.latent = (z / np.maximum(norm, 1e-12)).astype(np.float32)


def _where(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few true cells of a matrix."""
    return np.divmod(np.flatnonzero(hit.reshape(-1)), hit.shape[1])


def _blocks(w: tokens.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Block number of each word, and row of each block."""
    count = np.bincount(w.doc, minlength=n)
    begin = np.concatenate([[0], np.cumsum(count)])[:-1]
    place = np.arange(len(w.hash)) - begin[w.doc]
    each = -(-count // BLOCK)
    first = np.concatenate([[0], np.cumsum(each)])[:-1]
    return first[w.doc] + place // BLOCK, np.repeat(np.arange(n), each)


BLOCKS = "docs long, blocks long, packed binary, size binary, word binary, times binary"


def _count_words(sent):
    """Words of the vocabulary in all blocks (per piece: number of words of each block, words, times), and
    their document frequencies: one packed array per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = sent.value
        v = len(index.vocabulary)
        df, docs = np.zeros(v, np.int64), 0

        def row(*values):
            return pa.RecordBatch.from_arrays(
                [pa.array([x], pa.int64() if i < 2 else pa.binary()) for i, x in enumerate(values)],
                names=["docs", "blocks", "packed", "size", "word", "times"])
        for b in batches:
            docs += b.num_rows
            for lo, hi in tokens.pieces_of_rows(b.column(0)):
                w = tokens.words(b.column(0).slice(lo, hi - lo), plain=True)
                block, of = _blocks(w, hi - lo)
                r, c, tf = index.tally(w.hash, block)
                if len(r):
                    df += np.bincount(_distinct(of[r] * v + c) % v, minlength=v)
                    size = np.bincount(r)
                    size = size[size > 0]
                    yield row(0, len(size), None, size.astype(np.uint8).tobytes(), c.astype(_kind(v)).tobytes(), tf.astype(np.uint8).tobytes())
        if docs:
            yield row(docs, 0, zlib.compress(df.tobytes(), 1), None, None, None)
    return run


def _kind(v: int):
    return np.uint16 if v <= 1 << 16 else np.uint32


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def _unpacked(index: Index, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sparse unit TF-IDF rows of the blocks that ``_count_words`` kept."""
    for b in batches:
        for size, word, times in zip(*(b.column(i) for i in range(3))):
            size = np.frombuffer(size.as_buffer(), np.uint8)
            word = np.frombuffer(word.as_buffer(), _kind(len(index.vocabulary))).astype(np.int64)
            yield index.unit(np.repeat(np.arange(len(size)), size), word, np.frombuffer(times.as_buffer(), np.uint8).astype(float))


def _half(v: int) -> np.ndarray:
    """The cell (a, b), a <= b, of the upper half of a square is number ``_half(v)[a] + b``, row by row."""
    a = np.arange(v)
    return a * v - a * (a + 1) // 2


def _gram(sent):
    """Task's share of A'A over TF-IDF rows of blocks: strips of its upper half, the diagonal halved."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = sent.value
        v = len(index.vocabulary)
        half, total = _half(v), np.zeros(v * (v + 1) // 2)
        for r, c, x in _unpacked(index, batches):
            size = np.bincount(r)
            left = np.repeat(np.cumsum(size), size) - np.arange(len(r))  # the words of a block ascend
            one = np.repeat(np.arange(len(r)), left)
            two = one + np.arange(len(one)) - np.repeat(np.cumsum(left) - left, left)
            np.add.at(total, half[c[one]] + c[two], x[one] * x[two])
        total[half + np.arange(v)] /= 2
        for s in range(0, v, STRIP):
            part = total[half[s] + s:half[min(s + STRIP, v) - 1] + v]
            if part.any():
                yield pa.RecordBatch.from_pydict({"first": pa.array([s], pa.int64()),
                                                  "packed": pa.array([part.astype(np.float32).tobytes()], pa.binary())})
    return run


def _strip_product(base):
    """Task's share of A'A Q, from strips of ``_gram``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = base.value
        total = np.zeros_like(q)
        for b in batches:
            for first, raw in zip(b.column(0).to_pylist(), b.column(1)):
                flat, part = np.frombuffer(raw.as_buffer(), np.float32), np.zeros((min(STRIP, len(q) - first), len(q) - first))
                for i in range(len(part)):
                    part[i, i:], flat = flat[:len(q) - first - i], flat[len(q) - first - i:]
                own = slice(first, first + len(part))
                total[own] += part @ q[first:]
                total[first:] += part.T @ q[own]
        if total.any():
            yield pa.RecordBatch.from_pydict({"packed": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})
    return run


def _block_product(sent, base):
    """Task's share of A'(A Q) over TF-IDF rows of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = base.value
        total = np.zeros_like(q)
        for rows in _unpacked(sent.value, batches):
            total += _apply(*rows, q)
        if total.any():
            yield pa.RecordBatch.from_pydict({"packed": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})
    return run


def _apply(r: np.ndarray, c: np.ndarray, x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A'(A q) of sparse rows, column by column."""
    out = np.empty_like(q)
    for j in range(q.shape[1]):
        y = np.bincount(r, x * q[:, j][c])
        out[:, j] = np.bincount(c, x * y[r], minlength=len(q))
    return out


def _sum_packed(df: DataFrame, column: str, dtype) -> np.ndarray | None:
    """Sum of the tasks' arrays; added up pairwise in tasks until few are left for the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for raw in b.column(0):
                x = np.frombuffer(zlib.decompress(raw.as_py()), dtype)
                total = x.copy() if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_pydict({"packed": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    few = df.select(column).repartition(8).mapInArrow(add, "packed binary")
    arrays = [np.frombuffer(zlib.decompress(bytes(r[0])), dtype) for r in few.collect()]  # eight arrays
    return sum(arrays) if arrays else None


def _latent_space(index: Index, counted: DataFrame, sent_rank: int) -> np.ndarray:
    """Right singular vectors (words x rank) of benchmark passages and all blocks of ``counted``: randomised
    SVD, products with the matrix made in tasks."""
    spark = counted.sparkSession
    v = len(index.vocabulary)
    rank = min(sent_rank, v, max(1, len(index.of)))
    width = min(v, rank + 8)
    q = np.linalg.qr(np.random.default_rng(11).normal(size=(v, width)))[0]
    own = index.own_rows()
    sent = spark.sparkContext.broadcast(index)
    blocks = counted.where("size is not null").select("size", "word", "times")
    strips = None
    if v <= GRAM_WORDS:
        tasks = -(-(counted.agg(F.sum("blocks")).first()[0] or 0) // GRAM_BLOCKS)
        strips = materialise(blocks.coalesce(max(1, tasks)).mapInArrow(_gram(sent), "first long, packed binary"), "leak-gram")
    for step in range(POWER_STEPS + 1):
        base = spark.sparkContext.broadcast(q)
        part = blocks.mapInArrow(_block_product(sent, base), "packed binary") if strips is None else \
            strips.mapInArrow(_strip_product(base), "packed binary")
        other = _sum_packed(part, "packed", np.float64)
        base.unpersist()
        total = _apply(*own, q)
        if other is not None:  # the benchmark weighs as much as the documents
            other = other.reshape(q.shape)
            total = total + other * (np.linalg.norm(total) / max(np.linalg.norm(other), 1e-12))
        if step < POWER_STEPS:
            q = np.linalg.qr(total)[0]
    if strips is not None:
        drop_table(strips)
    values, vectors = np.linalg.eigh(q.T @ total + total.T @ q)
    return q @ vectors[:, np.argsort(values)[::-1][:rank]]


def _lcs(x: np.ndarray, n: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lengths of longest common subsequences of rows of x (first n words) and y (up to 64 words), bit-parallel."""
    v = np.full(len(x), ~np.uint64(0))
    bit = np.uint64(1) << np.arange(y.shape[1], dtype=np.uint64)
    for j in range(x.shape[1]):
        use = j < n
        if not use.any():
            break
        m = ((y == x[:, j:j + 1]) * bit).sum(1, dtype=np.uint64)
        u = v & m
        v = np.where(use, (v + u) | (v - u), v)
    return 64 - np.bitwise_count(v).astype(np.int64) if hasattr(np, "bitwise_count") else \
        np.array([64 - int(z).bit_count() for z in v], np.int64)


FOUND = "doc_id long, item_id long, overlap double, answer double, n_items int"


def _keep_clean(sent, column: str, cosine: float, min_overlap: float, min_answer: float):
    """Rows (structs with the text in ``column``) without contained items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = sent.value
        for b in batches:
            text = pc.struct_field(b.column(0), column).cast(pa.string())
            for lo, hi in tokens.pieces_of_rows(text):
                best = _search_piece(index, text.slice(lo, hi - lo), hi - lo, cosine, min_overlap, min_answer)
                clean = pa.array([x[3] == 0 for x in best])
                yield b.slice(lo, hi - lo).filter(clean)
    return run


def _search(sent, cosine: float, min_overlap: float, min_answer: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = sent.value
        for b in batches:
            for lo, hi in tokens.pieces_of_rows(b.column(1)):
                best = _search_piece(index, b.column(1).slice(lo, hi - lo), hi - lo, cosine, min_overlap, min_answer)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column(0).slice(lo, hi - lo),
                    "item_id": pa.array([x[0] for x in best], pa.int64()), "overlap": pa.array([x[1] for x in best], pa.float64()),
                    "answer": pa.array([x[2] for x in best], pa.float64()), "n_items": pa.array([x[3] for x in best], pa.int32())})
    return run


def _compare(index: Index, w: tokens.Words, of: np.ndarray, start: np.ndarray, pairs: np.ndarray) -> Iterator[tuple]:
    """Windows, passages, lengths of their longest common subsequences, and words of the windows."""
    for s in range(0, len(pairs), 8192):
        a, p = np.divmod(pairs[s:s + 8192], len(index.of))
        last = np.where((a + 1 < len(of)) & (of[np.minimum(a + 1, len(of) - 1)] == of[a]), a + 2, a + 1)
        place = start[a][:, None] + np.arange(2 * BLOCK)
        inside = place < start[last][:, None]
        text = np.where(inside, w.hash[np.minimum(place, len(w.hash) - 1)], np.uint64(0))
        yield a, p, _lcs(index.passages[p], index.lengths[p], text), text


def _sums(table: np.ndarray, k: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of rows ``k`` of the table, ``count`` neighbouring ones each."""
    out, first = np.empty((len(count), table.shape[1]), table.dtype), np.cumsum(count) - count
    for s in range(0, len(count), 1024):  # the sums stay in the cache
        order = np.argsort(-count[s:s + 1024], kind="stable") + s
        begin, n = first[order], np.searchsorted(-count[order], -np.arange(count[order[0]]))
        part = np.zeros((len(order), table.shape[1]), table.dtype)
        for j, m in enumerate(n):
            part[:m] += table[k[begin[:m] + j]]
        out[order] = part
    return out


def _search_piece(index: Index, column: pa.Array, n: int, cosine: float, min_overlap: float, min_answer: float) -> list[tuple]:
    none = [(None, 0.0, 0.0, 0)] * n
    w = tokens.words(column, plain=True)
    if not len(w.hash) or not len(index.of):
        return none
    block, of = _blocks(w, n)
    at, k = index.find(w.hash)
    if not len(at):
        return none
    z = _sums(index.weighted, k, np.bincount(block[at], minlength=len(of)))
    joined = of[1:] == of[:-1]
    shared = list(index.sharing(block[at], k, joined))
    z[:-1][joined] += z[1:][joined]  # window: a block and the next one of the document
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    win, passage = [], []
    for s in range(0, len(z), 4096):
        a, p = _where(z[s:s + 4096] @ index.latent.T >= cosine)
        win.append(a + s)
        passage.append(p)
    n_passages = len(index.of)
    pairs = np.unique(np.concatenate([a * n_passages + p for a, p in [*zip(win, passage), *shared]]))
    if not len(pairs):
        return none
    start = np.searchsorted(block, np.arange(len(of) + 1))
    share = max(LEAST_COVER, min_overlap)
    found = [np.zeros(0, np.int64)]
    for a, p, size, _ in _compare(index, w, of, start, pairs):
        full = size >= share * index.lengths[p] - 1e-9
        found.append(of[a[full]] * len(index.items) + index.of[p[full]])
    # an item that is covered to min_overlap has a passage that is: all windows of such documents count
    row, item = np.divmod(np.unique(np.concatenate(found)), len(index.items))
    first, own = np.searchsorted(of, np.arange(n + 1)), np.searchsorted(index.of, np.arange(len(index.items) + 1))
    every = [(np.arange(first[x], first[x + 1])[:, None] * n_passages + np.arange(own[y], own[y + 1])).ravel() for x, y in zip(row, item)]
    cover: dict[tuple[int, int], dict[int, int]] = {}
    before: dict[tuple[int, int], dict[int, int]] = {}
    answer: dict[tuple[int, int], int] = {}
    for a, p, size, text in _compare(index, w, of, start, np.concatenate(every) if every else found[0]):
        good = np.flatnonzero(size >= LEAST_COVER * index.lengths[p])
        item = index.of[p[good]]
        reply = _lcs(index.answers[item], index.answer_lengths[item], text[good])
        body = _lcs(index.passages[p[good]], index.body[p[good]], text[good])
        for g, y, z, b in zip(good, item, reply, body):
            key = int(of[a[g]]), int(y)
            for kept, x in ((cover, size[g]), (before, b)):
                best_of = kept.setdefault(key, {})
                best_of[int(p[g])] = max(best_of.get(int(p[g]), 0), int(x))
            answer[key] = max(answer.get(key, 0), int(z))
    best = list(none)
    for (row, item), own in cover.items():
        overlap, reply = sum(own.values()) / index.sizes[item], answer[row, item] / int(index.answer_lengths[item])
        copied = overlap >= WHOLE or sum(before[row, item].values()) >= index.sizes[item] - ANSWER_WORDS
        if overlap >= min_overlap and (reply >= min_answer or copied and not index.asked[item]):
            old = best[row]
            new = (index.items[item], round(overlap, 9), round(reply, 9))
            if old[0] is None or (-new[1], new[0]) < (-old[1], old[0]):
                best[row] = (*new, old[3] + 1)
            else:
                best[row] = (*old[:3], old[3] + 1)
    return best


def _rounds(docs: DataFrame, benchmark: DataFrame, answer_col: str | None, min_overlap: float) -> Iterator[Index]:
    """Fitted indexes over the benchmark, ``ITEMS_PER_ROUND`` items or so at a time."""
    spark = docs.sparkSession
    text = docs.select(F.col("text").cast("string").alias("text"))
    answer = F.col(f"`{answer_col}`").cast("string") if answer_col else F.lit(None).cast("string")
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer"))
    rounds = max(1, -(-items.count() // ITEMS_PER_ROUND))
    for r in range(rounds):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == r).orderBy("item_id", "text")
        index = Index([tuple(x) for x in own.collect()])
        if len(index.vocabulary):
            counted = materialise(text.mapInArrow(_count_words(spark.sparkContext.broadcast(index)), BLOCKS), "leak-blocks")
            df = _sum_packed(counted.where("packed is not null"), "packed", np.int64)
            n_docs = counted.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
            index.weigh(df if df is not None else np.zeros(len(index.vocabulary)), n_docs)
            index.post(max(LEAST_COVER, min_overlap))
            index.settle(_latent_space(index, counted, RANK))
            drop_table(counted)
        yield index


def contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.40, min_overlap: float = 0.6,
                 min_answer: float = 0.5, answer_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, contaminated, n_items, item_id, overlap, answer``.

    ``item_id`` is the item covered best (ties: the smallest id). Items that are NULL or have fewer
    than ``MIN_WORDS`` words are ignored; without items nothing is contaminated. NULL and empty
    texts are clean. Repeated rows are judged each; other columns are ignored.
    """
    spark = docs.sparkSession
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = [text.mapInArrow(_search(spark.sparkContext.broadcast(index), cosine, min_overlap, min_answer), FOUND)
             for index in _rounds(docs, benchmark, answer_col, min_overlap)]
    out = found[0]
    if len(found) > 1:  # the best of all rounds; row numbers agree between scans of the same input
        out = None
        for one in found:
            one = one.withColumn("row", F.monotonically_increasing_id())
            out = one if out is None else out.unionByName(one)
        best = F.min(F.struct((-F.col("overlap")).alias("m"), "item_id", "answer"))
        out = out.groupBy("row", "doc_id").agg(best.alias("b"), F.sum("n_items").cast("int").alias("n_items")).select(
            "doc_id", "b.item_id", (-F.col("b.m")).alias("overlap"), "b.answer", "n_items")
    return out.select("doc_id", (F.col("n_items") > 0).cast("int").alias("contaminated"), "n_items", "item_id", "overlap", "answer")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.40, min_overlap: float = 0.6,
                      min_answer: float = 0.5, answer_col: str | None = None) -> DataFrame:
    """Rows of ``docs`` that contain no item of the benchmark, with all their columns and without a shuffle."""
    out = docs
    for index in _rounds(docs, benchmark, answer_col, min_overlap):
        rows = out.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        kind = rows.schema["row"].dataType.simpleString()
        sent = docs.sparkSession.sparkContext.broadcast(index)
        out = rows.mapInArrow(_keep_clean(sent, "text", cosine, min_overlap, min_answer), f"row {kind}").select("row.*")
    return out
