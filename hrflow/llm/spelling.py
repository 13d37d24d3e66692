"""Spelling variants: words of a vocabulary that differ by one edit, grouped under their common form.

The vocabulary is a sorted list, cut into blocks that share a prefix. A word is compared with a
block by one scan: rows of the banded edit matrix (three cells for one edit) belong to prefixes,
so the rows of the prefix shared with the word visited before are reused, and where all cells of a
row exceed one edit the whole range with that prefix is skipped by binary search.

Two near words of which the shorter has 2m or 2m + 1 code points share the first m or the last m of
them, whichever half the edit isn't in. So two sorted lists, of the words and of the words reversed,
bring all near words under a common prefix of half their length; the second list only counts what
the first can't see. A prefix with more than ``Bounds.block`` words is split by its next code point,
and words descend to the parts whose prefix is within one edit.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialise, with_columns_of

LETTERS = "A-Za-zÀ-ÿ"
TOP = "\U0010ffff"


@dataclass(frozen=True)
class Bounds:
    """Least length (three or more) and count of a word, the divisor of hashes that lose a code point,
    how many times a form outnumbers its variant, words of a block, distinct words a task holds
    before it sends their counts on, words of a scanning task."""

    length: int = 6
    count: int = 5
    every: int = 199
    factor: int = 5
    block: int = 8192
    held: int = 200_000
    rows: int = 32_768


def _runs(text: str, pattern: re.Pattern) -> Counter:
    """Counts of the runs of a whole text, A-Z lower-cased (other letters stay)."""
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    if len(text) < 1 << 22:
        return Counter(pattern.findall(text))
    return Counter(m.group() for m in pattern.finditer(text))


def _count_batches(bounds: Bounds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # shorter runs are no words, with or without a code point less
        pattern, held = re.compile(f"[{LETTERS}]{{{bounds.length},}}"), Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

        for b in batches:
            for own, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                runs = _runs(text.as_py() or "", pattern)
                if own is None:
                    held.update(runs)
                    continue
                start = zlib.crc32(b"%d:" % own)
                for word, n in runs.items():
                    h = zlib.crc32(word.encode("utf-8", "surrogatepass"), start)
                    if h % bounds.every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < bounds.length:
                            continue
                    held[word] += n
            if len(held) > bounds.held:
                yield sent()
                held.clear()
        if held:
            yield sent()
    return run


def vocabulary(docs: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """``word, n``: the words of ``docs`` and how often they occur, counted in the scan first."""
    rows = with_columns_of(docs, [("doc_id", "long"), ("text", "string")])
    counted = rows.mapInArrow(_count_batches(bounds), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= bounds.count)


def _next_row(row: tuple[int, int, int], own: str, d: int, c: str) -> tuple[int, int, int]:
    """Cells for ``d``, ``d + 1`` and ``d + 2`` code points of ``own`` after ``d + 1`` of the other word,
    whose last is ``c``; two means two or more."""
    a, b, e = row
    size = len(own)
    x = a if 0 < d <= size and own[d - 1] == c else a + 1
    if b + 1 < x:
        x = b + 1
    y = b if d < size and own[d] == c else b + 1
    if d >= size:
        y = 2
    else:
        if e + 1 < y:
            y = e + 1
        if x + 1 < y:
            y = x + 1
    z = e if d + 1 < size and own[d + 1] == c else e + 1
    if d + 1 >= size:
        z = 2
    elif y + 1 < z:
        z = y + 1
    return (x if x < 2 else 2), (y if y < 2 else 2), (z if z < 2 else 2)


def within_one(own: str, prefix: str) -> bool:
    """Whether a word that starts with ``prefix`` can be within one edit of ``own``."""
    row = (2, 0, 1)
    for d, c in enumerate(prefix):
        row = _next_row(row, own, d, c)
        if min(row) > 1:
            return False
    return True


def shared_lengths(words: list[str]) -> list[int]:
    """Length of the prefix that each word of a sorted list shares with the one before."""
    out = [0]
    for v, w in zip(words, words[1:]):
        n, most = 0, min(len(v), len(w))
        while n < most and v[n] == w[n]:
            n += 1
        out.append(n)
    return out


def one_edit_away(words: list[str], shared: list[int], own: str) -> list[int]:
    """Places of the words of a sorted list that are exactly one edit from ``own``."""
    rows, found, i = [(2, 0, 1)], [], 0
    while i < len(words):
        word = words[i]
        del rows[shared[i] + 1:]
        d, row = len(rows) - 1, rows[-1]
        while d < len(word):
            row = _next_row(row, own, d, word[d])
            rows.append(row)
            d += 1
            if row[0] > 1 and row[1] > 1 and row[2] > 1:
                i = bisect_left(words, word[:d] + TOP, i + 1)
                break
        else:
            at = 1 + len(own) - d
            if 0 <= at <= 2 and row[at] == 1:
                found.append(i)
            i += 1
    return found


def _block_near(m: int, rows: list[tuple[str, int, bool]], reverse: bool) -> Iterator[tuple[str, int, int, str]]:
    """Near words of one block (sorted ``key, n, inside``; all share ``m`` code points) per word that asks."""
    words = [(k, n) for k, n, inside in rows if inside]
    ends = [k[m:] for k, _ in words]  # what words share first leaves their distance as it is
    shared = shared_lengths(ends)
    for own, _, _ in rows:
        best = None
        near = 0
        for j in one_edit_away(ends, shared, own[m:]):
            other, n = words[j]
            # of the words of three lengths here, pairs of the longest belong to the blocks of m + 1; the
            # reversed list leaves words that share the first code points to the other one
            if min(len(own), len(other)) // 2 != m or (reverse and other[-m:] == own[-m:]):
                continue
            near += 1
            found = (-n, other[::-1] if reverse else other)
            if best is None or found < best:
                best = found
        if near:
            yield own[::-1] if reverse else own, near, -best[0], best[1]


def _scan(reverse: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by block and key; a block may go on in the next batch."""
        held, own = [], None
        out: list[tuple[str, int, int, str]] = []

        def sent() -> pa.RecordBatch:
            word, near, most, form = zip(*out) if out else ([],) * 4
            out.clear()
            return pa.RecordBatch.from_pydict({"word": pa.array(word, pa.string()), "n_near": pa.array(near, pa.int64()),
                                               "form_n": pa.array(most, pa.int64()), "form": pa.array(form, pa.string())})

        for b in batches:
            for m, block, *row in zip(*(b.column(c).to_pylist() for c in ("m", "block", "key", "n", "inside"))):
                if (m, block) != own:
                    if len(held) > 1:
                        out.extend(_block_near(own[0], held, reverse))
                    held, own = [], (m, block)
                held.append(row)
            yield sent()
        if len(held) > 1:
            out.extend(_block_near(own[0], held, reverse))
            yield sent()
    return run


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words to the parts of their prefix that are within one edit."""
    for b in batches:
        rows = zip(*(b.column(c).to_pylist() for c in ("m", "key", "n", "parts")))
        out = [(m, k, n, p) for m, k, n, ps in rows for p in ps if within_one(k, p)]
        m, key, n, part = zip(*out) if out else ([],) * 4
        yield pa.RecordBatch.from_pydict({"m": pa.array(m, pa.int32()), "key": pa.array(key, pa.string()),
                                          "n": pa.array(n, pa.int64()), "block": pa.array(part, pa.string())})


def _near(words: DataFrame, reverse: bool, bounds: Bounds) -> DataFrame:
    """Near words of each word by one sorted list: ``word, n_near, form_n, form``."""
    half = F.array_distinct(F.expr("array(int(length(word) div 2), int((length(word) - 1) div 2))"))
    keyed = words.select((F.reverse("word") if reverse else F.col("word")).alias("key"), "n", F.explode(half).alias("m"))
    rows = keyed.withColumn("block", F.left("key", F.col("m")))
    visits, at, done, deeper = rows.limit(0), ["m", "block"], [], 0
    while True:  # blocks by prefix; the words that visit a block that is too large go on to its parts
        large = materialise(rows.groupBy(*at).count().where(F.col("count") > bounds.block).select(*at), "words-large")
        last = large.isEmpty()
        ready = [r if last else r.join(large, at, "left_anti") for r in (rows, visits)]
        done.append((ready[0].withColumn("inside", F.lit(True)).unionByName(ready[1].withColumn("inside", F.lit(False))))
                    .select(*at, "key", "n", "inside"))
        if last:
            break
        deeper += 1
        split = rows.join(large, at, "left_semi")
        asking = visits.join(large, at, "left_semi").unionByName(split)
        rows = materialise(split.withColumnRenamed("block", "whole").withColumn("block", F.left("key", F.col("m") + deeper)), "words-rows")
        parts = rows.groupBy("m", F.col("whole").alias("block")).agg(F.collect_set("block").alias("parts"))  # one per next code point
        asked = (asking.join(parts, at).select("m", "key", "n", "parts").mapInArrow(_descend, "m int, key string, n long, block string"))
        rows = rows.drop("whole")
        # a word is in its own block once, as a row of it; other visitors only ask
        visits = materialise(asked.join(rows.select("m", "key", "block"), ["m", "key", "block"], "left_anti"), "words-visits")
    found, tasks = None, 1 + words.count() // bounds.rows  # few bytes, much work: not left to the size of the shuffle
    for blocks in done:
        near = (blocks.repartition(tasks, *at).sortWithinPartitions(*at, "key")
                .mapInArrow(_scan(reverse), "word string, n_near long, form_n long, form string"))
        found = near if found is None else found.unionByName(near)
    return found


def with_roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a ``form``: the end of the chain of forms, by doubling steps
    (a form occurs several times as often as its variant, so chains are short and end)."""
    steps = materialise(forms.where("form is not null").select("word", F.col("form").alias("root")), "words-roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if steps.join(on, "root", "left_semi").isEmpty():
            return steps
        steps = materialise(steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "words-roots")


def variants(docs: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """One row per word of ``docs`` (``doc_id, text``): ``word, form, root, n, n_near, form_n``.

    NULL and empty texts hold no words; in rows with a NULL id no run loses a code point; repeated
    rows count as often as they come; an empty table gives no rows. Ties of ``form`` go to the
    smallest word in code-point order. Other columns are ignored, whatever their names; a missing
    text column counts as NULL.
    """
    if bounds.length < 3:
        raise ValueError("words need at least three code points")
    words = materialise(vocabulary(docs, bounds), "words")
    near = _near(words, False, bounds).unionByName(_near(words, True, bounds))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    formed = -F.col("best.less") >= bounds.factor * F.col("n")
    forms = materialise(words.join(near, "word", "left").select(
        "word", F.when(formed, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, -F.col("best.less")).alias("form_n")), "words-forms")
    return forms.join(with_roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
