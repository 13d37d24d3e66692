"""Operators 11 to 13 against brute force in plain Python, with edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from hrflow.llm import merkle, mtree, spelling

VEC = "vec_id long, embedding array<float>, v string, k string"


# op11 -----------------------------------------------------------------------------
def plain_top(rows, k=10, every=100):
    """Best k of every query by sorting all products."""
    ok = [(i, [int(np.floor(1024.0 * float(np.float32(x)))) for x in e]) for i, e in rows
          if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out, seen = [], set()
    for n, (i, q) in enumerate(ok):
        if i % every or (i, tuple(q)) in seen:
            continue
        seen.add((i, tuple(q)))
        best = sorted((-sum(a * b for a, b in zip(q, x)), j) for m, (j, x) in enumerate(ok) if m != n and len(x) == len(q))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def vectors(n, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + 0.2 * rng.normal(size=(n, dim))
    x[: n // 3] = x[0]                        # a third are copies
    x[n // 2] *= 40                           # one long vector
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("bounds", [mtree.Bounds(), mtree.Bounds(node=50, page=4, routing=8, queries=3, rounds=4),
                                    mtree.Bounds(node=20, page=4, routing=3, queries=3, rounds=1)])
def test_top_products_match_brute_force(spark, bounds):
    rows = vectors(400)
    df = spark.createDataFrame([(i, e, "x", "y") for i, e in rows], VEC).repartition(5)
    got = sorted(map(tuple, mtree.top_inner_products(df, every=20, bounds=bounds).collect()))
    assert got == plain_top(rows, every=20)


def test_top_products_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [-1.0, 2.0]), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (-100, [0.0, 0.0]), (2, None), (3, [None, 1.0]),
            (4, [nan, 1.0]), (5, [inf, 1.0]), (100, []), (6, []), (200, [3.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(i, e, "x", "y") for i, e in rows], VEC)
    got = sorted(map(tuple, mtree.top_inner_products(df).collect()))
    assert got == plain_top(rows)
    assert (100, 1, 6, 0) in got and not any(r[0] == 200 for r in got)
    assert mtree.top_inner_products(df.limit(0)).collect() == []
    long = spark.createDataFrame([(0, [3e9, 0.0], "", ""), (1, [1.0, 1.0], "", "")], VEC)
    assert mtree.top_inner_products(long).collect() == []


def test_exact_beyond_doubles(spark):
    """Products over 2^53 stay exact."""
    rng = random.Random(5)
    rows = [(i, [float(rng.randrange(1 << 17)) for _ in range(3)]) for i in range(60)]
    df = spark.createDataFrame([(i, e, "", "") for i, e in rows], VEC)
    got = sorted(map(tuple, mtree.top_inner_products(df, every=20, bounds=mtree.Bounds(node=20, page=4)).collect()))
    assert got == plain_top(rows, every=20) and max(r[3] for r in got) > 1 << 53


# op12 -----------------------------------------------------------------------------
def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    return any(a[:i] + b[i] + a[i + (len(a) == len(b)):] == b for i in range(len(b)))


def plain_words(rows, length=6, count=5, factor=5):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= length and c >= count}
    form, near = {}, {}
    for w in n:
        found = [v for v in n if one_edit(w, v)]
        near[w] = len(found)
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], near[w], n[form[w]] if form[w] else None))
    return sorted(out)


def word_rows():
    rng = random.Random(11)
    base = ["shared" + "".join(rng.choice("abÉé×") for _ in range(rng.randrange(0, 7))) for _ in range(60)]
    base += ["".join(rng.choice("abc") for _ in range(rng.randrange(5, 9))) for _ in range(120)]
    chain = ["follow", "follows", "followst"]
    rows = []
    for i in range(300):
        words = [rng.choice(base) for _ in range(30)] + [chain[0]] * 40 + [chain[1]] * (6 if i % 2 else 0) + [chain[2]] * (i % 9 == 0)
        rng.shuffle(words)
        rows.append((i, rng.choice([" ", ", ", "\n", "5"]).join(w.upper() if w.isascii() and rng.random() < 0.1 else w for w in words)))
    return rows + [(None, "withoutid " * 7), (7000, None), (7001, ""), rows[0], rows[0]]


@pytest.mark.parametrize("block", [8192, 20, 3])
def test_words_match_brute_force(spark, block):
    rows = word_rows()
    df = spark.createDataFrame([(d, t, 1, "w", 2) for d, t in rows], "doc_id long, text string, n int, word string, m int").repartition(3)
    got = sorted(map(tuple, spelling.variants(df, spelling.Bounds(block=block, rows=50, held=100)).collect()))
    assert got == plain_words(rows)
    assert any(r[1] != r[2] and r[1] is not None for r in got)  # a chain of forms


def test_words_of_no_and_long_texts(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert spelling.variants(df).collect() == [] and spelling.variants(df.limit(0)).collect() == []
    long = [(1, "lengthy " * 700_000), (2, "lengthi " * 6)]
    got = sorted(map(tuple, spelling.variants(spark.createDataFrame(long, "doc_id long, text string")).collect()))
    assert got == plain_words(long)


def test_scan_finds_what_pairs_do():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 8))) for _ in range(150)})
    shared = spelling.shared_lengths(words)
    for own in words + ["zz", "abababa"]:
        assert [words[j] for j in spelling.one_edit_away(words, shared, own)] == [w for w in words if one_edit(own, w)]
        for prefix in ("a", "ab", "bba"):
            assert spelling.within_one(own, prefix) or not any(one_edit(own, w) or own == w for w in words if w.startswith(prefix))


# op13 -----------------------------------------------------------------------------
def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_manifest(rows):
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[1], r[2], r[3], text)))

    def tree(nodes):
        """Root, and per node the (left, right) siblings level by level."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for p, i in zip(paths, at):
                run = i // 8 * 8
                p.append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + 8])))
            nodes, at = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)], [i // 8 for i in at]
        return nodes[0], paths

    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    order = sorted(langs, key=lambda s: (s is not None, (s or "").encode()))
    trees = {g: tree([x[2] for x in sorted(langs[g], key=lambda x: x[:3])]) for g in order}
    root, tops = tree([trees[g][0] for g in order]) if order else (None, [])
    out = []
    for g, top in zip(order, tops):
        for (_, _, own, r), path in zip(sorted(langs[g], key=lambda x: x[:3]), trees[g][1]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            node = leaf(r, re.sub("[A-Z]", lambda m: m.group().lower(), r[4])) if bad else own
            for left, right in path + top:
                node = sha(left + node + right)
            out.append((r[0], own, trees[g][0], root, sha("".join(a + b for a, b in path + top)), node, node == root))
    return sorted(out, key=str)


DOCS = "doc_id long, source string, lang string, n_chars long, text string, g string, n long"


def check_manifest(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS).repartition(4)
    assert sorted(map(tuple, merkle.manifest(df).collect()), key=str) == plain_manifest(rows)


def test_manifest_matches_brute_force(spark):
    """A language over several blocks (a last block of one leaf), small ones, and more languages than a run holds."""
    rows = [(i, "s", "en", i, f"Text {i} É") for i in range(2 * 512 * 1 + 1)]
    rows += [(5000 + i, None, f"l{i % 70}", None, "A" if i % 2 else None) for i in range(100)]
    rows += [(9000, "one", None, 3, "alone"), (9001, "two", "", 3, "EMPTY lang"), (9002, "Two", "zé", 3, "")]
    check_manifest(spark, rows)


def test_manifest_edge_cases(spark):
    check_manifest(spark, [])
    check_manifest(spark, [(1, None, None, None, None)])
    check_manifest(spark, [(3, "s", "en", 1, "Same"), (3, "s", "en", 1, "Same"), (3, "s", "en", 1, "Other"), (None, "s", "en", 1, "NULL id"),
                           (None, "s", "en", None, "NULL id"), (-3, "s", "en", 1, "L" * 2_000_000)])


@pytest.mark.parametrize("n", [1, 7, 8, 9, 63, 64, 65, 512])
def test_sweeps(n):
    leaves = [sha(str(i)) for i in range(n)]
    done = merkle.forward(leaves, merkle.levels_over(n))
    assert [d[:2] for d in done] == sorted(d[:2] for d in done)  # labels in order
    for leaf, chain in zip(leaves, merkle.backward(n, done, ())):
        for left, right in merkle._walk(chain):
            leaf = sha(left + leaf + right)
        assert leaf == (done[-1][4] if done else leaves[0])
