import random
import textwrap

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hrflow.llm import decontam, license as lic, tokens

VOCABULARY = [a + b for a in ("ba", "ko", "ri", "tu", "se", "mo", "la", "ne") for b in ("da", "fi", "go", "hu", "ja", "ky", "lo", "mi")]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(9)
    words = lambda n: [rng.choice(VOCABULARY) + (rng.choice("xyzvw") if rng.random() < 0.6 else "") for _ in range(n)]
    items = [(i, words(rng.randint(15, 60))) for i in range(40)]
    docs, truth = [], set()
    for i in range(300):
        text = words(rng.randint(1, 400))
        if i % 7 == 0:
            own = list(items[i % 40][1])
            if i % 14 == 0:  # a paraphrase: some words replaced
                for k in rng.sample(range(len(own) - 6), len(own) // 8):
                    own[k] = "other"
            at = rng.randrange(len(text) + 1)
            text[at:at] = own
            truth.add(i)
        text = " ".join(text)
        docs.append((i, text.upper() if i % 21 == 0 else text))
    return docs, [(i, " ".join(w)) for i, w in items], truth


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").withColumn("overlap", F.lit("x"))


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))


def test_planted_items_are_found_and_clean_texts_left_alone(spark, planted):
    docs, items, truth = planted
    got = decontam.contaminated(frame(spark, docs), bench(spark, items)).collect()
    assert len(got) == len(docs)
    assert {r.doc_id for r in got if r.contaminated} == truth
    assert all(r.item_id == r.doc_id % 40 for r in got if r.contaminated)
    kept = decontam.without_benchmark(frame(spark, docs), bench(spark, items))
    assert kept.columns == ["doc_id", "text", "overlap"]
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - truth


def test_rounds_give_the_same(spark, planted, monkeypatch):
    docs, items, truth = planted
    monkeypatch.setattr(decontam, "ITEMS_PER_ROUND", 15)
    got = decontam.contaminated(frame(spark, docs), bench(spark, items)).collect()
    assert len(got) == len(docs) and {r.doc_id for r in got if r.contaminated} == truth


def exact(docs, items, min_overlap=0.6, min_answer=0.5):
    """Documents with a covered item: every window against every passage, without a choice of candidates."""
    def lcs(x, y):
        t = [0] * (len(y) + 1)
        for a in x:
            old = 0
            for j, b in enumerate(y, 1):
                old, t[j] = t[j], old + 1 if a == b else max(t[j], t[j - 1])
        return t[-1]

    out = set()
    for i, text in docs:
        w = text.lower().split()
        windows = [w[s:s + 64] for s in range(0, len(w), 32)]
        for _, item in items:
            own = item.split()
            parts = [[own[k] for k in p] for p in np.array_split(np.arange(len(own)), -(-len(own) // 32))]
            near = [v for v in windows if sum(x in set(v) for x in own) >= 0.4 * len(parts[0])]
            sizes = [[lcs(p, v) for v in near] for p in parts]
            good = [v for j, v in enumerate(near) if any(x[j] >= 0.4 * len(p) for x, p in zip(sizes, parts))]
            overlap = sum(max((y for y in x if y >= 0.4 * len(p)), default=0) for x, p in zip(sizes, parts)) / len(own)
            if overlap >= min_overlap and any(lcs(own[-6:], v) >= min_answer * len(own[-6:]) for v in good):
                out.add(i)
                break
    return out


def test_short_items_in_long_texts_are_found(spark):
    rng = random.Random(4)
    words = lambda n: [rng.choice(VOCABULARY) + (rng.choice("xyzvw") if rng.random() < 0.6 else "") for _ in range(n)]
    items = [(i, " ".join(words(rng.randint(5, 15)))) for i in range(400)]
    docs, planted = [], set()
    for i in range(120):
        text = words(rng.randint(150, 300))
        if i % 2:
            at = rng.randrange(len(text))
            text[at:at] = items[i][1].split()
            planted.add(i)
        docs.append((i, " ".join(text)))
    got = {r.doc_id for r in decontam.contaminated(frame(spark, docs), bench(spark, items)).where("contaminated = 1").collect()}
    assert planted <= got
    assert got == exact(docs, items)


def test_cut_items_and_reworded_endings_are_found(spark):
    rng = random.Random(5)
    words = lambda n: [rng.choice(VOCABULARY) + rng.choice("xyzvw") for _ in range(n)]
    own = {i: words(n) for i, n in enumerate((56, 40, 56, 18, 16, 40))}
    new = lambda n: [f"new{j}" for j in range(n)]
    texts = {0: own[0][:50], 1: own[1][:34], 2: own[2][:-6] + new(6), 3: own[3][:-6] + new(6), 4: own[4][:-6] + new(6),
             5: own[5][:26], 6: own[5][:2] + new(3) + own[5][5:18] + new(3) + own[5][21:34] + new(6)}
    docs = [(i, " ".join(words(90) + t + words(90))) for i, t in texts.items()]
    items = [(i, " ".join(w)) for i, w in own.items()]
    got = {r.doc_id for r in decontam.contaminated(frame(spark, docs), bench(spark, items)).where("contaminated = 1").collect()}
    assert got == {0, 1, 2, 3, 4}
    given = bench(spark, items).withColumn("answer", F.when(F.col("item_id") < 2, F.lit("quite another answer here")))
    got = decontam.contaminated(frame(spark, docs), given, answer_col="answer").where("contaminated = 1").collect()
    assert {r.doc_id for r in got} == {2, 3, 4}


def test_latent_space_is_fitted_to_all_documents(spark, monkeypatch):
    rng = np.random.default_rng(8)
    items = [(i, " ".join(rng.choice(VOCABULARY, 20))) for i in range(6)]
    docs = [(i, " ".join(rng.choice(VOCABULARY[:20] if i % 3 else VOCABULARY[20:], rng.integers(20, 90)))) for i in range(1300)]
    docs += [(5000, None), (5001, ""), (5002, "none of these"), docs[0]]

    def rows(texts):
        """Unit TF-IDF rows of blocks, word by word."""
        out = []
        for t in texts:
            w = (t or "").split()
            for s in range(0, len(w), decontam.BLOCK):
                x = np.zeros(len(words))
                for u in w[s:s + decontam.BLOCK]:
                    if u in words:
                        x[words.index(u)] += 1
                x = np.where(x > 0, 1 + np.log(np.maximum(x, 1)), 0) * idf
                if x.any():
                    out.append(x / np.linalg.norm(x))
        return np.array(out)

    words = sorted({u for _, t in items for u in t.split()})
    df = np.array([sum(u in (t or "").split() for _, t in docs) for u in words])
    idf = np.log((1.0 + len(docs)) / (1.0 + df)) + 0.05
    for bound in (decontam.GRAM_WORDS, 0):
        monkeypatch.setattr(decontam, "RANK", 5)
        monkeypatch.setattr(decontam, "GRAM_WORDS", bound)
        index = next(decontam._rounds(frame(spark, docs), bench(spark, items), None, 0.6))
        order = [int(np.searchsorted(index.vocabulary, tokens.words(pa.array([u], pa.large_string()), plain=True).hash[0])) for u in words]
        assert np.allclose(index.idf[order], idf)
        own, other = (x.T @ x for x in (rows(t for _, t in items), rows(t for _, t in docs)))
        q = np.zeros((len(words), min(len(words), 5 + 8)))
        q[:] = np.linalg.qr(np.random.default_rng(11).normal(size=q.shape))[0][order]
        for step in range(decontam.POWER_STEPS + 1):
            total = own @ q + other @ q * (np.linalg.norm(own @ q) / np.linalg.norm(other @ q))
            if step < decontam.POWER_STEPS:
                q = np.linalg.qr(total)[0]
        values, vectors = np.linalg.eigh(q.T @ total + total.T @ q)
        space = q @ vectors[:, np.argsort(values)[::-1][:5]]
        got = index.space[order]
        assert np.abs(got @ got.T - space @ space.T).max() < 1e-3


def test_edges(spark, planted):
    docs, items, _ = planted
    odd = [(1, None), (2, ""), (3, " \n "), (4, "a " * 50_000), (None, items[0][1]), (5, items[0][1]), (5, items[0][1])]
    got = decontam.contaminated(frame(spark, odd), bench(spark, items + [(90, None), (91, "short one"), (None, "x " * 30), (92, "")])).collect()
    assert sorted((r.doc_id or 0, r.contaminated) for r in got) == [(0, 1), (1, 0), (2, 0), (3, 0), (4, 0), (5, 1), (5, 1)]
    assert decontam.contaminated(frame(spark, []), bench(spark, items)).count() == 0
    assert {r.contaminated for r in decontam.contaminated(frame(spark, docs[:5]), bench(spark, [])).collect()} == {0}


def test_bit_parallel_lcs():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 6, (40, 32)).astype(np.uint64), rng.integers(0, 6, (40, 64)).astype(np.uint64)
    n = rng.integers(1, 33, 40)
    got = decontam._lcs(x, n, y)
    for i in range(40):
        t = np.zeros((n[i] + 1, 65), int)
        for p in range(n[i]):
            for q in range(64):
                t[p + 1, q + 1] = t[p, q] + 1 if x[i, p] == y[i, q] else max(t[p, q + 1], t[p + 1, q])
        assert t[-1, -1] == got[i]


def test_licenses_own_and_inherited(spark):
    files = [("a/LICENSE", "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software"),
             ("a/b/c/x.py", "print(1)"), ("a/b/y.py", "Licensed under the Apache License, Version 2.0.\n" + "code here\n" * 40),
             ("a/b/NOTICE", "This work is licensed under the GNU General Public License, version 3."),
             ("z/q.py", "nothing"), ("top.py", None), ("ab/x.py", "a line"), ("e.py", ""), ("e.py", ""), (None, "x"),
             ("a/b/deep/er/w.py", "long " * 100_000)]
    df = spark.createDataFrame(files, "path string, text string").withColumn("license", F.lit(1)).withColumn("header", F.lit(2))
    got = {r.path: (r.own_license, r.license, r.inherited_from) for r in lic.scan(df).collect()}
    assert len(got) == 9 + 0 and None not in got
    assert got["a/LICENSE"] == ("MIT", "MIT", None)
    assert got["a/b/y.py"][0] == "Apache-2.0"
    assert got["a/b/c/x.py"] == (None, "GPL-3.0", "a/b/NOTICE")
    assert got["a/b/deep/er/w.py"] == (None, "GPL-3.0", "a/b/NOTICE")
    assert got["z/q.py"] == got["ab/x.py"] == got["top.py"] == got["e.py"] == (None, None, None)
    assert lic.scan(df.limit(0)).count() == 0


def test_licenses_among_other_words(spark):
    apache, gpl = "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3."
    other = lambda n, tag: " ".join(f"{tag}word{j}" for j in range(n))
    files = [(f"d{n}", other(n, "a") + " " + apache[:-1].lower() + " " + other(n, "b")) for n in (5, 10, 20, 3000)]
    files += [("g", other(40, "c") + " and " + gpl + " " + other(40, "d")),
              ("two", apache + "\n" + "code here\n" * 3 + other(12, "e") + " the licence of the shop and its copyright " + other(12, "f")),
              ("plain", other(20, "g") + " under the license of the state he drove " + other(20, "h")),
              ("copyright", "Copyright 2020 " + other(30, "i"))]
    files += [(f"no{j}", "an ordinary text") for j in range(300)]
    got = {r.path: r.own_license for r in lic.scan(spark.createDataFrame(files, "path string, text string")).collect() if r.path[:2] != "no"}
    assert got == {"d5": "Apache-2.0", "d10": "Apache-2.0", "d20": "Apache-2.0", "d3000": "Apache-2.0", "g": "GPL-3.0",
                   "two": "Apache-2.0", "plain": None, "copyright": None}


def test_whole_licences_are_licence_files_whatever_their_names(spark):
    mit = "MIT License\n\nCopyright (c) 2020 Some One\n\n" + "\n".join(textwrap.wrap(lic.WHOLE_TEXTS["MIT"], 70))
    isc = "ISC License\n\nCopyright (c) 2021, Another One\n\n" + "\n".join(textwrap.wrap(lic.WHOLE_TEXTS["ISC"], 70))
    bsd = "Copyright 1999 A University\n\n" + "\n".join(textwrap.wrap(lic.WHOLE_TEXTS["BSD-3-Clause"], 60))
    story = " ".join(f"story{i}" for i in range(400))
    files = [("p/LICENSE", mit), ("p/src/a.py", "x = 1"), ("p/src/b.py", "x = 2"), ("i/LICENSE.md", isc), ("i/src/a.py", "y"),
             ("b/terms.txt", bsd), ("b/one/two/a.py", "z"), ("m/terms.txt", mit.upper()), ("m/a.py", "q"),
             ("n/COPYING", "Licensed under the Apache License, Version 2.0.\n" + story), ("n/a.py", "w"),
             ("o/story.txt", "Licensed under the Apache License, Version 2.0.\n" + story), ("o/a.py", "v"),
             ("o/LICENSE", story)] + [(f"x/no{j}.txt", "an ordinary text") for j in range(200)]
    got = {r.path: (r.own_license, r.license, r.inherited_from)
           for r in lic.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got["p/LICENSE"][0] == got["m/terms.txt"][0] == "MIT" and got["i/LICENSE.md"][0] == "ISC"
    assert got["b/terms.txt"][0] == "BSD-3-Clause" and got["n/COPYING"][0] == got["o/story.txt"][0] == "Apache-2.0"
    assert got["p/src/a.py"] == got["p/src/b.py"] == (None, "MIT", "p/LICENSE")
    assert got["i/src/a.py"] == (None, "ISC", "i/LICENSE.md") and got["m/a.py"] == (None, "MIT", "m/terms.txt")
    assert got["b/one/two/a.py"] == (None, "BSD-3-Clause", "b/terms.txt")
    assert got["n/a.py"] == (None, "Apache-2.0", "n/COPYING")
    assert got["o/a.py"] == got["o/LICENSE"] == got["x/no7.txt"] == (None, None, None)
    assert len(got) == len(files)
