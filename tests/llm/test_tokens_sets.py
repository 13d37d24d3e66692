import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from hrflow.llm import tokens
from hrflow.llm.set_join import jaccard_classes
from hrflow.llm.tables import connected_components, materialise

WORD = r"[^\x20\x09-\x0D]+"


def words_of(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles_of(text, k):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbB\t\n é\xa0 ü.", max_size=40)), max_size=8), st.integers(1, 5))
def test_shingle_sets_have_the_sizes_of_the_plain_ones(texts, k):
    got = dict(tokens.shingle_sets(pa.array(texts, pa.string()), k))
    assert {i: len(s) for i, s in got.items()} == {i: len(shingles_of(t, k)) for i, t in enumerate(texts) if shingles_of(t, k)}


def test_equal_words_equal_hashes_in_any_piece(monkeypatch):
    texts = ["x" * 300 + " one two", "One " + "y " * 200 + "two", "one two"]
    whole = tokens.words(pa.array(texts))
    monkeypatch.setattr(tokens, "PIECE", 64)
    cut = tokens.words(pa.array(texts))
    assert (whole.hash == cut.hash).all()
    assert whole.hash[1] == whole.hash[3] == whole.hash[-2]


def brute(rows, k, percent):
    sets, parent = {}, {}
    for i, t in rows:
        sets[i] = shingles_of(t, k)
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for i, s in sets.items():
        for j, n in collections.Counter(j for g in s for j in holders[g] if j > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choices(vocabulary, k=14))
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "ONE"), (5, "a b c"), (6, "a b c d")]
    base = [rng.choice(vocabulary) for _ in range(120)]
    chain = list(base)
    while len(rows) < n:
        kind = rng.random()
        i = 2 * len(rows)
        if kind < 0.25:        # a chain of drifting copies
            for _ in range(rng.randint(0, 3)):
                chain[rng.randrange(len(chain))] = rng.choice(vocabulary)
            rows.append((i, " ".join(chain)))
        elif kind < 0.45:      # near copies of one text
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((i, " ".join(own)))
        elif kind < 0.55:
            rows.append((i, rng.choice(rows)[1]))
        else:                  # a common line and words of its own
            rows.append((i, line + "\n" + " ".join(rng.choices(vocabulary, k=rng.choice([2, 3, 30, 200])))))
    return rows


@pytest.mark.parametrize("seed,k,percent", [(1, 4, 85), (2, 5, 80), (3, 1, 60)])
def test_components_equal_brute_force(spark, seed, k, percent):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(df, k=k, percent=percent).collect()}
    assert got == brute(rows, k, percent)


def test_no_pass_is_left_out_when_lists_are_long(spark, monkeypatch):
    from hrflow.llm import set_join
    monkeypatch.setattr(set_join, "SHORT", 1)   # every list goes through pivots and the last pass
    monkeypatch.setattr(set_join, "PASSES", 2)
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(df).collect()}
    assert got == brute(rows, 4, 85)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, "a b c d e"), (3, "x y z")],
                               "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_classes(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (2, 2, 1), (3, 1, 3)], key=str)
    assert jaccard_classes(df.limit(0)).count() == 0


def test_a_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    df = spark.createDataFrame([(1, long), (2, long + " more"), (3, "short one")], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(df).collect()}
    assert got == {1: (59_997, 1), 2: (59_998, 1), 3: (1, 3)}


def test_connected_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, int(x)) for x in rng.integers(501, 600, 80)] + [(7, 7), (None, 3)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(101, 161)} | {b: 500 for a, b in edges if a == 500}
    assert {k: v for k, v in got.items() if k != v} == want


def test_repeated_ids_lose_no_link(spark):
    """Different texts of one id with sets of one size: what is near to either is linked."""
    words = [f"w{i}" for i in range(120)]
    a, b = " ".join(words[:60]), " ".join(words[60:])
    near = lambda t: t.rsplit(" ", 1)[0] + " other"
    rows = [(1, a), (1, b), (2, near(a)), (3, near(b)), (4, "quite different text of its own"), (None, a), (5, None)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, row int")
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_classes(df, k=4, percent=85).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (None, None), (5, 5)], key=str)


def test_sketch_follows_the_corpus(spark):
    from hrflow.llm import set_join
    assert set_join.sketch_cells(spark.createDataFrame([], "text string")) == set_join.CELLS[0]
    small = spark.range(4).selectExpr("repeat('x', 1000) AS text")
    assert set_join.sketch_cells(small) == set_join.CELLS[0]
    large = spark.range(1 << 10).selectExpr("repeat('x', 1 << 18) AS text")
    assert set_join.sketch_cells(large) == 1 << 20


def test_scratch_tables_of_large_rows_have_small_pages(spark):
    """F1, pipeline: packed arrays made pages of a hundred rows, whatever their bytes."""
    rows = spark.range(60, numPartitions=1).select(
        "id", F.expr("array_join(transform(sequence(1, 4096), i -> sha2(concat(id, ':', i), 256)), '')").alias("packed"))
    table = materialise(rows, "large-rows")
    jvm, pages = spark.sparkContext._jvm, []
    for name in table.inputFiles():
        file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            jvm.org.apache.hadoop.fs.Path(name), spark.sparkContext._jsc.hadoopConfiguration())
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
        for block in reader.getFooter().getBlocks():
            for column in block.getColumns():
                index = reader.readOffsetIndex(column)
                pages += [index.getCompressedPageSize(i) for i in range(index.getPageCount())]
        reader.close()
    assert max(pages) < 2 << 20
    assert table.count() == 60 and table.where(F.length("packed") != 1 << 18).isEmpty()
