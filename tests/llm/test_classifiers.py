import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hrflow.llm import quality, tables, toxicity

DOCS = "doc_id long, text string"
LABELS = "doc_id long, quality int, toxic int"


def prose(rng, n):
    out = []
    for i in range(n):
        out.append(("" if i % 9 else "") + rng.choice(["alpha", "beta", "gamma", "delta", "river", "stone", "green", "light",
                                                       "walks", "under", "the", "of", "a", "moves"]) + ("." if i % 11 == 10 else ""))
    return " ".join(out)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(400):
        text, good, toxic = prose(rng, rng.randint(20, 200)), 1, 0
        if i % 5 == 0:
            good, text = 0, " ".join(w.upper() + "!!" for w in text.split()) if i % 2 else " ".join(["same"] * rng.randint(20, 90))
        if i % 4 == 1:
            toxic = 1
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["villain", "grumble", "zorkish", "zorkable"]))
            text = " ".join(words)
        docs.append((i, text))
        labels.append((i, good, toxic))
    return spark.createDataFrame(docs, DOCS).cache(), spark.createDataFrame(labels, LABELS).cache()


def accuracy(scored, labels, column):
    rows = scored.join(labels, "doc_id").where("held_out").select("predicted", column).collect()
    assert len(rows) > 40
    return np.mean([r[0] == r[1] for r in rows])


def test_quality_held_out_accuracy(labelled):
    docs, labels = labelled
    assert accuracy(quality.quality_scores(docs, labels), labels, "quality") >= 0.97


def test_toxicity_held_out_accuracy_and_spans(labelled):
    docs, labels = labelled
    found = toxicity.toxic_documents(docs, labels)
    assert accuracy(found, labels, "toxic") >= 0.95
    row = found.where("predicted = 1").join(docs, "doc_id").first()
    assert all(row.text[s.start:s.end].split()[0].startswith(("villain", "grumble", "zork")) for s in row.spans) and row.spans


def test_held_out_labels_are_not_used(spark, labelled):
    docs, labels = labelled
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality.quality_scores(docs, labels).orderBy("doc_id").collect()
    assert a == quality.quality_scores(docs, flipped).orderBy("doc_id").collect()


def test_edge_rows(spark, labelled):
    docs, labels = labelled
    odd = spark.createDataFrame([(1000, None), (1001, ""), (1002, " \n"), (1003, "x" * 200_000), (None, "a b"), (1004, "a"), (1004, "a")],
                                DOCS).withColumn("score", F.lit(7)).withColumn("label", F.lit("x"))
    for f in (quality.quality_scores, toxicity.toxic_documents):
        got = f(docs.withColumn("score", F.lit(7)).withColumn("label", F.lit("x")).unionByName(odd), labels).where(
            "doc_id >= 1000 or doc_id is null").collect()
        assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 1004}) == 1
        assert [r.held_out for r in got if r.doc_id is None] == [None]
        none, empty, blank = (next(r.score for r in got if r.doc_id == i) for i in (1000, 1001, 1002))
        assert none == empty
    assert all(r.score == 0 for r in got if r.doc_id in (1000, 1001, 1002))


def test_empty_tables(spark, labelled):
    docs, labels = labelled
    for f in (quality.quality_scores, toxicity.toxic_documents):
        assert f(docs.limit(0), labels).count() == 0
        assert f(docs.limit(5), labels.limit(0)).count() == 5


def test_without_toxic_keeps_columns_and_clean_rows(labelled):
    docs, labels = labelled
    field = toxicity.fit(docs, labels)
    more = docs.withColumn("spans", F.lit(1)).withColumn("n_words", F.lit("x"))
    kept = toxicity.without_toxic(more, field)
    assert kept.columns == more.columns
    want = {r.doc_id for r in toxicity.score(docs, field).where("score < 0.5").collect()}
    assert {r.doc_id for r in kept.collect()} == want and 200 < len(want) < 400


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 17, 200):
        odds, first = np.exp(rng.normal(size=n)), rng.random(n) < 0.2
        first[0] = True
        trans, start = rng.normal(size=(2, 2)), rng.normal(size=2)
        got, pairs, _ = toxicity.forward_backward(odds, first, trans, start, edges=True)
        want = np.zeros(n)
        edges = np.zeros((2, 2))
        cut = [*np.flatnonzero(first), n]
        for a, b in zip(cut[:-1], cut[1:]):
            e = np.stack([np.ones(b - a), odds[a:b]], 1)
            al, be = np.zeros((b - a, 2)), np.ones((b - a, 2))
            al[0] = np.exp(start) * e[0]
            for t in range(1, b - a):
                al[t] = al[t - 1] @ np.exp(trans) * e[t]
            for t in range(b - a - 2, -1, -1):
                be[t] = np.exp(trans) @ (e[t + 1] * be[t + 1])
            g = al * be
            want[a:b] = g[:, 1] / g.sum(1)
            for t in range(1, b - a):
                m = al[t - 1][:, None] * np.exp(trans) * (e[t] * be[t])[None, :]
                edges += m / m.sum()
        assert np.allclose(got, want) and np.allclose(pairs, edges)


def test_toxicity_fit_writes_few_files_in_many_partitions(spark, labelled, monkeypatch):
    docs, labels = labelled
    want = toxicity.score(docs, toxicity.fit(docs, labels)).orderBy("doc_id").collect()
    files = {}

    def noted(df, name, *rest):
        out = tables.materialise(df, name, *rest)
        files[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(toxicity, "materialise", noted)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "100")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        field = toxicity.fit(docs, labels)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(files) == 6 and max(files.values()) <= toxicity.SAMPLE_TASKS
    got = toxicity.score(docs, field).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in want]
    assert np.allclose([r.score for r in got], [r.score for r in want], atol=1e-4)


def test_scratch_tables_have_no_marker_and_cost_one_job(spark):
    rows = spark.createDataFrame([(1, "a", [1.5]), (2, None, None)], "id long, t string, v array<double>")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("scratch-table", "scratch-table")
    try:
        out = tables.materialise(rows, "marker")
        empty = tables.materialise(rows.where("id > 9"), "marker-empty")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("scratch-table")) == 2
    folder = out.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert [f for f in os.listdir(folder) if "SUCCESS" in f] == []
    assert out.schema == rows.schema and empty.schema == rows.schema and empty.count() == 0
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, rows.collect()))
