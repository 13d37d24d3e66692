import re

import pytest

import corpus_pipeline as C
from hrflow.llm import toxicity
from hrflow.llm.pii import luhn_digit
from test_tokens_sets import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's output on the smoke tables, and the input."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, f in C.STAGES:
        out.append(C.materialise(f(spark, out[-1], SF), f"test-{name}"))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_all_but_the_last_keep_the_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:5])
    assert {"size", "source_size", "target", "taken"} <= set(stages[5].columns)


def test_run_equals_the_stages(spark, stages):
    cols = ["doc_id", "source", "size", "taken"]
    assert sorted(map(str, C.run(spark, SF).select(*cols).collect())) == sorted(map(str, stages[5].select(*cols).collect()))


def test_toxic_documents_go(spark, stages):
    field = toxicity.fit(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(stages[1]) == ids(toxicity.score(stages[0], field).where("score < 0.5"))


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert ids(stages[2]) == {component for _, component in brute(rows, 5, 80).values()}


def test_documents_with_benchmark_items_go(spark, stages):
    norm = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = [norm(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {r.doc_id for r in stages[2].collect() if any(f" {x} " in f" {norm(r.text)} " for x in items)}
    assert ids(stages[2]) - ids(stages[3]) == want and want


def test_personal_data_is_replaced(stages):
    old = {r.doc_id: r for r in stages[3].collect()}
    mail, card = re.compile(r"[\w.]+@[\w.]+\w"), re.compile(r"(?<![\w.-])\d{16}\b")
    changed = 0
    for r in stages[4].collect():
        cards = [v for v in card.findall(old[r.doc_id].text) if luhn_digit(v[:-1]) == v[-1]]
        for v in mail.findall(old[r.doc_id].text) + cards:
            assert v not in r.text
            changed += 1
        assert r.n_chars == len(r.text)
    assert changed


def test_empty_and_odd_documents(spark):
    odd = spark.createDataFrame([(1, None, "en", None, None), (2, "", "en", "s", 0), (None, "a b c d e f", None, "s", 11),
                                 (2, "", "en", "s", 0), (3, "x " * 40_000, "en", "s", 80_000)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (odd, odd.limit(0)):
        df = rows
        for _, f in C.STAGES:
            df = C.materialise(f(spark, df, SF), "odd")
        assert df.count() == (4 if rows is odd else 0)
