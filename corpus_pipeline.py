"""Corpus pipeline: documents without toxic, duplicate and benchmark texts, pseudonymised and mixed.

``STAGES`` are applied in order; every stage gets all rows that its predecessor kept, as a
table in the shared folder. ``run`` does all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hrflow.llm.decontam import without_benchmark
from hrflow.llm.mixing import mix, sized
from hrflow.llm.pii import pseudonymise
from hrflow.llm.queries import DEMO_KEY
from hrflow.llm.set_join import jaccard_classes
from hrflow.llm.tables import materialise, read_table
from hrflow.llm.toxicity import fit, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the toxicity model rejects."""
    return without_toxic(docs, fit(docs, read_table(spark, sf_dir, "labels")))


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document (the smallest id) of each group linked at 5-word shingle similarity 0.8, with
    all its different texts (one row of each), and rows without an id."""
    found = jaccard_classes(docs, k=5, percent=80)
    again = found.where("doc_id != component_id").select("doc_id")
    again = materialise(again.distinct(), "again")
    kept = docs.join(again, "doc_id", "left_anti").select(*docs.columns)
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    return kept.where("doc_id is null").unionByName(kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a passage of the benchmark."""
    return without_benchmark(docs, read_table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms under the key in ``spark.hrflow.pii.key`` (a demonstration key
    where it is unset); ``n_chars`` follows the new text where it is known."""
    key = spark.conf.get("spark.hrflow.pii.key", None)
    out = pseudonymise(docs, key.encode() if key else DEMO_KEY, out_col="_pii").drop("_pii")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their target weights: the documents with ``size, source_size, target,
    epochs, taken`` (words that the mix takes of each)."""
    return mix(materialise(sized(docs), "sized"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("jaccard_dedup", jaccard_dedup), ("decontamination", decontamination), ("pii", pii),
    ("mixing", mixing)]

#: Stages with trained models and tree searches have no SQL; tests compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents`` of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
