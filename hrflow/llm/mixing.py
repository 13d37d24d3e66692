"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Sizes are words (``[^\\x20\\x09-\\x0D]+``, which is what ``\\S+`` means here). Sources share ``share`` times all words by weight; no
source gets more than ``cap`` times its own size, and what a capped source leaves is shared
again by weight (closed form over one row per source). A source whose target holds e whole
epochs takes every document e times; the rest of the target goes to documents in the order of
their keys ``-ln(u) / quality``, u uniform and fixed by id and seed: weighted sampling without
replacement. The document that crosses the budget is taken in part, so the target is met exactly.

The order is never sorted as a whole: keys fall into ``BINS`` fixed bins, words are summed per
source and bin before the shuffle, prefix sums run over bins, and only the documents of the one
bin per source in which the budget ends are sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialise

WORD = r"\S+"
BINS = 4096
#: Weights of the sources in code point order, repeating.
SOURCE_WEIGHTS = (5, 2, 1)


def quality_weight(text):
    """Document quality weight: 1 less twice the share of digits and ASCII marks, 0.05 at least."""
    n = F.greatest(F.length(text), F.lit(1))
    marks = F.length(text) - F.length(F.regexp_replace(text, r"[\d\p{Punct}]+", ""))
    return F.coalesce(F.greatest(F.lit(0.05), 1 - 2 * marks / n), F.lit(0.05))


def sized(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """``docs`` with ``_size`` (words; NULL: 0), ``_key`` (sampling key) and ``_bin`` of it."""
    text = F.col("text").cast("string")
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    out = docs.withColumns({
        "_size": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"),
        "_key": F.round(-F.log(u) / quality_weight(text), 12)})
    return out.withColumn("_bin", F.least(F.lit(BINS - 1), F.floor(BINS * (1 - F.exp(-F.col("_key"))))).cast("int"))


def targets(sizes: DataFrame, share: float = 1.5, cap: int = 2, weights: tuple[int, ...] = SOURCE_WEIGHTS) -> DataFrame:
    """``source, source_size, target`` from one row per source (``source, source_size``).

    With sources sorted by cap / weight, the level is the largest of (total - caps before) /
    (weights from here on); a target is the smaller of its cap and weight * level.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") - 1) % len(weights) + 1)
    one = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))) \
        .withColumn("w", w.cast("long")).withColumn("cap", cap * F.col("source_size"))
    whole = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    level = ((share * F.sum("source_size").over(whole) - (F.sum("cap").over(by_cap) - F.col("cap")))
             / (F.sum("w").over(whole) - (F.sum("w").over(by_cap) - F.col("w"))))
    return (one.withColumn("level", level).withColumn("level", F.max("level").over(whole))
            .select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("w") * F.col("level")).alias("target")))


def mix(items: DataFrame, share: float = 1.5, cap: int = 2, weights: tuple[int, ...] = SOURCE_WEIGHTS) -> DataFrame:
    """Rows of ``sized(...)`` with ``size, source_size, target, epochs, taken`` added.

    ``taken`` counts the words that the mix takes of the document, repeats included. A NULL
    source is a source of its own, last in order. Repeated rows are documents of their own.
    Documents without words take 0; an empty table gives no rows. Columns of ``items`` with one of
    the added names are replaced. Rows are read twice (sums, then the result): pass a table.
    """
    bins = (items.groupBy("source", "_bin").agg(F.sum("_size").alias("words")))
    bins = materialise(bins, "mix-bins")  # BINS rows per source at most
    plan = targets(bins.groupBy("source").agg(F.sum("words").alias("source_size")), share, cap, weights)
    plan = (plan.withColumn("want", F.round("target").cast("long"))
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("want div source_size")).otherwise(0))
            .withColumn("rest", F.col("want") - F.col("epochs") * F.col("source_size")))
    order = Window.partitionBy("source").orderBy("_bin")
    before = bins.withColumn("before", F.sum("words").over(order) - F.col("words"))
    edge = (before.alias("b").join(plan.alias("p"), F.expr("b.source <=> p.source"))
            .where("b.before <= p.rest and p.rest < b.before + b.words")
            .groupBy("b.source").agg(F.min(F.struct("b._bin", "b.before")).alias("e")))
    plan = (plan.alias("p").join(edge.alias("e"), F.expr("p.source <=> e.source"), "left")
            .select(F.col("p.source").alias("_source"), "source_size", "target", "epochs", "rest",
                    F.coalesce("e.e._bin", F.lit(BINS)).alias("_edge"), F.coalesce("e.e.before", F.lit(0)).alias("_before")))
    plan = materialise(plan.coalesce(1), "mix-plan")  # one row per source: Spark broadcasts it if small
    own = items.drop("size", "source_size", "target", "epochs", "taken", "rest")
    rows = own.withColumnRenamed("_size", "size").join(plan, F.expr("source <=> _source"))
    # the bin in which the budget ends, sorted by key
    at_edge = rows.where("_bin = _edge")
    run = Window.partitionBy("_source").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    at_edge = at_edge.withColumn("_more", F.expr("rest - _before") - F.coalesce(F.sum("size").over(run), F.lit(0)))
    others = rows.where("_bin != _edge").withColumn("_more", F.expr("if(_bin < _edge, size, 0L)"))
    more = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("_more")))
    return (at_edge.unionByName(others)
            .withColumn("taken", F.when(F.col("rest") > 0, more).otherwise(0) + F.col("epochs") * F.col("size"))
            .drop("_source", "_key", "_bin", "_edge", "_before", "_more", "rest"))


def mixed(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """``doc_id, source, size, source_size, target, epochs, taken`` of every document."""
    narrow = docs.select("doc_id", F.col("source").cast("string").alias("source"), "text")
    return mix(materialise(sized(narrow, seed).drop("text"), "mix-items"))
