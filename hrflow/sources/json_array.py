"""Items of JSON arrays, with files cut into byte ranges.

Spark's JSON readers give one task to a file that is one array. Here a file is read as text cut
at commas, so its byte ranges are read by different tasks, and window functions find which commas
separate items. Every piece tells how it changes quotes and bracket depth, for a start inside and
one outside a string; sums within a range and then over the ranges of a file (a row each) give the
state before every piece. A piece that starts outside strings at depth 1 starts an item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

ARRAY = "["


def _depth(text):
    """Opening less closing brackets outside strings, for a text that starts outside."""
    outside = F.regexp_replace(text, r'"[^"]*("|\z)', "")
    return F.regexp_count(outside, F.lit(r"[\[{]")) - F.regexp_count(outside, F.lit(r"[\]}]"))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, n, piece`` with the change of quotes and depth before (``flip, rel0, rel1``)
    and in the piece (``odd, gain0, gain1``; 0: the range starts outside a string, 1: inside)."""
    read = (spark.read.option("lineSep", ",").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece")))
    within = Window.partitionBy("file", "block").orderBy("at")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    bare = F.regexp_replace("piece", r"(?s)\\.", "")  # an escape never holds a comma
    out = (read.withColumn("odd", F.regexp_count(bare, F.lit('"')) % 2)
           .withColumns({"from_out": _depth(bare), "from_in": _depth(F.regexp_replace(bare, r'^[^"]*("|\z)', ""))})
           .withColumns({"n": F.row_number().over(within), "flip": F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2})
           .withColumns({"gain0": F.when(F.col("flip") == 0, F.col("from_out")).otherwise(F.col("from_in")),
                         "gain1": F.when(F.col("flip") == 0, F.col("from_in")).otherwise(F.col("from_out"))}))
    return out.withColumns({f"rel{h}": F.coalesce(F.sum(f"gain{h}").over(before), F.lit(0)) for h in (0, 1)})


def read_array_items(spark: SparkSession, path: str) -> DataFrame:
    """``file, item``: the JSON text of every item of the array that a file holds.

    A file that holds a single value instead gives that value. Empty files and arrays give no
    rows; partition folders of the path are not part of the result.
    """
    pieces = _pieces(spark, path)
    first = F.regexp_extract("piece", r"^\s*(\S?)", 1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (pieces.groupBy("file", "block")
              .agg(F.sum("odd").alias("odd"), F.sum("gain0").alias("g0"), F.sum("gain1").alias("g1"), F.min_by(first, "n").alias("root"))
              .withColumns({"inside": F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2,
                            "root": F.first("root").over(Window.partitionBy("file").orderBy("block"))})
              .withColumn("level", F.coalesce(F.sum(F.when(F.col("inside") == 0, F.col("g0")).otherwise(F.col("g1"))).over(earlier), F.lit(0)))
              .select("file", "block", "inside", "root", "level"))
    by = lambda kind: F.when(F.col("inside") == 0, F.col(f"{kind}0")).otherwise(F.col(f"{kind}1"))
    placed = pieces.join(blocks, ["file", "block"]).withColumns(
        {"depth": F.col("level") + by("rel"), "outside": (F.col("inside") + F.col("flip")) % 2 == 0})
    starts = F.col("outside") & ((F.col("depth") == 0) | ((F.col("depth") == 1) & (F.col("root") == ARRAY)))
    closes = (F.col("depth") + by("gain") == 0) & ((F.col("inside") + F.col("flip") + F.col("odd")) % 2 == 0)
    upto = Window.partitionBy("file", "block").orderBy("n")
    placed = (placed.withColumn("start", F.when(starts, F.struct("block", "n")))
              .withColumn("own", F.last("start", ignorenulls=True).over(upto))
              .select("file", "block", "n", "piece", "root", "own", (starts & (F.col("depth") == 0)).alias("opens"), closes.alias("closes")))
    carried = (placed.groupBy("file", "block").agg(F.max("own").alias("last"))
               .select("file", "block", F.last("last", ignorenulls=True).over(earlier).alias("carried")))
    items = (placed.join(carried, ["file", "block"]).withColumn("id", F.coalesce("own", "carried"))
             .groupBy("file", "id", "root")
             .agg(F.array_sort(F.collect_list(F.struct("block", "n", "piece"))).alias("p"),
                  F.max("opens").alias("opens"), F.max("closes").alias("closes")))
    text = F.array_join("p.piece", ",")
    text = F.when(F.col("opens") & (F.col("root") == ARRAY), F.regexp_replace(text, r"^\s*\[", "")).otherwise(text)
    text = F.when(F.col("closes") & (F.col("root") == ARRAY), F.regexp_replace(text, r"\]\s*\z", "")).otherwise(text)
    return items.select("file", F.regexp_replace(text, r"^\s+|\s+\z", "").alias("item")).where("item != ''")
