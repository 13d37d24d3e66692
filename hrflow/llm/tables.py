"""Shared-folder tables and connected components for the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


#: Bytes of an Arrow batch: texts are long, and a Python worker holds a few copies of a batch.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_BYTES`` unless it has set a size itself."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":  # Spark's default
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def materialise(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    The copy cuts the lineage and survives lost executors; its schema is known, so no job reads it off
    the files. ``tasks``: most tasks that write it, for tables of bounded size. Without Hadoop's native
    library each file on a local folder costs its writer two child processes, so small tables are
    few files and the driver writes no ``_SUCCESS`` marker. Pages are closed by their bytes from the
    first row on: Parquet looks at a page's size after 100 rows only, and with packed arrays for rows its
    codec then keeps buffers of tens of MB outside the heap for the rest of the session.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_path(spark, name)
    out = df if tasks is None else df.coalesce(tasks)
    (out.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
     .option("parquet.page.size.row.check.min", "1").parquet(path))
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files behind a table made by ``materialise`` (they must not be read again)."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/hrflow-" in folder:
            p = jvm.org.apache.hadoop.fs.Path(folder)
            p.getFileSystem(conf).delete(p, True)


def with_columns_of(df: DataFrame, columns: Iterable[tuple[str, str]]) -> DataFrame:
    """``df`` narrowed to named, typed columns; a missing one becomes NULL of its type."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in columns])


def connected_components(edges: DataFrame, name: str = "cc", max_rounds: int = 64) -> DataFrame:
    """Smallest reachable id of every node: ``(id, component)`` from ``(a, b)`` edges.

    Alternating large-star and small-star passes (Kiveris et al., 2014): each pass hangs
    neighbours under the smallest one, so a chain of length n takes O(log n) rounds. Every
    round is a table in the shared folder; the driver only learns whether it is settled. Edges with a NULL end and loops are ignored; nodes without edges are absent.
    """
    u, v = F.greatest("a", "b"), F.least("a", "b")
    table = materialise(edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
                        .select(u.alias("u"), v.alias("v")).distinct(), name)
    for _ in range(max_rounds):
        # settled when no node hangs under another one and is hung under itself, or under two
        several = table.groupBy("u").agg(F.count("*").alias("c")).where("c > 1").select("u")
        hung = table.join(table.select(F.col("v").alias("w")).distinct(), F.col("u") == F.col("w"), "left_semi").select("u")
        if several.unionByName(hung).isEmpty():
            return table.select(F.col("u").alias("id"), F.col("v").alias("component"))
        both = table.unionByName(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        nxt = materialise(small, name)
        drop_table(table)
        table = nxt
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def numbered_rows(df: DataFrame, key: str, name: str) -> DataFrame | None:
    """``df`` with a number per row (``row``; NULL where ``key`` is) if some ``key`` occurs more than once,
    else None: operators on pairs then work on rows and ``ids_of_rows`` gathers them."""
    if df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty():
        return None
    return materialise(df.withColumn("row", F.when(F.col(key).isNotNull(), F.monotonically_increasing_id())), name)


def ids_of_rows(rows: DataFrame, labels: DataFrame, key: str, name: str) -> DataFrame:
    """``row, id, component_id_of`` of numbered ``rows``: the smallest ``key`` that a row reaches through
    rows of one label (``row, label``) and rows that share a key."""
    rows = rows.where("row is not null")
    first = rows.groupBy(key).agg(F.min("row").alias("first"))
    edges = (labels.where("row is not null").select(F.col("row").alias("a"), F.col("label").alias("b"))
             .unionByName(rows.join(first, key).select(F.col("row").alias("a"), F.col("first").alias("b"))))
    component = connected_components(edges, name)
    at = rows.join(component.withColumnRenamed("id", "row"), "row", "left").select(
        "row", F.col(key).alias("id"), F.coalesce("component", "row").alias("root"))
    least = at.groupBy("root").agg(F.min("id").alias("component_id_of"))
    return materialise(at.join(least, "root").select("row", "id", "component_id_of"), name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
