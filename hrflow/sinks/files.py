"""File sinks and the JSON-array writers used for round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], mode: str = "overwrite",
                      fmt: str = "parquet", **options) -> None:
    """K1/K2: partitioned write. ``overwrite`` replaces only the partitions present in
    ``df`` (dynamic), so other run dates / statuses / years survive and a re-run of the
    same run key is idempotent."""
    w = df.write.mode(mode).partitionBy(*partition_by).format(fmt)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")
    w.options(**options).save(path)


def append_run_partition(df: DataFrame, path: str, run_date: str, by_day: bool = True) -> None:
    """K1: stamp a run date as ``year/month/day`` (or ``year``) partition and write it
    rerun-safe."""
    y, m, d = run_date.split("-")
    out = df.withColumn("year", F.lit(int(y)))
    cols = ["year"]
    if by_day:
        out = out.withColumn("month", F.lit(int(m))).withColumn("day", F.lit(int(d)))
        cols = ["year", "month", "day"]
    write_partitioned(out, path, cols)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: unpartitioned Parquet."""
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: CSV with header."""
    df.write.mode(mode).option("header", True).csv(path)


def write_alert_texts(rendered: DataFrame, path: str, num_writers: int | None = None) -> None:
    """K6: one text document per (run_date, emp_id) folder, written by the executors
    (no driver loop). ``rendered`` has ``run_date``, ``emp_id`` and ``content``.

    There is one row per employee, so hashing on the folder keys spreads the documents
    evenly and each folder gets exactly one writer (one file). The partition count is
    explicit so that AQE does not fold a small alert set into one sequential writer.
    """
    n = num_writers or int(rendered.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    (rendered.select("run_date", "emp_id", "content").repartition(n, "run_date", "emp_id")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("run_date", "emp_id").text(path))


def write_json_arrays(df: DataFrame, path: str, value: str | None = None, max_items: int = 10_000) -> None:
    """Write files that each hold one JSON array of at most ``max_items`` items.

    ``value`` names a string column to write as an array of strings; without it each
    row becomes a JSON object. Rows are chunked by their position inside their input
    partition (the partition index and row index packed in ``monotonically_increasing_id``),
    so no array grows with the data and no shuffle key can be hot.
    """
    if value:
        # a JSON string literal: to_json of a one-element array without its brackets
        one = F.to_json(F.array(F.col(value)))
        item = F.expr("substring(__one, 2, length(__one) - 2)")
        df = df.withColumn("__one", one)
    else:
        item = F.to_json(F.struct(*df.columns))
    rid = F.monotonically_increasing_id()
    chunk = F.concat_ws("-", F.shiftright(rid, 33), F.floor((rid % F.lit(1 << 33)) / F.lit(max_items)))
    parts = (df.select(chunk.alias("part"), item.alias("j"))
               .groupBy("part")
               .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("j")), F.lit("]")).alias("value")))
    parts.write.mode("overwrite").partitionBy("part").text(path)


def partition_folders(spark, path: str, column: str) -> list[tuple[str, str]]:
    """(value, folder) of the partitions of ``column`` directly below ``path`` that have a value."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return [(v, f"{path}/{column}={v}") for v in sorted(values) if v != "__HIVE_DEFAULT_PARTITION__"]


def delete_folder(spark, path: str) -> None:
    """Delete a folder on whatever store it is in."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
