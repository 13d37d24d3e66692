"""K8: process only new files, then archive them.

The reference lists an inbox, remembers ``inputFiles()`` and copies + deletes each file
after the write. The file-source stream does the same bookkeeping in its checkpoint:
each file is read once, and ``cleanSource=archive`` moves it out of the inbox after
the batch commits. ``availableNow`` processes what is there and stops, which is what a
daily job wants; nothing new means an empty run.

A batch lands in a folder of its own, named by the streaming query and the batch number, so
a replay replaces it and a reader can tell which batches it has taken over already.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns ``checkpoint`` (a new one after a reset); "manual"
    where no query has run."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return "manual"
    stream = fs.open(p)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def ingest_new_files(spark: SparkSession, inbox: str, schema: T.StructType, out: str, checkpoint: str,
                     archive: str | None = None, fmt: str = "csv", header: bool = True,
                     run_key: str | None = None):
    """Land every file of ``inbox`` not seen before below ``out`` (Parquet).

    Batches land in ``[ingest_run=<run_key>/]ingest_query=<id>/ingest_batch=<n>``.
    """
    from ..sources.files import exists
    if not exists(spark, inbox):
        return None  # nothing was ever delivered: nothing to do
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", header)
    if archive is not None:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    top = out if run_key is None else f"{out}/ingest_run={run_key}"

    def land(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{top}/ingest_query={query_id(spark, checkpoint)}/ingest_batch={n}")

    q = (r.load(inbox).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def numbered_folders(spark: SparkSession, pattern: str) -> list[tuple[str, int, str]]:
    """(query id, number, path) of the complete batch folders that match ``pattern``, whose last two
    levels are ``<name>=<query>/<name>=<number>``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for st in fs.globStatus(p) or []:
        path = st.getPath()
        if fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            out.append((path.getParent().getName().split("=", 1)[1], int(path.getName().split("=", 1)[1]), path.toString()))
    return sorted(out)


def landed_batches(spark: SparkSession, out: str) -> list[tuple[str, int, str]]:
    """Complete batches below ``out`` (runs included)."""
    return numbered_folders(spark, f"{out}/ingest_run=*/ingest_query=*/ingest_batch=*")


def read_landed(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths).select(*[F.col(c) for c in schema.fieldNames()])
