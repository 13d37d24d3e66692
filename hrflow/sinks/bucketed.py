"""Bucketed Parquet folders through Spark's own bucketed tables.

Rows of a key lie in one of ``buckets`` files, so joins, aggregates and windows by the key need no
exchange over the table. The catalog entry lives in the session only: a writer drops it and keeps
the files, a reader declares the table over them again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _name() -> str:
    return f"hrflow_bucketed_{uuid.uuid4().hex}"


def write_bucketed(parts: list[DataFrame], path: str, key: str, buckets: int) -> None:
    """Write the rows of all ``parts`` (equal columns) to the new folder ``path``.

    A part that comes from a table bucketed the same way is written as it lies; one that does not is
    to be repartitioned by the caller, or its tasks write a file per bucket each.
    """
    name, spark = _name(), parts[0].sparkSession
    try:
        for i, part in enumerate(parts):
            w = part.write.format("parquet").bucketBy(buckets, key).mode("append" if i else "error")
            (w if i else w.option("path", path)).saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The folder as a table bucketed by ``key``; the count must be the one it was written with."""
    name = _name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{location}'")
    try:
        return spark.table(name).select(*schema.fieldNames())
    finally:
        spark.sql(f"DROP TABLE {name}")
