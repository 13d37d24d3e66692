"""S6: JDBC source.

The reference reads its strike table from PostgreSQL with an ``IN (...)`` list of
every active employee built on the driver. Here the table is read as is and the
membership is a semi join, which Spark runs distributed; small filters on plain
columns are still pushed to the database by the JDBC source.

No database is started by this repository; these readers are used where a cluster
provides one. Without a database, the strike table lives in the Parquet snapshot
store (``sinks.snapshot``) and the same semi join applies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """A table or ``(SELECT ...) AS t`` sub-query; optionally read in parallel ranges."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def restrict_to(df: DataFrame, ids: DataFrame, key: str = "employee_id", ids_key: str = "emp_id") -> DataFrame:
    """The reference's ``WHERE key IN (<collected ids>)`` as a semi join."""
    return df.join(ids.select(F.col(ids_key).alias(key)).filter(F.col(key).isNotNull()), key, "left_semi")
