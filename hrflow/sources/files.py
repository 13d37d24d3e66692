"""File readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from .json_array import read_array_items


# S1 -------------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """Header CSV. Without a schema every column is a string (no inference pass); with
    one, fields that do not parse become NULL (PERMISSIVE)."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


# S3 -------------------------------------------------------------------------------
def read_csv_headerless(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Positional CSV. A header line, if present, becomes a data row whose typed fields
    are NULL (SURVEY Q12)."""
    return spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE").csv(path)


# S4 / S5 --------------------------------------------------------------------------
def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet folder with partition discovery."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_partition(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """One partition of a partitioned folder, as a filter on the partition column.

    Spark prunes the other folders at planning time (``PartitionFilters``), and a
    value that was never written gives an empty frame instead of PATH_NOT_FOUND.
    """
    return spark.read.parquet(path).filter(F.col(column) == F.lit(value))


# S7 -------------------------------------------------------------------------------
def read_json_string_array(spark: SparkSession, path: str, column: str = "word") -> DataFrame:
    """Files that each hold one JSON array of strings (a word list or vocabulary).

    Files are read in byte ranges, so one huge array is read by several tasks; NULL items stay.
    """
    one = F.from_json(F.concat(F.lit("["), "item", F.lit("]")), "array<string>")
    return read_array_items(spark, path).select(F.get(one, F.lit(0)).alias(column))


# S8 -------------------------------------------------------------------------------
def read_json_objects(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that each hold one JSON array of objects (or one object), read in byte ranges.

    Fields that are absent or do not parse are NULL, as are all fields of an item that is no
    object. Partition folders of the path are not part of the result.
    """
    return read_array_items(spark, path).select(F.from_json("item", schema).alias("r")).select("r.*")


# S9 -------------------------------------------------------------------------------
def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  **options) -> DataFrame:
    """Optional input: the table at ``path`` or, if the path does not exist, an empty table.

    Only a missing path is caught; any other error (bad schema, no access) is raised,
    unlike the reference's bare ``except``.
    """
    if not any(ch in path for ch in "*?[{") and not exists(spark, path):
        return spark.createDataFrame([], schema)
    try:
        df = spark.read.format(fmt).options(**options).schema(schema).load(path)
        df.schema  # resolve now so that a missing path fails here
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or "") or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists on its file system (local, HDFS or object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
