"""Adapters: the reference's logical inputs as views over the driver's test tables.

Each adapter is a DataFrame derived from ``{sf_dir}/<table>.parquet`` so that a query
and its DuckDB oracle see the same rows (FIXTURES.md §2). Only the columns used are
read; Spark prunes the rest at the Parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import word_tokens
from ..operators.strikes import apply_penalties

SECONDS_90_DAYS = 7776000


_TABLES: dict[str, tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's test table. The test tables are read-only, so the DataFrame (its file
    listing and footer schema) is kept per path for the session that read it."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hit = _TABLES.get(path)
    if hit is None or hit[0] is not spark:
        hit = _TABLES[path] = (spark, spark.read.parquet(path))
    return hit[1]


def x_employee(spark, sf_dir) -> DataFrame:
    """Customers as employees with NULL, junk, fractional and negative ages; every tenth
    customer twice."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    age = (F.when(k % 50 == 0, F.lit(None).cast("string"))
            .when(k % 77 == 0, F.lit("abc"))
            .when(k % 31 == 0, F.lit("0.5"))
            .when(k % 29 == 0, F.lit("-3"))
            .otherwise((F.lit(18) + k % 45).cast("string")))
    rows = c.unionAll(c.filter(k % 10 == 0))
    return rows.select(k.cast("string").alias("emp_id"), F.col("c_name").alias("name"), age.alias("age"))


def x_timeframe(spark, sf_dir) -> DataFrame:
    """Orders as job intervals: start = order date, 90-day end for finished orders."""
    o = table(spark, sf_dir, "orders")
    start = F.unix_timestamp("o_orderdate")
    return o.select(
        F.col("o_custkey").cast("string").alias("emp_id"),
        F.col("o_orderpriority").alias("designation"),
        start.alias("start_date"),
        F.when(F.col("o_orderstatus") == "F", start + SECONDS_90_DAYS).alias("end_date"),
        F.col("o_totalprice").alias("salary"))


def x_leave(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("emp_id"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("event_id") * 7919 % 366).cast("int")).alias("date"),
        F.when(F.col("event_type") == "signup", F.lit("CANCELLED"))
         .when(F.col("event_type") == "error", F.lit("PENDING"))
         .otherwise(F.lit("ACTIVE")).alias("status"))


# The holiday calendar of FIXTURES.md, with a header-like row and a duplicate.
CALENDAR_VALUES = """
  ('reason', CAST(NULL AS DATE)),
  ('New Year', DATE'2024-01-01'),
  ('Mid January', DATE'2024-01-15'),
  ('Summer', DATE'2024-07-04'),
  ('Winter', DATE'2024-12-25'),
  ('Winter', DATE'2024-12-25')"""


def x_calendar(spark, sf_dir=None) -> DataFrame:
    """The holiday list (6 rows, independent of scale). Used only together with leave data.
    A VALUES list is a local relation: planning sees its size, no job reads it."""
    return spark.sql(f"SELECT * FROM VALUES {CALENDAR_VALUES} AS v(reason, date)")


def x_calendar_feed(spark, sf_dir) -> DataFrame:
    """A raw calendar feed whose size grows with the data: the holiday list plus one
    (event type, day) entry per event, full of duplicates, dates as timestamps."""
    e = table(spark, sf_dir, "events")
    feed = e.select(F.col("event_type").alias("reason"),
                    F.to_date("ts").cast("timestamp_ntz").alias("date"))
    hol = x_calendar(spark).select("reason", F.col("date").cast("timestamp_ntz").alias("date"))
    return hol.unionByName(feed)


def x_quota(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("emp_id"),
                    (F.lit(20) + F.col("user_id") % 20).cast("int").alias("leave_quota"),
                    F.lit(2024).alias("year")).distinct()


def x_message(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").cast("string").alias("sender"),
                    (F.col("conv_id") + 1).cast("string").alias("receiver"),
                    F.col("text").alias("message"))


# The marked words of FIXTURES.md.
MARKED_WORDS = ["THAT", "FOR", "IS", "ERED"]


def x_marked(spark, sf_dir=None) -> DataFrame:
    values = ", ".join(f"('{w}')" for w in MARKED_WORDS)
    return spark.sql(f"SELECT * FROM VALUES {values} AS v(word)")


def x_vocab(spark, sf_dir, min_messages: int = 2) -> DataFrame:
    """Vocabulary derived from the messages: words used in at least ``min_messages``
    distinct messages (document frequency, computed with partial aggregation)."""
    # equal messages count once, so the messages are made distinct first
    msgs = x_message(spark, sf_dir).distinct()
    words = msgs.select(F.explode(F.array_distinct(word_tokens("message"))).alias("word"))
    df = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return df.filter(F.col("n") >= min_messages).select("word")


def x_strikes_base(spark, sf_dir, whole: bool = False) -> DataFrame:
    """Stored strike rows: unchanged, changed and NULL salaries. Every third customer has no row
    yet, which upsert and sync need; ``whole`` gives all of them one."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    # latest order per customer, highest price among same-day orders
    latest = o.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_totalprice")).alias("m")) \
              .select("o_custkey", F.col("m.o_totalprice").alias("price"))
    k = F.col("c_custkey")
    j = (c if whole else c.filter(k % 3 != 0)).join(latest, k == F.col("o_custkey"), "left")
    salary = (F.when(k % 10 == 0, F.lit(None).cast("double"))
               .when(k % 7 == 0, F.coalesce(F.col("price"), F.lit(1.0)))
               .otherwise((F.lit(1000) + k).cast("double")))
    return j.select(k.cast("string").alias("employee_id"), salary.alias("salary"),
                    (k % 13).cast("int").alias("no_of_strikes"), (k % 13 >= 10).alias("is_inactive"))


def x_strikes(spark, sf_dir, whole: bool = False) -> DataFrame:
    """Stored strike table with its ladder derived by the penalties operator."""
    return apply_penalties(x_strikes_base(spark, sf_dir, whole))


def x_flag_log(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("employee_id"), F.col("ts").alias("start_date"))
