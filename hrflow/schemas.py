"""Declared schemas of the logical tables."""

from pyspark.sql import types as T

S = T.StringType()

EMPLOYEE = T.StructType([T.StructField("emp_id", S), T.StructField("name", S), T.StructField("age", S)])

TIMEFRAME_RAW = T.StructType([
    T.StructField("emp_id", S), T.StructField("designation", S),
    T.StructField("start_date", T.LongType()), T.StructField("end_date", T.LongType()),
    T.StructField("salary", T.DoubleType()),
])

TIMEFRAME_GOLD = T.StructType([
    T.StructField("emp_id", S), T.StructField("designation", S),
    T.StructField("start_date", T.DateType()), T.StructField("end_date", T.DateType()),
    T.StructField("salary", T.DoubleType()), T.StructField("status", S),
])

# The stored history keeps the seconds each record came with beside the derived dates.
TIMEFRAME_STORED = T.StructType(TIMEFRAME_GOLD.fields + [
    T.StructField("given_start", T.LongType()), T.StructField("given_end", T.LongType())])

LEAVE = T.StructType([T.StructField("emp_id", S), T.StructField("date", T.DateType()),
                      T.StructField("status", S)])

LEAVE_GOLD = T.StructType(LEAVE.fields + [
    T.StructField("ingest_date", T.DateType()), T.StructField("ingest_timestamp", T.TimestampNTZType()),
    T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
])

CALENDAR = T.StructType([T.StructField("reason", S), T.StructField("date", T.TimestampNTZType())])

# emp_id is a string everywhere, unlike the reference's int quota schema.
QUOTA = T.StructType([T.StructField("emp_id", S), T.StructField("leave_quota", T.IntegerType()),
                      T.StructField("year", T.IntegerType())])

MESSAGE = T.StructType([T.StructField("sender", S), T.StructField("receiver", S),
                        T.StructField("message", S)])

WORD = T.StructType([T.StructField("word", S)])

LADDER_STEPS = 10
LADDER_COLUMNS = [f"strike_{i}" for i in range(1, LADDER_STEPS + 1)]

STRIKES = T.StructType(
    [T.StructField("employee_id", S), T.StructField("salary", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in LADDER_COLUMNS]
    + [T.StructField("no_of_strikes", T.IntegerType()), T.StructField("is_inactive", T.BooleanType())]
)

FLAG_LOG = T.StructType([T.StructField("employee_id", S), T.StructField("start_date", T.TimestampNTZType()),
                         T.StructField("role", S)])

TRACKING = T.StructType([T.StructField("emp_id", S)])
