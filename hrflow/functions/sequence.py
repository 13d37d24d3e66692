"""``lead`` within a key that stays balanced when one key is huge.

A plain ``lead().over(Window.partitionBy(key))`` sends every row of a key to one task.
Here the first order column cuts each key into slices of one day, so a key holding a third of
all rows, be it within one month, is spread over as many tasks as it has days. ``lead`` runs
within (key, day); the last row of a day then finds its successor among the first and last
rows of the key's days. Both sides are bounded whatever the size of a key: two rows per day
(73 000 per century), and the rows of one day. A slice follows from the row alone, so there is one
path for every input and nothing to agree on between parts of the plan.

All order columns are ascending with NULLs first. Rows that tie in the whole order are
interchangeable. An order that starts with text is not cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

SLICE_DAYS = 1


def _slice(df: DataFrame, column: str, width: float | None):
    """Slice number of the column: days for dates, seconds for numbers and time stamps."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.DateType):
        return F.floor(F.unix_date(c) / F.lit(float(width or SLICE_DAYS)))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(F.unix_seconds(c.cast("timestamp")) / F.lit(float(width or SLICE_DAYS * 86400)))
    if isinstance(kind, T.NumericType):
        return F.floor(c / F.lit(float(width or SLICE_DAYS * 86400)))
    return F.lit(0).cast("long")


def next_in_key(df: DataFrame, key: str, order: list[str], value: str, out: str,
                width: float | None = None) -> DataFrame:
    """Add ``out`` = ``value`` of the next row of the same ``key`` in ``order``."""
    sort_cols = [F.col(c).asc_nulls_first() for c in [*order, *([value] if value not in order else [])]]
    within = Window.partitionBy(key, "__slice").orderBy(*sort_cols)
    follower = F.lead(F.struct(F.col(value).alias("v")))
    cut = (df.withColumn("__slice", _slice(df, order[0], width))
             .withColumns({"__next": follower.over(within), "__first": F.row_number().over(within) == 1}))
    inner = cut.filter("__next IS NOT NULL").withColumn(out, F.col("__next.v"))
    # of rows that tie, those with a successor in their slice come first
    across = Window.partitionBy(key).orderBy(*sort_cols, F.col("__next").isNull())
    ends = (cut.filter("__next IS NULL OR __first").withColumn("__after", follower.over(across))
               .filter("__next IS NULL").withColumn(out, F.col("__after.v")).drop("__after"))
    return inner.unionByName(ends).drop("__slice", "__next", "__first")
