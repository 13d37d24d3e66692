"""Calendar expressions."""

from pyspark.sql import Column, functions as F

# Spark's dayofweek numbers Sunday as 1 and Saturday as 7.
WEEKEND_DAYS = (1, 7)


def is_weekend(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.dayofweek(c).isin(*WEEKEND_DAYS)


def date_sequence(start, end) -> Column:
    """Inclusive array of days between two date columns (empty when start > end)."""
    s = F.to_date(F.col(start) if isinstance(start, str) else start)
    e = F.to_date(F.col(end) if isinstance(end, str) else end)
    return F.when(s <= e, F.sequence(s, e)).otherwise(F.array().cast("array<date>"))
