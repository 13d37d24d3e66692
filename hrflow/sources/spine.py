"""S10: day series between two dates, inclusive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import date_sequence


def date_spine(bounds: DataFrame, start: str = "start", end: str = "end", out: str = "date") -> DataFrame:
    """One row per day from ``start`` to ``end`` for every row of ``bounds``.

    Other columns of ``bounds`` are carried along, so a per-key range (say, per
    employee) expands in parallel on the executors.
    """
    keep = [c for c in bounds.columns if c not in (start, end)]
    return bounds.select(*keep, F.explode(date_sequence(start, end)).alias(out))
