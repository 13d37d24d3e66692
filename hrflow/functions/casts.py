"""Lenient casts that keep the non-ANSI results of the reference under ANSI mode.

Spark 4 runs with ANSI on; a plain ``cast`` of ``'abc'`` raises. The reference ran
non-ANSI, where a text number such as ``'1.5'`` or ``'1700000000.0'`` cast to an
integral type by truncation and junk became NULL (SURVEY Q1, Q4).
"""

from pyspark.sql import Column, functions as F

SECONDS_PER_DAY = 86400


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c) -> Column:
    """'1.5' -> 1, '0.5' -> 0, 'abc' -> NULL (truncation toward zero)."""
    return _col(c).try_cast("double").try_cast("int")


def epoch_to_date(c) -> Column:
    """Epoch seconds -> calendar date in UTC, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(_col(c) / F.lit(SECONDS_PER_DAY)).cast("int"))
