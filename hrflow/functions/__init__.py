"""Reusable Column expressions. All are built-in Spark SQL functions (codegen, no UDF)."""

from .casts import lenient_int, epoch_to_date
from .calendar import is_weekend, date_sequence
from .text import WORD_PATTERN, word_tokens
from .money import ladder_exprs, ladder_step_sql, ladder_value_sql, q
from .dedupe import keep_max, keep_min
from .sequence import next_in_key

__all__ = [
    "lenient_int", "epoch_to_date",
    "is_weekend", "date_sequence", "WORD_PATTERN", "word_tokens",
    "ladder_exprs", "ladder_step_sql", "ladder_value_sql", "q", "keep_max", "keep_min", "next_in_key",
]
