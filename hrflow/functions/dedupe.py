"""Deterministic one-row-per-key selection as an aggregate.

``row_number() = 1`` over a window puts every row of a key into one task. As a
``max``/``min`` over a struct the choice is a partial aggregate: each map task keeps
one candidate per key before the shuffle, so a key holding a third of all rows
costs one row per map task in the exchange. Struct order compares field by field
with NULL lowest, which gives the tie-breaks (SURVEY Q2) for free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .money import q


def _pick(df: DataFrame, keys, order_cols, fn: str, nulls_last: bool) -> DataFrame:
    keys = list(keys)
    order_cols = list(order_cols)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    fields = []
    for c in order_cols:
        if nulls_last:
            # a NULL must lose to every value: lead with an is-not-null flag
            fields.append(f"{q(c)} IS NOT NULL AS {q('__nn_' + c)}")
        fields.append(f"{q(c)} AS {q(c)}")
    fields += [f"{q(c)} AS {q(c)}" for c in rest]
    # built as SQL text: one call into the JVM instead of one per column
    picked = df.groupBy(*keys).agg(F.expr(f"{fn}(struct({', '.join(fields)}))").alias("__pick"))
    return picked.selectExpr(*[q(c) if c in keys else f"__pick.{q(c)} AS {q(c)}" for c in df.columns])


def keep_max(df: DataFrame, keys, order_cols=()) -> DataFrame:
    """Per key, the row that is largest by ``order_cols`` (NULLs last), then by the other columns."""
    return _pick(df, keys, order_cols, "max", nulls_last=True)


def keep_min(df: DataFrame, keys, order_cols=()) -> DataFrame:
    """Per key, the row that is smallest by ``order_cols`` then by the other columns (NULLs first)."""
    return _pick(df, keys, order_cols, "min", nulls_last=False)
