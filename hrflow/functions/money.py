"""Salary penalty ladder: every strike cuts 10 %, compounding (strike_i = salary * 0.9^i).

Rounding is done in decimal so that it is exact and engine-independent (SURVEY Q22):
``round(CAST(salary AS DECIMAL(24,8)) * CAST(0.9^i AS DECIMAL(11,10)), 2)`` as double, so
it happens once, after the product. The ten factors 0.9 .. 0.3486784401 have at most ten decimals, so DECIMAL(11,10) holds
them exactly.

The ladder is written as SQL text: ten columns of nested expressions built call by call
cost a few hundred round trips to the JVM; as ``selectExpr`` text they cost one.
"""

from decimal import Decimal

from ..schemas import LADDER_STEPS

# 10 % cut per strike, ten steps.
PENALTY_RATE = Decimal("0.9")


def q(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def ladder_factor_sql(i: int) -> str:
    return f"CAST('{PENALTY_RATE ** i}' AS DECIMAL(11,10))"


def ladder_value_sql(salary: str, i: int) -> str:
    """salary * 0.9^i rounded to cents, as double (no count condition)."""
    return f"CAST(round(CAST({q(salary)} AS DECIMAL(24,8)) * {ladder_factor_sql(i)}, 2) AS DOUBLE)"


def ladder_step_sql(salary: str, count: str, i: int) -> str:
    """strike_i: the salary after i cuts, if at least i strikes and the salary is known."""
    return (f"CASE WHEN {q(count)} >= {i} AND {q(salary)} IS NOT NULL "
            f"THEN {ladder_value_sql(salary, i)} ELSE CAST(NULL AS DOUBLE) END")


def ladder_exprs(salary: str = "salary", count: str = "no_of_strikes") -> list[str]:
    """The ten ladder columns as ``selectExpr`` text."""
    return [f"{ladder_step_sql(salary, count, i)} AS strike_{i}" for i in range(1, LADDER_STEPS + 1)]

