"""Strike table: upsert, penalties, deactivation, salary sync, cool-down, retention
(SURVEY J30-J39).

The strike table is keyed by ``employee_id`` with columns ``salary``,
``strike_1..strike_10``, ``no_of_strikes`` and ``is_inactive``. Every operator returns
the next version of the table (or of the log) as a DataFrame; nothing is updated in
place.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import keep_max, ladder_exprs, ladder_step_sql, q
from ..schemas import LADDER_COLUMNS

# Fixed value: ten strikes make an employee inactive.
INACTIVE_AT = 10
RETENTION_DAYS = 30

TABLE_COLUMNS = ["employee_id", "salary", *LADDER_COLUMNS, "no_of_strikes", "is_inactive"]
STAGING_COLUMNS = ["employee_id", "salary", *LADDER_COLUMNS, "no_of_strikes"]


NULL_LADDER = [f"CAST(NULL AS DOUBLE) AS {c}" for c in LADDER_COLUMNS]


def current_salaries(timeframe: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Salary of each ACTIVE employee; with several open intervals the latest start wins
    (SURVEY Q31). A partial aggregate, so a hot employee costs one row per map task.
    ``only`` (a frame with ``employee_id``) limits the work to those employees."""
    active = timeframe.filter(F.col("status") == "ACTIVE").select("emp_id", "start_date", "salary")
    if only is not None:
        active = active.join(only.select(F.col("employee_id").alias("emp_id")).distinct(), "emp_id", "left_semi")
    latest = keep_max(active, ["emp_id"], ["start_date", "salary"])
    return latest.select(F.col("emp_id").alias("employee_id"), "salary")


def with_salaries(counts: DataFrame, timeframe: DataFrame) -> DataFrame:
    """``counts`` with each employee's current salary as ``new_salary``: one join with the history and one
    aggregate, in which the batch appears once. The salary is that of ``current_salaries``."""
    active = timeframe.filter(F.col("status") == "ACTIVE").select(F.col("emp_id").alias("employee_id"), "start_date", "salary")
    latest = F.max(F.struct("start_date", "salary")).alias("__latest")
    return (counts.join(active, "employee_id", "left").groupBy("employee_id", "strike_count").agg(latest)
            .select("employee_id", "strike_count", F.col("__latest.salary").alias("new_salary")))


# J31 ------------------------------------------------------------------------------
def apply_penalties(df: DataFrame, count: str = "no_of_strikes") -> DataFrame:
    """strike_i = round(salary * 0.9^i, 2) where the count reaches i, else NULL."""
    keep = [c for c in df.columns if c not in LADDER_COLUMNS]
    ladder = dict(zip(LADDER_COLUMNS, ladder_exprs("salary", count)))
    names = [c for c in TABLE_COLUMNS if c in keep or c in ladder] + [c for c in keep if c not in TABLE_COLUMNS]
    return df.selectExpr(*[ladder.get(c, q(c)) for c in names])


# J30 + J31 + J32 ------------------------------------------------------------------
def upsert_strikes(stored: DataFrame, counts: DataFrame, salaries: DataFrame | None = None) -> DataFrame:
    """Add each employee's new strikes to the stored count, insert unknown employees.

    The stored salary is kept and filled only when it is NULL, from ``salaries`` or from a column
    ``new_salary`` of ``counts`` (``with_salaries``). Adds an ``__affected`` flag for the employees of this batch.
    """
    if salaries is not None:
        counts = counts.join(salaries.select("employee_id", F.col("salary").alias("new_salary")), "employee_id", "left")
    elif "new_salary" not in counts.columns:
        counts = counts.withColumn("new_salary", F.lit(None).cast("double"))
    inc = counts.select("employee_id", F.col("strike_count").alias("__inc"), F.col("new_salary").alias("__new_salary"))
    s = stored.alias("s")
    j = s.join(inc.alias("i"), F.col("s.employee_id") == F.col("i.employee_id"), "full_outer")
    return j.selectExpr(
        "coalesce(s.employee_id, i.employee_id) AS employee_id",
        "coalesce(s.salary, i.__new_salary) AS salary",
        *[f"s.{c} AS {c}" for c in LADDER_COLUMNS],
        "CAST(coalesce(CAST(s.no_of_strikes AS BIGINT), 0) + coalesce(i.__inc, 0) AS INT) AS no_of_strikes",
        "coalesce(s.is_inactive, false) AS is_inactive",
        "i.employee_id IS NOT NULL AS __affected")


def penalize_and_deactivate(upserted: DataFrame) -> DataFrame:
    """For the affected employees: recompute the ladder and set ``is_inactive`` at 10+
    strikes (sticky, SURVEY J32). Other rows stay as stored."""
    cols = ["employee_id", "salary"]
    cols += [f"CASE WHEN __affected THEN {ladder_step_sql('salary', 'no_of_strikes', i)} ELSE {c} END AS {c}"
             for i, c in enumerate(LADDER_COLUMNS, start=1)]
    cols += ["no_of_strikes",
             f"CASE WHEN __affected THEN is_inactive OR no_of_strikes >= {INACTIVE_AT} ELSE is_inactive END"
             " AS is_inactive"]
    return upserted.selectExpr(*cols)


def apply_strike_batch(stored: DataFrame, events: DataFrame, salaries: DataFrame | None = None,
                       timeframe: DataFrame | None = None) -> DataFrame:
    """One batch of strike events applied to the table: J29 -> J30 -> J31 -> J32; salaries as a table or
    from the job history."""
    from .messages import strike_counts
    counts = strike_counts(events)
    if timeframe is not None:
        counts = with_salaries(counts, timeframe)
    return penalize_and_deactivate(upsert_strikes(stored, counts, salaries))


# J33 / J34 ------------------------------------------------------------------------
def _join_totals(stored: DataFrame, totals: DataFrame) -> DataFrame:
    t = totals.select(F.col("employee_id").alias("__id"), F.col("strike_count"))
    return stored.join(t, F.col("employee_id") == F.col("__id"), "inner").drop("__id")


def penalties_frozen(stored: DataFrame, totals: DataFrame) -> DataFrame:
    """Variant: steps already earned keep their stored value, new steps use the current
    salary, steps above the new total become NULL; the count becomes the new total."""
    j = _join_totals(stored, totals)
    cols = ["employee_id", "salary"]
    for i, c in enumerate(LADDER_COLUMNS, start=1):
        cols.append(f"CASE WHEN strike_count >= {i} AND no_of_strikes < {i} "
                    f"THEN {ladder_step_sql('salary', 'strike_count', i)} "
                    f"WHEN strike_count < {i} THEN CAST(NULL AS DOUBLE) ELSE {c} END AS {c}")
    cols.append("CAST(coalesce(strike_count, 0) AS INT) AS no_of_strikes")
    return j.selectExpr(*cols)


def penalties_replace(stored: DataFrame, totals: DataFrame) -> DataFrame:
    """Variant: the ladder is recomputed from the new total, which replaces the count."""
    j = _join_totals(stored, totals)
    return j.selectExpr("employee_id", "salary", *ladder_exprs("salary", "strike_count"),
                        "CAST(coalesce(strike_count, 0) AS INT) AS no_of_strikes")


# J35 - J37 ------------------------------------------------------------------------
def sync_new(salaries: DataFrame, stored: DataFrame) -> DataFrame:
    """Active employees without a strike row: count 0, empty ladder."""
    return (salaries.join(stored.select("employee_id"), "employee_id", "left_anti")
                    .selectExpr("employee_id", "salary", *NULL_LADDER, "CAST(0 AS INT) AS no_of_strikes"))


def sync_changed(salaries: DataFrame, stored: DataFrame, repair_null_salary: bool = False) -> DataFrame:
    """Active employees whose salary differs from the stored one: new salary, ladder
    recomputed on the stored count. ``!=`` is NULL-unsafe like the reference, so a stored
    NULL salary is not repaired unless ``repair_null_salary`` (SURVEY Q20)."""
    a = salaries.alias("a")
    s = stored.alias("s")
    differs = (~F.col("a.salary").eqNullSafe(F.col("s.salary")) if repair_null_salary
               else F.col("a.salary") != F.col("s.salary"))
    j = a.join(s, (F.col("a.employee_id") == F.col("s.employee_id")) & differs, "inner")
    base = j.select(F.col("a.employee_id").alias("employee_id"), F.col("a.salary").alias("salary"),
                    F.col("s.no_of_strikes").alias("no_of_strikes"))
    return base.selectExpr("employee_id", "salary", *ladder_exprs("salary", "no_of_strikes"), "no_of_strikes")


def sync_strikes(stored: DataFrame, salaries: DataFrame, repair_null_salary: bool = False) -> DataFrame:
    """New and changed active employees merged into the strike table, in one full join.

    A new employee gets count 0 and an empty ladder; a changed salary (``sync_changed``) gives
    the ladder on the stored count; other rows stay. ``is_inactive`` is untouched, FALSE for new
    rows; NULL counts become 0.
    """
    a, s = salaries.select("employee_id", F.col("salary").alias("__salary")).alias("a"), stored.alias("s")
    differs = "NOT (__salary <=> s.salary)" if repair_null_salary else "__salary != s.salary"
    joined = s.join(a, F.col("s.employee_id") == F.col("a.employee_id"), "full_outer").withColumns({
        "__new": F.col("s.employee_id").isNull(),
        "__changed": F.expr(f"a.employee_id IS NOT NULL AND s.employee_id IS NOT NULL AND coalesce({differs}, false)")})
    return joined.selectExpr(
        "CASE WHEN __new THEN a.employee_id ELSE s.employee_id END AS employee_id",
        "CASE WHEN __new OR __changed THEN __salary ELSE s.salary END AS salary",
        *[f"CASE WHEN __changed THEN {ladder_step_sql('__salary', 'no_of_strikes', i)} WHEN NOT __new THEN s.{c} END AS {c}"
          for i, c in enumerate(LADDER_COLUMNS, start=1)],
        "CAST(coalesce(s.no_of_strikes, 0) AS INT) AS no_of_strikes",
        "CASE WHEN __new THEN false ELSE s.is_inactive END AS is_inactive")


# J38 ------------------------------------------------------------------------------
def cooldown(stored: DataFrame) -> DataFrame:
    """Monthly reset: count 0 and empty ladder for everyone not inactive (NULL counts as
    not inactive). Salary is left alone (SURVEY Q30)."""
    keep = "coalesce(is_inactive, false)"
    return stored.selectExpr(
        "employee_id", "salary",
        *[f"CASE WHEN {keep} THEN {c} ELSE CAST(NULL AS DOUBLE) END AS {c}" for c in LADDER_COLUMNS],
        f"CAST(CASE WHEN {keep} THEN no_of_strikes ELSE 0 END AS INT) AS no_of_strikes",
        "is_inactive")


# J39 ------------------------------------------------------------------------------
def retention_cutoff(as_of, days: int = RETENTION_DAYS) -> dt.datetime:
    """Log rows before this moment are old."""
    return (dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of) - dt.timedelta(days=days)


def retain_flag_log(log: DataFrame, strikes: DataFrame, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """Drop log rows older than ``as_of - days`` of employees in the strike table that are
    not inactive; keep everything else.

    Only the old part of the log meets the join, and the strike table is keyed, so the
    anti join needs no distinct.
    """
    cutoff = F.lit(retention_cutoff(as_of, days)).cast("timestamp_ntz")
    resettable = strikes.filter(~F.coalesce(F.col("is_inactive"), F.lit(False))).select("employee_id")
    old = F.col("start_date") < cutoff
    recent = log.filter(~old | F.col("start_date").isNull())
    expired_kept = log.filter(old).join(resettable, "employee_id", "left_anti")
    return recent.unionByName(expired_kept)
