"""Reports over leave and strikes and alert rendering (K6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import is_weekend
from ..sources.spine import date_spine
from .leave import holiday_dates

# Report defaults of the reference, now parameters.
REPORT_START, REPORT_END = "2024-01-01", "2024-12-31"
ANOMALY_THRESHOLD_PCT = 8
USAGE_THRESHOLD_PCT = 80


# J19 ------------------------------------------------------------------------------
def working_days_between(bounds: DataFrame, calendar: DataFrame | None,
                         start: str = "start", end: str = "end") -> DataFrame:
    """Days from ``start`` to ``end`` of each bounds row, without weekends and holidays.

    The day spine has one row per calendar day in the range, so its size is set by
    the parameters, not by the data. The reference's union + distinct + anti join of
    weekends is a filter here; holidays remain an anti join.
    """
    days = date_spine(bounds, start, end).filter(~is_weekend("date"))
    if calendar is not None:
        days = days.join(holiday_dates(calendar), "date", "left_anti")
    return days.distinct()


def working_days(spark, calendar: DataFrame | None, start=REPORT_START, end=REPORT_END) -> DataFrame:
    s = dt.date.fromisoformat(start) if isinstance(start, str) else start
    e = dt.date.fromisoformat(end) if isinstance(end, str) else end
    bounds = spark.range(1).select(F.lit(s).alias("start"), F.lit(e).alias("end"))
    return working_days_between(bounds, calendar)


# J20 ------------------------------------------------------------------------------
def leave_anomaly(leave: DataFrame, workdays: DataFrame, start=REPORT_START, end=REPORT_END,
                  threshold_pct: float = ANOMALY_THRESHOLD_PCT) -> DataFrame:
    """Employees whose distinct ACTIVE leave days on working days exceed ``threshold_pct``
    of all working days (strict, on the unrounded share; SURVEY Q16).

    The number of working days is a scalar subquery inside the same plan (no driver
    ``count()``); ``try_divide`` gives NULL instead of an error for zero working days.
    The working-day table has one row per day of the report range; Spark broadcasts it by its
    measured size.
    """
    s = dt.date.fromisoformat(start) if isinstance(start, str) else start
    e = dt.date.fromisoformat(end) if isinstance(end, str) else end
    total = workdays.select(F.count(F.lit(1))).scalar()
    if "year" in leave.columns:
        # the gold table is partitioned by year: the same bound on the partition column
        # lets the scan skip other years entirely
        leave = leave.filter(F.col("year").between(s.year, e.year))
    days = (leave.filter((F.col("status") == "ACTIVE") & F.to_date("date").between(F.lit(s), F.lit(e)))
                 .select("emp_id", F.to_date("date").alias("date"))
                 .dropDuplicates(["emp_id", "date"])
                 .join(workdays.select("date"), "date", "inner"))
    counts = days.groupBy("emp_id").agg(F.count(F.lit(1)).alias("upcoming_leaves_count"))
    share = F.try_divide(F.col("upcoming_leaves_count"), total) * 100
    return counts.filter(share > threshold_pct).select("emp_id", "upcoming_leaves_count")


# J21 ------------------------------------------------------------------------------
def leave_usage_by_horizon(leave: DataFrame, quota: DataFrame, year: int, horizons: list[int],
                           threshold_pct: float = USAGE_THRESHOLD_PCT) -> DataFrame:
    """``leave_usage`` before each of several months, in one conditional aggregate: its rows with ``before_month``."""
    last = max(horizons)
    if "year" in leave.columns and "month" in leave.columns:
        # gold leave is partitioned by year/month = year(date)/month(date): the same
        # predicate on the partition columns prunes the scan to this year's months
        leave = leave.filter((F.col("year") == year) & (F.col("month") < last))
    taken = (leave.filter((F.month("date") < last) & (F.year("date") == year) & (F.col("status") == "ACTIVE"))
                  .groupBy("emp_id").agg(*[F.count_if(F.month("date") < m).alias(f"__{m}") for m in horizons]))
    q = quota.filter(F.col("year") == year).select("emp_id", "leave_quota", "year")
    rounds = F.array(*[F.struct(F.lit(m).alias("before_month"), F.col(f"__{m}").alias("leaves_taken")) for m in horizons])
    joined = taken.select("emp_id", rounds.alias("rounds")).join(q, "emp_id", "left").select(
        "emp_id", "leave_quota", "year", F.inline("rounds"))
    lq = F.col("leave_quota").cast("bigint")
    hundredths = F.when(lq > 0, F.expr("(leaves_taken * 20000 + leave_quota) div (leave_quota * 2)"))
    return (joined.withColumn("__h", hundredths)
                  .filter(F.col("__h") > int(threshold_pct * 100))
                  .select("before_month", "emp_id", "leaves_taken", "leave_quota", "year",
                          (F.col("__h") / F.lit(100.0)).alias("leave_percent")))


def leave_usage(leave: DataFrame, quota: DataFrame, year: int = 2024, before_month: int = 12,
                threshold_pct: float = USAGE_THRESHOLD_PCT) -> DataFrame:
    """ACTIVE leave days in the months before ``before_month`` of ``year`` against the
    employee's quota for that year; keep those with round(share, 2) > threshold.

    The left join followed by the threshold drops employees without quota
    (SURVEY Q18); two quotas of one employee-year give two rows (Q14).
    """
    return leave_usage_by_horizon(leave, quota, year, [before_month], threshold_pct).drop("before_month")


# J22 / J23 ------------------------------------------------------------------------
def new_alerts(flagged: DataFrame, tracking: DataFrame | None) -> DataFrame:
    """Flagged employees never alerted before (anti join; NULL IDs dropped, SURVEY Q19)."""
    flagged = flagged.filter(F.col("emp_id").isNotNull())
    if tracking is None:
        return flagged
    return flagged.join(tracking.select("emp_id"), "emp_id", "left_anti")


def update_tracking(tracking: DataFrame | None, new: DataFrame) -> DataFrame:
    ids = new.select("emp_id")
    if tracking is not None:
        ids = tracking.select("emp_id").unionByName(ids)
    return ids.dropDuplicates(["emp_id"])


def alerts_of_round(usage: DataFrame, before_month: int) -> DataFrame:
    """J22 over ``leave_usage_by_horizon``: the rows of one monthly run whose employee no earlier run
    alerted."""
    first = F.min("before_month").over(Window.partitionBy("emp_id"))
    return (usage.filter(F.col("emp_id").isNotNull()).withColumn("__first", first)
            .filter((F.col("before_month") == before_month) & (F.col("__first") == before_month)).drop("before_month", "__first"))


def tracking_of_rounds(usage: DataFrame) -> DataFrame:
    """J23 over ``leave_usage_by_horizon``: everyone alerted by any of the monthly runs."""
    return usage.filter(F.col("emp_id").isNotNull()).select("emp_id").distinct()


# K6 rendering ---------------------------------------------------------------------
def render_alert_text(alerts: DataFrame, run_date: str) -> DataFrame:
    """One text document per alerted employee; the layout is the reference's.

    The last line has no line break here: the text writer ends every row with one.
    """
    # Fixed value: the alert layout (labels and padding).
    content = F.concat(
        F.lit("Employee ID: "), F.col("emp_id").cast("string"), F.lit("\n"),
        F.lit("Leave Taken: "), F.col("leaves_taken").cast("string"), F.lit("\n"),
        F.lit("Leave Quota: "), F.col("leave_quota").cast("string"), F.lit("\n"),
        F.lit("Usage:       "), F.col("leave_percent").cast("string"), F.lit("%\n"),
        F.lit("Date:        "), F.lit(run_date))
    return alerts.select(F.col("emp_id").cast("string").alias("emp_id"),
                         F.lit(run_date).alias("run_date"), content.alias("content"))


# J40-J43 --------------------------------------------------------------------------
def strike_leaderboard(strikes: DataFrame, n: int = 20, only_with_strikes: bool = False) -> DataFrame:
    """Top ``n`` by strikes (ties by employee_id): a bounded top-k (TakeOrdered)."""
    df = strikes.filter(F.col("no_of_strikes") > 0) if only_with_strikes else strikes
    return (df.orderBy(F.col("no_of_strikes").desc_nulls_last(), F.col("employee_id").asc_nulls_last())
              .limit(n)
              .select("employee_id", "salary", "no_of_strikes", "strike_1", "strike_2", "strike_3",
                      "strike_4", "strike_5", "is_inactive"))


def strike_stats(strikes: DataFrame) -> DataFrame:
    """Totals in one pass instead of four scans."""
    return strikes.agg(
        F.count(F.lit(1)).alias("total_employees"),
        F.count_if(F.col("no_of_strikes") > 0).alias("with_strikes"),
        F.count_if(F.col("is_inactive") == F.lit(True)).alias("suspended"),
        F.coalesce(F.max("no_of_strikes"), F.lit(0)).alias("max_strikes"))


def recent_flags(log: DataFrame, n: int = 10) -> DataFrame:
    return (log.orderBy(F.col("start_date").desc_nulls_last(), F.col("employee_id").asc_nulls_last())
               .limit(n).select("employee_id", "start_date"))


def suspended_report(strikes: DataFrame, n: int = 10) -> DataFrame:
    return (strikes.filter(F.col("is_inactive") == F.lit(True))
                   .orderBy(F.col("no_of_strikes").desc_nulls_last(), F.col("employee_id").asc_nulls_last())
                   .limit(n).select("employee_id", "salary", "no_of_strikes", "strike_10"))
