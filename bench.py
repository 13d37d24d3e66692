"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion into the ``noop`` sink (all rows computed, nothing
collected): one warm-up round, then the median of ``BENCH_REPS`` rounds. Prints one
JSON line; ``value`` is the sum of the per-query medians.

yearly, daily (two days, the second merging into the first) and monthly jobs of
``hrflow.plans.jobs`` run in order on bronze
CSV files written from the test tables beforehand (the preparation is not timed).
Set ``BENCH_DAG=0`` to skip it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from hrflow.plans import jobs  # noqa: E402
from hrflow.plans.catalog import MERGE_SPLIT_EPOCH, queries  # noqa: E402
from hrflow.session import build_session, scratch_path  # noqa: E402
from hrflow.sources import fixtures as fx  # noqa: E402

# The daily and monthly jobs of the reference, as queries.
HEADLINE = [
    "timeframe_history",      # J6  gold job history
    "timeframe_merge",        # J7  accumulate a new batch
    "dept_active_report",     # J8  head-count per designation
    "leave_clean",            # J18 gold leave table
    "leave_anomaly_8pct",     # J20 flagship report
    "leave_usage_80pct",      # J21 monthly quota report
    "message_flag",           # J26 marked-word scan
    "strike_deactivate",      # J32 one strike batch applied to the table
    "strikes_sync",           # J37 salary sync into the strike table
    "strike_cooldown",        # J38 monthly reset
    "flag_log_retention",     # J39 log retention
]


def run_dag(spark, sf_dir: str) -> dict[str, float]:
    lay = jobs.Layout(scratch_path(spark, "bench-lake"))
    fx.x_employee(spark, sf_dir).write.option("header", True).csv(lay.employee_in)
    raw, old = fx.x_timeframe(spark, sf_dir), F.col("start_date") < MERGE_SPLIT_EPOCH
    raw.filter(old).write.option("header", True).csv(lay.timeframe_inbox)
    fx.x_leave(spark, sf_dir).write.option("header", True).csv(lay.leave_in)
    fx.x_quota(spark, sf_dir).write.option("header", True).csv(lay.quota_in)
    fx.x_calendar(spark).write.option("header", False).csv(lay.calendar_in)
    out = {}
    def second_day():
        raw.filter(~old).write.mode("append").option("header", True).csv(lay.timeframe_inbox)
        return lambda: jobs.run_daily(spark, lay, "2024-12-02")

    for name, fn in (("yearly", lambda: jobs.run_yearly(spark, lay, "2024-01-01")),
                     ("daily", lambda: jobs.run_daily(spark, lay, "2024-12-01")),
                     ("second_day", None),
                     ("monthly", lambda: jobs.run_monthly(spark, lay, "2024-12-01"))):
        fn = fn or second_day()  # the delivery is not timed
        t0 = time.perf_counter()
        fn()
        out[name] = round(time.perf_counter() - t0, 3)
    out["total"] = round(sum(out.values()), 3)
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = build_session(master=f"local[{cpus}]", app="hrflow-bench", shuffle_partitions=2 * cpus)
    qs = queries()
    times: dict[str, list[float]] = {k: [] for k in HEADLINE}
    for rnd in range(reps + 1):
        for k in HEADLINE:
            t0 = time.perf_counter()
            qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if rnd > 0:
                times[k].append(time.perf_counter() - t0)
    med = {k: round(statistics.median(v), 3) for k, v in times.items()}
    dag = run_dag(spark, sf_dir) if os.environ.get("BENCH_DAG", "1") != "0" else None
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(med.values()), 3), "unit": "sec",
                      "queries": med, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "reps": reps, "dag_sec": dag}))
    spark.stop()


if __name__ == "__main__":
    main()
