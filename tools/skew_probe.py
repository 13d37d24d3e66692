"""Measure task balance of the interval chain when one employee holds a third of the rows.

    python tools/skew_probe.py [--sf-dir /root/testdata/sf0.1]

The input is derived from ``orders``: every third order is re-assigned to employee "HOT"
(start dates kept distinct), the rest keep their customer. The chain (J3, replace mode)
runs twice, with a plain window and with slices, under Spark's event
log written to a fresh scratch folder, with AQE partition coalescing off so that the 16
shuffle partitions stay visible. For every stage the script reports the number of tasks
and the largest and median shuffle-read records per task.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def events(log_path):
    files = sorted(glob.glob(os.path.join(log_path, "*"))) if os.path.isdir(log_path) else [log_path]
    for f in files:
        for line in open(f):
            yield json.loads(line)


def stage_stats(log_path):
    """{group: {stage: (tasks, max records read, median records read)}}"""
    tasks, group_of = {}, {}
    for e in events(log_path):
        if e.get("Event") == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id", "-")
            for sid in e.get("Stage IDs", []):
                group_of[sid] = g
        if e.get("Event") == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            rd = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            tasks.setdefault(e["Stage ID"], []).append(rd)
    out = {}
    for s, v in sorted(tasks.items()):
        if max(v) > 0:
            out.setdefault(group_of.get(s, "-"), {})[s] = (len(v), max(v), statistics.median(v))
    return out


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    a = ap.parse_args()
    logdir = tempfile.mkdtemp(prefix="hrflow-eventlog-")
    from hrflow.session import build_session
    from hrflow.operators import history as H
    from pyspark.sql import Window, functions as F
    spark = build_session(shuffle_partitions=16, extra={"spark.eventLog.enabled": "true",
                                                         "spark.eventLog.dir": logdir,
                                                         "spark.eventLog.compress": "false",
                                                         # keep 16 tasks: on small data AQE would
                                                         # merge partitions and hide the imbalance
                                                         "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    o = spark.read.parquet(f"{a.sf_dir}/orders.parquet")
    hot = F.col("o_orderkey") % 3 == 0
    df = o.select(
        F.when(hot, F.lit("HOT")).otherwise(F.col("o_custkey").cast("string")).alias("emp_id"),
        F.col("o_orderpriority").alias("designation"),
        (F.unix_timestamp("o_orderdate") + F.col("o_orderkey")).alias("start_date"),
        F.lit(None).cast("bigint").alias("end_date"),
        F.col("o_totalprice").alias("salary"))
    n_hot = df.filter(F.col("emp_id") == "HOT").count()
    print(f"rows={df.count()} hot-key rows={n_hot}")
    plain = F.lead("start_date").over(Window.partitionBy("emp_id").orderBy("start_date", "salary", "designation"))
    for name, out in (("plain window", df.withColumn("end_date", plain)), ("slices", H.chain_intervals(df, "replace"))):
        spark.sparkContext.setJobGroup(name, name)
        spark.sparkContext.setLocalProperty("callSite.short", name)
        out.write.format("noop").mode("overwrite").save()
    spark.stop()
    log = glob.glob(os.path.join(logdir, "*"))[0]
    for g, stages in stage_stats(log).items():
        print(g)
        print("  stage  tasks  max-records  median-records")
        for s, (n, mx, md) in stages.items():
            print(f"  {s:5d} {n:6d} {mx:12d} {md:15.0f}")


if __name__ == "__main__":
    main()
