import datetime as dt

import pytest
from pyspark.sql import Window, functions as F

from conftest import rows
from hrflow import schemas
from hrflow.functions import sequence
from hrflow.operators import history as H

D = dt.date
DAY = 86400


def test_employee_age_rules(spark):
    # SURVEY Q1: '30' and '1.5' stay; '0.5', '-1', 'abc', NULL go; duplicates collapse
    df = spark.createDataFrame(
        [("1", "a", "30"), ("2", "b", "0.5"), ("3", "c", "1.5"), ("4", "d", "-1"), ("5", "e", "abc"),
         ("6", "f", None), ("1", "a", "30"), (None, "g", "40")], "emp_id string, name string, age string")
    assert rows(H.clean_employees(df)) == [("1", "a", "30"), ("3", "c", "1.5")]


def test_employee_extra_columns_deterministic(spark):
    df = spark.createDataFrame([("1", "a", "30", "x"), ("1", "a", "30", "b")],
                               "emp_id string, name string, age string, dept string")
    assert rows(H.clean_employees(df)) == [("1", "a", "30", "b")]


def test_lenient_epoch_text(spark):
    # SURVEY Q4 / FIXTURES §4
    df = spark.createDataFrame([("1", "x", v, None, "10") for v in ("1700000000", "1700000000.0", "", " 17 ")],
                               "emp_id string, designation string, start_date string, end_date string, salary string")
    got = [r.start_date for r in H.normalize_timeframe(df).collect()]
    assert sorted(got, key=lambda x: (x is not None, x)) == [None, 17, 1700000000, 1700000000]


def test_dedupe_highest_salary_null_last(spark):
    df = spark.createDataFrame([("1", "A", 100, None, None), ("1", "B", 100, None, 5.0), ("1", "C", 100, None, 7.0),
                                ("2", "A", 100, None, None)],
                               "emp_id string, designation string, start_date long, end_date long, salary double")
    out = rows(H.dedupe_timeframe(df), "emp_id", "designation", "salary")
    assert out == [("1", "C", 7.0), ("2", "A", None)]


def test_chain_fill_null_keeps_explicit_end_and_null_start_first(spark, monkeypatch):
    # SURVEY Q6: a NULL start sorts first, so its next start is the earliest real one
    df = spark.createDataFrame([("1", "A", None, None, 1.0), ("1", "B", 100, 150, 2.0), ("1", "C", 200, None, 3.0),
                                ("1", "D", 300, None, 4.0)],
                               "emp_id string, designation string, start_date long, end_date long, salary double")
    for days in (30, 1 / 86400):  # slices of 30 days, and of a second
        monkeypatch.setattr(sequence, "SLICE_DAYS", days)
        out = rows(H.chain_intervals(df, "fill_null"), "designation", "end_date")
        assert out == [("A", 100), ("B", 150), ("C", 300), ("D", None)]
        rep = rows(H.chain_intervals(df, "replace"), "designation", "end_date")
        assert rep == [("A", 100), ("B", 200), ("C", 300), ("D", None)]


def test_chain_across_partitions_hot_key(spark):
    # one key over many range partitions: every interval must end at the next start
    n = 5000
    df = spark.range(n).select(F.lit("hot").alias("emp_id"), F.lit("X").alias("designation"),
                               (F.col("id") * DAY).alias("start_date"), F.lit(None).cast("long").alias("end_date"),
                               F.lit(1.0).alias("salary"))
    cold = spark.range(50).select(F.col("id").cast("string").alias("emp_id"), F.lit("Y").alias("designation"),
                                  F.lit(5).cast("long").alias("start_date"), F.lit(None).cast("long").alias("end_date"),
                                  F.lit(1.0).alias("salary"))
    out = H.chain_intervals(df.unionByName(cold), "replace")
    hot = out.filter(F.col("emp_id") == "hot")
    bad = hot.filter(~((F.col("end_date") == F.col("start_date") + DAY)
                       | ((F.col("start_date") == (n - 1) * DAY) & F.col("end_date").isNull())))
    assert bad.count() == 0
    assert out.filter((F.col("emp_id") != "hot") & F.col("end_date").isNotNull()).count() == 0


def _plain_lead(df, key, order, value):
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("nxt", F.lead(value).over(w))


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("aqe", ["true", "false"])
def test_sliced_lead_equals_window_with_an_extra_column(spark, reuse, aqe):
    """400 000 rows, one key with a third of them, a column outside the order."""
    from hrflow.functions.sequence import next_in_key
    df = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 97).cast("string")).alias("k"),
        F.when(F.col("id") % 501 != 0, F.col("id") * 37 % 100_003).alias("o"), F.col("id").alias("v"),
        F.xxhash64("id").alias("extra"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        a = next_in_key(df, "k", ["o", "v"], "v", "nxt", width=1_000).cache()
        assert a.count() == 400_000
        assert a.exceptAll(_plain_lead(df, "k", ["o", "v"], "v")).count() == 0
    finally:
        a.unpersist()
        for c, v in old.items():
            spark.conf.set(c, v)


def test_key_with_one_busy_month_is_spread(spark):
    """A key with 300 000 rows within 30 days: no group of the windows holds more than a day's rows or
    two rows a day."""
    from hrflow.functions import sequence
    month = spark.range(300_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % (30 * 86_400)).alias("o"), F.col("id").alias("v"))
    df = month.unionByName(spark.range(3_000).select(F.col("id").cast("string").alias("k"), F.lit(5).alias("o"), F.col("id").alias("v")))
    sizes = df.groupBy("k", sequence._slice(df, "o", None).alias("s")).count()
    assert sizes.agg(F.max("count")).first()[0] <= 300_000 // 30 + 100
    assert sizes.groupBy("k").count().agg(F.max("count")).first()[0] == 30
    got = sequence.next_in_key(df, "k", ["o", "v"], "v", "nxt")
    assert got.exceptAll(_plain_lead(df, "k", ["o", "v"], "v")).count() == 0 and got.count() == 303_000


def test_replace_mode_intervals_do_not_overlap(spark):
    df = spark.createDataFrame([("1", "A", s, None, 1.0) for s in (10, 30, 20, 50)],
                               "emp_id string, designation string, start_date long, end_date long, salary double")
    out = sorted((r.start_date, r.end_date) for r in H.chain_intervals(df, "replace").collect())
    for (s1, e1), (s2, _) in zip(out, out[1:]):
        assert e1 == s2 and s1 < e1


def test_status_future_end_is_inactive(spark):
    df = spark.createDataFrame([("1", "A", 0, 4102444800, 1.0), ("2", "A", 0, None, 1.0)],
                               "emp_id string, designation string, start_date long, end_date long, salary double")
    out = rows(H.derive_status(df), "emp_id", "start_date", "end_date", "status")
    assert out == [("1", D(1970, 1, 1), D(2100, 1, 1), "INACTIVE"), ("2", D(1970, 1, 1), None, "ACTIVE")]


def test_epoch_date_ignores_session_zone(spark):
    df = spark.createDataFrame([("1", "A", 1704067199, None, 1.0)],
                               "emp_id string, designation string, start_date long, end_date long, salary double")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert H.derive_status(df).first().start_date == D(2023, 12, 31)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_merge_resent_file_no_zero_length(spark):
    # SURVEY Q8: re-sending the same rows does not create zero-length intervals
    hist = H.build_timeframe(spark.createDataFrame(
        [("1", "A", 0, None, 10.0), ("1", "B", 86400 * 10, None, 20.0)],
        "emp_id string, designation string, start_date long, end_date long, salary double"))
    again = spark.createDataFrame([("1", "B", 86400 * 10, None, 20.0)],
                                  "emp_id string, designation string, start_date long, end_date long, salary double")
    out = rows(H.merge_timeframe(hist, again), "designation", "start_date", "end_date", "status")
    assert out == [("A", D(1970, 1, 1), D(1970, 1, 11), "INACTIVE"), ("B", D(1970, 1, 11), None, "ACTIVE")]


def test_dept_report_zero_and_null_designation(spark):
    tf = spark.createDataFrame([("1", "A", "ACTIVE"), ("2", "A", "INACTIVE"), ("3", "B", "INACTIVE"),
                                ("4", None, "ACTIVE")], "emp_id string, designation string, status string")
    assert rows(H.active_by_designation(tf)) == [(None, 0), ("A", 1), ("B", 0)]


def test_upsert_report_keeps_target_only_key(spark):
    # SURVEY Q21: a key only in the target keeps its designation
    t = spark.createDataFrame([("A", 1), ("OLD", 5)], "designation string, active_employees long")
    s = spark.createDataFrame([("A", 3), ("NEW", 2)], "designation string, active_employees long")
    assert rows(H.upsert_report(t, s)) == [("A", 3), ("NEW", 2), ("OLD", 5)]


def _tf(spark, rows_):
    return spark.createDataFrame(rows_, "emp_id string, designation string, start_date long, end_date long, "
                                        "salary double")


def test_accumulated_history_equals_one_build(spark):
    first = [("1", "A", 0, None, 1.0), ("1", "B", DAY * 5, DAY * 6, 2.0), ("2", "A", 0, None, 3.0),
             (None, "Z", DAY, None, 4.0), ("3", "X", DAY, DAY * 2, 9.0)]
    second = [("1", "C", DAY * 9, None, 5.0), ("1", "D", DAY * 5, None, 7.0), (None, "Y", DAY * 3, None, 6.0),
              ("2", "A", 0, DAY * 4, 3.0)]
    empty = spark.createDataFrame([], schemas.TIMEFRAME_STORED)
    cols = [*H.HISTORY_COLUMNS, "status"]
    whole = rows(H.build_timeframe(_tf(spark, first + second)), *cols)
    for one, two in ((first, second), (second, first), (first + second, second)):
        hist = H.accumulate_timeframe(empty, _tf(spark, one))
        assert rows(H.accumulate_timeframe(hist, _tf(spark, two)), *cols) == whole
    # a leaver keeps the given end and stays inactive
    assert ("3", "X", D(1970, 1, 2), D(1970, 1, 3), 9.0, "INACTIVE") in whole


def test_replace_merge_drops_resent_rows(spark):
    first = _tf(spark, [("1", "A", 0, None, 1.0)])
    empty = spark.createDataFrame([], schemas.TIMEFRAME_GOLD)
    hist = H.merge_timeframe(empty, first)
    both = _tf(spark, [("1", "A", 0, None, 1.0), ("1", "B", DAY * 2, None, 2.0)])
    assert rows(H.merge_timeframe(hist, both)) == [("1", "A", D(1970, 1, 1), D(1970, 1, 3), 1.0, "INACTIVE"),
                                                   ("1", "B", D(1970, 1, 3), None, 2.0, "ACTIVE")]


def test_merge_reads_the_bucketed_history_in_place(spark, tmp_dir):
    """No exchange over the history side, equal results, employees without an id included."""
    from hrflow import schemas
    from hrflow.sinks.bucketed import read_bucketed, write_bucketed
    sch = "emp_id string, designation string, start_date long, end_date long, salary double"
    old = [(str(i % 40) if i % 13 else None, f"d{i % 3}", 86400 * 30 * i, None if i % 4 else 86400 * 30 * (i + 2), 100.0 + i)
           for i in range(300)]
    new = [(str(i % 60), "d9", 86400 * 30 * (i * 7 % 400), None, 500.0) for i in range(0, 60, 9)] + [(None, "d1", 86400, None, 1.0)]
    once = H.build_timeframe(spark.createDataFrame(old + new, sch))
    first = H.accumulate_timeframe(spark.createDataFrame([], schemas.TIMEFRAME_STORED), spark.createDataFrame(old, sch))
    write_bucketed([first.repartition(4, "emp_id")], f"{tmp_dir}/h1", "emp_id", 4)
    history = read_bucketed(spark, f"{tmp_dir}/h1", schemas.TIMEFRAME_STORED, "emp_id", 4)
    stay, chained = H.merge_into_history(history, spark.createDataFrame(new, sch), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stay._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan" in line)
        history_side = plan[:plan.index("FileScan")].rsplit("SortMergeJoin", 1)[1]
        assert "LeftAnti" in plan and "Exchange" not in history_side and "Bucketed: false" not in scan, plan
        write_bucketed([stay, chained.repartition(4, "emp_id")], f"{tmp_dir}/h2", "emp_id", 4)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    merged = read_bucketed(spark, f"{tmp_dir}/h2", schemas.TIMEFRAME_STORED, "emp_id", 4)
    assert rows(merged.select(*H.HISTORY_COLUMNS, "status")) == rows(once.select(*H.HISTORY_COLUMNS, "status"))
    assert spark.catalog.listTables() == [] or not any("hrflow_bucketed" in t.name for t in spark.catalog.listTables())
