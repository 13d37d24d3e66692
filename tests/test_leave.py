import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from hrflow.operators import leave as L, reports as R

D = dt.date
LEAVE = "emp_id string, date date, status string"


def test_prefilter_drops_weekends_nulls_unknown(spark):
    df = spark.createDataFrame([("1", D(2024, 1, 6), "ACTIVE"), ("1", D(2024, 1, 8), "ACTIVE"),
                                ("1", D(2024, 1, 9), "PENDING"), (None, D(2024, 1, 9), "ACTIVE"),
                                ("2", None, "ACTIVE"), ("2", D(2024, 1, 10), "CANCELLED")], LEAVE)
    assert rows(L.prefilter_leave(df)) == [("1", D(2024, 1, 8), "ACTIVE"), ("2", D(2024, 1, 10), "CANCELLED")]


def test_tie_goes_to_cancelled(spark):
    # SURVEY Q10
    df = spark.createDataFrame([("1", D(2024, 1, 8), "ACTIVE"), ("1", D(2024, 1, 8), "CANCELLED"),
                                ("2", D(2024, 1, 8), "ACTIVE"), ("2", D(2024, 1, 8), "ACTIVE"),
                                ("2", D(2024, 1, 8), "CANCELLED")], LEAVE)
    st = L.stamp_ingest(df, "2024-01-02", "2024-01-02 07:00:00")
    assert rows(L.resolve_leave_status(st), "emp_id", "status") == [("1", "CANCELLED"), ("2", "ACTIVE"), ("2", "ACTIVE")]
    fused = L.resolve_and_dedupe(st)
    assert rows(fused, "emp_id", "status") == [("1", "CANCELLED"), ("2", "ACTIVE")]
    assert rows(fused) == rows(L.latest_ingest(L.resolve_leave_status(st)))


def test_latest_ingest_uses_real_timestamp(spark):
    # SURVEY Q11: with a real time stamp column the latest row wins
    df = spark.createDataFrame([("1", D(2024, 1, 8), "ACTIVE", dt.datetime(2024, 1, 1)),
                                ("1", D(2024, 1, 8), "ACTIVE", dt.datetime(2024, 2, 1))],
                               "emp_id string, date date, status string, ingest_timestamp timestamp_ntz")
    assert L.latest_ingest(df).first().ingest_timestamp == dt.datetime(2024, 2, 1)


def test_calendar_drops_header_row_and_duplicates(spark):
    cal = spark.createDataFrame([("reason", None), ("X", dt.datetime(2024, 1, 1)), ("X", dt.datetime(2024, 1, 1))],
                                "reason string, date timestamp_ntz")
    assert rows(L.clean_calendar(cal), "reason", "year") == [("X", 2024)]


def test_quota_two_values_both_stay(spark):
    # SURVEY Q14
    q = spark.createDataFrame([("1", 20, 2024), ("1", 25, 2024), ("1", 20, 2024), (None, 20, 2024)],
                              "emp_id string, leave_quota int, year int")
    assert rows(L.clean_quota(q)) == [("1", 20, 2024), ("1", 25, 2024)]


def test_empty_calendar_and_zero_working_days(spark):
    empty_cal = spark.createDataFrame([], "reason string, date date")
    wd = R.working_days(spark, empty_cal, "2024-01-06", "2024-01-07")  # a weekend only
    assert wd.count() == 0
    leave = spark.createDataFrame([("1", D(2024, 1, 8), "ACTIVE")], LEAVE)
    assert R.leave_anomaly(leave, wd).count() == 0  # zero divisor: NULL share, no error
    wd2 = R.working_days(spark, empty_cal, "2024-01-01", "2024-01-31")
    assert wd2.count() == 23


def test_anomaly_strict_threshold(spark):
    cal = spark.createDataFrame([], "reason string, date date")
    wd = R.working_days(spark, cal, "2024-01-01", "2024-01-25")  # 19 working days; 8 % of 19 = 1.52
    leave = spark.createDataFrame([("1", D(2024, 1, 2), "ACTIVE"), ("1", D(2024, 1, 3), "ACTIVE"),
                                   ("2", D(2024, 1, 2), "ACTIVE"), ("2", D(2024, 1, 2), "ACTIVE"),
                                   ("3", D(2024, 1, 2), "CANCELLED"), ("3", D(2024, 1, 3), "CANCELLED")], LEAVE)
    assert rows(R.leave_anomaly(leave, wd)) == [("1", 2)]


def test_usage_rounding_half_up_and_missing_quota(spark):
    # 27 / 32 = 84.375 % -> 84.38; an employee without quota drops out
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(27)]
    leave = spark.createDataFrame([("1", d, "ACTIVE") for d in days] + [("2", d, "ACTIVE") for d in days], LEAVE)
    quota = spark.createDataFrame([("1", 32, 2024)], "emp_id string, leave_quota int, year int")
    out = R.leave_usage(leave, quota).collect()
    assert [(r.emp_id, r.leaves_taken, r.leave_percent) for r in out] == [("1", 27, 84.38)]


def test_usage_exactly_80_is_not_flagged(spark):
    days = [D(2024, 2, 1) + dt.timedelta(days=i) for i in range(16)]
    leave = spark.createDataFrame([("1", d, "ACTIVE") for d in days], LEAVE)
    quota = spark.createDataFrame([("1", 20, 2024), ("1", 0, 2024)], "emp_id string, leave_quota int, year int")
    assert R.leave_usage(leave, quota).count() == 0


def test_alerts_and_tracking(spark):
    flagged = spark.createDataFrame([("1",), ("2",), (None,)], "emp_id string")
    tracking = spark.createDataFrame([("1",)], "emp_id string")
    new = R.new_alerts(flagged, tracking)
    assert rows(new) == [("2",)]
    assert rows(R.update_tracking(tracking, new)) == [("1",), ("2",)]


def test_alert_text_layout(spark):
    a = spark.createDataFrame([("7", 17, 20, 85.0)], "emp_id string, leaves_taken long, leave_quota int, leave_percent double")
    txt = R.render_alert_text(a, "2024-12-01").first().content
    assert txt == ("Employee ID: 7\nLeave Taken: 17\nLeave Quota: 20\nUsage:       85.0%\nDate:        2024-12-01")


def test_rounds_equal_one_run_after_another(spark):
    """Both monthly runs in one aggregate give what two runs with a tracking table give."""
    import datetime as dt
    rng = range(1, 13)
    days = [(f"e{e}", dt.date(2024, m, k + 1), "ACTIVE" if k % 7 else "CANCELLED") for e in range(12) for m in rng for k in range((e * m) % 9)]
    leave = spark.createDataFrame(days, "emp_id string, date date, status string")
    quota = spark.createDataFrame([(f"e{e}", 5 + e, 2024) for e in range(11)] + [("e3", 1, 2024), ("e4", 0, 2024), ("e5", 9, 2023)],
                                  "emp_id string, leave_quota int, year int")
    tracking, usage = None, R.leave_usage_by_horizon(leave, quota, 2024, [6, 11, 12])
    for month in (6, 11, 12):
        own = R.leave_usage(leave, quota, 2024, month)
        new = R.new_alerts(own, tracking)
        assert rows(R.alerts_of_round(usage, month)) == rows(new)
        assert rows(usage.where(F.col("before_month") == month).drop("before_month")) == rows(own)
        tracking = spark.createDataFrame(R.update_tracking(tracking, new).collect(), "emp_id string")
    assert rows(R.tracking_of_rounds(usage)) == rows(tracking)
