import datetime as dt
import os

from pyspark.sql import functions as F

from hrflow import schemas
from hrflow.plans import jobs
from hrflow.sinks import snapshot
from hrflow.streaming import monitor

DAY = 86400


def _csv(spark, rows, schema, path, header=True):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").option("header", header).csv(path)


def test_daily_monthly_yearly_end_to_end(spark, tmp_dir):
    lay = jobs.Layout(os.path.join(tmp_dir, "lake"))
    _csv(spark, [("1", "Ann", "30"), ("2", "Bo", "abc"), ("1", "Ann", "30")], "emp_id string, name string, age string",
         lay.employee_in)
    base = int(dt.datetime(2023, 1, 2).timestamp())
    _csv(spark, [("1", "DEV", str(base), None, "1000"), ("2", "OPS", str(base), str(base + 30 * DAY), "800"),
                 ("2", "OPS", str(base + 40 * DAY), None, "900"), ("3", "OPS", str(base), str(base + 9 * DAY), "700")],
         "emp_id string, designation string, start_date string, end_date string, salary string", lay.timeframe_inbox)
    leave = [("1", dt.date(2024, 1, 1) + dt.timedelta(days=i), "ACTIVE") for i in range(0, 60)]
    _csv(spark, leave, "emp_id string, date date, status string", lay.leave_in)
    _csv(spark, [("1", 20, 2024), ("2", 20, 2024)], "emp_id string, leave_quota int, year int", lay.quota_in)
    _csv(spark, [("New Year", dt.datetime(2024, 1, 1))], "reason string, date timestamp_ntz", lay.calendar_in,
         header=False)

    jobs.run_yearly(spark, lay, "2024-01-01")
    jobs.run_daily(spark, lay, "2024-03-01")
    jobs.run_daily(spark, lay, "2024-03-01")  # re-run: same outputs

    assert spark.read.parquet(lay.employee_gold).count() == 1
    tf = jobs.current_timeframe(spark, lay)
    assert sorted((r.emp_id, r.status) for r in tf.collect()) == [("1", "ACTIVE"), ("2", "ACTIVE"), ("2", "INACTIVE"),
                                                                  ("3", "INACTIVE")]
    assert snapshot.current_version(spark, lay.timeframe_gold) == 0
    silver = spark.read.option("header", True).csv(lay.timeframe_silver_csv)
    assert silver.count() == 4 and set(silver.columns) >= {"emp_id", "status", "ingest_run"}
    strikes = jobs.read_strikes(spark, lay)
    assert sorted((r.employee_id, r.salary, r.no_of_strikes) for r in strikes.collect()) == [("1", 1000.0, 0), ("2", 900.0, 0)]
    dept = spark.read.parquet(lay.dept_report).collect()
    assert sorted((r.designation, r.active_employees) for r in dept) == [("DEV", 1), ("OPS", 1)]
    anomaly = spark.read.parquet(lay.anomaly_report).collect()
    assert [(r.emp_id, str(r.run_date)) for r in anomaly] == [("1", "2024-03-01")]

    # the stream shares the layout: strikes come on top of the synced table
    from hrflow.sources.stream import stream_json_files
    from hrflow.streaming.monitor import start_strikes
    words = spark.createDataFrame([("IS",)], "word string")
    cfg = jobs.monitor_config(lay, trigger_seconds=None)
    spark.createDataFrame([("1", "2", "this is bad")], schemas.MESSAGE).write.json(os.path.join(tmp_dir, "messages"))
    start_strikes(spark, stream_json_files(spark, os.path.join(tmp_dir, "messages")), words, cfg).awaitTermination()
    s2 = {r.employee_id: (r.salary, r.no_of_strikes) for r in jobs.read_strikes(spark, lay).collect()}
    assert s2 == {"1": (1000.0, 1), "2": (900.0, 1)}

    jobs.run_monthly(spark, lay, "2024-03-01")
    s3 = {r.employee_id: (r.no_of_strikes, r.strike_1) for r in jobs.read_strikes(spark, lay).collect()}
    assert s3 == {"1": (0, None), "2": (0, None)}  # cool-down
    usage = spark.read.parquet(lay.usage_report).collect()
    assert [r.emp_id for r in usage] == ["1"]  # 42 working days of leave in Jan-Feb vs quota 20
    assert [r.emp_id for r in snapshot.read_current(spark, lay.alert_tracking, schemas.TRACKING).collect()] == ["1"]
    texts = spark.read.text(lay.alert_texts, wholetext=True).collect()
    assert len(texts) == 1 and texts[0].value.startswith("Employee ID: 1\n")
    jobs.run_monthly(spark, lay, "2024-03-01")  # re-run: no second alert, no second reset
    assert snapshot.current_version(spark, lay.alert_tracking) == 0


TF = "emp_id string, designation string, start_date string, end_date string, salary string"


def _deliver(spark, lay, name, rows_):
    """One more file in the inbox."""
    part = os.path.join(lay.root, "_parts", name)
    _csv(spark, rows_, TF, part)
    os.makedirs(lay.timeframe_inbox, exist_ok=True)
    for f in os.listdir(part):
        if f.endswith(".csv"):
            os.rename(os.path.join(part, f), os.path.join(lay.timeframe_inbox, f"{name}.csv"))


def _history(spark, lay):
    return sorted((r.emp_id, str(r.start_date), str(r.end_date), r.status) for r in jobs.current_timeframe(spark, lay).collect())


def test_leaver_stays_inactive_and_silver_equals_gold(spark, tmp_dir):
    lay = jobs.Layout(os.path.join(tmp_dir, "lake"))
    _deliver(spark, lay, "a", [("7", "OPS", "0", str(DAY * 3), "1"), ("8", "OPS", "0", None, "1")])
    jobs.run_timeframe(spark, lay, "2024-03-01")
    assert _history(spark, lay) == [("7", "1970-01-01", "1970-01-04", "INACTIVE"), ("8", "1970-01-01", "None", "ACTIVE")]
    silver = spark.read.option("header", True).csv(lay.timeframe_silver_csv)
    assert sorted((r.emp_id, r.start_date, str(r.end_date), r.status) for r in silver.collect()) == _history(spark, lay)
    _deliver(spark, lay, "b", [("8", "DEV", str(DAY * 5), None, "2"), ("9", "DEV", str(DAY), str(DAY * 2), "2")])
    jobs.run_timeframe(spark, lay, "2024-03-02")
    assert _history(spark, lay) == [("7", "1970-01-01", "1970-01-04", "INACTIVE"), ("8", "1970-01-01", "1970-01-06", "INACTIVE"),
                                    ("8", "1970-01-06", "None", "ACTIVE"), ("9", "1970-01-02", "1970-01-03", "INACTIVE")]


def test_late_file_of_an_applied_run_is_merged(spark, tmp_dir):
    lay = jobs.Layout(os.path.join(tmp_dir, "lake"))
    _deliver(spark, lay, "a", [("1", "A", "0", None, "1")])
    jobs.run_timeframe(spark, lay, "2024-03-01")
    _deliver(spark, lay, "late", [("2", "B", "0", None, "1")])
    jobs.run_timeframe(spark, lay, "2024-03-01")
    assert [r[0] for r in _history(spark, lay)] == ["1", "2"]
    version = snapshot.current_version(spark, lay.timeframe_gold)
    jobs.run_timeframe(spark, lay, "2024-03-02")  # nothing new
    assert snapshot.current_version(spark, lay.timeframe_gold) == version


def test_crash_between_landing_and_commit(spark, tmp_dir, monkeypatch):
    import pytest
    lay = jobs.Layout(os.path.join(tmp_dir, "lake"))
    _deliver(spark, lay, "a", [("1", "A", "0", None, "1")])
    with monkeypatch.context() as m:
        m.setattr(snapshot, "commit_folder", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            jobs.run_timeframe(spark, lay, "2024-03-01")
    _deliver(spark, lay, "b", [("2", "B", "0", None, "1")])
    jobs.run_timeframe(spark, lay, "2024-03-02")
    assert [r[0] for r in _history(spark, lay)] == ["1", "2"]


def test_removed_leave_record_leaves_gold(spark, tmp_dir):
    lay = jobs.Layout(os.path.join(tmp_dir, "lake"))
    sch = "emp_id string, date date, status string"
    _csv(spark, [("1", dt.date(2024, 3, 4), "ACTIVE"), ("1", dt.date(2024, 5, 6), "ACTIVE")], sch, lay.leave_in)
    jobs.run_leave(spark, lay, "2024-03-01", "2024-03-01 07:00:00")
    _csv(spark, [("1", dt.date(2024, 3, 4), "ACTIVE")], sch, lay.leave_in)
    jobs.run_leave(spark, lay, "2024-03-02", "2024-03-02 07:00:00")
    gold = snapshot.read_current(spark, lay.leave_gold, schemas.LEAVE_GOLD)
    assert [str(r.date) for r in gold.collect()] == ["2024-03-04"]


def _log(spark, lay, n, rows_):
    spark.createDataFrame(rows_, "employee_id string, role string, start_date timestamp_ntz").write.parquet(
        f"{lay.flag_log}/query_id=q/batch_id={n}")


def test_expired_log_rows_do_not_come_back(spark, tmp_dir):
    lay = jobs.Layout(os.path.join(tmp_dir, "lake"))
    monitor.init_strikes(spark, jobs.monitor_config(lay), spark.createDataFrame(
        [("1", 1.0, *[None] * 10, 1, False)], schemas.STRIKES))
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 30)
    _log(spark, lay, 0, [("1", "sender", new)])
    _log(spark, lay, 1, [("1", "sender", old)])      # the newest batch expires as a whole
    jobs.run_log_retention(spark, lay, "2024-04-01")
    assert [r.start_date for r in jobs.read_flag_log(spark, lay).collect()] == [new]
    assert not os.path.exists(f"{lay.flag_log}/query_id=q/batch_id=1")
    _log(spark, lay, 2, [("1", "receiver", new)])
    assert jobs.read_flag_log(spark, lay).count() == 2
    jobs.run_log_retention(spark, lay, "2024-04-01")  # applied already
    assert jobs.read_flag_log(spark, lay).count() == 2


def test_crash_between_cooldown_and_retention(spark, tmp_dir, monkeypatch):
    import pytest
    lay = jobs.Layout(os.path.join(tmp_dir, "lake"))
    monitor.init_strikes(spark, jobs.monitor_config(lay), spark.createDataFrame(
        [("1", 1.0, *[None] * 10, 4, False)], schemas.STRIKES))
    _log(spark, lay, 0, [("1", "sender", dt.datetime(2024, 1, 1))])
    with monkeypatch.context() as m:
        m.setattr(jobs, "run_log_retention", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            jobs.run_monthly(spark, lay, "2024-04-01")
    jobs.run_monthly(spark, lay, "2024-04-01")
    assert jobs.read_flag_log(spark, lay).count() == 0
    assert [r.no_of_strikes for r in jobs.read_strikes(spark, lay).collect()] == [0]


def test_retention_leaves_kept_days_alone(spark, tmp_dir, monkeypatch):
    """Days past the cutoff go, rows of inactive employees stay, files of later days are not written again."""
    import glob
    import pytest
    lay = jobs.Layout(os.path.join(tmp_dir, "lake"))
    monitor.init_strikes(spark, jobs.monitor_config(lay), spark.createDataFrame(
        [("1", 1.0, *[None] * 10, 1, False), ("2", 1.0, *[None] * 10, 12, True)], schemas.STRIKES))
    at = [dt.datetime(2024, m, 15, 9) for m in (1, 2, 3)]
    _log(spark, lay, 0, [(e, "sender", t) for e in ("1", "2", "9") for t in at] + [("1", "sender", None)])
    with monkeypatch.context() as m:  # dies after the days were written
        m.setattr(snapshot, "commit_folder", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            jobs.run_log_retention(spark, lay, "2024-02-20")
    assert jobs.read_flag_log(spark, lay).count() == 10

    def log():
        return sorted((r.employee_id, r.start_date.month if r.start_date else 0) for r in jobs.read_flag_log(spark, lay).collect())

    jobs.run_log_retention(spark, lay, "2024-03-01")      # another run date takes it up
    assert log() == [("1", 0), ("1", 2), ("1", 3), ("2", 1), ("2", 2), ("2", 3), ("9", 1), ("9", 2), ("9", 3)]
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{lay.flag_log_days}/day=2024-03-15/taken=2024-03-01/*.parquet")}
    assert files and not os.path.exists(f"{lay.flag_log_days}/day=2024-01-15")
    _log(spark, lay, 1, [("1", "receiver", at[0]), ("1", "receiver", at[2])])
    jobs.run_log_retention(spark, lay, "2024-04-01")
    assert log() == [("1", 0), ("1", 3), ("1", 3), ("2", 1), ("2", 2), ("2", 3), ("9", 1), ("9", 2), ("9", 3)]
    assert {f: os.path.getmtime(f) for f in files} == files
    assert [d for d, _ in jobs.SF.partition_folders(spark, lay.flag_log_days, "day")] == ["2024-03-15"]
