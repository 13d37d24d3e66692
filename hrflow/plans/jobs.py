"""The reference's job order as plain calls with an explicit run date.

The reference's scheduler runs, in this order (SURVEY §7.2): yearly quota and calendar,
employee master, job history, salary sync into the strike table, leave cleaning, the
department and 8 % reports; monthly the 80 % report with alerts, the strike cool-down
and the log retention. The stream runs on its own (``streaming.monitor``).

Storage follows the bronze/silver/gold layout. Tables the reference read and then
overwrote in place (job history, alert tracking, strike table) are versioned snapshots
here (``sinks.snapshot``), and so is the leave table, which each run derives anew from all
records: a run writes a new version and a crash leaves the old one current. Reports are partitioned by run date and overwritten per partition, so a
re-run replaces its own output and keeps the other dates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import history as H, leave as L, reports as R, strikes as K
from ..session import ensure_defaults
from ..sinks import files as SF, snapshot
from ..sinks.bucketed import read_bucketed, write_bucketed
from ..sources import files as SRC
from ..streaming import monitor
from ..streaming.ingest import ingest_new_files, landed_batches, numbered_folders, read_landed


@dataclass
class Layout:
    root: str
    history_buckets: int = 64      # files of the job history, by employee

    def p(self, rel: str) -> str:
        return f"{self.root.rstrip('/')}/{rel}"

    # The folders in which the feeds arrive.
    @property
    def employee_in(self): return self.p("bronze/employee_data")
    @property
    def timeframe_inbox(self): return self.p("bronze/employee_timeframe_data/unprocessed")
    @property
    def leave_in(self): return self.p("bronze/employee_leave_data")
    @property
    def quota_in(self): return self.p("bronze/employee_leave_quota_data")
    @property
    def calendar_in(self): return self.p("bronze/employee_calendar")
    # own folders
    @property
    def timeframe_processed(self): return self.p("bronze/archive")
    @property
    def employee_gold(self): return self.p("gold/employees")
    @property
    def timeframe_landed(self): return self.p("silver/job_history_landed")
    @property
    def timeframe_silver_csv(self): return self.p("silver/job_history_csv")
    @property
    def timeframe_gold(self): return self.p("gold/job_history")
    @property
    def leave_gold(self): return self.p("gold/leave")
    @property
    def quota(self): return self.p("silver/leave_quota")
    @property
    def calendar(self): return self.p("silver/holidays")
    @property
    def dept_report(self): return self.p("gold/report_headcount")
    @property
    def anomaly_report(self): return self.p("gold/report_leave_share")
    @property
    def usage_report(self): return self.p("gold/report_quota_use")
    @property
    def alert_tracking(self): return self.p("silver/alerted_employees")
    @property
    def alert_texts(self): return self.p("gold/alert_texts")
    @property
    def strikes(self): return self.p("gold/strikes")
    @property
    def salaries(self): return self.p("gold/current_salaries")
    @property
    def flag_log(self): return self.p("silver/flag_log")
    @property
    def flag_log_retained(self): return self.p("silver/flag_log_retained")
    @property
    def flag_log_days(self): return self.p("silver/flag_log_days")
    @property
    def checkpoints(self): return self.p("_checkpoints")


def _year_of(run_date: str) -> int:
    return int(run_date[:4])


# yearly -----------------------------------------------------------------------------------
def run_yearly(spark: SparkSession, lay: Layout, run_date: str) -> None:
    """Leave quota (J11) and holiday calendar (J10), partitioned by year."""
    ensure_defaults(spark)
    quota = SRC.read_or_empty(spark, lay.quota_in, schemas.QUOTA, fmt="csv", header=True)
    SF.write_partitioned(L.clean_quota(quota), lay.quota, ["year"])
    cal = SRC.read_or_empty(spark, lay.calendar_in, schemas.CALENDAR, fmt="csv", header=False)
    SF.write_partitioned(L.clean_calendar(cal), lay.calendar, ["year"])


# daily ------------------------------------------------------------------------------------
def current_timeframe(spark: SparkSession, lay: Layout) -> DataFrame | None:
    found = snapshot.current_folder(spark, lay.timeframe_gold)
    return None if found is None else read_bucketed(spark, found[0], schemas.TIMEFRAME_STORED, "emp_id", found[1]["buckets"])


def store_timeframe(spark: SparkSession, lay: Layout, parts: tuple[DataFrame, DataFrame], keys: list[str], parent: int | None) -> int:
    """Commit (rows that stay, rows chained again) as the next version of the history: the former are
    copied bucket by bucket, only the latter are dealt to buckets."""
    n = lay.history_buckets
    stay, chained = parts
    found = snapshot.current_folder(spark, lay.timeframe_gold)
    if found is None or found[1]["buckets"] != n:  # first version, or a new bucket count
        stay = stay.repartition(n, "emp_id")
    return snapshot.commit_folder(spark, lay.timeframe_gold, lambda path: write_bucketed(
        [stay, chained.repartition(n, "emp_id")], path, "emp_id", n), keys, {"buckets": n}, parent)


def run_employee_master(spark: SparkSession, lay: Layout, run_date: str) -> None:
    """J1 -> K1: clean employees into the run's year/month/day partition."""
    df = SRC.read_or_empty(spark, lay.employee_in, schemas.EMPLOYEE, fmt="csv", header=True)
    SF.append_run_partition(H.clean_employees(df), lay.employee_gold, run_date)


def _ingest_run(path: str) -> str:
    return path.split("/ingest_run=", 1)[1].split("/", 1)[0]


def run_timeframe(spark: SparkSession, lay: Layout, run_date: str) -> None:
    """K8 -> J7: land only new inbox files (archived afterwards), merge every landed batch
    that the stored history does not hold yet and commit it as a new version, bucketed by
    employee. Merged batches of former runs are deleted, so listing the landed ones does not grow
    with the age of the table. A late file of a past run, or one landed by a run that died before its commit,
    is merged by the next run."""
    ingest_new_files(spark, lay.timeframe_inbox, schemas.TIMEFRAME_RAW, lay.timeframe_landed,
                     f"{lay.checkpoints}/timeframe", archive=lay.timeframe_processed, run_key=run_date)

    def once():
        parent = snapshot.current_version(spark, lay.timeframe_gold)
        landed = landed_batches(spark, lay.timeframe_landed)
        merged = snapshot.applied(spark, lay.timeframe_gold)
        waiting = [(f"landed:{q}:{n}", path) for q, n, path in landed if not merged(f"landed:{q}:{n}")]
        if not waiting:
            return parent
        # silver: the files of each run concerned as dated intervals, CSV with header, one partition per run
        for run in sorted({_ingest_run(path) for _, path in waiting}):
            own = read_landed(spark, [path for _, _, path in landed if _ingest_run(path) == run], schemas.TIMEFRAME_RAW)
            SF.write_partitioned(H.build_timeframe(own).withColumn("ingest_run", F.lit(run)),
                                 lay.timeframe_silver_csv, ["ingest_run"], fmt="csv", header=True)
        history, found = current_timeframe(spark, lay), snapshot.current_folder(spark, lay.timeframe_gold)
        if history is None:
            history = spark.createDataFrame([], schemas.TIMEFRAME_STORED)
        batch = read_landed(spark, [path for _, path in waiting], schemas.TIMEFRAME_RAW)
        return store_timeframe(spark, lay, H.merge_into_history(
            history, batch, found[1]["buckets"] if found else None), [key for key, _ in waiting], parent)

    snapshot.retrying(once)
    merged = snapshot.applied(spark, lay.timeframe_gold)
    for q, n, path in landed_batches(spark, lay.timeframe_landed):  # merged batches of former runs are done with
        if _ingest_run(path) < run_date and merged(f"landed:{q}:{n}"):
            SF.delete_folder(spark, path)


def run_strike_sync(spark: SparkSession, lay: Layout, run_date: str) -> None:
    """T3's salary table, then J37: active salaries into the strike table, with what the stream has
    counted so far."""
    tf = current_timeframe(spark, lay)
    if tf is None:
        return
    cfg = monitor_config(lay)
    monitor.store_salaries(spark, cfg, tf)
    salaries = snapshot.read_current(spark, lay.salaries, monitor.SALARIES).select("employee_id", "salary")
    monitor.rewrite_strikes(spark, cfg, f"sync:{run_date}", lambda stored: K.sync_strikes(stored, salaries))


def read_strikes(spark: SparkSession, lay: Layout) -> DataFrame:
    """The strike table: the stored one plus what the stream has counted since."""
    return monitor.read_strikes(spark, monitor_config(lay))


def run_leave(spark: SparkSession, lay: Layout, run_date: str, run_ts: str) -> None:
    """J18 -> K2: the gold leave table of all records as a new version, by year and month; what left
    the input leaves the table."""
    raw = SRC.read_or_empty(spark, lay.leave_in, schemas.LEAVE, fmt="csv", header=True)
    cal = SRC.read_or_empty(spark, lay.calendar, schemas.CALENDAR)
    tf = current_timeframe(spark, lay)
    gold = L.clean_leave(raw, cal, tf, run_date, run_ts)
    snapshot.commit(spark, lay.leave_gold, gold, partition_by=["year", "month"])


def _write_report(df: DataFrame, root: str, run_date: str) -> str:
    """Write a report as the partition of its run (an empty one too, so that a re-run leaves nothing
    stale); the partition's path."""
    path = f"{root}/run_date={run_date}"
    SF.write_parquet(df, path)
    return path


def run_daily_reports(spark: SparkSession, lay: Layout, run_date: str,
                      report_start: str = R.REPORT_START, report_end: str = R.REPORT_END) -> None:
    """J8 and J20, each in its ``run_date`` partition."""
    tf = current_timeframe(spark, lay)
    if tf is not None:
        _write_report(H.active_by_designation(tf), lay.dept_report, run_date)
    leave = snapshot.read_current(spark, lay.leave_gold, schemas.LEAVE_GOLD)
    cal = SRC.read_or_empty(spark, lay.calendar, schemas.CALENDAR)
    wd = R.working_days(spark, cal, report_start, report_end)
    _write_report(R.leave_anomaly(leave, wd, report_start, report_end), lay.anomaly_report, run_date)


def run_daily(spark: SparkSession, lay: Layout, run_date: str, run_ts: str | None = None) -> None:
    ensure_defaults(spark)
    run_ts = run_ts or f"{run_date} 07:00:00"
    run_employee_master(spark, lay, run_date)
    run_timeframe(spark, lay, run_date)
    run_strike_sync(spark, lay, run_date)
    run_leave(spark, lay, run_date, run_ts)
    run_daily_reports(spark, lay, run_date)


# monthly ----------------------------------------------------------------------------------
def monitor_config(lay: Layout, trigger_seconds: int | None = 10, kafka_input: bool = False) -> monitor.MonitorConfig:
    """Stream settings that share this layout's strike table, salaries and flag log."""
    return monitor.MonitorConfig(log_path=lay.flag_log, checkpoint=f"{lay.checkpoints}/monitor", strikes_root=lay.strikes,
                                 salaries_root=lay.salaries, trigger_seconds=trigger_seconds, kafka_input=kafka_input)


def run_monthly(spark: SparkSession, lay: Layout, run_date: str) -> None:
    """J21 -> K3, J22/J23 + K6 alerts, J38 cool-down, J39 log retention."""
    ensure_defaults(spark)
    year, month = _year_of(run_date), int(run_date[5:7])
    leave = snapshot.read_current(spark, lay.leave_gold, schemas.LEAVE_GOLD)
    quota = SRC.read_or_empty(spark, lay.quota, schemas.QUOTA)
    usage = R.leave_usage(leave, quota, year, month)
    # the alerts read the written report instead of deriving it again
    usage = spark.read.schema(usage.schema).parquet(_write_report(usage, lay.usage_report, run_date))

    key = f"alerts:{run_date}"
    tracking = snapshot.read_current(spark, lay.alert_tracking, schemas.TRACKING)
    if not snapshot.is_applied(spark, lay.alert_tracking, key):
        new = R.new_alerts(usage, tracking)
        SF.write_alert_texts(R.render_alert_text(new, run_date), lay.alert_texts)
        snapshot.commit(spark, lay.alert_tracking, R.update_tracking(tracking, new), key)

    if snapshot.current_version(spark, lay.strikes) is not None or monitor.started(spark, monitor_config(lay)):
        monitor.rewrite_strikes(spark, monitor_config(lay), f"cooldown:{run_date}", K.cooldown)
        run_log_retention(spark, lay, run_date)


def _live_log(spark: SparkSession, lay: Layout) -> list[tuple[str, int, str]]:
    """Batches of the stream's log that the retained log does not hold yet."""
    taken = snapshot.applied(spark, lay.flag_log_retained)
    return [(q, n, path) for q, n, path in numbered_folders(spark, f"{lay.flag_log}/query_id=*/batch_id=*")
            if not taken(f"log:{q}:{n}")]


def _log_days(spark: SparkSession, lay: Layout, runs: list[str]) -> DataFrame:
    """The log by day, as far as the named retention runs took it over."""
    schema = T.StructType([*schemas.FLAG_LOG.fields, T.StructField("day", T.DateType()), T.StructField("taken", T.StringType())])
    days = SRC.read_or_empty(spark, lay.flag_log_days, schema)
    return days.where(F.col("taken").isin(runs))


def run_log_retention(spark: SparkSession, lay: Layout, run_date: str) -> None:
    """J39 by day: the log's days take over the stream's batches, days past the cutoff are read, what
    stays of them (employees that are inactive) joins the kept rows, and their folders are deleted.

    Days that are kept are neither read nor written. The commit of the kept rows names the run, the
    cutoff and the batches taken over, so a run that died is taken up by the next one; its key is its
    own, so one that died after the cool-down still retains.
    """
    key = f"retention:{run_date}"

    def once():
        parent, found = snapshot.current_version(spark, lay.flag_log_retained), snapshot.current_folder(spark, lay.flag_log_retained)
        live = _live_log(spark, lay)
        if snapshot.is_applied(spark, lay.flag_log_retained, key) or (parent is None and not live):
            return parent
        about = found[1] if found else {"runs": [], "cutoff": ""}
        runs, cutoff = sorted({*about["runs"], run_date}), str(K.retention_cutoff(f"{run_date} 00:00:00").date())
        if live:
            rows = read_landed(spark, [path for _, _, path in live], schemas.FLAG_LOG)
            SF.write_partitioned(rows.withColumns({"day": F.to_date("start_date"), "taken": F.lit(run_date)}),
                                 lay.flag_log_days, ["day", "taken"])
        expired = _log_days(spark, lay, runs).where(F.col("day") < F.lit(cutoff).cast("date")).select(*schemas.FLAG_LOG.fieldNames())
        kept = snapshot.read_current(spark, lay.flag_log_retained, schemas.FLAG_LOG).unionByName(expired)
        kept = K.retain_flag_log(kept, read_strikes(spark, lay), f"{run_date} 00:00:00")
        return snapshot.commit_folder(spark, lay.flag_log_retained, lambda path: SF.write_parquet(kept, path),
                                      [key, *(f"log:{q}:{n}" for q, n, _ in live)],
                                      {"runs": runs, "cutoff": max(cutoff, about["cutoff"])}, parent)

    snapshot.retrying(once)
    found, taken = snapshot.current_folder(spark, lay.flag_log_retained), snapshot.applied(spark, lay.flag_log_retained)
    for q, n, path in numbered_folders(spark, f"{lay.flag_log}/query_id=*/batch_id=*"):
        if taken(f"log:{q}:{n}"):
            SF.delete_folder(spark, path)
    for day, path in SF.partition_folders(spark, lay.flag_log_days, "day") if found else []:
        if day < found[1]["cutoff"]:
            SF.delete_folder(spark, path)


def read_flag_log(spark: SparkSession, lay: Layout) -> DataFrame:
    """The flag log as of now: kept rows of expired days, the days since, and the stream's batches that
    are not taken over yet."""
    found = snapshot.current_folder(spark, lay.flag_log_retained)
    log = snapshot.read_current(spark, lay.flag_log_retained, schemas.FLAG_LOG)
    if found:
        since = F.col("day").isNull() | (F.col("day") >= F.lit(found[1]["cutoff"]).cast("date"))
        log = log.unionByName(_log_days(spark, lay, found[1]["runs"]).where(since).select(*log.columns))
    live = [path for _, _, path in _live_log(spark, lay)]
    return log.unionByName(read_landed(spark, live, schemas.FLAG_LOG)) if live else log
