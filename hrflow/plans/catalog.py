"""Registered queries: one per operator key of SURVEY §2.

Each query takes ``(spark, sf_dir)``, reads the driver's tables through the adapters
of ``sources.fixtures`` and returns a DataFrame. Queries for sources and sinks write
their input to a fresh folder under the shared checkpoint root and read it back.
Parameters are the reference's defaults (SURVEY Q15) or fixed run keys, never the clock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..session import ensure_defaults, scratch_path
from ..sinks import files as sink_files, snapshot
from ..sinks.bucketed import read_bucketed, write_bucketed
from ..sinks.kafka import kafka_frame
from ..sources import fixtures as fx, files as src_files
from ..sources.jdbc import restrict_to
from ..sources.spine import date_spine
from ..sources.stream import stream_json_files
from ..operators import history as H, leave as L, messages as M, reports as R, strikes as K
from ..streaming.ingest import ingest_new_files
from ..streaming.monitor import (
    MonitorConfig, init_strikes, read_strikes, start_monitor, start_strikes, store_salaries, strike_totals)

# Fixed run keys and parameters of the registered queries.
RUN_DATE = "2024-01-02"
RUN_TS = "2024-01-02 07:00:00"
ALERT_RUN_DATE = "2024-12-01"
RETENTION_AS_OF = "2024-02-10 00:00:00"
# History before this start (1996-01-01) is the stored part, the rest the new batch (J7, J9).
MERGE_SPLIT_EPOCH = 820454400


# shared building blocks -------------------------------------------------------------
def timeframe_gold(spark, d) -> DataFrame:
    return H.build_timeframe(fx.x_timeframe(spark, d))


def known_employees(spark, d) -> DataFrame:
    """The job history's employees: any status counts (J14), so the records as they came will do."""
    return H.normalize_timeframe(fx.x_timeframe(spark, d)).select("emp_id")


def leave_gold(spark, d) -> DataFrame:
    return L.clean_leave(fx.x_leave(spark, d), fx.x_calendar(spark), known_employees(spark, d), RUN_DATE, RUN_TS)


def leave_before_stamp(spark, d) -> DataFrame:
    df = L.prefilter_leave(fx.x_leave(spark, d))
    df = L.drop_holidays(df, fx.x_calendar(spark))
    df = L.keep_known_employees(df, known_employees(spark, d))
    return L.stamp_ingest(df, RUN_DATE, RUN_TS)


def usage_report(spark, d, before_month=12) -> DataFrame:
    return R.leave_usage(leave_gold(spark, d), L.clean_quota(fx.x_quota(spark, d)), 2024, before_month)


def usage_rounds(spark, d) -> DataFrame:
    """What the previous monthly run (months before November) and this one report."""
    return R.leave_usage_by_horizon(leave_gold(spark, d), L.clean_quota(fx.x_quota(spark, d)), 2024, [11, 12])


def flagged(spark, d) -> DataFrame:
    return M.flag_messages(fx.x_message(spark, d), fx.x_marked(spark))


def events(spark, d) -> DataFrame:
    return M.strike_events(flagged(spark, d))


def salaries(spark, d, only=None) -> DataFrame:
    return K.current_salaries(timeframe_gold(spark, d), only)


def batch_totals(spark, d) -> DataFrame:
    """New strike totals of the employees in the batch: stored count + new strikes."""
    st = fx.x_strikes(spark, d).select("employee_id", "no_of_strikes")
    c = M.strike_counts(events(spark, d))
    return c.join(st, "employee_id", "left").select(
        "employee_id", (F.coalesce("no_of_strikes", F.lit(0)) + F.col("strike_count")).alias("strike_count"))


def _out(spark, name) -> str:
    return scratch_path(spark, name)


def _split_files(df: DataFrame, n: int) -> DataFrame:
    """``n`` output files of about equal size for stream inputs."""
    return df.repartition(n)


# sources ------------------------------------------------------------------------------
def q_scan_csv_strings(spark, d):
    p = _out(spark, "s1")
    sink_files.write_csv(fx.x_employee(spark, d), p)
    return src_files.read_csv(spark, p)


def q_scan_csv_schema(spark, d):
    p = _out(spark, "s2")
    sink_files.write_csv(fx.x_leave(spark, d), p)
    return src_files.read_csv(spark, p, schemas.LEAVE)


def q_scan_csv_headerless(spark, d):
    p = _out(spark, "s3")
    fx.x_calendar_feed(spark, d).write.mode("overwrite").option("header", False).csv(p)
    return src_files.read_csv_headerless(spark, p, schemas.CALENDAR)


def q_scan_parquet(spark, d):
    p = _out(spark, "s4")
    sink_files.write_partitioned(leave_gold(spark, d), p, ["year", "month"])
    return src_files.read_parquet(spark, p)


def q_scan_partition(spark, d):
    p = _out(spark, "s5")
    sink_files.write_partitioned(timeframe_gold(spark, d), p, ["status"])
    return src_files.read_partition(spark, p, "status", "ACTIVE")


def q_scan_jdbc(spark, d):
    """The strike table read with the active employees as membership filter."""
    root = _out(spark, "s6")
    snapshot.commit(spark, root, fx.x_strikes(spark, d, whole=True))
    stored = snapshot.read_current(spark, root, schemas.STRIKES)
    active = timeframe_gold(spark, d).filter(F.col("status") == "ACTIVE")
    return restrict_to(stored, active)


def q_scan_json_array(spark, d):
    p = _out(spark, "s7")
    sink_files.write_json_arrays(fx.x_vocab(spark, d), p, value="word")
    return src_files.read_json_string_array(spark, p)


def q_scan_json_objects(spark, d):
    p = _out(spark, "s8")
    sink_files.write_json_arrays(fx.x_message(spark, d), p)
    return src_files.read_json_objects(spark, p, schemas.MESSAGE)


def q_scan_optional(spark, d):
    p = _out(spark, "s9")
    fx.x_quota(spark, d).write.mode("overwrite").parquet(p)
    present = src_files.read_or_empty(spark, p, schemas.QUOTA)
    missing = src_files.read_or_empty(spark, p + "-never-written", schemas.QUOTA)
    return present.unionByName(missing)


def q_date_spine(spark, d):
    """Every day between each employee's first and last leave record."""
    bounds = fx.x_leave(spark, d).groupBy("emp_id").agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return date_spine(bounds, "start", "end")


def q_stream_messages(spark, d):
    base = _out(spark, "s11")
    inbox, out = f"{base}/inbox", f"{base}/out"
    _split_files(fx.x_message(spark, d), 4).write.mode("overwrite").json(inbox)
    q = (stream_json_files(spark, inbox, 1).writeStream.format("parquet")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.schema(schemas.MESSAGE).parquet(out)


# sinks ------------------------------------------------------------------------------
def q_sink_append_partitioned(spark, d):
    p = _out(spark, "k1")
    clean = H.clean_employees(fx.x_employee(spark, d))
    sink_files.append_run_partition(clean, p, RUN_DATE)
    sink_files.append_run_partition(clean, p, RUN_DATE)  # a re-run replaces, not doubles
    return src_files.read_parquet(spark, p)


def q_sink_overwrite_partitioned(spark, d):
    p = _out(spark, "k2")
    gold = timeframe_gold(spark, d)
    sink_files.write_partitioned(gold, p, ["status"])
    sink_files.write_partitioned(gold.filter(F.col("status") == "ACTIVE"), p, ["status"])  # other status survives
    return src_files.read_parquet(spark, p)


def q_sink_parquet_plain(spark, d):
    p = _out(spark, "k3")
    sink_files.write_parquet(usage_report(spark, d), p)
    return src_files.read_parquet(spark, p)


def q_sink_csv(spark, d):
    p = _out(spark, "k4")
    sink_files.write_csv(timeframe_gold(spark, d), p)
    return src_files.read_csv(spark, p, schemas.TIMEFRAME_GOLD)


def q_sink_jdbc(spark, d):
    """The sync staging table, written as a snapshot version (no database here)."""
    root = _out(spark, "k5")
    stored = fx.x_strikes(spark, d)
    sal = salaries(spark, d)
    staging = K.sync_new(sal, stored).unionByName(K.sync_changed(sal, stored))
    snapshot.commit(spark, root, staging)
    return snapshot.read_current(spark, root)


def q_sink_text_alerts(spark, d):
    p = _out(spark, "k6")
    new = R.alerts_of_round(usage_rounds(spark, d), 12)
    sink_files.write_alert_texts(R.render_alert_text(new, ALERT_RUN_DATE), p)
    back = spark.read.schema("value string, run_date string, emp_id string").text(p, wholetext=True)
    return back.select("emp_id", "run_date", F.col("value").alias("content"))


def q_sink_kafka_messages(spark, d):
    return kafka_frame(fx.x_message(spark, d))


def q_stream_file_ingest(spark, d):
    base = _out(spark, "k8")
    inbox = f"{base}/inbox"
    sink_files.write_csv(_split_files(fx.x_timeframe(spark, d), 4), inbox)
    ingest_new_files(spark, inbox, schemas.TIMEFRAME_RAW, f"{base}/out", f"{base}/checkpoint",
                     archive=f"{base}/processed")
    # a second run finds nothing new
    ingest_new_files(spark, inbox, schemas.TIMEFRAME_RAW, f"{base}/out", f"{base}/checkpoint",
                     archive=f"{base}/processed")
    return spark.read.schema(schemas.TIMEFRAME_RAW).parquet(f"{base}/out").select(*schemas.TIMEFRAME_RAW.fieldNames())


# employee master and job history --------------------------------------------------
def q_employee_clean(spark, d):
    return H.clean_employees(fx.x_employee(spark, d))


def q_timeframe_dedupe(spark, d):
    return H.dedupe_timeframe(H.normalize_timeframe(fx.x_timeframe(spark, d)))


def q_timeframe_intervals(spark, d):
    return H.chain_intervals(H.dedupe_timeframe(H.normalize_timeframe(fx.x_timeframe(spark, d))), "fill_null")


def q_timeframe_chain(spark, d):
    return H.build_timeframe_chained(fx.x_timeframe(spark, d))


def q_timeframe_status(spark, d):
    return H.derive_status(H.normalize_timeframe(fx.x_timeframe(spark, d)))


def q_timeframe_history(spark, d):
    return timeframe_gold(spark, d)


def q_timeframe_merge(spark, d):
    """The daily job's merge over two batches: the first one stored bucketed by employee, as the job
    stores it, and read in place."""
    path, raw = _out(spark, "j7"), fx.x_timeframe(spark, d)
    old, buckets = F.col("start_date") < MERGE_SPLIT_EPOCH, 8
    first = H.accumulate_timeframe(spark.createDataFrame([], schemas.TIMEFRAME_STORED), raw.filter(old))
    write_bucketed([first.repartition(buckets, "emp_id")], path, "emp_id", buckets)
    history = read_bucketed(spark, path, schemas.TIMEFRAME_STORED, "emp_id", buckets)
    return H.accumulate_timeframe(history, raw.filter(~old | F.col("start_date").isNull()), buckets).select(
        *H.HISTORY_COLUMNS, "status")


def q_timeframe_merge_replace(spark, d):
    raw = fx.x_timeframe(spark, d)
    old = H.build_timeframe(raw.filter(F.col("start_date") < MERGE_SPLIT_EPOCH))
    new = raw.filter(~(F.col("start_date") < MERGE_SPLIT_EPOCH) | F.col("start_date").isNull())
    return H.merge_timeframe(old, new)


def q_dept_active_report(spark, d):
    return H.active_by_designation(timeframe_gold(spark, d))


def q_dept_report_upsert(spark, d):
    raw = fx.x_timeframe(spark, d)
    target = H.active_by_designation(H.build_timeframe(raw.filter(F.col("start_date") < MERGE_SPLIT_EPOCH)))
    staging = H.active_by_designation(timeframe_gold(spark, d))
    return H.upsert_report(target, staging)


# leave ------------------------------------------------------------------------------
def q_leave_calendar(spark, d):
    return L.clean_calendar(fx.x_calendar_feed(spark, d))


def q_leave_quota(spark, d):
    return L.clean_quota(fx.x_quota(spark, d))


def q_leave_prefilter(spark, d):
    return L.prefilter_leave(fx.x_leave(spark, d))


def q_leave_drop_holidays(spark, d):
    return L.drop_holidays(L.prefilter_leave(fx.x_leave(spark, d)), fx.x_calendar(spark))


def q_leave_known_employees(spark, d):
    df = L.drop_holidays(L.prefilter_leave(fx.x_leave(spark, d)), fx.x_calendar(spark))
    return L.keep_known_employees(df, timeframe_gold(spark, d))


def q_leave_stamp(spark, d):
    return leave_before_stamp(spark, d)


def q_leave_resolve_status(spark, d):
    return L.resolve_leave_status(leave_before_stamp(spark, d))


def q_leave_latest(spark, d):
    return L.latest_ingest(L.resolve_leave_status(leave_before_stamp(spark, d)))


def q_leave_clean(spark, d):
    return leave_gold(spark, d)


def q_working_days(spark, d):
    """Working days over the span of the leave data."""
    bounds = fx.x_leave(spark, d).agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return R.working_days_between(bounds, fx.x_calendar(spark))


def q_leave_anomaly_8pct(spark, d):
    return R.leave_anomaly(leave_gold(spark, d), R.working_days(spark, fx.x_calendar(spark)))


def q_leave_usage_80pct(spark, d):
    return usage_report(spark, d)


def q_leave_alert_new(spark, d):
    return R.alerts_of_round(usage_rounds(spark, d), 12)


def q_leave_alert_tracking(spark, d):
    return R.tracking_of_rounds(usage_rounds(spark, d))


# messages ---------------------------------------------------------------------------
def q_message_validate(spark, d):
    return M.validate_messages(fx.x_message(spark, d))


def q_message_parse(spark, d):
    kv = kafka_frame(fx.x_message(spark, d)).select(F.col("key").cast("binary").alias("key"),
                                                     F.col("value").cast("binary").alias("value"))
    return M.parse_messages(kv)


def q_message_flag(spark, d):
    return flagged(spark, d)


def q_message_flag_vocab(spark, d):
    return M.flag_messages_in_vocab(fx.x_message(spark, d), fx.x_marked(spark), fx.x_vocab(spark, d))


def q_strike_events(spark, d):
    return events(spark, d)


def q_strike_counts(spark, d):
    return M.strike_counts(events(spark, d))


# strikes ----------------------------------------------------------------------------
def q_strike_upsert(spark, d):
    counts = K.with_salaries(M.strike_counts(events(spark, d)), timeframe_gold(spark, d))
    up = K.upsert_strikes(fx.x_strikes(spark, d), counts)
    return up.select("employee_id", "salary", "no_of_strikes", "is_inactive")


def q_strike_penalties(spark, d):
    return K.apply_penalties(fx.x_strikes_base(spark, d, whole=True))


def q_strike_deactivate(spark, d):
    return K.apply_strike_batch(fx.x_strikes(spark, d), events(spark, d), timeframe=timeframe_gold(spark, d))


def q_strike_penalties_frozen(spark, d):
    return K.penalties_frozen(fx.x_strikes(spark, d), batch_totals(spark, d))


def q_strike_penalties_replace(spark, d):
    return K.penalties_replace(fx.x_strikes(spark, d), batch_totals(spark, d))


def q_strikes_sync_new(spark, d):
    return K.sync_new(salaries(spark, d), fx.x_strikes(spark, d))


def q_strikes_sync_changed(spark, d):
    return K.sync_changed(salaries(spark, d), fx.x_strikes(spark, d))


def q_strikes_sync(spark, d):
    return K.sync_strikes(fx.x_strikes(spark, d), salaries(spark, d))


def q_strike_cooldown(spark, d):
    return K.cooldown(fx.x_strikes(spark, d, whole=True))


def q_flag_log_retention(spark, d):
    return K.retain_flag_log(fx.x_flag_log(spark, d), fx.x_strikes(spark, d, whole=True), RETENTION_AS_OF)


def q_strike_leaderboard(spark, d):
    return R.strike_leaderboard(fx.x_strikes(spark, d, whole=True), 20)


def q_strike_stats(spark, d):
    return R.strike_stats(fx.x_strikes(spark, d, whole=True))


def q_flag_log_recent(spark, d):
    return R.recent_flags(fx.x_flag_log(spark, d), 10)


def q_suspended_report(spark, d):
    return R.suspended_report(fx.x_strikes(spark, d, whole=True), 10)


# streaming --------------------------------------------------------------------------
def _message_stream(spark, d, name, **settings) -> tuple[MonitorConfig, DataFrame]:
    """Settings and source of a stream over the message table as four files, one per batch."""
    base = _out(spark, name)
    inbox = f"{base}/inbox"
    _split_files(fx.x_message(spark, d), 4).write.mode("overwrite").json(inbox)
    cfg = MonitorConfig(log_path=f"{base}/log", checkpoint=f"{base}/checkpoint", trigger_seconds=None, name=name,
                        **{k: f"{base}/{v}" for k, v in settings.items()})
    if cfg.salaries_root is not None:
        store_salaries(spark, cfg, timeframe_gold(spark, d))
    return cfg, stream_json_files(spark, inbox, 1)


def q_stream_flag_log(spark, d):
    cfg, source = _message_stream(spark, d, "t1")
    start_monitor(spark, source, fx.x_marked(spark), cfg).awaitTermination()
    return spark.read.parquet(cfg.log_path).select("employee_id", "role")


def q_stream_strikes(spark, d):
    cfg, source = _message_stream(spark, d, "t2", strikes_root="strikes", salaries_root="salaries")
    init_strikes(spark, cfg, fx.x_strikes(spark, d))
    start_strikes(spark, source, fx.x_marked(spark), cfg).awaitTermination()
    return read_strikes(spark, cfg)


def q_stream_salary_enrich(spark, d):
    cfg, source = _message_stream(spark, d, "t3", salaries_root="salaries", enriched_path="enriched")
    start_monitor(spark, source, fx.x_marked(spark), cfg).awaitTermination()
    return spark.read.parquet(cfg.enriched_path).select("employee_id", "role", "salary")


def q_stream_restart(spark, d):
    """Both queries are killed in their third batch, after its work and before its commit, and
    restarted from their checkpoints: strikes per employee in the log and in the state."""
    cfg, source = _message_stream(spark, d, "t4")

    def killed(query, batch):
        if batch == 2:
            raise RuntimeError(f"{query}: killed before the commit of batch {batch}")

    for start in (start_monitor, start_strikes):
        cfg.after_batch = killed
        try:
            start(spark, source, fx.x_marked(spark), cfg).awaitTermination()
        except StreamingQueryException as e:
            if "killed before the commit" not in str(e):
                raise
        cfg.after_batch = None
        start(spark, source, fx.x_marked(spark), cfg).awaitTermination()
    logged = spark.read.parquet(cfg.log_path).groupBy("employee_id").agg(F.count("*").alias("logged"))
    return logged.join(strike_totals(spark, cfg).withColumnRenamed("total", "counted"), "employee_id", "full")


# registry ---------------------------------------------------------------------------
KEYS = [
    # sources
    "scan_csv_strings", "scan_csv_schema", "scan_csv_headerless", "scan_parquet", "scan_partition",
    "scan_jdbc", "scan_json_array", "scan_json_objects", "scan_optional", "date_spine", "stream_messages",
    # sinks
    "sink_append_partitioned", "sink_overwrite_partitioned", "sink_parquet_plain", "sink_csv", "sink_jdbc",
    "sink_text_alerts", "sink_kafka_messages", "stream_file_ingest",
    # history
    "employee_clean", "timeframe_dedupe", "timeframe_intervals", "timeframe_chain", "timeframe_status",
    "timeframe_history", "timeframe_merge", "timeframe_merge_replace", "dept_active_report", "dept_report_upsert",
    # leave
    "leave_calendar", "leave_quota", "leave_prefilter", "leave_drop_holidays", "leave_known_employees",
    "leave_stamp", "leave_resolve_status", "leave_latest", "leave_clean", "working_days",
    "leave_anomaly_8pct", "leave_usage_80pct", "leave_alert_new", "leave_alert_tracking",
    # messages and strikes
    "message_validate", "message_parse", "message_flag", "message_flag_vocab", "strike_events",
    "strike_counts", "strike_upsert", "strike_penalties", "strike_deactivate", "strike_penalties_frozen",
    "strike_penalties_replace", "strikes_sync_new", "strikes_sync_changed", "strikes_sync",
    "strike_cooldown", "flag_log_retention", "strike_leaderboard", "strike_stats", "flag_log_recent",
    "suspended_report",
    # streaming
    "stream_flag_log", "stream_strikes", "stream_salary_enrich", "stream_restart",
]


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_defaults(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    g = globals()
    return {k: _wrap(g[f"q_{k}"]) for k in KEYS}
