"""The monitoring stream: strikes in Spark's streaming state, restarts, the stored table below it."""

import glob
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import rows
from hrflow import schemas
from hrflow.operators import messages as M, strikes as K
from hrflow.sinks import snapshot
from hrflow.sources.stream import stream_json_files
from hrflow.streaming import monitor as S

D = "emp_id string, designation string, start_date date, end_date date, salary double, status string"


def config(tmp_dir, **more):
    return S.MonitorConfig(log_path=f"{tmp_dir}/log", checkpoint=f"{tmp_dir}/ck", strikes_root=f"{tmp_dir}/strikes",
                           trigger_seconds=None, **more)


def marked(spark):
    return spark.createDataFrame([("Is",), (None,)], "word string")


def deliver(spark, tmp_dir, messages, name="in"):
    spark.createDataFrame(messages, schemas.MESSAGE).coalesce(1).write.mode("append").json(f"{tmp_dir}/{name}")
    return stream_json_files(spark, f"{tmp_dir}/{name}", 1)


def counts(spark, cfg):
    return {r.employee_id: r.no_of_strikes for r in S.read_strikes(spark, cfg).collect()}


def test_log_and_strikes_equal_one_batch(spark, tmp_dir):
    msgs = [(str(i % 7), None if i % 5 == 0 else str(i), ("that is, it" if i % 2 else "nothing") if i % 11 else None) for i in range(60)]
    for part in range(3):
        source = deliver(spark, tmp_dir, msgs[part::3])
    cfg = config(tmp_dir)
    S.start_monitor(spark, source, marked(spark), cfg).awaitTermination()
    q = S.start_strikes(spark, source, marked(spark), cfg)
    q.awaitTermination()
    assert sum(n for _, n, _ in S.progress(q)) == 60
    log = spark.read.parquet(cfg.log_path)
    assert log.select("batch_id").distinct().count() == 3
    events = M.strike_events(M.flag_messages(spark.createDataFrame(msgs, schemas.MESSAGE), marked(spark)))
    assert rows(log, "employee_id", "role") == rows(events)
    assert rows(S.read_strikes(spark, cfg)) == rows(K.apply_strike_batch(spark.createDataFrame([], schemas.STRIKES), events))


def test_replayed_log_batch_replaces_itself(spark, tmp_dir):
    cfg = config(tmp_dir)
    batch = spark.createDataFrame([("a", "b", "it is")], schemas.MESSAGE)
    for _ in range(2):
        S.process_batch(spark, batch, 0, marked(spark), cfg)
    assert spark.read.parquet(cfg.log_path).count() == 2
    S.process_batch(spark, spark.createDataFrame([("a", "b", "no")], schemas.MESSAGE), 1, marked(spark), cfg)
    assert glob.glob(f"{tmp_dir}/log/*/batch_id=1") == []


def test_restart_counts_nothing_twice(spark, tmp_dir):
    for n in range(4):
        source = deliver(spark, tmp_dir, [("a", f"r{n}", "it is")])
    seen = []

    def killed(query, batch):
        seen.append((query, batch))
        if batch == 1 and len(seen) < 3:
            raise RuntimeError("killed")

    for start in (S.start_monitor, S.start_strikes):
        seen.clear()
        cfg = config(tmp_dir, after_batch=killed)
        with pytest.raises(StreamingQueryException, match="killed"):
            start(spark, source, marked(spark), cfg).awaitTermination()
        start(spark, source, marked(spark), cfg).awaitTermination()
        assert [b for _, b in seen] == [0, 1, 1, 2, 3]  # batch 1 is run again
    assert spark.read.parquet(f"{tmp_dir}/log").where("employee_id = 'a'").count() == 4
    assert counts(spark, config(tmp_dir)) == {"a": 4, "r0": 1, "r1": 1, "r2": 1, "r3": 1}


def test_jobs_and_stream_share_the_table(spark, tmp_dir):
    """A cool-down between two batches, run twice, and a reset of the checkpoint after a rewrite."""
    cfg = config(tmp_dir)
    S.init_strikes(spark, cfg, spark.createDataFrame([("a", 10.0, *[None] * 10, 8, False), ("x", None, *[None] * 10, None, True)],
                                                     schemas.STRIKES))
    S.start_strikes(spark, deliver(spark, tmp_dir, [("a", "b", "is"), ("a", "c", "is")]), marked(spark), cfg).awaitTermination()
    assert counts(spark, cfg) == {"a": 10, "b": 1, "c": 1, "x": 0}
    for _ in range(2):
        S.rewrite_strikes(spark, cfg, "cooldown:1", K.cooldown)
    assert counts(spark, cfg) == {"a": 10, "b": 0, "c": 0, "x": 0}  # a stays inactive
    S.start_strikes(spark, deliver(spark, tmp_dir, [("b", "d", "is")]), marked(spark), cfg).awaitTermination()
    assert counts(spark, cfg) == {"a": 10, "b": 1, "c": 0, "d": 1, "x": 0}
    S.rewrite_strikes(spark, cfg, "before-reset", lambda t: t)
    cfg.checkpoint = f"{tmp_dir}/ck2"
    S.start_strikes(spark, deliver(spark, tmp_dir, [("d", "e", "is")], "in2"), marked(spark), cfg).awaitTermination()
    assert counts(spark, cfg) == {"a": 10, "b": 1, "c": 0, "d": 2, "e": 1, "x": 0}


def test_concurrent_rewrite_starts_again(spark, tmp_dir):
    cfg = config(tmp_dir)
    S.init_strikes(spark, cfg, spark.createDataFrame([("a", 1.0, *[None] * 10, 1, False)], schemas.STRIKES))
    calls = []

    def change(table):
        calls.append(1)
        if len(calls) == 1:  # another job commits in between
            S.rewrite_strikes(spark, cfg, "other", lambda t: t.withColumn("salary", F.lit(2.0)))
        return table.withColumn("no_of_strikes", F.col("no_of_strikes") + 1)

    S.rewrite_strikes(spark, cfg, "own", change)
    assert [(r.salary, r.no_of_strikes) for r in S.read_strikes(spark, cfg).collect()] == [(2.0, 2)] and len(calls) == 2
    with pytest.raises(snapshot.ConcurrentCommit):
        snapshot.commit(spark, cfg.strikes_root, spark.range(1), parent=0)


def test_salaries_of_a_batch_open_their_folders_only(spark, tmp_dir):
    import datetime as dt
    cfg = config(tmp_dir, salaries_root=f"{tmp_dir}/salaries", enriched_path=f"{tmp_dir}/enriched", salary_buckets=16)
    start = dt.date(2020, 1, 1)
    history = spark.createDataFrame([(str(i), "DEV", start, None, float(i), "ACTIVE") for i in range(200)], D)
    S.store_salaries(spark, cfg, history)
    found = S.salaries_of(spark, cfg, spark.createDataFrame([("7",), ("7",), ("none",)], "employee_id string"))
    assert rows(found) == [("7", 7.0)]
    filters = [line for line in plan(found).splitlines() if line.startswith("PartitionFilters: [")]
    assert filters and "bucket" in filters[0]
    S.process_batch(spark, spark.createDataFrame([("7", "none", "it is")], schemas.MESSAGE), 0, marked(spark), cfg)
    assert rows(spark.read.parquet(cfg.enriched_path), "employee_id", "salary") == [("7", 7.0), ("none", None)]
    # a refreshed salary reaches the next batch, and fills what the strike table lacks
    S.store_salaries(spark, cfg, history.withColumn("salary", F.col("salary") + 1))
    S.process_batch(spark, spark.createDataFrame([("7", "8", "it is")], schemas.MESSAGE), 1, marked(spark), cfg)
    assert rows(spark.read.parquet(cfg.enriched_path).where("batch_id = 1"), "employee_id", "salary") == [("7", 8.0), ("8", 9.0)]
    S.start_strikes(spark, deliver(spark, tmp_dir, [("7", "none", "is")]), marked(spark), cfg).awaitTermination()
    assert {r.employee_id: (r.salary, r.strike_1) for r in S.read_strikes(spark, cfg).collect()} == {"7": (8.0, 7.2), "none": (None, None)}


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_state_has_one_exchange_and_keeps_its_size(spark, tmp_dir):
    """Many batches over the same employees: the files of a late batch are no larger than those of an early one."""
    cfg = config(tmp_dir)
    for n in range(12):
        source = deliver(spark, tmp_dir, [(f"e{i}", f"f{i}", "it is") for i in range(20)])
    q = S.start_strikes(spark, source, marked(spark), cfg)
    q.awaitTermination()
    assert [b for b, _, _ in S.progress(q)] == list(range(12))
    assert q._jsq.explainInternal(False).count("Exchange hashpartitioning") == 1
    sizes = {}
    for f in glob.glob(f"{cfg.state_checkpoint}/state/0/*/*.changelog"):
        v = int(os.path.basename(f).split(".")[0].split("_")[0])
        sizes[v] = sizes.get(v, 0) + os.path.getsize(f)
    late = [sizes[v] for v in sorted(sizes) if v > 2]
    assert late and max(late) <= 2 * min(late)
    assert set(counts(spark, cfg).values()) == {12}


def test_marked_word_list_is_bounded(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(S, "MARKED_LIMIT", 1)
    words = spark.createDataFrame([("is",), ("it",)], "word string")
    with pytest.raises(StreamingQueryException, match="marked words"):
        S.start_strikes(spark, deliver(spark, tmp_dir, [("a", "b", "it is")]), words, config(tmp_dir)).awaitTermination()
