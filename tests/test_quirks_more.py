import datetime as dt
import os

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from conftest import rows
from hrflow import schemas
from hrflow.operators import leave as L, strikes as K
from hrflow.functions.sequence import next_in_key
from hrflow.streaming.monitor import MonitorConfig, process_batch

D = dt.date


def test_known_employees_any_status_or_active_only(spark):
    # SURVEY Q9
    leave = spark.createDataFrame([("1", D(2024, 1, 8), "ACTIVE"), ("2", D(2024, 1, 8), "ACTIVE")],
                                  "emp_id string, date date, status string")
    tf = spark.createDataFrame([("1", "INACTIVE"), ("2", "ACTIVE"), ("2", "ACTIVE")], "emp_id string, status string")
    assert rows(L.keep_known_employees(leave, tf), "emp_id") == [("1",), ("2",)]
    assert rows(L.keep_known_employees(leave, tf, active_only=True), "emp_id") == [("2",)]


def test_text_ids_survive_quota(spark):
    # SURVEY Q13: IDs such as EMP042 are strings everywhere, so they are not lost
    q = spark.createDataFrame([("EMP042", 20, 2024)], schemas.QUOTA)
    assert rows(L.clean_quota(q)) == [("EMP042", 20, 2024)]


def test_current_salary_latest_open_interval(spark):
    # SURVEY Q31: two ACTIVE rows of one employee -> the latest start wins
    tf = spark.createDataFrame([("1", D(2020, 1, 1), 10.0, "ACTIVE"), ("1", D(2022, 1, 1), 20.0, "ACTIVE"),
                                ("1", D(2023, 1, 1), 30.0, "INACTIVE")],
                               "emp_id string, start_date date, salary double, status string")
    assert rows(K.current_salaries(tf)) == [("1", 20.0)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 50))), min_size=1, max_size=60),
       st.integers(1, 9))
def test_sliced_lead_property(spark, data, width):
    df = spark.createDataFrame([(str(k), o, i) for i, (k, o) in enumerate(data)], "k string, o int, v int")
    a = rows(next_in_key(df, "k", ["o", "v"], "v", "nxt", width=width))
    w = Window.partitionBy("k").orderBy(F.col("o").asc_nulls_first(), "v")
    assert a == rows(df.withColumn("nxt", F.lead("v").over(w)))


def test_kafka_records_through_the_batch(spark, tmp_dir):
    # the Kafka path: key/value bytes are parsed inside the batch
    from hrflow.sinks.kafka import kafka_frame
    msgs = spark.createDataFrame([("1", "2", "that is it"), ("3", "4", "nothing")], schemas.MESSAGE)
    kv = kafka_frame(msgs).selectExpr("CAST(key AS BINARY) AS key", "CAST(value AS BINARY) AS value")
    cfg = MonitorConfig(log_path=os.path.join(tmp_dir, "log"), checkpoint=os.path.join(tmp_dir, "ck"),
                        trigger_seconds=None, kafka_input=True)
    process_batch(spark, kv, 7, spark.createDataFrame([("IS",)], "word string"), cfg)
    log = spark.read.parquet(cfg.log_path)
    assert rows(log, "employee_id", "role", "batch_id") == [("1", "sender", 7), ("2", "receiver", 7)]
