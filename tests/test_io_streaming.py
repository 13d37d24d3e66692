import json
import os
import random

from pyspark.sql import functions as F

from conftest import rows
from hrflow import schemas
from hrflow.sinks import files as SF, snapshot
from hrflow.sources import files as SRC
from hrflow.sources.stream import stream_json_files

MSG = "sender string, receiver string, message string"


def test_headerless_csv_header_becomes_null_row(spark, tmp_dir):
    p = os.path.join(tmp_dir, "cal")
    os.makedirs(p)
    with open(os.path.join(p, "c.csv"), "w") as f:
        f.write("reason,date\nNew Year,2024-01-01\n")
    df = SRC.read_csv_headerless(spark, p, schemas.CALENDAR)
    assert sorted(r.reason for r in df.filter(F.col("date").isNull()).collect()) == ["reason"]


def test_json_string_array_file(spark, tmp_dir):
    p = os.path.join(tmp_dir, "w.json")
    with open(p, "w") as f:
        f.write('[\n  "THAT",\n  "FOR"\n]\n')
    assert rows(SRC.read_json_string_array(spark, p)) == [("FOR",), ("THAT",)]


def test_json_objects_file(spark, tmp_dir):
    p = os.path.join(tmp_dir, "m.json")
    with open(p, "w") as f:
        f.write('[{"sender": "EMP042", "receiver": "EMP099", "message": "x"},\n {"sender": "a"}]')
    assert rows(SRC.read_json_objects(spark, p, schemas.MESSAGE)) == [("EMP042", "EMP099", "x"), ("a", None, None)]


def test_one_json_array_is_read_by_many_tasks(spark, tmp_dir):
    rng = random.Random(3)
    text = lambda: "".join(rng.choice(list('ab,,{}[]":\\\n é')) for _ in range(rng.randint(0, 40)))
    objects = [{"sender": text(), "receiver": text(), "message": text() * rng.choice((1, 1, 30))} for _ in range(200)]
    words = [text() for _ in range(300)] + [None, "", ","]
    both = {"o.json": objects, "w.json": words, "one.json": objects[0], "none.json": [], "blank.json": None}
    for name, value in both.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("" if value is None else json.dumps(value, indent=rng.choice((None, 1)), ensure_ascii=name == "w.json"))
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, "300")
    try:
        at = lambda name: os.path.join(tmp_dir, name)
        assert spark.read.option("lineSep", ",").text(at("o.json")).rdd.getNumPartitions() > 20
        want = sorted((o["sender"], o["receiver"], o["message"]) for o in objects)
        assert rows(SRC.read_json_objects(spark, at("o.json"), MSG)) == want
        assert rows(SRC.read_json_objects(spark, at("one.json"), MSG)) == [tuple(objects[0].values())]
        got = [r.word for r in SRC.read_json_string_array(spark, at("w.json")).collect()]
        assert sorted(got, key=str) == sorted(words, key=str)
        for name in ("none.json", "blank.json"):
            assert rows(SRC.read_json_string_array(spark, at(name))) == []
    finally:
        spark.conf.set(key, old)


def test_read_or_empty_only_catches_missing_path(spark, tmp_dir):
    df = SRC.read_or_empty(spark, os.path.join(tmp_dir, "nope"), schemas.QUOTA)
    assert df.count() == 0 and df.schema == schemas.QUOTA


def test_rerun_replaces_partition(spark, tmp_dir):
    p = os.path.join(tmp_dir, "emp")
    df = spark.createDataFrame([("1", "a", "30")], "emp_id string, name string, age string")
    SF.append_run_partition(df, p, "2024-01-02")
    SF.append_run_partition(df, p, "2024-01-02")
    SF.append_run_partition(df, p, "2024-01-03")
    assert spark.read.parquet(p).count() == 2


def test_snapshot_commit_and_crash_safety(spark, tmp_dir):
    root = os.path.join(tmp_dir, "snap")
    a = spark.createDataFrame([("1", 1)], "employee_id string, n int")
    assert snapshot.commit(spark, root, a, "b0") == 0
    assert snapshot.is_applied(spark, root, "b0")
    # a folder that no log entry names does not count
    a.write.parquet(os.path.join(root, "data-crashed"))
    assert snapshot.current_version(spark, root) == 0
    assert snapshot.commit(spark, root, a.withColumn("n", F.lit(2)), "b1") == 1
    assert snapshot.read_current(spark, root).first().n == 2


def _stream_setup(spark, tmp_dir, n_files=3):
    inbox = os.path.join(tmp_dir, "inbox")
    msgs = spark.createDataFrame([(str(i), str(i + 1), "that is it" if i % 2 else "nothing") for i in range(30)], MSG)
    msgs.repartition(n_files).write.json(inbox)
    words = spark.createDataFrame([("IS",)], "word string")
    return inbox, msgs, words


def test_ledger_high_water_mark(spark, tmp_dir):
    root = os.path.join(tmp_dir, "led")
    a = spark.createDataFrame([("1", 1)], "employee_id string, n int")
    snapshot.commit(spark, root, a, "mon:ck:0")
    snapshot.commit(spark, root, a, "mon:ck:1")
    snapshot.commit(spark, root, a, "sync:2024-03-01")
    assert snapshot.is_applied(spark, root, "mon:ck:0") and snapshot.is_applied(spark, root, "mon:ck:1")
    assert not snapshot.is_applied(spark, root, "mon:ck:2") and not snapshot.is_applied(spark, root, "mon:other:0")
    assert snapshot.is_applied(spark, root, "sync:2024-03-01") and not snapshot.is_applied(spark, root, "sync:2024-03-02")
    entry = snapshot.read_entry(spark, root, snapshot.current_version(spark, root))
    assert entry["keys"] == ["sync:2024-03-01"] and entry["high"] == {"mon:ck": 1}


def test_no_local_fallback_on_a_cluster(monkeypatch):
    import pytest
    from types import SimpleNamespace as N
    from hrflow import session
    sc = N(getCheckpointDir=lambda: None, master="yarn", getConf=lambda: N(get=lambda k, d=None: None))
    with pytest.raises(RuntimeError):
        session.checkpoint_root(N(sparkContext=sc, conf=N(get=lambda k, d=None: None)))


def test_read_or_empty_raises_other_errors(spark, tmp_dir):
    import pytest
    p = os.path.join(tmp_dir, "q")
    spark.createDataFrame([("1", 20, 2024)], schemas.QUOTA).write.parquet(p)
    with pytest.raises(Exception) as e:
        SRC.read_or_empty(spark, p, schemas.QUOTA, fmt="no.such.format").collect()
    assert "PATH_NOT_FOUND" not in str(e.value)
