"""Command line: run one job of the job order, or start the message stream.

    python -m hrflow yearly  --root s3a://bucket --run-date 2024-01-01
    python -m hrflow daily   --root s3a://bucket --run-date 2024-03-01
    python -m hrflow monthly --root s3a://bucket --run-date 2024-03-01
    python -m hrflow stream  --root s3a://bucket --words marked_words.json \\
        (--kafka host:9092 --topic employee-messages | --inbox s3a://bucket/bronze/messages)

Submit with ``spark-submit -m``-style launchers or ``python -m`` on a node that has a
Spark session; master and resources come from the usual Spark configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import jobs
from .session import ensure_defaults


def main(argv=None):
    ap = argparse.ArgumentParser(prog="hrflow")
    ap.add_argument("job", choices=["yearly", "daily", "monthly", "stream"])
    ap.add_argument("--root", required=True, help="root of the bronze/silver/gold layout")
    ap.add_argument("--run-date", help="YYYY-MM-DD")
    ap.add_argument("--run-ts", help="ingest time stamp, default <run-date> 07:00:00")
    ap.add_argument("--words", help="JSON array file(s) of marked words (stream)")
    ap.add_argument("--kafka", help="bootstrap servers (stream)")
    ap.add_argument("--topic", default="employee-messages")
    ap.add_argument("--inbox", help="folder of JSON-lines message files (stream, instead of Kafka)")
    ap.add_argument("--trigger-seconds", type=int, default=10)
    ap.add_argument("--max-offsets", type=int, help="intake limit per trigger, default none")
    a = ap.parse_args(argv)

    spark = ensure_defaults(SparkSession.builder.appName(f"hrflow-{a.job}").getOrCreate())
    lay = jobs.Layout(a.root)
    if a.job == "yearly":
        jobs.run_yearly(spark, lay, a.run_date)
    elif a.job == "daily":
        jobs.run_daily(spark, lay, a.run_date, a.run_ts)
    elif a.job == "monthly":
        jobs.run_monthly(spark, lay, a.run_date)
    else:
        from .sources.files import read_json_string_array
        from .sources.stream import stream_json_files, stream_kafka
        from .streaming.monitor import start_monitor, start_strikes
        words = read_json_string_array(spark, a.words)
        if a.kafka:
            source = stream_kafka(spark, a.kafka, a.topic, max_offsets_per_trigger=a.max_offsets)
        else:
            source = stream_json_files(spark, a.inbox)
        cfg = jobs.monitor_config(lay, a.trigger_seconds, kafka_input=bool(a.kafka))
        start_strikes(spark, source, words, cfg)
        start_monitor(spark, source, words, cfg)
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
