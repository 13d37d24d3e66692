"""K7: publish validated messages to Kafka (key = sender, value = JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.messages import MESSAGE_FIELDS, validate_messages


def kafka_frame(msgs: DataFrame) -> DataFrame:
    """The key/value frame the Kafka sink takes, built from the valid messages."""
    v = validate_messages(msgs)
    return v.select(F.col("sender").cast("string").alias("key"),
                    F.to_json(F.struct(*[F.col(c) for c in MESSAGE_FIELDS])).alias("value"))


def write_kafka(msgs: DataFrame, servers: str, topic: str) -> None:
    """Batch write; needs the Kafka connector jar on the cluster."""
    (kafka_frame(msgs).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
