"""S11: the message stream.

On a cluster the stream is the Kafka topic (``stream_kafka``); the connector jar is
supplied by the deployment. Tests and the registered queries use the file source over
JSON-lines files with the same schema (``stream_json_files``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import MESSAGE


def stream_kafka(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Raw Kafka records (``key``, ``value`` bytes, ...); parse with ``parse_messages``."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    return (r if max_offsets_per_trigger is None else r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)).load()


def stream_json_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                      schema=MESSAGE) -> DataFrame:
    """Parsed messages from JSON-lines files arriving in ``path``."""
    r = spark.readStream.schema(schema)
    return (r if max_files_per_trigger is None else r.option("maxFilesPerTrigger", max_files_per_trigger)).json(path)
