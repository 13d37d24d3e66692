"""Message monitoring stream: two streaming queries over one source.

The log query flags each micro-batch and writes its strike events to the partition
``query_id=Q/batch_id=N`` (overwrite, so a replay replaces instead of doubling), with the current
salaries beside it where ``enriched_path`` is set. A batch without hits ends there.

The strike query counts strikes per employee in Spark's own streaming state: a keyed aggregation
in update mode on the RocksDB state store with changelog checkpoints, so a batch writes what it
changed and takes the same time whatever has passed before. Its state is the product; the strike
table is the stored table with the strikes counted since (``read_strikes``, over Spark's state
reader). The stored table remembers per employee how many strikes of the state it holds, so jobs
that rewrite it (salary sync, cool-down) and the stream never write the same thing and the stream
needs no ledger. Both queries restart from their checkpoints.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions import word_tokens
from ..operators.messages import flag_messages, normalized_words, parse_messages, strike_events
from ..operators.strikes import current_salaries, penalize_and_deactivate, upsert_strikes
from ..schemas import STRIKES
from ..sinks import snapshot
from .ingest import query_id

#: Most marked words that the strike query's filter holds in one row; the list is configuration, not data.
MARKED_LIMIT = 100_000
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: The stored strike table: strikes of the state of query ``counted_by`` that its counts include.
STORED = T.StructType(STRIKES.fields + [T.StructField("counted", T.LongType()), T.StructField("counted_by", T.StringType())])
SALARIES = T.StructType([T.StructField("employee_id", T.StringType()), T.StructField("salary", T.DoubleType()),
                         T.StructField("bucket", T.LongType())])


@dataclass
class MonitorConfig:
    log_path: str                         # flag log, by query_id and batch_id
    checkpoint: str                       # streaming checkpoint folder of the log query
    strikes_root: str | None = None       # stored strike table (a snapshot); the state comes on top
    salaries_root: str | None = None      # current salaries (a snapshot, see store_salaries)
    enriched_path: str | None = None      # strike events with current salary (T3)
    trigger_seconds: int | None = 10      # None = availableNow (process what is there, stop)
    name: str = "message-monitor"
    kafka_input: bool = False             # input rows are Kafka records (value bytes)
    salary_buckets: int = 64              # folders of the salary table
    after_batch: Callable[[str, int], None] | None = None  # called with query and batch before a batch commits

    @property
    def state_checkpoint(self) -> str:
        return f"{self.checkpoint.rstrip('/')}-strikes"


# current salaries ---------------------------------------------------------------------
def _bucket(cfg: MonitorConfig):
    return F.pmod(F.xxhash64("employee_id"), F.lit(cfg.salary_buckets))


def store_salaries(spark: SparkSession, cfg: MonitorConfig, timeframe: DataFrame) -> None:
    """The current salary of each active employee as a small table in ``salary_buckets`` folders; the
    daily job refreshes it, so that the stream reads no history."""
    table = current_salaries(timeframe).withColumn("bucket", _bucket(cfg))
    snapshot.commit(spark, cfg.salaries_root, table.repartition(cfg.salary_buckets, "bucket"), partition_by=["bucket"])


def salaries_of(spark: SparkSession, cfg: MonitorConfig, employees: DataFrame) -> DataFrame | None:
    """Stored salaries of a micro-batch's employees: only their folders are listed and read."""
    stored = snapshot.read_current(spark, cfg.salaries_root, SALARIES) if cfg.salaries_root else None
    if stored is None:
        return None
    asked = employees.select("employee_id").distinct().withColumn("bucket", _bucket(cfg))
    folders = [r[0] for r in asked.select("bucket").distinct().collect()]  # at most salary_buckets
    return (stored.where(F.col("bucket").isin(folders)).join(asked, ["bucket", "employee_id"], "left_semi")
            .select("employee_id", "salary"))


# log query ------------------------------------------------------------------------------
def process_batch(spark: SparkSession, batch: DataFrame, batch_id: int, words: DataFrame,
                  cfg: MonitorConfig, flagged_at=None) -> None:
    msgs = parse_messages(batch) if cfg.kafka_input else batch
    ts = flagged_at if flagged_at is not None else F.current_timestamp().cast("timestamp_ntz")
    events = strike_events(flag_messages(msgs, words), ts).persist()
    try:
        if not events.isEmpty():
            part = f"query_id={query_id(spark, cfg.checkpoint)}/batch_id={batch_id}"
            events.write.mode("overwrite").parquet(f"{cfg.log_path}/{part}")
            salaries = salaries_of(spark, cfg, events) if cfg.enriched_path is not None else None
            if salaries is not None:
                events.join(salaries, "employee_id", "left").write.mode("overwrite").parquet(f"{cfg.enriched_path}/{part}")
    finally:
        events.unpersist()
    if cfg.after_batch is not None:
        cfg.after_batch("log", batch_id)


def _triggered(writer, cfg: MonitorConfig):
    if cfg.trigger_seconds is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{cfg.trigger_seconds} seconds")


def start_monitor(spark: SparkSession, source: DataFrame, words: DataFrame, cfg: MonitorConfig):
    """Start the log query; ``words`` is the marked-word list (a static frame)."""
    def fn(batch, batch_id):
        process_batch(spark, batch, batch_id, words, cfg)

    w = source.writeStream.foreachBatch(fn).option("checkpointLocation", cfg.checkpoint).queryName(cfg.name)
    return _triggered(w, cfg).start()


# strike query ---------------------------------------------------------------------------
def strike_totals_stream(source: DataFrame, words: DataFrame, cfg: MonitorConfig) -> DataFrame:
    """Strikes per employee as a streaming aggregation.

    The marked words are one row of at most ``MARKED_LIMIT`` words that Spark broadcasts to the
    narrow filter, so the only exchange is the state's, by employee.
    """
    marked = normalized_words(words).agg(F.collect_set("word").alias("marked")).withColumn(
        "marked", F.when(F.size("marked") <= MARKED_LIMIT, F.col("marked"))
        .otherwise(F.raise_error(F.lit(f"more than {MARKED_LIMIT} marked words")).cast("array<string>")))
    msgs = parse_messages(source) if cfg.kafka_input else source
    hits = msgs.join(F.broadcast(marked)).where(F.arrays_overlap(word_tokens("message"), "marked"))
    return strike_events(hits).groupBy("employee_id").agg(F.count(F.lit(1)).alias("total"))


def start_strikes(spark: SparkSession, source: DataFrame, words: DataFrame, cfg: MonitorConfig):
    """Start the strike query; its result is its state. The number of state partitions is
    ``spark.sql.shuffle.partitions`` at the first start."""
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    w = strike_totals_stream(source, words, cfg).writeStream.outputMode("update")
    if cfg.after_batch is None:
        w = w.format("noop")
    else:
        def fn(batch, batch_id):
            batch.write.format("noop").mode("overwrite").save()  # runs the aggregation
            cfg.after_batch("strikes", batch_id)
        w = w.foreachBatch(fn)
    return _triggered(w.option("checkpointLocation", cfg.state_checkpoint).queryName(f"{cfg.name}-strikes"), cfg).start()


def progress(query) -> list[tuple[int, int, int]]:
    """(batch, input rows, milliseconds) of the batches of a query's recent progress."""
    return [(p["batchId"], p["numInputRows"], p["durationMs"].get("triggerExecution", 0)) for p in query.recentProgress]


def _committed_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """Newest committed batch of a checkpoint (Spark keeps the last hundred or so commits)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return max((int(n) for n in names if n.isdigit()), default=None)


def started(spark: SparkSession, cfg: MonitorConfig) -> bool:
    """Whether the strike query has committed a batch."""
    return _committed_batch(spark, cfg.state_checkpoint) is not None


def strike_totals(spark: SparkSession, cfg: MonitorConfig) -> DataFrame:
    """Strikes per employee (``employee_id, total``) in the state as of the newest committed batch; one
    batch whatever the stream does meanwhile."""
    n = _committed_batch(spark, cfg.state_checkpoint)
    if n is None:
        return spark.createDataFrame([], "employee_id string, total long")
    state = spark.read.format("statestore").option("batchId", n).load(cfg.state_checkpoint)
    return state.select(F.col("key.employee_id").alias("employee_id"), F.col("value").getField("count").alias("total"))


def _stored(spark: SparkSession, cfg: MonitorConfig) -> DataFrame:
    return snapshot.read_current(spark, cfg.strikes_root, STORED)


def _with_new_strikes(spark: SparkSession, cfg: MonitorConfig, stored: DataFrame, totals: DataFrame) -> DataFrame:
    """The stored table plus the strikes counted since it was written (J30-J32)."""
    inside = stored.where(F.col("counted_by") == query_id(spark, cfg.state_checkpoint)).select("employee_id", "counted")
    new = totals.join(inside, "employee_id", "left").select(
        "employee_id", (F.col("total") - F.coalesce("counted", F.lit(0))).alias("strike_count")).where("strike_count > 0")
    salaries = snapshot.read_current(spark, cfg.salaries_root, SALARIES) if cfg.salaries_root else None
    return penalize_and_deactivate(upsert_strikes(stored.select(*STRIKES.fieldNames()), new, salaries))


def read_strikes(spark: SparkSession, cfg: MonitorConfig) -> DataFrame:
    """The strike table as of now; a missing stored salary is filled from the current salaries."""
    return _with_new_strikes(spark, cfg, _stored(spark, cfg), strike_totals(spark, cfg))


def init_strikes(spark: SparkSession, cfg: MonitorConfig, table: DataFrame) -> None:
    """Store ``table`` as the strike table if there is none."""
    if snapshot.current_version(spark, cfg.strikes_root) is None:
        none = F.lit(None)
        snapshot.commit(spark, cfg.strikes_root, table.select(
            *STRIKES.fieldNames(), none.cast("long").alias("counted"), none.cast("string").alias("counted_by")))


def rewrite_strikes(spark: SparkSession, cfg: MonitorConfig, key: str, change: Callable[[DataFrame], DataFrame]) -> None:
    """Store ``change(strike table)`` with the strikes counted so far in it, unless ``key`` was applied.

    The stream may go on: what it counts meanwhile comes on top. Before a checkpoint is reset, a
    rewrite takes over what the old state holds.
    """
    def once():
        parent = snapshot.current_version(spark, cfg.strikes_root)
        if snapshot.is_applied(spark, cfg.strikes_root, key):
            return parent
        totals = strike_totals(spark, cfg)
        table = change(_with_new_strikes(spark, cfg, _stored(spark, cfg), totals))
        own = totals.select("employee_id", F.col("total").alias("counted"),
                            F.lit(query_id(spark, cfg.state_checkpoint)).alias("counted_by"))
        return snapshot.commit(spark, cfg.strikes_root, table.join(own, "employee_id", "left").select(*STORED.fieldNames()),
                               key, parent=parent)

    snapshot.retrying(once)
