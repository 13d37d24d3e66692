"""hrflow: workforce batch and streaming analytics as plain Spark DataFrame operators.

Sub-packages:
    sources    readers (CSV, Parquet, JSON, optional inputs, date spines, streams)
    sinks      writers (partitioned Parquet, CSV, text alerts, Kafka frames, snapshots)
    functions  reusable Column expressions (lenient casts, calendar, tokens, ladder)
    operators  DataFrame -> DataFrame operators (history, leave, reports, messages, strikes)
    streaming  Structured Streaming jobs (flag log, strike state, file ingest)
    plans      job order and the registered queries with their SQL oracles
"""

__all__ = ["sources", "sinks", "functions", "operators", "streaming", "plans"]
