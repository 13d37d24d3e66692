"""K5: JDBC sink (overwrite a staging table).

No database is started by this repository; the function is for clusters that have
one. Without a database the staging table is a snapshot version (``sinks.snapshot``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "overwrite", batch_size: int = 10000) -> None:
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
          .option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
