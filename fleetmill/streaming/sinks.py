"""Sinks that survive retries."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_stream(df: DataFrame, path: str, checkpoint: str, name: str, trigger: str | None = None, partition: str = "_event_date") -> StreamingQuery:
    """Appends to a Parquet table partitioned by date; without a trigger it takes what is there and
    ends."""
    writer = df.writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint).option("path", path).format("parquet").partitionBy(partition)
    return writer.trigger(**({"processingTime": trigger} if trigger else {"availableNow": True})).start()


def each_batch(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, name: str, trigger: str | None = None) -> StreamingQuery:
    """Calls ``handle`` with each batch that has rows."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            handle(batch, batch_id)

    writer = df.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(run)
    return writer.trigger(**({"processingTime": trigger} if trigger else {"availableNow": True})).start()


def batch_writer(path: str, query: str) -> Callable[[DataFrame, int], None]:
    """Writes a batch into a folder of its own, which a repeated call replaces: a batch that runs
    again after a failure leaves no rows twice."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/query={query}/batch={batch_id}")

    return handle


def replace_partitions(df: DataFrame, path: str, partition: str = "_event_date") -> None:
    """Overwrites exactly the partitions that ``df`` has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def recompute_touched(silver_path: str, gold_path: str, compute: Callable[[DataFrame], DataFrame], ts: str, schema: str, lookback_days: int = 1) -> Callable[[DataFrame, int], None]:
    """Gold from whole days: for the dates in a batch and the day after each (whose first rows have
    their previous ones there), silver is read again, with the days before for the previous row of
    each key, the metric computed and those dates replaced. Only these days are read, so a late row
    costs its own days. Silver appends, so a day never loses rows. Whatever the batches, the result
    is that of one batch over all rows."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        dates = [date.fromisoformat(r[0]) for r in batch.select("_event_date").distinct().collect()]  # the days of one batch
        touched = {d + timedelta(days=k) for d in dates for k in (0, 1)}
        read = {d - timedelta(days=k) for d in touched for k in range(lookback_days + 1)}
        own = spark.read.schema(schema).parquet(silver_path).where(F.col("_event_date").isin(sorted(map(str, read))))
        replace_partitions(compute(own).where(F.col("_event_date").isin(sorted(map(str, touched)))), gold_path)

    return handle
