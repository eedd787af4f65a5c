"""Batch tables replayed as streams, to hold the streaming jobs against batch plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.config import DEFAULT
from fleetmill.functions import time
from fleetmill.plans import gold, silver
from fleetmill.plans import testbed as tb
from fleetmill.streaming.sinks import append_stream, each_batch, recompute_touched


def _folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        base = "file://" + tempfile.gettempdir()
    return f"{base.rstrip('/')}/fleetmill-replay-{uuid.uuid4().hex}"


def dedup_replay(spark: SparkSession, d: str) -> DataFrame:
    """Positions, every tenth twice, through the streaming deduplication. Rows of one source file
    are dealt by time, so none is late."""
    top = _folder(spark)
    p = tb.positions(spark, d)
    p.unionByName(p.where("event_id % 10 = 0")).write.parquet(f"{top}/in")
    stream = spark.readStream.schema(p.schema).parquet(f"{top}/in")
    kept = silver.filter_box(stream).withWatermark("event_ts", DEFAULT.positions_watermark).dropDuplicatesWithinWatermark(["vehicle_id", "event_ts"])
    out = kept.select("vehicle_id", "event_ts", "event_id", time.event_date(F.col("event_ts")).alias("_event_date"))
    append_stream(out, f"{top}/out", f"{top}/check", f"dedup_{uuid.uuid4().hex}").awaitTermination()
    return spark.read.schema("vehicle_id string, event_ts timestamp, event_id long").parquet(f"{top}/out").drop("_event_date")


def hourly_replay(spark: SparkSession, d: str) -> DataFrame:
    """Hourly speeds by recomputing touched days, from positions that arrive in three batches."""
    top = _folder(spark)
    rows = tb.enriched(spark, d)
    for part in range(3):  # three files, one for each batch
        rows.where(F.pmod("event_id", F.lit(3)) == part).write.mode("append").parquet(f"{top}/silver")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{top}/silver")
    ddl = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    compute = lambda df: gold.speed_hourly(gold.instantaneous_speed(df, order=("event_ts", "event_id")))
    # the testbed's vehicles may rest for days: the previous report can be any time before
    handle = recompute_touched(f"{top}/silver", f"{top}/gold", compute, "event_ts", ddl, 100)
    each_batch(stream, handle, f"{top}/check", f"hourly_{uuid.uuid4().hex}").awaitTermination()
    out = spark.read.parquet(f"{top}/gold").withColumn("_event_date", F.col("_event_date").cast("string"))
    return out.select("window_start", "window_end", "h3_index", "line_code", "line_number", "time_period", "is_weekday", "_event_date", "observation_count", F.round("avg_speed_kmh", 4).alias("avg_speed_kmh"), "congestion_level")
