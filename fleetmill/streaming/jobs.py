"""The streaming jobs: bronze, silver and stop arrivals as appends, gold by recomputing the days that
a batch touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill import schemas
from fleetmill.config import DEFAULT, Settings
from fleetmill.plans import gold, silver
from fleetmill.sources.files import json_stream
from fleetmill.streaming.sinks import append_stream, batch_writer, each_batch, recompute_touched


def bronze(spark: SparkSession, source: str, target: str, checkpoint: str, cfg: Settings = DEFAULT, once: bool = True):
    """JSON lines to the raw table, with lineage."""
    return append_stream(silver.with_lineage(json_stream(spark, source)), target, checkpoint, "bronze", None if once else cfg.silver_trigger)


def silver_rows(raw: DataFrame, routes: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """Raw to enriched positions on a stream: the box comes before the state, so rows outside need
    none; a repeated (vehicle, time) within the watermark is dropped, as are late rows."""
    parsed = silver.filter_box(silver.parse_timestamps(raw), cfg).withWatermark("event_ts", cfg.positions_watermark)
    out = silver.enrich(parsed.dropDuplicatesWithinWatermark(["vehicle_id", "event_ts"]), routes, cfg)
    return out.select(*[c.split()[0] for c in schemas.ENRICHED_POSITIONS.split(", ")])


def silver_positions(spark: SparkSession, bronze_path: str, routes: DataFrame, target: str, checkpoint: str, cfg: Settings = DEFAULT, once: bool = True):
    raw = spark.readStream.schema(schemas.RAW_POSITIONS).parquet(bronze_path)
    return append_stream(silver_rows(raw, routes, cfg), target, checkpoint, "silver_positions", None if once else cfg.silver_trigger)


def arrivals_rows(positions: DataFrame, stops: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """Arrivals on a stream: the earliest, nearest report of each vehicle, stop and window, given out
    once the watermark has passed the window; later rows are dropped."""
    near = silver.arrival_candidates(positions, stops, cfg).withWatermark("arrival_time", cfg.arrivals_watermark)
    first = F.min_by(F.struct(*[c for c in near.columns if c not in ("vehicle_id", "stop_id")]), F.struct("arrival_time", "distance_to_stop_m", "route_id"))
    got = near.groupBy("vehicle_id", "stop_id", F.window("arrival_time", cfg.dedup_window)).agg(first.alias("first"))
    return got.select("vehicle_id", "stop_id", "first.*").select(*[c.split()[0] for c in schemas.STOP_ARRIVALS.split(", ")])


def stop_arrivals(spark: SparkSession, positions_path: str, stops: DataFrame, target: str, checkpoint: str, cfg: Settings = DEFAULT, once: bool = True):
    """Appends only, so that the jobs that read arrivals as a stream never lose a file."""
    stream = spark.readStream.schema(schemas.ENRICHED_POSITIONS).parquet(positions_path)
    return append_stream(arrivals_rows(stream, stops, cfg), target, checkpoint, "stop_arrivals", None if once else cfg.gold_trigger)


def speed(spark: SparkSession, positions_path: str, target: str, checkpoint: str, cfg: Settings = DEFAULT, once: bool = True):
    stream = spark.readStream.schema(schemas.ENRICHED_POSITIONS).parquet(positions_path)
    handle = recompute_touched(positions_path, target, lambda df: gold.speed_hourly(gold.instantaneous_speed(df, cfg), cfg), "event_ts", schemas.ENRICHED_POSITIONS)
    return each_batch(stream, handle, checkpoint, "speed_congestion", None if once else cfg.gold_trigger)


def headway(spark: SparkSession, arrivals_path: str, target: str, checkpoint: str, cfg: Settings = DEFAULT, once: bool = True):
    stream = spark.readStream.schema(schemas.STOP_ARRIVALS).parquet(arrivals_path)
    handle = recompute_touched(arrivals_path, target, lambda df: gold.headway_metrics(gold.headways(df, cfg), cfg), "arrival_time", schemas.STOP_ARRIVALS)
    return each_batch(stream, handle, checkpoint, "headway_regularity", None if once else cfg.gold_trigger)


def on_time(spark: SparkSession, arrivals_path: str, stop_times: DataFrame, target: str, checkpoint: str, cfg: Settings = DEFAULT, once: bool = True):
    stream = spark.readStream.schema(schemas.STOP_ARRIVALS).parquet(arrivals_path)
    handle = recompute_touched(arrivals_path, target, lambda df: gold.on_time_hourly(gold.match_schedule(df, stop_times, cfg), cfg), "arrival_time", schemas.STOP_ARRIVALS)
    return each_batch(stream, handle, checkpoint, "on_time_performance", None if once else cfg.gold_trigger)


def raw_batches(stream: DataFrame, target: str, checkpoint: str, name: str):
    """Any stream, each batch into a folder of its own."""
    return each_batch(stream, batch_writer(target, name), checkpoint, name)
