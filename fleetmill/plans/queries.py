"""The registered queries of the transit engine, on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill import schemas
from fleetmill.functions import classify, geo
from fleetmill.plans import dashboards, gold, silver
from fleetmill.plans import testbed as tb
from fleetmill.streaming import replay


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Columns as rounded doubles, so that two engines' last digits don't matter."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), n) for c, n in digits.items()})


def _api_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Positions folded into poll messages (an hour's reports of a line make one), written as JSON
    text, parsed and flattened again."""
    p = tb.positions(spark, d)
    vehicle = F.struct(
        F.col("vehicle_id").alias("p"), F.col("is_accessible").alias("a"), F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ta"), F.round("latitude", 6).alias("py"), F.round("longitude", 6).alias("px")
    )
    lines = p.groupBy(F.window("event_ts", "1 hour"), "line_code", "line_number", "line_direction").agg(F.collect_list(vehicle).alias("vs"))
    line = F.struct(F.col("line_number").alias("c"), F.col("line_code").alias("cl"), F.col("line_direction").alias("sl"), "vs")
    text = lines.select(F.to_json(F.struct(F.lit("12:00").alias("hr"), F.array(line).alias("l"))).alias("json"))
    parsed = text.select(F.from_json("json", schemas.API_RESPONSE).alias("r")).select("r.l")
    return silver.flatten_positions(parsed).drop("line_direction", "ingestion_timestamp")


def _pos_dedup(spark: SparkSession, d: str) -> DataFrame:
    p = tb.positions(spark, d)
    return silver.dedup_positions(p.unionByName(p.where("event_id % 10 = 0"))).select("vehicle_id", "event_ts", "event_id")


def _line_codes(spark: SparkSession, d: str) -> DataFrame:
    routes = tb.routes(spark, d).select("route_id")
    both = routes.union(tb.read(spark, d, "nation").select("n_name"))
    return both.select("route_id", silver.line_code("route_id").alias("line_code"))


def _haversine(spark: SparkSession, d: str) -> DataFrame:
    n = tb.read(spark, d, "supplier").count()
    near = tb.read(spark, d, "events").select("event_id", ((F.col("user_id") * 31 + F.col("event_id")) % n).cast("string").alias("stop_id"))
    pairs = silver.filter_box(tb.positions(spark, d)).join(near, "event_id").join(tb.stops(spark, d), "stop_id")
    return pairs.select("event_id", F.round(geo.haversine_m(F.col("latitude"), F.col("longitude"), F.col("stop_lat"), F.col("stop_lon")), 3).alias("distance_m"))


def _stop_arrivals(spark: SparkSession, d: str) -> DataFrame:
    found = silver.stop_arrivals(silver.filter_box(tb.positions(spark, d)), tb.stops(spark, d))
    return found.select("vehicle_id", "stop_id", "line_code", "arrival_time", F.round("distance_to_stop_m", 3).alias("distance_to_stop_m"))


def _windows(length: str, mean: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        events = tb.read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
        more = [F.round(F.avg("value"), 6).alias("avg_value")] if mean else []
        out = events.groupBy(F.window("ts", length), "event_type").agg(F.count(F.lit(1)).alias("n"), *more)
        return out.withColumn("window_start", F.col("window.start")).drop("window")

    return run


SPEED = {"avg_speed_kmh": 4, "stddev_speed_kmh": 4, "p10_speed_kmh": 4, "median_speed_kmh": 4, "p90_speed_kmh": 4, "avg_segment_distance_m": 3}
WEEK = (tb.FIRST, tb.LAST)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pos_bounds": lambda s, d: silver.filter_box(tb.positions(s, d)).select("event_id", "vehicle_id", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude")),
        "pos_enriched_left": lambda s, d: silver.with_route(tb.positions(s, d, 30), tb.routes(s, d)).select("event_id", "line_code", "route_short_name", "route_long_name"),
        "pos_dedup": _pos_dedup,
        "time_features": lambda s, d: tb.enriched(s, d).select("event_id", "hour_of_day", "is_weekday", "_event_date", classify.time_period(F.col("hour_of_day")).alias("time_period")),
        "api_flatten": _api_flatten,
        "line_code_extract": _line_codes,
        "haversine_pairs": _haversine,
        "hex_cell": lambda s, d: tb.enriched(s, d).select("event_id", "h3_index"),
        "speed_pairs": lambda s, d: _rounded(tb.speeds(s, d), distance_m=3, speed_kmh=4).select("event_id", "vehicle_id", "distance_m", "time_delta_seconds", "speed_kmh"),
        "speed_hourly": lambda s, d: _rounded(tb.speed_hourly(s, d), **SPEED),
        "congestion_class": lambda s, d: tb.speeds(s, d).select("event_id", classify.congestion(F.col("speed_kmh")).alias("congestion_level")),
        "speed_distribution": lambda s, d: dashboards.speed_distribution(tb.speed_hourly(s, d), *WEEK),
        "speed_trend": lambda s, d: dashboards.speed_trend(tb.speed_hourly(s, d), *WEEK),
        "worst_corridors": lambda s, d: dashboards.worst_corridors(tb.speed_hourly(s, d), *WEEK),
        "congestion_map": lambda s, d: dashboards.congestion_map(tb.speed_hourly(s, d), tb.DAY, f"{tb.DAY} 12:00:00"),
        "headways": lambda s, d: tb.headways(s, d).select("event_id", "headway_seconds"),
        "headway_hourly": lambda s, d: _rounded(tb.headway_hourly(s, d), avg_headway_seconds=4, stddev_headway_seconds=4, headway_cv=5),
        "worst_bunching": lambda s, d: dashboards.worst_bunching(tb.headway_hourly(s, d), *WEEK),
        "severity_distribution": lambda s, d: dashboards.severity_distribution(tb.headway_hourly(s, d), *WEEK),
        "headway_trend_param": lambda s, d: dashboards.headway_trend(tb.headway_hourly(s, d), 1, *WEEK),
        "stop_arrivals_grid": _stop_arrivals,
        "schedule_with_route": lambda s, d: silver.stop_times_table(tb.trip_calls(s, d), tb.trips(s, d)),
        "nearest_schedule": lambda s, d: tb.matched(s, d).select("event_id", "stop_id", "trip_id", "delay_seconds"),
        "on_time_class": lambda s, d: tb.matched(s, d).groupBy("on_time_status").agg(F.count(F.lit(1)).alias("arrivals")),
        "on_time_hourly": lambda s, d: _rounded(tb.on_time_hourly(s, d), avg_delay_seconds=4),
        "on_time_trend": lambda s, d: dashboards.on_time_trend(tb.on_time_hourly(s, d), *WEEK),
        "on_time_worst": lambda s, d: dashboards.on_time_worst(tb.on_time_hourly(s, d), *WEEK),
        "peak_compare": lambda s, d: dashboards.peak_compare(tb.on_time_hourly(s, d), *WEEK),
        "fleet_actual": lambda s, d: gold.actual_fleet(tb.enriched(s, d, 30), tb.DAY),
        "fleet_planned": tb.planned,
        "fleet_utilization": lambda s, d: _rounded(tb.fleet(s, d), utilization_ratio=5),
        "fleet_status": lambda s, d: dashboards.fleet_status(tb.fleet(s, d), tb.DAY),
        "fleet_underserved": lambda s, d: dashboards.fleet_underserved(tb.fleet(s, d), tb.DAY),
        "fleet_trend": lambda s, d: dashboards.fleet_trend(tb.fleet_week(s, d), *WEEK),
        "fleet_full": lambda s, d: dashboards.fleet_full(tb.fleet(s, d), tb.DAY),
        "service_frequency": lambda s, d: gold.service_frequency(tb.enriched(s, d), tb.DAY),
        "census_brackets": lambda s, d: _rounded(silver.census_table(tb.census(s, d)), population_density=4).select("tract_code", "h3_index", "population_density", "income_bracket"),
        "census_hex": lambda s, d: _rounded(gold.census_by_cell(silver.census_table(tb.census(s, d))), avg_income_brl=4, population_density=4),
        "coverage_equity": lambda s, d: _rounded(tb.equity(s, d), population=1, households=1, avg_income_brl=4, population_density=4, vehicles_per_1k_population=5),
        "equity_overview": lambda s, d: dashboards.equity_overview(tb.equity(s, d), tb.DAY),
        "equity_scatter": lambda s, d: _rounded(dashboards.equity_scatter(tb.equity(s, d), tb.DAY), population=1, avg_income_brl=4, vehicles_per_1k_population=5),
        "equity_underserved": lambda s, d: dashboards.equity_underserved(tb.equity(s, d), tb.DAY),
        "equity_by_hour": lambda s, d: _rounded(dashboards.equity_by_hour(tb.equity(s, d), tb.DAY), avg_vehicles_per_1k=5, avg_lines=5),
        "window_5min": _windows("5 minutes"),
        "window_1h": _windows("1 hour", mean=True),
        "stream_dedup_replay": replay.dedup_replay,
        "stream_hourly_replay": replay.hourly_replay,
    }
