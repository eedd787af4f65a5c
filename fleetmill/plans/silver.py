"""Raw messages and static files to clean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmill.config import DEFAULT, Settings
from fleetmill.functions import geo, time
from fleetmill.functions.classify import income_bracket, ratio
from fleetmill.operators.joins import left_lookup, radius_join, radius_join_by_pairs
from fleetmill.operators.sequences import dedup_first


def flatten_positions(responses: DataFrame, ingested: str = "current_timestamp()") -> DataFrame:
    """Polls (one column ``l`` of lines with vehicles) to one row for each vehicle; lines without
    vehicles give none."""
    line = responses.select(F.explode("l").alias("line"))
    vehicle = line.select("line", F.explode("line.vs").alias("v"))
    return vehicle.select(
        F.col("v.p").alias("vehicle_id"),
        F.col("line.cl").alias("line_code"),
        F.col("line.c").alias("line_number"),
        F.col("line.sl").alias("line_direction"),
        F.col("v.py").alias("latitude"),
        F.col("v.px").alias("longitude"),
        F.col("v.a").alias("is_accessible"),
        F.col("v.ta").alias("event_timestamp"),
        F.expr(f"cast({ingested} as string)").alias("ingestion_timestamp"),
    )


def with_lineage(raw: DataFrame) -> DataFrame:
    """Bronze: when and from which file a row came, and the date of its event (null if that isn't
    readable). Needs a file source."""
    day = F.to_date(F.try_to_timestamp("event_timestamp"))
    return raw.select("*", F.current_timestamp().alias("_bronze_ingested_at"), day.alias("_event_date"), F.col("_metadata.file_path").alias("_source_file"))


def parse_timestamps(df: DataFrame) -> DataFrame:
    """Texts to instants; what isn't a timestamp becomes null."""
    parsed = {"event_ts": F.try_to_timestamp("event_timestamp"), "ingestion_ts": F.try_to_timestamp("ingestion_timestamp")}
    return df.withColumns(parsed).drop("event_timestamp", "ingestion_timestamp")


def filter_box(df: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    return df.where(geo.within_box(F.col("latitude"), F.col("longitude"), cfg))


def with_time_features(df: DataFrame, ts: str = "event_ts", cfg: Settings = DEFAULT) -> DataFrame:
    t = F.col(ts)
    return df.withColumns({"hour_of_day": time.local_hour(t, cfg.zone), "is_weekday": time.is_weekday(t, cfg.zone), "_event_date": time.event_date(t)})


def with_route(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Left join to routes by line code; of several routes with one code the first id counts."""
    return left_lookup(df, routes, "line_code", "line_code", ["route_short_name", "route_long_name", "route_type"], ["route_id"])


def enrich(df: DataFrame, routes: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """Parsed, deduplicated positions to the enriched table."""
    out = with_time_features(with_route(filter_box(df, cfg), routes), "event_ts", cfg)
    return out.withColumn("h3_index", geo.hex_cell(F.col("latitude"), F.col("longitude"), cfg))


def dedup_positions(df: DataFrame) -> DataFrame:
    return dedup_first(df, ["vehicle_id", "event_ts"], ["ingestion_ts"])


def stop_matches(positions: DataFrame, stops: DataFrame, cfg: Settings = DEFAULT, grid: bool = True) -> DataFrame:
    """Positions within the radius of stops; ``route_id`` is taken from stops that have it. Positions
    outside the configured box, for which the grid's steps would be too small, match nothing."""
    positions = filter_box(positions, cfg)
    if "route_id" not in stops.columns:
        stops = stops.withColumn("route_id", F.lit(None).cast("string"))
    stops = stops.select("stop_id", "route_id", "stop_lat", "stop_lon")
    slim = positions.select("vehicle_id", "line_code", "latitude", "longitude", "event_ts")
    if grid:
        return radius_join(slim, stops, cfg.stop_radius_m, ("latitude", "longitude"), ("stop_lat", "stop_lon"), max(abs(cfg.lat_min), abs(cfg.lat_max)), "distance_to_stop_m")
    return radius_join_by_pairs(slim, stops, cfg.stop_radius_m, ("latitude", "longitude"), ("stop_lat", "stop_lon"), "distance_to_stop_m")


def arrival_candidates(positions: DataFrame, stops: DataFrame, cfg: Settings = DEFAULT, grid: bool = True) -> DataFrame:
    near = stop_matches(positions, stops, cfg, grid).withColumnRenamed("event_ts", "arrival_time").withColumn("_event_date", time.event_date(F.col("arrival_time")))
    return near.select("vehicle_id", "stop_id", "route_id", "line_code", "arrival_time", "latitude", "longitude", "distance_to_stop_m", "_event_date")


def stop_arrivals(positions: DataFrame, stops: DataFrame, cfg: Settings = DEFAULT, grid: bool = True) -> DataFrame:
    """One arrival for each vehicle, stop and dedup window: the earliest, nearest."""
    return dedup_first(arrival_candidates(positions, stops, cfg, grid), ["vehicle_id", "stop_id", F.window("arrival_time", cfg.dedup_window)], ["arrival_time", "distance_to_stop_m", "route_id"])


def stop_entries(positions: DataFrame, stops: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """Arrivals as transitions: a vehicle near a stop that wasn't near it at its previous report."""
    near = stop_matches(positions, stops, cfg).groupBy("vehicle_id", "event_ts", "stop_id").agg(F.min("distance_to_stop_m").alias("distance_to_stop_m"))
    numbered = positions.select("vehicle_id", "event_ts").distinct().withColumn("_n", F.expr("row_number() over (partition by vehicle_id order by event_ts)"))
    seen = near.join(numbered, ["vehicle_id", "event_ts"])
    gap = seen.withColumn("_inside", F.lit(True)).withColumn("_last", F.expr("lag(_n) over (partition by vehicle_id, stop_id order by _n)"))
    return gap.where("_last is null or _last < _n - 1").drop("_n", "_last", "_inside")


def line_code(route_id: str | F.Column) -> F.Column:
    """The first run of digits as a number, null if there is none."""
    return F.regexp_extract(route_id, r"(\d+)", 1).try_cast("int")


def routes_table(routes: DataFrame) -> DataFrame:
    return routes.withColumns({"line_code": line_code("route_id"), "_loaded_at": F.current_timestamp()})


def stop_times_table(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Stop times with the route of their trip."""
    return stop_times.join(trips.select("trip_id", "route_id"), "trip_id")


def census_table(census: DataFrame, cfg: Settings = DEFAULT, municipality: str | None = None) -> DataFrame:
    """Tracts of one municipality with their cell, density and income bracket."""
    own = census.where(F.col("municipality_code") == (municipality or cfg.municipality))
    return own.withColumns({
        "h3_index": geo.hex_cell(F.col("centroid_lat"), F.col("centroid_lon"), cfg),
        "population_density": ratio(F.col("population"), F.col("area_km2")),
        "income_bracket": income_bracket(F.col("avg_income_brl")),
    })


