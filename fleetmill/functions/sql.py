"""The column functions for SQL texts: temporary functions that the optimizer inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from fleetmill.config import DEFAULT, Settings
from fleetmill.functions.geo import EARTH_M


def register(spark: SparkSession, cfg: Settings = DEFAULT) -> list[str]:
    """Creates ``haversine_m``, ``within_box``, ``local_hour``, ``is_weekday``, ``time_period``,
    ``on_time_status`` and ``congestion``; returns their names."""
    bodies = {
        "haversine_m": (
            "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE",
            "DOUBLE",
            f"2 * {EARTH_M}D * asin(sqrt(least(1D, pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))",
        ),
        "within_box": ("lat DOUBLE, lon DOUBLE", "BOOLEAN", f"lat BETWEEN {cfg.lat_min}D AND {cfg.lat_max}D AND lon BETWEEN {cfg.lon_min}D AND {cfg.lon_max}D"),
        "local_hour": ("ts TIMESTAMP", "INT", f"hour(from_utc_timestamp(ts, '{cfg.zone}'))"),
        "is_weekday": ("ts TIMESTAMP", "BOOLEAN", f"dayofweek(from_utc_timestamp(ts, '{cfg.zone}')) BETWEEN 2 AND 6"),
        "time_period": ("h INT", "STRING", "CASE WHEN h >= 6 AND h < 9 THEN 'morning_peak' WHEN h >= 9 AND h < 16 THEN 'off_peak' WHEN h >= 16 AND h < 20 THEN 'evening_peak' ELSE 'night' END"),
        "on_time_status": ("delay BIGINT", "STRING", f"CASE WHEN delay < {cfg.early_s} THEN 'early' WHEN delay <= {cfg.late_s} THEN 'on_time' ELSE 'late' END"),
        "congestion": ("kmh DOUBLE", "STRING", "CASE WHEN kmh > 20 THEN 'free_flow' WHEN kmh > 10 THEN 'slow' WHEN kmh > 5 THEN 'congested' ELSE 'gridlock' END"),
    }
    for name, (args, kind, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")
    return list(bodies)
