"""Transit tables derived from the driver's star-schema tables by plain arithmetic, so that every
plan can run, and be held against SQL, on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.plans import gold, silver

#: The day, and the span of days, that dated queries ask for.
DAY, FIRST, LAST = "2024-01-10", "2024-01-08", "2024-01-14"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _lat(k: Column) -> Column:
    return F.lit(-24.0) + (k * 37 % 1000) * F.lit(0.0006)


def _lon(k: Column) -> Column:
    return F.lit(-46.9) + (k * 53 % 1000) * F.lit(0.0006)


def stops(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return read(spark, d, "supplier").select(k.cast("string").alias("stop_id"), _lat(k).alias("stop_lat"), _lon(k).alias("stop_lon"))


def positions(spark: SparkSession, d: str, lines: int = 20) -> DataFrame:
    """One report for each event, near the stop that its numbers point to; some at (0, 0)."""
    n = read(spark, d, "supplier").count()  # from file footers
    k = (F.col("user_id") * 31 + F.col("event_id")) % n
    off = F.col("event_id") % 97 == 0
    lat = F.when(off, 0.0).otherwise(_lat(k) + (F.col("event_id") % 17 - 8) * F.lit(1e-4))
    lon = F.when(off, 0.0).otherwise(_lon(k) + (F.col("event_id") % 13 - 6) * F.lit(1e-4))
    line = (F.col("user_id") % lines).cast("int")
    return read(spark, d, "events").select(
        "event_id", F.col("user_id").cast("string").alias("vehicle_id"), line.alias("line_code"), F.concat(F.lit("L"), line.cast("string")).alias("line_number"),
        (F.col("user_id") % 2 + 1).cast("int").alias("line_direction"), lat.alias("latitude"), lon.alias("longitude"), (F.col("event_id") % 3 == 0).alias("is_accessible"),
        F.col("ts").cast("timestamp").alias("event_ts"), F.col("ts").cast("timestamp").alias("ingestion_ts"),
    )


def routes(spark: SparkSession, d: str) -> DataFrame:
    """One for each nation, and a second one with the code of every fifth, to tell fan-out."""
    k = F.col("n_nationkey")
    one = lambda suffix: F.concat((F.lit(33000) + k).cast("string"), F.lit(suffix))
    base = read(spark, d, "nation")
    rows = base.select(one("-10").alias("route_id"), k.cast("int").alias("line_code"), F.col("n_name").alias("route_short_name"), F.concat(F.lit("Line "), "n_name").alias("route_long_name"), F.lit(3).alias("route_type"))
    more = base.where("n_nationkey % 5 = 0").select(one("-11").alias("route_id"), k.cast("int").alias("line_code"), F.lit("second").alias("route_short_name"), F.lit("second").alias("route_long_name"), F.lit(3).alias("route_type"))
    return rows.unionByName(more)


def trips(spark: SparkSession, d: str) -> DataFrame:
    """One for each customer; the first routes have many, the last few. Every other trip of a line
    with two routes is of the second."""
    k = F.col("c_custkey")
    line = F.least(k * 7 % 25, F.floor(k / 25) * 11 % 25)
    route = F.when((line % 5 == 0) & (k % 2 == 1), "-11").otherwise("-10")
    return read(spark, d, "customer").select(F.concat((F.lit(33000) + line).cast("string"), route).alias("route_id"), k.cast("string").alias("trip_id"))


def trip_calls(spark: SparkSession, d: str) -> DataFrame:
    return trips(spark, d).select("trip_id", F.col("route_id").alias("stop_id"))


def timetable(spark: SparkSession, d: str) -> DataFrame:
    """A call every half hour at each stop (an event type), as clock texts. Those about midnight are
    of the day before only: from 24:00 on."""
    types = read(spark, d, "events").select("event_type").distinct()
    runs = types.select("event_type", F.explode(F.sequence(F.lit(2), F.lit(49))).alias("k"))
    s = F.col("k") * 1800 + F.length("event_type") * 60
    clock = F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("int"), (F.floor(s / 60) % 60).cast("int"), (s % 60).cast("int"))
    return runs.select(F.col("k").cast("string").alias("trip_id"), F.col("event_type").alias("stop_id"), F.lit("R").alias("route_id"), clock.alias("arrival_time"))


def type_arrivals(spark: SparkSession, d: str) -> DataFrame:
    """Events as arrivals: the type is the stop."""
    return read(spark, d, "events").select(
        F.col("user_id").cast("string").alias("vehicle_id"), F.col("event_type").alias("stop_id"), F.lit("R").alias("route_id"), (F.col("user_id") % 2).cast("int").alias("line_code"),
        F.col("ts").cast("timestamp").alias("arrival_time"), "event_id",
    )


def census(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return read(spark, d, "supplier").select(
        k.cast("string").alias("tract_code"), F.when(k % 10 == 9, "9999999").otherwise("3550308").alias("municipality_code"), (100 + k * 7919 % 5000).cast("int").alias("population"),
        (30 + k * 101 % 900).cast("int").alias("households"), F.abs("s_acctbal").alias("avg_income_brl"), (0.5 + (k % 7) * F.lit(0.25)).alias("area_km2"),
        _lat(k).alias("centroid_lat"), _lon(k).alias("centroid_lon"),
    )


def enriched(spark: SparkSession, d: str, lines: int = 20) -> DataFrame:
    out = silver.with_time_features(silver.filter_box(positions(spark, d, lines)))
    return out.withColumn("h3_index", silver.geo.hex_cell(F.col("latitude"), F.col("longitude")))


def speeds(spark: SparkSession, d: str) -> DataFrame:
    return gold.instantaneous_speed(enriched(spark, d), order=("event_ts", "event_id"))


def speed_hourly(spark: SparkSession, d: str) -> DataFrame:
    return gold.speed_hourly(speeds(spark, d))


def headways(spark: SparkSession, d: str) -> DataFrame:
    return gold.headways(type_arrivals(spark, d))


def headway_hourly(spark: SparkSession, d: str) -> DataFrame:
    return gold.headway_metrics(headways(spark, d))


def matched(spark: SparkSession, d: str) -> DataFrame:
    return gold.match_schedule(type_arrivals(spark, d), timetable(spark, d))


def on_time_hourly(spark: SparkSession, d: str) -> DataFrame:
    return gold.on_time_hourly(matched(spark, d))


def planned(spark: SparkSession, d: str) -> DataFrame:
    return gold.planned_trips(trips(spark, d), routes(spark, d))


def fleet(spark: SparkSession, d: str, date: str = DAY) -> DataFrame:
    return gold.fleet_utilization(gold.actual_fleet(enriched(spark, d, 30), date), planned(spark, d), date)


def fleet_week(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [fleet(spark, d, f"2024-01-{day:02d}") for day in range(int(FIRST[-2:]), int(LAST[-2:]) + 1)])


def equity(spark: SparkSession, d: str, date: str = DAY) -> DataFrame:
    return gold.coverage_equity(gold.service_frequency(enriched(spark, d), date), gold.census_by_cell(silver.census_table(census(spark, d))), date)
