"""Batch sinks and the jobs that load static and daily tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetmill.config import DEFAULT, Settings
from fleetmill.plans import gold, silver
from fleetmill.sources.files import extracted, read_census, read_gtfs
from fleetmill.streaming.sinks import replace_partitions


def overwrite(df: DataFrame, path: str) -> int:
    """Writes the whole table and returns its rows, counted while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get["n"]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose columns have grown: files written before a column came have nulls."""
    return spark.read.option("mergeSchema", True).parquet(path)


def load_gtfs(spark: SparkSession, archive: str, work: str, target: str) -> dict[str, int]:
    """A zipped feed to the reference tables; rows by table."""
    with extracted(archive, work) as folder:
        feed = read_gtfs(spark, folder)
        feed["routes"] = silver.routes_table(feed["routes"])
        feed["stop_times"] = silver.stop_times_table(feed["stop_times"], feed["trips"])
        return {name: overwrite(df.withColumn("_loaded_at", F.current_timestamp()), f"{target}/gtfs_{name}") for name, df in feed.items()}


def load_census(spark: SparkSession, source: str, target: str, cfg: Settings = DEFAULT) -> int:
    return overwrite(silver.census_table(read_census(spark, source, cfg), cfg).withColumn("_loaded_at", F.current_timestamp()), target)


def fleet_day(spark: SparkSession, positions: DataFrame, stop_times: DataFrame, routes: DataFrame, date: str, target: str) -> None:
    """One day of fleet utilization; replaces that day's partition only."""
    replace_partitions(gold.fleet_utilization(gold.actual_fleet(positions, date), gold.planned_trips(stop_times, routes), date), target)


def equity_day(spark: SparkSession, positions: DataFrame, census: DataFrame, date: str, target: str) -> None:
    replace_partitions(gold.coverage_equity(gold.service_frequency(positions, date), gold.census_by_cell(census), date), target)
