"""The eighteen dashboard questions over the gold tables. Dates are parameters: no question reads
the clock. Each takes the gold DataFrame that it is about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ordinal(c: str, values: list[str]) -> Column:
    out = F.when(F.col(c) == values[0], 1)
    for i, v in enumerate(values[1:], 2):
        out = out.when(F.col(c) == v, i)
    return out.otherwise(len(values) + 1)


def _between(start: str, end: str) -> Column:
    return (F.col("_event_date") >= start) & (F.col("_event_date") <= end)


def _share(part: str, whole: str, digits: int = 1) -> Column:
    """A percentage of two sums."""
    return F.round(F.try_divide(F.sum(part).cast("double") * 100, F.sum(whole).cast("double")), digits)


def _mean(c: str, digits: int) -> Column:
    """A rounded mean; noise in the last digits is taken off first, so that ties round alike."""
    return F.round(F.round(F.avg(c), 6), digits)


BRACKETS = ["low", "medium", "high", "very_high"]
STATUSES = ["no_service", "severely_underserved", "underserved", "normal", "over_capacity"]
SEVERITIES = ["critical", "severe", "moderate", "regular"]


def equity_overview(equity: DataFrame, date: str) -> DataFrame:  # D1
    day = equity.where((F.col("_event_date") == date) & F.col("income_bracket").isNotNull())
    out = day.groupBy("income_bracket", "service_equity_score").agg(
        F.count_distinct("h3_index").alias("areas"), F.round(F.avg("vehicles_per_1k_population"), 2).alias("avg_vehicles_per_1k"),
        F.round(F.avg("avg_income_brl"), 0).alias("avg_income"), F.sum("population").alias("population"),
    )
    return out.orderBy(_ordinal("income_bracket", BRACKETS), "service_equity_score")


def equity_scatter(equity: DataFrame, date: str, hours: tuple[int, int] = (6, 22)) -> DataFrame:  # D2
    rows = equity.where((F.col("_event_date") == date) & F.col("avg_income_brl").isNotNull() & F.col("hour_of_day").between(*hours))
    return rows.select("h3_index", "hour_of_day", "avg_income_brl", "vehicles_per_1k_population", "population", "income_bracket", "service_equity_score")


def equity_underserved(equity: DataFrame, date: str, top: int = 50) -> DataFrame:  # D3
    rows = equity.where((F.col("_event_date") == date) & (F.col("service_equity_score") == "underserved"))
    rows = rows.select("h3_index", "hour_of_day", "population", F.round("avg_income_brl", 0).alias("avg_income"), F.round("vehicles_per_1k_population", 2).alias("vehicles_per_1k"), "unique_routes")
    return rows.orderBy("vehicles_per_1k", "h3_index", "hour_of_day").limit(top)


def equity_by_hour(equity: DataFrame, date: str) -> DataFrame:  # D4
    rows = equity.where((F.col("_event_date") == date) & F.col("income_bracket").isNotNull())
    return rows.groupBy("hour_of_day", "income_bracket").agg(F.avg("vehicles_per_1k_population").alias("avg_vehicles_per_1k"), F.avg("unique_routes").alias("avg_lines")).orderBy("hour_of_day", "income_bracket")


def fleet_status(fleet: DataFrame, date: str) -> DataFrame:  # D5
    out = fleet.where(F.col("_event_date") == date).groupBy("status").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("actual_vehicles").alias("vehicles"), F.sum("planned_trips").alias("trips"), F.round(F.avg("utilization_ratio"), 2).alias("avg_utilization")
    )
    return out.orderBy(_ordinal("status", STATUSES))


def fleet_underserved(fleet: DataFrame, date: str, top: int = 30) -> DataFrame:  # D6
    rows = fleet.where((F.col("_event_date") == date) & F.col("status").isin("no_service", "severely_underserved", "underserved"))
    rows = rows.select("line_code", "line_number", "actual_vehicles", "planned_trips", F.round("utilization_ratio", 2).alias("utilization"), "status")
    return rows.orderBy(F.asc_nulls_first("utilization"), F.desc("planned_trips"), "line_code").limit(top)


def fleet_trend(fleet: DataFrame, start: str, end: str) -> DataFrame:  # D7
    out = fleet.where(_between(start, end)).groupBy("_event_date").agg(
        F.sum("actual_vehicles").alias("vehicles"), F.sum("planned_trips").alias("trips"),
        F.round(F.try_divide(F.sum("actual_vehicles").cast("double"), F.sum("planned_trips").cast("double")), 2).alias("utilization"),
        F.count_if(F.col("status").isin("severely_underserved", "no_service")).alias("critical_lines"), F.count_if(F.col("status") == "normal").alias("normal_lines"),
    )
    return out.orderBy("_event_date")


def fleet_full(fleet: DataFrame, date: str, top: int = 20) -> DataFrame:  # D8
    rows = fleet.where((F.col("_event_date") == date) & F.col("status").isin("normal", "over_capacity"))
    rows = rows.select("line_code", "line_number", "actual_vehicles", "planned_trips", F.round("utilization_ratio", 2).alias("utilization"))
    return rows.orderBy(F.desc("utilization"), "line_code").limit(top)


def worst_bunching(headway: DataFrame, start: str, end: str, least: int = 20, top: int = 20) -> DataFrame:  # D9
    out = headway.where(_between(start, end) & F.col("is_weekday")).groupBy("route_id", "line_code", "stop_id").agg(
        F.sum("arrival_count").alias("headways"), F.round(F.avg("headway_cv"), 3).alias("avg_cv"), F.round(F.round(F.avg("avg_headway_seconds") / 60, 6), 1).alias("avg_headway_min")
    )
    return out.where(F.col("headways") >= least).orderBy(F.desc("avg_cv"), "stop_id", "line_code").limit(top)


def severity_distribution(headway: DataFrame, start: str, end: str) -> DataFrame:  # D10
    out = headway.where(_between(start, end)).groupBy("bunching_severity", "time_period").agg(
        F.count(F.lit(1)).alias("windows"), F.count_distinct("line_code").alias("lines"), F.round(F.avg("headway_cv"), 3).alias("avg_cv")
    )
    return out.orderBy(_ordinal("bunching_severity", SEVERITIES), "time_period")


HEADWAY_TREND = """
SELECT window_start, stop_id, line_code, round(avg_headway_seconds / 60, 1) AS avg_headway_min, round(headway_cv, 3) AS cv, bunching_severity
FROM {headway} WHERE line_code = :line_code AND _event_date BETWEEN :start AND :end ORDER BY window_start, stop_id
"""


def headway_trend(headway: DataFrame, line_code: int, start: str, end: str) -> DataFrame:  # D11
    """As SQL with named parameters."""
    return headway.sparkSession.sql(HEADWAY_TREND, args={"line_code": line_code, "start": start, "end": end}, headway=headway)


def on_time_trend(on_time: DataFrame, start: str, end: str) -> DataFrame:  # D12
    out = on_time.where(_between(start, end)).groupBy("window_start").agg(
        _share("on_time_count", "total_arrivals").alias("on_time_pct"), _share("early_count", "total_arrivals").alias("early_pct"), _share("late_count", "total_arrivals").alias("late_pct"),
        _mean("avg_delay_seconds", 1).alias("avg_delay_s"), F.sum("total_arrivals").alias("arrivals"),
    )
    return out.orderBy("window_start")


def on_time_worst(on_time: DataFrame, start: str, end: str, least: int = 10, top: int = 20) -> DataFrame:  # D13
    out = on_time.where(_between(start, end)).groupBy("route_id", "line_code").agg(
        F.sum("total_arrivals").alias("arrivals"), _share("on_time_count", "total_arrivals").alias("on_time_pct"), _mean("avg_delay_seconds", 1).alias("avg_delay_s")
    )
    return out.where(F.col("arrivals") >= least).orderBy("on_time_pct", "route_id", "line_code").limit(top)


def peak_compare(on_time: DataFrame, start: str, end: str) -> DataFrame:  # D14
    out = on_time.where(_between(start, end)).groupBy("time_period", "is_weekday").agg(
        _share("on_time_count", "total_arrivals").alias("on_time_pct"), _mean("avg_delay_seconds", 1).alias("avg_delay_s"), F.sum("total_arrivals").alias("arrivals")
    )
    return out.orderBy("time_period", "is_weekday")


def congestion_map(speed: DataFrame, date: str, since: str) -> DataFrame:  # D15
    """Cells of the windows that start at ``since`` or later."""
    rows = speed.where((F.col("_event_date") == date) & (F.col("window_start") >= F.lit(since).cast("timestamp")))
    return rows.select("h3_index", "line_code", F.round("avg_speed_kmh", 1).alias("avg_speed"), F.round("median_speed_kmh", 1).alias("median_speed"), "congestion_level", "observation_count").orderBy("avg_speed", "h3_index", "line_code")


def speed_distribution(speed: DataFrame, start: str, end: str) -> DataFrame:  # D16
    out = speed.where(_between(start, end)).groupBy("congestion_level").agg(F.count(F.lit(1)).alias("cells"), F.round(F.avg("avg_speed_kmh"), 2).alias("avg_speed"), F.sum("observation_count").alias("samples"))
    return out.orderBy(F.desc("samples"))


def worst_corridors(speed: DataFrame, start: str, end: str, least: int = 50, top: int = 20) -> DataFrame:  # D17
    """With the most frequent level; of equally frequent ones the first by name."""
    rows = speed.where(_between(start, end) & F.col("is_weekday"))
    levels = rows.groupBy("line_code", "line_number", "congestion_level").agg(
        F.count(F.lit(1)).alias("n"), F.sum("observation_count").alias("samples"), F.sum("avg_speed_kmh").alias("s"), F.sum("p10_speed_kmh").alias("s10")
    )
    out = levels.groupBy("line_code", "line_number").agg(
        F.sum("samples").alias("samples"), F.round(F.sum("s") / F.sum("n"), 2).alias("avg_speed"), F.round(F.sum("s10") / F.sum("n"), 2).alias("avg_p10"),
        F.min_by("congestion_level", F.struct(-F.col("n"), F.col("congestion_level"))).alias("usual_level"),
    )
    return out.where(F.col("samples") >= least).orderBy("avg_speed", "line_code").limit(top)


def speed_trend(speed: DataFrame, start: str, end: str) -> DataFrame:  # D18
    out = speed.where(_between(start, end)).groupBy("window_start").agg(
        F.round(F.avg("avg_speed_kmh"), 2).alias("avg_speed"), F.round(F.avg("median_speed_kmh"), 2).alias("median_speed"), F.sum("observation_count").alias("samples")
    )
    return out.orderBy("window_start")
