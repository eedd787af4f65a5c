from datetime import datetime, timedelta

import pytest
from core_data import DATA
from pyspark.sql import functions as F

from fleetmill import schemas
from fleetmill.config import DEFAULT
from fleetmill.operators.sequences import dedup_first, entered, with_previous
from fleetmill.plans import gold, silver
from fleetmill.plans import testbed as tb

RESPONSE = {
    "hr": "12:00",
    "l": [
        {"c": "8000-10", "cl": 33000, "sl": 1, "lt0": "A", "lt1": "B", "vs": [{"p": 11, "a": True, "ta": "2026-03-16T12:00:00Z", "py": -23.5, "px": -46.6}, {"p": "12", "a": False, "ta": "2026-03-16T12:00:00", "py": -23.6, "px": -46.7}]},
        {"c": "8001-10", "cl": 33001, "sl": 2, "lt0": "A", "lt1": "B", "vs": []},
    ],
}


def stamps(spark, rows, schema):
    df = spark.createDataFrame(rows, schema.replace("timestamp", "timestamp_ntz"))
    return df.select(*[F.col(c).cast("timestamp") if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes])


def test_flatten(spark, tmp_path):
    import json

    (tmp_path / "r.json").write_text(json.dumps(RESPONSE))
    got = silver.flatten_positions(spark.read.schema(schemas.API_RESPONSE).json(str(tmp_path)), "'now'").orderBy("vehicle_id").collect()
    assert [(r["vehicle_id"], r["line_code"], r["line_direction"], r["latitude"]) for r in got] == [("11", 33000, 1, -23.5), ("12", 33000, 1, -23.6)]


def test_parse_timestamps_keeps_junk_as_null(spark):
    df = spark.createDataFrame([("2026-03-16T12:00:00", "2026-03-16 12:00:01"), ("junk", None)], "event_timestamp string, ingestion_timestamp string")
    got = silver.parse_timestamps(df).collect()
    assert got[0]["event_ts"].hour == 12 and got[1]["event_ts"] is None and set(got[0].asDict()) == {"event_ts", "ingestion_ts"}


def test_routes_never_fan_out(spark):
    facts = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, line_code int")
    routes = spark.createDataFrame([("b", 5, "B", "BB", 3), ("a", 5, "A", "AA", 3)], "route_id string, line_code int, route_short_name string, route_long_name string, route_type int")
    got = silver.with_route(facts, routes).orderBy("id").collect()
    assert [r["route_short_name"] for r in got] == ["A", None, None]


def test_line_code(spark):
    df = spark.createDataFrame([("33000-10",), ("x",), (None,), ("9" * 20,)], "route_id string")
    assert [r[0] for r in df.select(silver.line_code("route_id")).collect()] == [33000, None, None, None]


def test_headways(spark):
    t = datetime(2026, 3, 16, 12)
    rows = [(v, "s", 1, "r", t + timedelta(minutes=m)) for v, m in (("a", 0), ("b", 10), ("c", 20), ("d", 20), ("e", 500))]
    got = gold.headways(stamps(spark, rows, "vehicle_id string, stop_id string, line_code int, route_id string, arrival_time timestamp")).collect()
    assert sorted(r["headway_seconds"] for r in got) == [600, 600]
    metrics = gold.headway_metrics(stamps(spark, rows, "vehicle_id string, stop_id string, line_code int, route_id string, arrival_time timestamp").transform(gold.headways)).first()
    assert metrics["arrival_count"] == 2 and metrics["headway_cv"] == 0 and metrics["bunching_severity"] == "regular"


def test_speed_leaves_out_the_implausible(spark):
    t = datetime(2026, 3, 16, 12)
    rows = [("a", -23.50, -46.6, t), ("a", -23.51, -46.6, t + timedelta(minutes=2)), ("a", -23.51, -46.6, t + timedelta(minutes=2)), ("a", -23.9, -46.6, t + timedelta(minutes=3)), ("b", -23.5, -46.6, t)]
    got = gold.instantaneous_speed(stamps(spark, rows, "vehicle_id string, latitude double, longitude double, event_ts timestamp")).collect()
    assert len(got) == 1 and 30 < got[0]["speed_kmh"] < 37


def test_schedule_match_takes_the_nearest_and_leaves_out_unreadable_clocks(spark):
    arrivals = stamps(spark, [("v", "s", "r", 1, datetime(2026, 3, 16, 15, 5)), ("w", "other", "r", 1, datetime(2026, 3, 16, 15))], "vehicle_id string, stop_id string, route_id string, line_code int, arrival_time timestamp")
    calls = spark.createDataFrame([("t1", "s", "r", "12:00:00"), ("t2", "s", "r", "12:10:00"), ("t3", "s", "r", "junk"), ("t0", "other", "r", None)], "trip_id string, stop_id string, route_id string, arrival_time string")
    got = gold.match_schedule(arrivals, calls).collect()
    assert [(r["trip_id"], r["delay_seconds"], r["on_time_status"]) for r in got] == [("t1", 300, "on_time")]


def test_schedule_match_goes_round_midnight(spark):
    """Local time is UTC-3: arrivals at 00:10, 23:55 and 05:00 against calls of the day before and the
    next; each nearest by hand over all calls."""
    rows = [("a", 3, 10, 0), ("b", 2, 55, 0), ("c", 8, 0, 0), ("d", 15, 0, 30)]
    arrivals = stamps(spark, [(v, "s", "r", 1, datetime(2026, 3, 16, h, m, sec)) for v, h, m, sec in rows], "vehicle_id string, stop_id string, route_id string, line_code int, arrival_time timestamp")
    clocks = {"t1": "24:10:00", "t2": "00:05:00", "t3": "29:00:00", "t4": "14:00:00", "t5": "10:01:00", "t6": "10:01:00"}
    calls = spark.createDataFrame([(t, "s", "r", c) for t, c in clocks.items()], "trip_id string, stop_id string, route_id string, arrival_time string")
    got = {r["vehicle_id"]: (r["trip_id"], r["delay_seconds"], r["on_time_status"]) for r in gold.match_schedule(arrivals, calls).collect()}
    assert got == {"a": ("t1", 0, "on_time"), "b": ("t2", -600, "early"), "c": ("t3", 0, "on_time"), "d": ("t5", 7170, "late")}
    alone = gold.match_schedule(arrivals, calls.where("trip_id = 't4'"))
    assert {r["vehicle_id"]: r["delay_seconds"] for r in alone.collect()} == {"a": 36600, "b": 35700, "c": -32400, "d": -7170}
    plan = alone._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Generate" in plan  # calls are dealt into slots, arrivals into none


def test_grid_join_equals_all_pairs(spark):
    points, stops = silver.filter_box(tb.positions(spark, DATA)), tb.stops(spark, DATA)
    grid = {(r["vehicle_id"], r["stop_id"], r["arrival_time"]) for r in silver.stop_arrivals(points, stops).collect()}
    pairs = {(r["vehicle_id"], r["stop_id"], r["arrival_time"]) for r in silver.stop_arrivals(points, stops, grid=False).collect()}
    assert grid == pairs and grid
    plan = silver.stop_arrivals(points, stops)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_stop_entries_are_transitions(spark):
    t = datetime(2026, 3, 16, 12)
    at = [(-23.5, 0), (-23.5, 1), (-23.6, 2), (-23.5, 3)]
    rows = stamps(spark, [("v", 1, lat, -46.6, t + timedelta(minutes=m)) for lat, m in at], "vehicle_id string, line_code int, latitude double, longitude double, event_ts timestamp")
    stop = spark.createDataFrame([("s", -23.5, -46.6)], "stop_id string, stop_lat double, stop_lon double")
    assert sorted(r["event_ts"].minute for r in silver.stop_entries(rows, stop).collect()) == [0, 3]


def test_sequence_operators(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, True), ("a", 3, False), ("a", 4, True), ("b", 1, False)], "k string, n int, inside boolean")
    assert [(r["n"], r["prev_n"]) for r in with_previous(df, ["k"], ["n"], ["n"]).orderBy("n").collect()] == [(2, 1), (3, 2), (4, 3)]
    assert sorted(r["n"] for r in entered(df, ["k"], ["n"], "inside").collect()) == [1, 4]
    assert sorted(r["n"] for r in dedup_first(df.union(df), ["k"], ["n"]).collect()) == [1, 1]


def test_fleet_keeps_lines_of_either_side(spark):
    actual = stamps(spark, [(1, "L1", 4, 9, datetime(2026, 1, 1), datetime(2026, 1, 1)), (2, "L2", 1, 1, datetime(2026, 1, 1), datetime(2026, 1, 1))], "line_code int, line_number string, actual_vehicles long, total_observations long, first_seen timestamp, last_seen timestamp")
    planned = spark.createDataFrame([("r", 1, "R1", "Long 1", 4), ("q", 1, "R0", "Long 0", 1), ("s", 3, "R3", None, 2)], "route_id string, line_code int, route_short_name string, route_long_name string, planned_trips long")
    assert {r["line_code"]: r["route_long_name"] for r in gold.fleet_utilization(actual, planned, "2026-01-01").collect()} == {1: "Long 0", 2: None, 3: None}
    got = {r["line_code"]: (r["line_number"], r["actual_vehicles"], r["planned_trips"], r["status"]) for r in gold.fleet_utilization(actual, planned, "2026-01-01").collect()}
    assert got == {1: ("L1", 4, 5, "normal"), 2: ("L2", 1, 0, "over_capacity"), 3: ("R3", 0, 2, "no_service")}


def test_census_bracket_follows_the_mean_income(spark):
    rows = [("t", 1000, 10, 1000.0, 2.0, -23.5, -46.6), ("u", 500, 10, 3000.0, 0.0, -23.5, -46.6)]
    tracts = spark.createDataFrame(rows, "tract_code string, population int, households int, avg_income_brl double, area_km2 double, centroid_lat double, centroid_lon double").withColumn("municipality_code", F.lit(DEFAULT.municipality))
    cell = gold.census_by_cell(silver.census_table(tracts)).first()
    assert (cell["population"], cell["avg_income_brl"], cell["population_density"], cell["income_bracket"]) == (1500, 2000.0, 500.0, "medium")


@pytest.mark.parametrize("name", ["speed_distribution", "congestion_map"])
def test_filters_reach_the_scan_and_no_python_runs(spark, name):
    import __spark_entry__ as e

    plan = e.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "props" not in plan  # unread columns are pruned
