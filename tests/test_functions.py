import math
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetmill.config import DEFAULT, Settings
from fleetmill.functions import classify, geo, sql, time


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(("function", "cases"), [
    (classify.time_period, {5: "night", 6: "morning_peak", 8: "morning_peak", 9: "off_peak", 15: "off_peak", 16: "evening_peak", 19: "evening_peak", 20: "night", None: "night"}),
    (classify.on_time_status, {-61: "early", -60: "on_time", 120: "on_time", 300: "on_time", 301: "late", None: "late"}),
    (classify.congestion, {25: "free_flow", 20: "slow", 15: "slow", 10: "congested", 7: "congested", 5: "gridlock", 3: "gridlock", None: "gridlock"}),
    (classify.income_bracket, {0: "low", 1499: "low", 1500: "medium", 4000: "high", 10000: "very_high", None: "very_high"}),
])
def test_classes(spark, function, cases):
    assert values(spark, function(F.col("x")), [(k,) for k in cases], "x int") == list(cases.values())


def test_classes_of_ratios(spark):
    assert values(spark, classify.bunching(F.col("x")), [(1.1,), (1.0,), (0.5,), (0.3,), (None,)], "x double") == ["critical", "severe", "moderate", "regular", "regular"]
    rows = [(0, 0.9), (3, 0.49), (3, 0.79), (3, 1.2), (3, 1.21), (3, None)]
    assert values(spark, classify.fleet_status(F.col("a"), F.col("r")), rows, "a int, r double") == ["no_service", "severely_underserved", "underserved", "normal", "over_capacity", "over_capacity"]
    rows = [("low", 1.9), ("low", 2.0), ("low", None), ("high", 0.0), ("medium", 9.0), (None, 1.0)]
    assert values(spark, classify.equity(F.col("b"), F.col("v")), rows, "b string, v double") == ["underserved", "adequate", "moderate", "well_served", "moderate", "moderate"]
    assert values(spark, classify.ratio(F.col("a"), F.col("b")), [(1, 2), (1, 0), (None, 2)], "a int, b int") == [0.5, None, None]
    assert values(spark, classify.income_bracket(F.col("x"), "unknown"), [(None,), (9,)], "x int") == ["unknown", "low"]


def test_distances(spark):
    d = geo.haversine_m(*[F.col(c) for c in "abcd"])
    rows = [(-23.55, -46.63, -23.55, -46.63), (-23.5505, -46.6333, -23.5614, -46.6559), (-23.55, -46.63, -22.91, -43.17), (0.0, 0.0, 0.0, 180.0), (None, 0.0, 0.0, 0.0)]
    same, near, far, half, none = values(spark, d, rows, "a double, b double, c double, d double")
    assert same == 0 and 1500 < near < 3500 and 300_000 < far < 420_000 and abs(half - math.pi * geo.EARTH_M) < 1 and none is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(*[st.floats(-24.1, -23.3), st.floats(-47, -46.2)] * 2), min_size=1, max_size=30))
def test_distance_and_cells_hold_for_any_points(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    there, back = geo.haversine_m(*[F.col(c) for c in "abcd"]), geo.haversine_m(*[F.col(c) for c in "cdab"])
    cell, other = geo.hex_cell(F.col("a"), F.col("b")), geo.hex_cell(F.col("c"), F.col("d"))
    for one, two, x, y, around in df.select(there, back, cell, other, geo.hex_neighbours(cell)).collect():
        assert abs(one - two) < 1e-6 and len(set(around)) == 7 and x in around
        if one < DEFAULT.hex_edge_m * 0.5:  # nearer than half an edge: the same or a touching cell
            assert y in around
        if x == y:
            assert one < 2.2 * DEFAULT.hex_edge_m


def test_box(spark):
    rows = [(-23.55, -46.63), (-24.1, -47.0), (-22.9, -43.2), (0.0, 0.0), (None, -46.5)]
    assert values(spark, geo.within_box(F.col("a"), F.col("b")), rows, "a double, b double") == [True, True, False, False, None]


def test_local_time(spark):
    rows = [(datetime(2026, 3, 16, 12),), (datetime(2026, 3, 15, 12),), (datetime(2026, 3, 16, 2),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz").select(F.col("t").cast("timestamp").alias("t"))
    got = df.select(time.local_hour(F.col("t")), time.local_weekday(F.col("t")), time.is_weekday(F.col("t")), time.event_date(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(9, 2, True, "2026-03-16"), (9, 1, False, "2026-03-15"), (23, 1, False, "2026-03-16")]


def test_service_clock(spark):
    assert values(spark, time.service_seconds(F.col("x")), [("00:00:00",), ("25:10:05",), (" 7:05:00",), ("junk",), ("",), (None,)], "x string") == [0, 90605, 25500, None, None, None]


def test_sql_functions(spark):
    assert "haversine_m" in sql.register(spark)
    row = spark.sql("SELECT haversine_m(-23.55D, -46.63D, -22.91D, -43.17D), within_box(-23.55D, -46.63D), local_hour(timestamp'2026-03-16 12:00:00'), time_period(7), on_time_status(301), congestion(7D)").first()
    assert 300_000 < row[0] < 420_000 and tuple(row)[1:] == (True, 9, "morning_peak", "late", "congested")


def test_settings_from_environment():
    cfg = Settings.from_env({"FLEETMILL_STOP_RADIUS_M": "75", "FLEETMILL_ZONE": "UTC", "OTHER": "1"})
    assert (cfg.stop_radius_m, cfg.zone, cfg.late_s) == (75.0, "UTC", 300)
