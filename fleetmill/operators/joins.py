"""Joins that Spark lacks as such: within a radius, and nearest in a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmill.functions.geo import grid_steps, haversine_m

#: A side is broadcast only after it was counted below this many rows.
BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A hint for a dimension that a bounded count shows to be small; else the planner decides
    (sort-merge, with skewed keys split at runtime)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def left_lookup(facts: DataFrame, dim: DataFrame, key: str, dim_key: str, values: list[str], order: list[str]) -> DataFrame:
    """Left join to a dimension cut down to one row for each key (the first by ``order``), so that
    it adds columns and never rows."""
    first = F.min_by(F.struct(*values), F.struct(*order))
    one = dim.where(F.col(dim_key).isNotNull()).groupBy(F.col(dim_key).alias("_key")).agg(first.alias("_dim"))
    joined = facts.join(broadcast_if_small(one), facts[key] == F.col("_key"), "left")
    return joined.select(*facts.columns, *[F.col(f"_dim.{v}").alias(v) for v in values])


def radius_join(points: DataFrame, places: DataFrame, radius_m: float, point: tuple[str, str], place: tuple[str, str], max_abs_lat: float, distance: str = "distance_m") -> DataFrame:
    """All pairs within a radius, exactly. Both sides get the square cell they lie in, with sides
    no smaller than the radius, so that a match lies in the same or a touching cell; the places are
    repeated in the nine cells around theirs, and the join is one on equal cells."""
    lat_step, lon_step = grid_steps(radius_m, max_abs_lat)
    cell = lambda c, step: F.floor(F.col(c) / step)
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    near = places.withColumn("_dy", F.explode(around)).withColumn("_dx", F.explode(around))
    near = near.withColumns({"_cy": cell(place[0], lat_step) + F.col("_dy"), "_cx": cell(place[1], lon_step) + F.col("_dx")}).drop("_dy", "_dx")
    keyed = points.withColumns({"_cy": cell(point[0], lat_step), "_cx": cell(point[1], lon_step)})
    pairs = keyed.join(broadcast_if_small(near), ["_cy", "_cx"])
    return pairs.withColumn(distance, haversine_m(F.col(point[0]), F.col(point[1]), F.col(place[0]), F.col(place[1]))).where(F.col(distance) <= radius_m).drop("_cy", "_cx")


def radius_join_by_pairs(points: DataFrame, places: DataFrame, radius_m: float, point: tuple[str, str], place: tuple[str, str], distance: str = "distance_m") -> DataFrame:
    """The same result by comparing every point with every place: what the grid is measured
    against. Only for a short list of places."""
    pairs = points.crossJoin(broadcast_if_small(places))
    return pairs.withColumn(distance, haversine_m(F.col(point[0]), F.col(point[1]), F.col(place[0]), F.col(place[1]))).where(F.col(distance) <= radius_m)


def nearest_on_clock(facts: DataFrame, calls: DataFrame, on: list[str], at: str, clock: str, name: str, period: int, gap: str, slots: int = 48) -> DataFrame:
    """For each fact the call on equal keys that is nearest on a clock that goes round: adds the
    call's ``clock`` and ``name`` and the signed ``gap``, fact less call, at most half a period. Ties
    go by name; facts without a call don't appear. Both times are 0 to period - 1.

    Calls are few for a key, so they are dealt into slots of the clock, each with the calls in it and
    the last before and first after it, among which the nearest to any time of the slot is. A fact
    then meets one short row, whatever the number of calls, and no rows are made or sorted."""
    width = period // slots
    once = calls.groupBy(*on, clock).agg(F.min(name).alias(name))
    timetable = once.groupBy(*on).agg(F.array_sort(F.collect_list(F.struct(F.col(clock).alias("at"), F.col(name).alias("name")))).alias("_calls"))
    slot = timetable.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    start = F.col("_slot") * width
    end = F.when(F.col("_slot") == slots - 1, period).otherwise(start + width)
    turned = lambda c, by: F.struct((c["at"] + by).alias("at"), c["name"].alias("name"))
    before, after = F.filter("_calls", lambda c: c["at"] < start), F.filter("_calls", lambda c: c["at"] >= end)
    last = F.coalesce(F.try_element_at(before, F.lit(-1)), turned(F.element_at("_calls", -1), -period))
    first = F.coalesce(F.try_element_at(after, F.lit(1)), turned(F.element_at("_calls", 1), period))
    inside = F.filter("_calls", lambda c: (c["at"] >= start) & (c["at"] < end))
    dealt = slot.select(*on, "_slot", F.concat(F.array(last), inside, F.array(first)).alias("_near"))
    met = facts.withColumn("_slot", F.least(F.floor(F.col(at) / width), F.lit(slots - 1)).cast("int")).join(broadcast_if_small(dealt), [*on, "_slot"])
    best = F.array_min(F.transform("_near", lambda c: F.struct(F.abs(F.col(at) - c["at"]).alias("far"), c["name"].alias("name"), (F.col(at) - c["at"]).alias("gap"), c["at"].alias("at"))))
    found = met.withColumn("_best", best)
    return found.select(*facts.columns, F.pmod(F.col("_best.at"), F.lit(period)).alias(clock), F.col("_best.name").alias(name), F.col("_best.gap").alias(gap))
