"""Classifications: the first rule that holds decides; null inputs end in the last class, unless
``unknown`` names another one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetmill.config import DEFAULT, Settings


def _first(rules: list[tuple[Column, str]], last: str, value: Column, unknown: str | None) -> Column:
    out = F.when(value.isNull(), unknown) if unknown else None
    for cond, name in rules:
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(last)


def time_period(hour: Column, unknown: str | None = None) -> Column:
    return _first([((hour >= 6) & (hour < 9), "morning_peak"), ((hour >= 9) & (hour < 16), "off_peak"), ((hour >= 16) & (hour < 20), "evening_peak")], "night", hour, unknown)


def on_time_status(delay_s: Column, cfg: Settings = DEFAULT, unknown: str | None = None) -> Column:
    return _first([(delay_s < cfg.early_s, "early"), (delay_s <= cfg.late_s, "on_time")], "late", delay_s, unknown)


def bunching(cv: Column, unknown: str | None = None) -> Column:
    return _first([(cv > 1.0, "critical"), (cv > 0.5, "severe"), (cv > 0.3, "moderate")], "regular", cv, unknown)


def congestion(kmh: Column, unknown: str | None = None) -> Column:
    return _first([(kmh > 20, "free_flow"), (kmh > 10, "slow"), (kmh > 5, "congested")], "gridlock", kmh, unknown)


def fleet_status(actual: Column, share: Column) -> Column:
    return _first([(actual == 0, "no_service"), (share < 0.5, "severely_underserved"), (share < 0.8, "underserved"), (share <= 1.2, "normal")], "over_capacity", share, None)


def income_bracket(income: Column, unknown: str | None = None) -> Column:
    return _first([(income < 1500, "low"), (income < 4000, "medium"), (income < 10000, "high")], "very_high", income, unknown)


def equity(bracket: Column, vehicles_per_1k: Column) -> Column:
    low = bracket == "low"
    return (
        F.when(low & (vehicles_per_1k < 2), "underserved")
        .when(low & (vehicles_per_1k >= 2), "adequate")
        .when(bracket.isin("high", "very_high"), "well_served")
        .otherwise("moderate")
    )


def ratio(top: Column, bottom: Column) -> Column:
    """The quotient as a double, null unless the divisor is positive."""
    return F.when(bottom > 0, top.cast("double") / bottom.cast("double"))
