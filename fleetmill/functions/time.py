"""Local time features and schedule clocks as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetmill.config import DEFAULT


def local_time(ts: Column, zone: str = DEFAULT.zone) -> Column:
    """The wall clock of a zone; ``ts`` is an instant in a session whose zone is UTC."""
    return F.from_utc_timestamp(ts, zone)


def local_hour(ts: Column, zone: str = DEFAULT.zone) -> Column:
    return F.hour(local_time(ts, zone))


def local_weekday(ts: Column, zone: str = DEFAULT.zone) -> Column:
    """1 on Sundays to 7 on Saturdays."""
    return F.dayofweek(local_time(ts, zone))


def is_weekday(ts: Column, zone: str = DEFAULT.zone) -> Column:
    return local_weekday(ts, zone).between(2, 6)


def event_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds, of each instant's own whole second."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def service_seconds(clock: Column) -> Column:
    """``HH:mm:ss``, also past 24 hours, as seconds since the service day began; null if it isn't
    such a text."""
    part = lambda k: F.regexp_extract(clock, r"^\s*(\d{1,3}):(\d{2}):(\d{2})\s*$", k).try_cast("int")
    return part(1) * 3600 + part(2) * 60 + part(3)
