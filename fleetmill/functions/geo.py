"""Distances, boxes and cells as column expressions; all stay inside generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetmill.config import DEFAULT, Settings

EARTH_M = 6_371_000.0
#: Offsets that make axial coordinates non-negative before they are packed into one number.
HEX_OFFSET, HEX_SPAN = 1 << 24, 1 << 25


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; null if any coordinate is."""
    half_lat, half_lon = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return 2 * EARTH_M * F.asin(F.sqrt(F.when(a > 1.0, 1.0).otherwise(a)))


def within_box(lat: Column, lon: Column, cfg: Settings = DEFAULT) -> Column:
    return lat.between(cfg.lat_min, cfg.lat_max) & lon.between(cfg.lon_min, cfg.lon_max)


def hex_cell(lat: Column, lon: Column, cfg: Settings = DEFAULT) -> Column:
    """The hexagon of a planar grid that a point lies in, as one number. Metres are equirectangular
    around the middle latitude of the box; fractional axial coordinates are rounded as cubes."""
    scale = math.cos(math.radians((cfg.lat_min + cfg.lat_max) / 2))
    x, y = F.radians(lon) * (EARTH_M * scale), F.radians(lat) * EARTH_M
    q, r = (x * (math.sqrt(3) / 3) - y / 3) / cfg.hex_edge_m, y * (2 / 3) / cfg.hex_edge_m
    rq, rr, rs = F.floor(q + 0.5), F.floor(r + 0.5), F.floor(-q - r + 0.5)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs + q + r)
    qi = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    ri = F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)
    return ((qi + HEX_OFFSET) * HEX_SPAN + ri + HEX_OFFSET).cast("long")


def hex_neighbours(cell: Column) -> Column:
    """The cell and the six around it."""
    steps = [(0, 0), (1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1)]
    return F.array(*[cell + dq * HEX_SPAN + dr for dq, dr in steps])


def grid_steps(radius_m: float, max_abs_lat: float) -> tuple[float, float]:
    """Sides, in degrees, of square cells no smaller than the radius anywhere up to that latitude."""
    degree_m = EARTH_M * math.pi / 180
    slack = 1.001
    return radius_m * slack / degree_m, radius_m * slack / (degree_m * max(1e-6, math.cos(math.radians(min(89.9, max_abs_lat)))))
