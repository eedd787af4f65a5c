"""Settings of the transit pipeline, one frozen object passed to what needs it."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    zone: str = "America/Sao_Paulo"
    lat_min: float = -24.1
    lat_max: float = -23.3
    lon_min: float = -47.0
    lon_max: float = -46.2
    stop_radius_m: float = 50.0
    max_speed_kmh: float = 150.0
    headway_min_s: int = 30
    headway_max_s: int = 7200
    early_s: int = -60
    late_s: int = 300
    hex_edge_m: float = 174.0
    municipality: str = "3550308"
    gold_window: str = "1 hour"
    dedup_window: str = "5 minutes"
    positions_watermark: str = "10 minutes"
    arrivals_watermark: str = "15 minutes"
    silver_trigger: str = "30 seconds"
    gold_trigger: str = "5 minutes"
    write_batch: int = 500
    write_attempts: int = 3
    output_mode: str = "files"

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ, prefix: str = "FLEETMILL_") -> Settings:
        """Settings from variables such as FLEETMILL_STOP_RADIUS_M; others keep their defaults."""
        kinds = {"float": float, "int": int, "str": str}
        return cls(**{f.name: kinds[str(f.type)](env[key]) for f in fields(cls) if (key := prefix + f.name.upper()) in env})


DEFAULT = Settings()
