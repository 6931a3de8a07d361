"""Thresholds of a monthly run; each can be set by an environment variable of its name in capitals."""

from __future__ import annotations

import os
from dataclasses import asdict, dataclass, fields
from datetime import date, timedelta


@dataclass(frozen=True)
class Thresholds:
    max_excluded_share: float = 0.05
    max_duplicate_share: float = 0.001
    min_on_scene_observed_share: float = 0.80
    min_weather_hour_coverage: float = 0.99
    min_rides_per_zone: int = 1000
    min_311_mapping_coverage: float = 0.90
    light_rain_max_mm: float = 2.5
    max_plausible_trip_miles: float = 100.0
    max_plausible_request_to_pickup_min: float = 60.0

    @classmethod
    def from_env(cls, env=os.environ, **fixed) -> Thresholds:
        read = {f.name: type(f.default)(env[f.name.upper()]) for f in fields(cls) if f.name.upper() in env}
        return cls(**(read | fixed))

    def echo(self) -> dict:
        return asdict(self)


def month_bounds(month: str) -> tuple[date, date]:
    first = date.fromisoformat(f"{month}-01")
    return first, (first + timedelta(days=31)).replace(day=1) - timedelta(days=1)
