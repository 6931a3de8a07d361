"""Ride lifecycle: intervals, status of times, flags and populations, as columns of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as x

VALIDATION = ["valid", "pickup_before_request", "dropoff_not_after_pickup", "missing_timestamp"]
ON_SCENE = ["observed", "same_as_pickup", "before_request", "after_pickup", "missing"]
PERIODS = ["overnight_00_05", "am_peak_06_09", "midday_10_15", "pm_peak_16_19", "evening_20_23"]
BANDS = ["dry", "light_rain", "moderate_or_heavy_rain", "weather_unavailable"]


def with_lifecycle(rides: DataFrame) -> DataFrame:
    """Adds intervals in minutes, validation_status, on_scene_status, flags, in_kpi_population and
    in_stage_population. Narrow: one projection, no row is dropped."""
    r, o, p, d = (F.col(f"{c}_datetime") for c in ("request", "on_scene", "pickup", "dropoff"))
    # statuses compare the times themselves: cheap, and filters on them reach the scan
    some = r.isNotNull() & p.isNotNull() & d.isNotNull()
    status = F.when(~some, "missing_timestamp").when(p < r, "pickup_before_request").when(d <= p, "dropoff_not_after_pickup").otherwise("valid")
    scene = F.when(o.isNull() | r.isNull() | p.isNull(), "missing").when(o > p, "after_pickup").when(o < r, "before_request").when(o == p, "same_as_pickup").otherwise("observed")
    kpi = some & (p >= r) & (d > p)
    mismatch = F.abs(F.col("trip_time") * 1_000_000 - x.micros(d, p)) > 60_000_000
    return rides.withColumns({
        "request_to_pickup_min": x.minutes(p, r), "request_to_on_scene_min": x.minutes(o, r), "on_scene_to_pickup_min": x.minutes(p, o), "trip_duration_min": x.minutes(d, p),
        "validation_status": status, "on_scene_status": scene, "request_on_whole_minute": x.whole_minute(r), "trip_time_mismatch": F.coalesce(mismatch, F.lit(False)),
        "in_kpi_population": kpi, "in_stage_population": kpi & F.coalesce((o >= r) & (o < p), F.lit(False)),
    })


def time_parts(request) -> dict:
    """Hour, weekday (Monday 0), weekend and period of the request; null for null."""
    hour, day = F.hour(request), F.weekday(request)
    period = F.when(hour < 6, PERIODS[0]).when(hour < 10, PERIODS[1]).when(hour < 16, PERIODS[2]).when(hour < 20, PERIODS[3]).when(hour.isNotNull(), PERIODS[4])
    return {"request_hour": hour.cast("byte"), "request_weekday": day.cast("byte"), "is_weekend": day >= 5, "time_period": period}


def precipitation_band(mm, matched, light_max: float):
    """Bands of hourly precipitation; a negative amount has no band though it matched."""
    return F.when(~matched, BANDS[3]).when(mm == 0, BANDS[0]).when((mm > 0) & (mm < light_max), BANDS[1]).when(mm >= light_max, BANDS[2]).otherwise(BANDS[3])
