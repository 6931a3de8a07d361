"""Zone and weather enrichment: dimension joins that keep every ride."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as x
from .lifecycle import precipitation_band, time_parts


def zone_dimension(raw: DataFrame) -> DataFrame:
    """location_id, zone, borough, service_zone, is_placeholder from the lookup's columns.

    Placeholders are codes for unknown places, not places."""
    z, b = F.col("Zone"), F.col("Borough")
    flag = F.coalesce(b.isin("Unknown", "N/A"), F.lit(False)) | F.coalesce(z.isin("N/A", "Outside of NYC"), F.lit(False))
    return raw.select(F.col("LocationID").cast("int").alias("location_id"), z.alias("zone"), b.alias("borough"), "service_zone", flag.alias("is_placeholder"))


def with_zones(rides: DataFrame, zones: DataFrame) -> DataFrame:
    """Labels for both ends, and placeholder_pickup: a placeholder's id, or one the lookup lacks.

    A lookup of some hundred rows; Catalyst broadcasts it by its size."""
    p = zones.select(F.col("location_id").alias("_p"), F.col("zone").alias("pickup_zone"), F.col("borough").alias("pickup_borough"), F.col("is_placeholder").alias("_ph"))
    d = zones.select(F.col("location_id").alias("_d"), F.col("zone").alias("dropoff_zone"), F.col("borough").alias("dropoff_borough"))
    out = rides.join(p, rides["PULocationID"] == F.col("_p"), "left").join(d, rides["DOLocationID"] == F.col("_d"), "left")
    return out.withColumn("placeholder_pickup", F.coalesce("_ph", F.lit(True))).drop("_p", "_d", "_ph")


def hourly_once(weather: DataFrame, order_col: str | None = None) -> DataFrame:
    """One row an hour; of repeated hours the first by order_col stays."""
    w = Window.partitionBy("hour").orderBy(order_col or "hour")
    return weather.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def with_weather(rides: DataFrame, weather: DataFrame | None, light_max: float = 2.5) -> DataFrame:
    """The request's hour joined with its weather, and the precipitation band.

    weather: hour, temperature_c, precipitation_mm, wind_speed_kmh, an hour once. Without
    it every ride is there with band weather_unavailable."""
    out = rides.withColumn("weather_hour", x.floor_hour("request_datetime"))
    cols = ["temperature_c", "precipitation_mm", "wind_speed_kmh"]
    if weather is None:
        out = out.withColumns({c: F.lit(None).cast("float") for c in cols})
    else:
        w = weather.select(F.col("hour").alias("_h"), *[F.col(c).cast("float").alias(c) for c in cols])
        out = out.join(F.broadcast(w), out["weather_hour"] == F.col("_h"), "left").drop("_h")  # hours are few, whatever they were counted from
    out = out.withColumn("weather_matched", F.col("precipitation_mm").isNotNull())
    return out.withColumn("precip_band", precipitation_band(F.col("precipitation_mm"), F.col("weather_matched"), light_max))


JOURNEY = [
    "ride_id", "hvfhs_license_num", "request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime", "pickup_zone_id", "pickup_zone",
    "pickup_borough", "dropoff_zone_id", "dropoff_zone", "dropoff_borough", "trip_miles", "trip_duration_min", "request_to_pickup_min",
    "request_to_on_scene_min", "on_scene_to_pickup_min", "on_scene_status", "validation_status", "in_kpi_population", "in_stage_population",
    "in_zone_population", "request_on_whole_minute", "trip_time_mismatch", "request_hour", "request_weekday", "is_weekend", "time_period", "weather_hour",
    "temperature_c", "precipitation_mm", "wind_speed_kmh", "precip_band",
]
STORED_AS_FLOAT = ["trip_duration_min", "request_to_pickup_min", "request_to_on_scene_min", "on_scene_to_pickup_min"]


def journey(lifecycle: DataFrame, zones: DataFrame, weather: DataFrame | None, light_max: float = 2.5) -> DataFrame:
    """All columns of a ride's journey, with the lifecycle's still in double precision."""
    out = with_weather(with_zones(lifecycle, zones), weather, light_max)
    out = out.withColumns(time_parts(F.col("request_datetime")))
    return out.withColumns({"in_zone_population": F.col("in_kpi_population") & ~F.col("placeholder_pickup"), "pickup_zone_id": F.col("PULocationID"), "dropoff_zone_id": F.col("DOLocationID")})


def published(journey_rows: DataFrame) -> DataFrame:
    """The 33 columns as they are stored; minutes narrow to float only here."""
    return journey_rows.select(*[(F.col(c).cast("float") if c in STORED_AS_FLOAT else F.col(c)).alias(c) for c in JOURNEY])
