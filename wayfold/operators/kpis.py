"""The published figures, unrounded unless rounding decides something."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as x
from ..functions import quantiles
from .lifecycle import BANDS

WAIT = "request_to_pickup_min"


def headline(rides: DataFrame) -> DataFrame:
    """Median and 90th percentile of the wait over the KPI population."""
    q = quantiles.by_rounds(rides.where("in_kpi_population").select(F.col(WAIT).alias("v")), [0.5, 0.9])
    return q.toDF("median_min", "p90_min", "population_rides")


def headline_scaled(rides: DataFrame) -> DataFrame:
    """The same figures from whole microseconds, counted a minute at a time."""
    waits = rides.where("in_kpi_population").select(x.micros("pickup_datetime", "request_datetime").alias("v"))
    q = quantiles.by_rounds(waits, [0.5, 0.9])
    return q.select((F.col("q0") / 60e6).alias("median_min"), (F.col("q1") / 60e6).alias("p90_min"), F.col("n").alias("population_rides"))


def arrival_share(rides: DataFrame) -> DataFrame:
    """Share of the wait before the driver arrives: a ratio of whole-number sums, with stage quantiles.

    value is null (withheld) where too few of all rides were observed; the caller decides."""
    stage = F.col("in_stage_population")
    r2o, r2p = x.micros("on_scene_datetime", "request_datetime"), x.micros("pickup_datetime", "request_datetime")
    shares = [
        F.try_divide(F.lit(100.0) * F.sum(F.when(stage, r2o)), F.sum(F.when(stage, r2p))).alias("arrival_share_pct"),
        F.count_if(stage).alias("stage_rides"),
        F.try_divide(F.lit(100.0) * F.count_if(stage), F.count_if(F.col("in_kpi_population"))).alias("share_of_kpi_pct"),
        F.try_divide(F.count_if(F.col("on_scene_status") == "observed"), F.count("*")).alias("observed_share"),
    ]
    return quantiles.summary(rides, [], shares, {f"{n}_{c}": (c, q, stage) for c in ("request_to_on_scene_min", "on_scene_to_pickup_min") for n, q in (("median", 0.5), ("p90", 0.9))})


def grouped(rides: DataFrame, by: list[str], condition, minimum: int = 0) -> DataFrame:
    """rides, median_min and p90_min per group with at least `minimum` rides."""
    waits = rides.where(condition).select(*by, F.col(WAIT).alias("v"))
    out = quantiles.by_rounds(waits, [0.5, 0.9], by).select(*by, F.col("n").alias("rides"), F.col("q0").alias("median_min"), F.col("q1").alias("p90_min"))
    return out.where(F.col("rides") >= minimum) if minimum else out


def by_zone(rides: DataFrame, min_rides: int) -> DataFrame:
    z = grouped(rides, ["pickup_zone_id", "pickup_zone", "pickup_borough"], F.col("in_zone_population"))
    return z.withColumn("ranked", F.col("rides") >= min_rides)


def by_level(rides: DataFrame) -> DataFrame:
    """rides, median_min and p90_min of the city, its boroughs and its zones: one selection over
    rows that stand for each of their levels."""
    no = F.lit(None)
    level = lambda name, b, z: F.struct(F.lit(name).alias("level"), b.cast("string").alias("borough"), z.cast("int").alias("zone_id"))
    b, z = F.col("pickup_borough"), F.col("pickup_zone_id")
    each = rides.where("in_zone_population").select(F.explode(F.array(level("city", no, no), level("borough", b, no), level("zone", b, z))).alias("x"), F.col(WAIT).alias("v"))
    out = quantiles.by_rounds(each.select("x.*", "v"), [0.5, 0.9], ["level", "borough", "zone_id"])
    return out.select("level", "borough", "zone_id", F.col("n").alias("rides"), F.col("q0").alias("median_min"), F.col("q1").alias("p90_min"))


def zone_extremes(zones: DataFrame, n: int = 5) -> DataFrame:
    """The best and worst ranked zones by rounded p90; ties by zone id, up for best, down for worst."""
    z = zones.where("ranked").withColumn("p90", x.round2("p90_min"))
    best, worst = z.orderBy("p90", "pickup_zone_id").limit(n), z.orderBy(F.desc("p90"), F.desc("pickup_zone_id")).limit(n)
    side = lambda d, name, order: d.withColumn("place", F.row_number().over(Window.orderBy(*order))).withColumn("side", F.lit(name))  # noqa: E731  five rows
    return side(best, "best", ["p90", "pickup_zone_id"]).union(side(worst, "worst", [F.desc("p90"), F.desc("pickup_zone_id")])).select("side", "place", "pickup_zone_id", "p90")


def zone_summary(zones: DataFrame, citywide: DataFrame) -> DataFrame:
    """Counts of ranked and unranked zones, and of those 1.5 times over the city (rounded figures)."""
    c = citywide.select(x.round2("p90_min").alias("city_p90"))
    z = zones.withColumn("p90", x.round2("p90_min"))
    r = F.col("ranked")
    return z.crossJoin(F.broadcast(c)).agg(
        F.count_if(r).alias("zones_ranked"), F.count_if(~r).alias("zones_below_min_rides"), F.min(F.when(r, F.col("p90"))).alias("best_p90"),
        F.max(F.when(r, F.col("p90"))).alias("worst_p90"), F.count_if(r & (F.col("p90") > F.col("city_p90") * 1.5)).alias("zones_over_1_5x"),
    )


def band_figures(rides: DataFrame) -> DataFrame:
    return grouped(rides, ["precip_band"], F.col("in_kpi_population") & F.col("weather_matched") & F.col("precip_band").isin(*BANDS[:3]))


def hour_matched(rides: DataFrame, min_rides: int) -> DataFrame:
    """Rain against dry in the same hour of day: difference of rounded medians, weighted by rides."""
    pop = rides.where(F.col("in_kpi_population") & F.col("weather_matched") & F.col("precip_band").isin(*BANDS[:3]))
    m = quantiles.by_rounds(pop.select("precip_band", "request_hour", F.col(WAIT).alias("v")), [0.5], ["precip_band", "request_hour"])
    m = m.select("precip_band", "request_hour", F.col("n").alias("c"), x.round2("q0").alias("med"))
    dry = m.where(F.col("precip_band") == BANDS[0]).select("request_hour", F.col("med").alias("dry"))
    rain = m.where((F.col("precip_band") != BANDS[0]) & (F.col("c") >= min_rides)).join(dry, "request_hour")
    return rain.groupBy("precip_band").agg((F.sum(F.col("c") * (F.col("med") - F.col("dry"))) / F.sum("c")).alias("diff_min"), F.count("*").alias("hours"))


def sensitivity(rides: DataFrame) -> DataFrame:
    """The headline with and without requests on a whole minute."""
    pop = rides.where("in_kpi_population")
    rest = ~F.col("request_on_whole_minute")
    counts = [F.count("*").alias("rides"), F.count_if(rest).alias("rides_rest")]
    return quantiles.summary(pop, [], counts, {"median_min": (WAIT, 0.5, None), "p90_min": (WAIT, 0.9, None), "median_rest_min": (WAIT, 0.5, rest), "p90_rest_min": (WAIT, 0.9, rest)})
