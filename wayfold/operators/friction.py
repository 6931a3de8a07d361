"""Complaints rolled up to zones and boroughs against pickups, zeros kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as x
from .quality import FAIL, PASS, WARN, Check

#: The descriptors that name each category of complaint.
PASSENGER = ["Car Service Company Complaint", "Driver Complaint - Passenger"]
NON_PASSENGER = ["Driver Complaint - Non Passenger", "Driver Report - Non Passenger"]
PICKUP_REASONS = ["Denied Request", "Refused Pick-Up", "Service Delay/No Show"]
COUNTERS = ["complaints_all", "complaints_passenger", "complaints_non_passenger", "complaints_pickup_reliability"]
REQUIRED = ["unique_key", "created_date", "complaint_type", "descriptor", "borough"]


def categorised(complaints: DataFrame) -> DataFrame:
    d = F.col("descriptor")
    category = F.when(d.isin(*PASSENGER), "passenger").when(d.isin(*NON_PASSENGER), "non_passenger").otherwise("other")
    return complaints.withColumns({"category": category, "pickup_reliability_reason": F.coalesce(F.col("descriptor_2").isin(*PICKUP_REASONS), F.lit(False))})


def pickups_by_zone(journey: DataFrame) -> DataFrame:
    return journey.where(~F.col("placeholder_pickup")).groupBy(F.col("PULocationID").alias("zone_id")).agg(F.count("*").alias("hvfhv_pickups"))


def by_zone(complaints: DataFrame, pickups: DataFrame, zones: DataFrame) -> DataFrame:
    """Every zone with pickups or complaints; what it lacks is zero."""
    c = F.count_if
    n = complaints.where("zone_id is not null").groupBy("zone_id").agg(
        F.count("*").alias(COUNTERS[0]), c(F.col("category") == "passenger").alias(COUNTERS[1]), c(F.col("category") == "non_passenger").alias(COUNTERS[2]),
        c(F.col("pickup_reliability_reason")).alias(COUNTERS[3]),
    )
    both = pickups.join(n, "zone_id", "full").fillna(0, ["hvfhv_pickups", *COUNTERS])
    z = zones.select(F.col("location_id").alias("_z"), "zone", "borough")
    return both.join(z, F.col("zone_id") == F.col("_z"), "left").drop("_z")


def by_borough(per_zone: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("hvfhv_pickups", *COUNTERS)]
    return per_zone.groupBy("borough").agg(*sums).withColumn("rate_per_100k", x.per_100k("complaints_passenger", "hvfhv_pickups"))


def levels(per_zone: DataFrame, minimum: dict[str, int]) -> DataFrame:
    """level (city, borough, zone), borough, zone_id, complaints_passenger, hvfhv_pickups and the
    rate, in one aggregate of the zones: boroughs and zones with the level's least pickups, the
    city with all of them. What tells an unknown borough from a level without one is the
    grouping's own number."""
    ids = F.grouping_id()
    sums = [F.sum(c).alias(c) for c in ("complaints_passenger", "hvfhv_pickups")]
    up = per_zone.rollup("borough", "zone_id").agg(*sums, F.when(ids == 3, "city").when(ids == 1, "borough").otherwise("zone").alias("level"))
    least = F.coalesce(*[F.when(F.col("level") == k, n) for k, n in minimum.items()], F.lit(0))
    kept = up.where(F.col("hvfhv_pickups") >= least).withColumn("rate_per_100k", x.per_100k("complaints_passenger", "hvfhv_pickups"))
    return kept.select("level", "borough", "zone_id", "complaints_passenger", "hvfhv_pickups", "rate_per_100k")


def kpi5(per_zone: DataFrame, borough_waits: DataFrame, min_rides: int) -> DataFrame:
    """Boroughs with enough pickups, beside the wait's p90 there; the city counts all boroughs."""
    up = levels(per_zone, {"borough": min_rides}).where("level <> 'zone'")
    w = borough_waits.select(F.col("pickup_borough").alias("_b"), "p90_min")
    out = up.join(w, F.col("borough").eqNullSafe(F.col("_b")) & (F.col("level") == "borough"), "left")
    return out.select("level", "borough", "complaints_passenger", "hvfhv_pickups", "rate_per_100k", "p90_min")


def zone_breakdown(zone_kpis: DataFrame, per_zone: DataFrame) -> DataFrame:
    """Zones with rides in the population, beside their complaints."""
    c = per_zone.select(F.col("zone_id").alias("_z"), "hvfhv_pickups", *COUNTERS)
    out = zone_kpis.join(c, F.col("pickup_zone_id") == F.col("_z"), "left").drop("_z").fillna(0, ["hvfhv_pickups", *COUNTERS])
    return out.withColumn("rate_per_100k", x.per_100k("complaints_passenger", "hvfhv_pickups"))


def mapping_summary(complaints: DataFrame) -> DataFrame:
    """How complaints were placed, and whether reported and mapped boroughs agree."""
    c, m = F.count_if, F.col("mapping")
    known = F.col("zone_borough").isNotNull() & F.col("reported_borough").isNotNull() & (F.col("reported_borough") != "Unspecified")
    passenger = F.col("category") == "passenger"
    return complaints.agg(
        F.count("*").alias("rows"), c(m.isin("mapped", "ambiguous_lowest_id")).alias("mapped"), c(m == "no_coordinates").alias("no_coordinates"),
        c(m == "outside_all_zones").alias("outside_all_zones"), c(m == "ambiguous_lowest_id").alias("ambiguous"), c(passenger).alias("passenger_total"),
        c(passenger & F.col("zone_id").isNull()).alias("passenger_unmapped"), c(known).alias("comparable"),
        c(known & (F.upper("zone_borough") == F.upper("reported_borough"))).alias("agree"),
    )


def required_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Missing values a field; empty text counts as missing."""
    one = df.agg(*[F.count_if(F.col(f).isNull() | (F.col(f).cast("string") == "")).alias(f) for f in fields])
    return one.selectExpr("stack({}, {}) AS (field, missing)".format(len(fields), ", ".join(f"'{f}', `{f}`" for f in fields)))


def complaint_checks(complaints: DataFrame, expected: int | None, first, last, complaint_type: str, min_coverage: float) -> list[Check]:
    """Rules about the complaints; complaints has the raw text columns and mapping, category."""
    n = complaints.count()
    s = lambda name, status, detail, scope="friction", category="completeness": Check(f"nyc311.{name}", status, scope, detail, category)
    out = []
    if expected is not None:
        out.append(s("retrieval_complete", PASS if n == expected else FAIL, f"expected {expected}, got {n}"))
    keys = complaints.groupBy("unique_key").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d")).first().d
    out.append(s("unique_key", FAIL if keys else PASS, f"duplicates {keys}", category="uniqueness"))
    gaps = {r.field: r.missing for r in required_fields(complaints, REQUIRED).collect()}
    out.append(s("required_fields", FAIL if n and n in gaps.values() else WARN if any(gaps.values()) else PASS, str(gaps), category="technical"))
    wrong = complaints.where(F.coalesce(F.col("complaint_type") != complaint_type, F.lit(True))).count()
    out.append(s("filter_semantics", FAIL if wrong else PASS, f"{wrong} of another type", category="semantic"))
    at = F.expr("try_cast(created_date AS TIMESTAMP_NTZ)")
    closed = F.expr("try_cast(closed_date AS TIMESTAMP_NTZ)")
    day = F.to_date(at)
    inside = F.coalesce((day >= F.lit(str(first)).cast("date")) & (day <= F.lit(str(last)).cast("date")), F.lit(False))
    r = complaints.agg(
        F.count_if(~inside).alias("outside"), F.countDistinct(day).alias("days"), F.count_if(closed < at).alias("early"),
        F.count_if(F.col("category") == "other").alias("unknown"),
    ).first()
    out.append(s("date_coverage", FAIL if r.outside else WARN if r.days < (last - first).days + 1 else PASS, f"outside {r.outside}, days {r.days}"))
    out.append(s("chronology_and_status", WARN if r.early else PASS, f"closed early {r.early}", "info", "chronology"))
    out.append(s("descriptor_classification", WARN if r.unknown else PASS, f"unknown {r.unknown}", "info", "semantic"))
    m = mapping_summary(complaints).first()
    share = m.mapped / n if n else 0
    out.append(s("zone_mapping_coverage", PASS if share >= 0.95 else WARN if share >= min_coverage else FAIL, str(m.asDict()), category="location"))
    out.append(s("zone_mapping_borough_agreement", PASS if m.comparable and m.agree / m.comparable >= 0.98 else WARN, f"{m.agree} of {m.comparable}", category="location"))
    return out
