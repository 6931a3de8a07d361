"""A month's run: retrieve, check, model, compute, check again, publish or refuse.

Spark does the work on rows; the driver sees counts, quantiles and rows by zone. Exit
codes: 0 published, 2 blocked by the gate, 1 retrieval or another failure.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from pathlib import Path
from urllib.parse import urlencode

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .. import publish
from ..config import Thresholds, month_bounds
from ..functions.expressions import haversine_km, since_epoch
from ..operators import enrich, friction, geo, kpis, lifecycle, quality
from ..operators.quality import FAIL, PASS, WARN, Check
from ..sources import http, shapefiles, tables
from ..storage import Place
from . import report

CHAOS = ["none", "missing_column", "duplicate_rows", "weather_gap", "api_flaky"]
COMPLAINT_TYPE = "For Hire Vehicle Complaint"
TIMEZONE = "America/New_York"
LATITUDE, LONGITUDE = 40.7812, -73.9665
K1, K2, K3, K4, K5 = "kpi_1_median_request_to_pickup_min", "kpi_2_p90_request_to_pickup_min", "kpi_3_driver_arrival_share_of_wait_pct", "kpi_4_p90_request_to_pickup_by_zone", "kpi_5_passenger_311_complaints_per_100k_rides"
HEADLINE = [
    "hvfhv.download_complete", "hvfhv.month_coverage", "hvfhv.timestamp_coverage", "hvfhv.trip_uniqueness", "hvfhv.chronology_request_pickup_dropoff",
    "hvfhv.request_semantics_scheduled_rides", "output.headline_consistency",
]
#: The checks each figure's own status is the worst of.
DEPENDS = {
    K1: HEADLINE,
    K2: HEADLINE,
    K3: ["hvfhv.on_scene_semantics", "hvfhv.chronology_request_pickup_dropoff"],
    K4: ["hvfhv.pickup_location_integrity", "output.zone_reconciliation", *HEADLINE[:5]],
    K5: ["nyc311.retrieval_complete", "nyc311.unique_key", "nyc311.date_coverage", "nyc311.zone_mapping_coverage", "nyc311.zone_mapping_borough_agreement", "output.friction_reconciliation"],
}


class Blocked(RuntimeError):
    pass


@dataclass
class Feeds:
    """Where each source is; a {month} in the trips' address is filled in."""

    trips: str = "https://d37ci6vzurychx.cloudfront.net/trip-data/fhvhv_tripdata_{month}.parquet"
    zones: str = "https://d37ci6vzurychx.cloudfront.net/misc/taxi_zone_lookup.csv"
    shapes: str = "https://d37ci6vzurychx.cloudfront.net/misc/taxi_zones.zip"
    weather: str = "https://archive-api.open-meteo.com/v1/archive"
    complaints: str = "https://data.cityofnewyork.us/resource/erm2-nwe9.json"
    page_size: int = 1000

    @classmethod
    def from_env(cls, env=os.environ) -> Feeds:
        names = {"trips": "HVFHV_URL_TEMPLATE", "zones": "ZONE_LOOKUP_URL", "shapes": "ZONE_SHAPES_URL", "weather": "WEATHER_API_URL", "complaints": "NYC311_API_URL"}
        return cls(**{k: env[v] for k, v in names.items() if v in env}, page_size=int(env.get("NYC311_PAGE_SIZE", 1000)))


@dataclass
class Run:
    spark: SparkSession
    month: str
    feeds: Feeds
    data: Place
    output: Place
    logs: Path
    thresholds: Thresholds = field(default_factory=Thresholds)
    chaos: str = "none"
    mode: str = "full"
    refresh_weather: bool = False
    refresh_311: bool = False
    retry: http.Retry = field(default_factory=http.Retry)

    def __post_init__(self):
        self.id = f"{datetime.now():%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"
        self.first, self.last = month_bounds(self.month)
        self.data, self.output = (p if isinstance(p, Place) else Place(self.spark, p) for p in (self.data, self.output))
        if self.chaos != "none":  # a drill never replaces the real month
            self.output = self.output / f"_chaos_{self.chaos}"
        self.checks: list[Check] = []
        self.manifests: dict = {}
        self.timings: dict = {}


def weather_url(base: str, month: str) -> str:
    """The month's hours and one day before it, as rides at its start were asked for earlier."""
    first, last = month_bounds(month)
    if base.startswith("file:"):  # a folder stands in for the service
        return base.format(month=month)
    asked = {"latitude": LATITUDE, "longitude": LONGITUDE, "start_date": first - timedelta(days=1), "end_date": last, "hourly": ",".join(tables.WEATHER_VARIABLES), "timezone": TIMEZONE}
    return f"{base}?{urlencode(asked)}"


def complaint_filter(month: str) -> str:
    first, last = month_bounds(month)
    return f"complaint_type='{COMPLAINT_TYPE}' AND created_date between '{first}T00:00:00' and '{last}T23:59:59'"


def repeated_rows(trips: DataFrame) -> DataFrame:
    """The table with its first twentieth (50,000 rows at most, one at least) once more."""
    k = min(50_000, max(1, trips.count() // 20))
    return trips.unionByName(trips.where(F.col("ride_id") < k))


def without_hours(weather: DataFrame, first: int = 100, last: int = 147) -> DataFrame:
    """Hours without those at the given places; the table has some hundred rows."""
    w = weather.withColumn("_i", F.row_number().over(Window.orderBy("hour")) - 1)
    return w.where(~F.col("_i").between(first, last)).drop("_i")


def get_trips(r: Run) -> DataFrame:
    to = r.data / "raw" / "hvfhv" / r.month / f"fhvhv_tripdata_{r.month}.parquet"
    m, used = http.preserved(r.feeds.trips.format(month=r.month), to, r.retry)
    r.manifests["hvfhv"] = m
    found = tables.footer(r.spark, str(to))
    announced = None if m["content_length"] is None else int(m["content_length"])
    r.checks.append(quality.download_complete(announced, m["bytes"], found, {"reused": used}))
    return tables.trips(r.spark, str(to))


def get_zones(r: Run) -> DataFrame:
    to = r.data / "reference" / "taxi_zone_lookup.csv"
    r.manifests["zones"], _ = http.preserved(r.feeds.zones, to, r.retry)
    raw = tables.zones(r.spark, str(to))
    r.checks.append(quality.required_columns(raw.columns, tables.ZONE_COLUMNS, "zones"))
    if r.checks[-1].status == FAIL:
        raise Blocked("the zone lookup lacks columns")
    zones = enrich.zone_dimension(raw)
    found = quality.zone_checks(zones)
    r.checks += found
    if any(c.status == FAIL for c in found):
        raise Blocked("the zone lookup isn't unique")
    return zones


def get_shapes(r: Run, zones: DataFrame) -> DataFrame | None:
    to = r.data / "reference" / "taxi_zones.zip"
    try:
        r.manifests["zone_shapes"], _ = http.preserved(r.feeds.shapes, to, r.retry)
        shapes = shapefiles.read(r.spark, str(to)).persist()
        found = quality.shape_checks(zones, shapes)
    except Exception as e:  # complaints can't be placed then; the rest of the month can be published
        r.checks.append(Check("zone_shapes.retrieval", FAIL, "friction", str(e)[:300], "completeness"))
        return None
    r.checks += found
    return shapes


def get_weather(r: Run) -> DataFrame | None:
    folder, url = r.data / "raw" / "weather" / r.month, weather_url(r.feeds.weather, r.month)
    at = folder / "_manifest.json"
    m = at.read_json()
    fresh = r.refresh_weather or r.chaos == "api_flaky"
    kept = not fresh and m and http.request_key(m["url"]) == http.request_key(url) and (kept_file := folder / m["file"]).exists() and kept_file.sha256() == m["sha256"]
    if not kept:
        try:
            if r.chaos == "api_flaky":
                r.retry.faults = [500, 429]
            m = http.download(url, folder / f"hourly_{datetime.now(UTC):%Y%m%dT%H%M%S%f}.json", r.retry)
            at.write_json(m)
        except http.RetrievalError as e:
            r.checks.append(Check("weather.retrieval", FAIL, "weather", str(e), "completeness"))
            return None
    r.manifests["weather"] = m
    try:
        payload = json.loads((folder / m["file"]).read())
    except json.JSONDecodeError as e:
        r.checks.append(Check("weather.structure", FAIL, "weather", str(e)))
        return None
    r.checks.append(Check("weather.retrieval", PASS, "weather", f"bytes {m['bytes']}", "completeness"))
    if not isinstance(payload, dict) or not isinstance(payload.get("hourly"), dict):
        r.checks.append(Check("weather.structure", FAIL, "weather", "no hourly part"))
        return None
    response = tables.weather_response(r.spark, str(folder / m["file"]))
    found = quality.weather_structure(response, list(tables.WEATHER_VARIABLES), TIMEZONE)
    r.checks += [c for c in found if c.check == "weather.structure" or c.status == FAIL]
    if found[0].status == FAIL:
        return None
    rows = tables.weather(response)
    away = response.select(haversine_km(F.lit(LATITUDE), F.lit(LONGITUDE), "latitude", "longitude").alias("km")).first().km
    if r.chaos == "weather_gap":
        rows = without_hours(rows)
    r.checks += quality.weather_checks(rows, r.first, r.last, r.thresholds, away)
    return enrich.hourly_once(rows, "place")


def get_complaints(r: Run) -> tuple[DataFrame, int] | None:
    base, where = r.data / "raw" / "nyc311" / r.month, complaint_filter(r.month)
    at = base / "_manifest.json"
    m = at.read_json()
    if r.refresh_311 or not m or m.get("where") != where or not http.intact(base, m):
        folder = base / f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}"
        try:
            if r.feeds.complaints.startswith("file:"):
                return from_file(r, folder, where, at)
            body = r.retry.get(f"{r.feeds.complaints}?{urlencode({'$select': 'count(*)', '$where': where})}", lambda x: x.read())
            url = lambda offset, size: f"{r.feeds.complaints}?{urlencode({'$where': where, '$order': 'unique_key', '$limit': size, '$offset': offset})}"
            m = http.pages(url, r.feeds.page_size, folder, r.retry, int(json.loads(body)[0]["count"])) | {"where": where}
            at.write_json(m)
        except (http.RetrievalError, ValueError, KeyError, IndexError) as e:
            r.checks.append(Check("nyc311.retrieval", FAIL, "friction", str(e)[:300], "completeness"))
            return None
    r.manifests["nyc311"] = m
    return tables.complaints(r.spark, str(base / m["folder"])), m["expected"]


def from_file(r: Run, folder: Place, where: str, at: Place) -> tuple[DataFrame, int]:
    """All complaints as one stored page, from a folder that stands in for the service."""
    url = r.feeds.complaints.format(month=r.month)
    n = len(json.loads(r.retry.get(url, lambda x: x.read())))
    m = http.pages(lambda offset, size: url, n + 1, folder, r.retry, n) | {"where": where}
    at.write_json(m)
    r.manifests["nyc311"] = m
    return tables.complaints(r.spark, str(folder)), n


def place(r: Run, complaints: DataFrame, shapes: DataFrame, zones: DataFrame) -> DataFrame:
    at = geo.mapping(geo.locate(friction.categorised(complaints), shapes))
    z = zones.select(F.col("location_id").alias("zone_id"), "zone", F.col("borough").alias("zone_borough"))
    return at.join(z, "zone_id", "left")


def rounded(v, digits: int = 2):
    return None if v is None else round(float(v), digits)


def figures(r: Run, j: DataFrame, per_zone: DataFrame | None, mapping, stages: bool, gate: dict) -> tuple[dict, DataFrame]:
    """All five figures as the files hold them, and the zone rows."""
    t = r.thresholds
    h, s = kpis.headline(j).first(), kpis.arrival_share(j).first()
    out = {K1: {"value": rounded(h.median_min), "population_rides": h.population_rides}, K2: {"value": rounded(h.p90_min), "population_rides": h.population_rides}}
    if stages:
        out[K3] = {
            "value": rounded(s.arrival_share_pct, 1), "population_rides": s.stage_rides, "population_share_of_kpi_population_pct": rounded(s.share_of_kpi_pct),
            "supporting": {c: rounded(s[c]) for c in s.asDict() if c.startswith(("median_", "p90_"))},
        }
    else:
        out[K3] = {"value": None, "withheld": True, "reason": "too few rides have an observed arrival"}
    zones = kpis.by_zone(j, t.min_rides_per_zone).persist()
    rows = [z.asDict() for z in zones.orderBy("pickup_zone_id").collect()]  # one a zone
    for z in rows:
        z["median_min"], z["p90_min"] = rounded(z["median_min"]), rounded(z["p90_min"])
    ranked = sorted((z for z in rows if z["ranked"]), key=lambda z: z["p90_min"])
    city = out[K2]["value"]
    out[K4] = {
        "value": {
            "zones_ranked": len(ranked), "zones_below_min_rides": len(rows) - len(ranked), "best_zone_p90_min": ranked[0]["p90_min"] if ranked else None,
            "worst_zone_p90_min": ranked[-1]["p90_min"] if ranked else None, "worst_5": ranked[-5:][::-1], "best_5": ranked[:5],
            "zones_with_p90_over_1_5x_citywide": sum(z["p90_min"] > 1.5 * city for z in ranked) if city else None,
        },
        "population_rides": sum(z["rides"] for z in rows), "detail_file": "zone_breakdown.csv",
    }
    if per_zone is not None and gate["publish_friction_kpi"]:
        waits = kpis.grouped(j, ["pickup_borough"], F.col("in_zone_population"), t.min_rides_per_zone)
        parts = friction.kpi5(per_zone, waits, t.min_rides_per_zone).collect()
        c = next(p for p in parts if p.level == "city")  # there are rides, so there is a city
        shown = {p.borough: {
            "passenger_complaints": p.complaints_passenger, "hvfhv_pickups": p.hvfhv_pickups, "rate_per_100k": rounded(p.rate_per_100k),
            "p90_request_to_pickup_min": rounded(p.p90_min),
        } for p in sorted(parts, key=lambda p: str(p.borough)) if p.level == "borough"}
        out[K5] = {
            "value": {
                "citywide_rate_per_100k": rounded(c.rate_per_100k), "citywide_passenger_complaints": c.complaints_passenger,
                "citywide_hvfhv_pickups": c.hvfhv_pickups, "passenger_complaints_unmapped": mapping.passenger_unmapped,
                "rate_understatement_pct": rounded(100 * mapping.passenger_unmapped / mapping.passenger_total, 1) if mapping.passenger_total else None,
                "by_borough": shown,
            },
            "population_rides": c.hvfhv_pickups,
        }
    else:
        out[K5] = {"value": None, "withheld": True, "reason": "complaints weren't retrieved, valid or placed"}
    return out, zones


def supporting(r: Run, j: DataFrame, complaints: DataFrame | None, gate: dict) -> dict:
    """Context beside the figures: companies, boroughs, rain, whole-minute requests, complaints."""
    names = {"HV0003": "Uber", "HV0005": "Lyft"}
    two = lambda x: {"rides": x.rides, "median": rounded(x.median_min), "p90": rounded(x.p90_min)}
    pop = F.col("in_kpi_population")
    out = {"by_company": {x.hvfhs_license_num: {"company": names.get(x.hvfhs_license_num, "unknown")} | two(x) for x in kpis.grouped(j, ["hvfhs_license_num"], pop).collect()}}
    out["by_borough"] = {x.pickup_borough: two(x) for x in kpis.grouped(j, ["pickup_borough"], F.col("in_zone_population"), r.thresholds.min_rides_per_zone).collect()}
    if gate["publish_weather_analysis"] and (bands := kpis.band_figures(j).collect()):
        matched = {x.precip_band: rounded(x.diff_min) for x in kpis.hour_matched(j, r.thresholds.min_rides_per_zone).collect()}
        out["precipitation_association"] = {"by_band": {x.precip_band: two(x) for x in bands}, "hour_matched_median_diff_vs_dry_min": {b: matched.get(b) for b in lifecycle.BANDS[1:3]}}
    else:
        out["precipitation_association"] = {"withheld": True, "reason": "weather failed its checks or wasn't joined"}
    s = kpis.sensitivity(j).first()
    out["sensitivity_scheduled_rides"] = {
        "kpi_population": {"rides": s.rides, "median": rounded(s.median_min), "p90": rounded(s.p90_min)},
        "excluding_whole_minute_requests": {"rides": s.rides_rest, "median": rounded(s.median_rest_min), "p90": rounded(s.p90_rest_min)},
    }
    if complaints is not None:
        out["nyc311_composition"] = {
            "complaints_by_category": {x.category: x["count"] for x in complaints.groupBy("category").count().collect()},
            "pickup_reliability_reasons": complaints.where("pickup_reliability_reason").count(),
        }
    return out


def output_checks(found: dict, sizes, per_borough: list | None, mapped: int) -> list[Check]:
    """What is about to be published must agree with its populations."""
    ok = lambda name, good, detail, scope="critical": Check(f"output.{name}", PASS if good else FAIL, scope, detail, "output")
    m, p = found[K1]["value"], found[K2]["value"]
    out = [
        ok("headline_consistency", m is not None and p is not None and 0 <= m <= p, f"median {m}, p90 {p}"),
        ok("population_bounds", 0 < sizes.kpi_population <= sizes.rows, f"{sizes.kpi_population} of {sizes.rows}"),
    ]
    if found[K3]["value"] is not None:
        out.append(ok("stage_share_bounds", 0 <= found[K3]["value"] <= 100, f"{found[K3]['value']}"))
    out.append(ok("zone_reconciliation", found[K4]["population_rides"] == sizes.zone_population, f"{found[K4]['population_rides']} and {sizes.zone_population}"))
    if per_borough is not None:
        c, n = sum(b.complaints_all for b in per_borough), sum(b.hvfhv_pickups for b in per_borough)
        out.append(ok("friction_reconciliation", c == mapped and n == sizes.zone_attributable_rides, f"complaints {c} and {mapped}, rides {n} and {sizes.zone_attributable_rides}", "friction"))
    n = sum(not k.get("withheld") for k in found.values())
    out.append(ok("metric_count", 3 <= n <= 5, f"{n} published"))
    return out


def _run(r: Run, log) -> Place:
    edition = publish.Edition(r.output, r.month, r.id)
    try:
        return _fill(r, edition, log)
    except BaseException:
        edition.discard()
        raise


def _fill(r: Run, edition: publish.Edition, log) -> Place:
    """Writes the edition and publishes it."""
    started = time.time()

    def stage(name):
        r.timings[name] = round(time.time() - started - sum(r.timings.values()), 2)
        log.info("stage %s took %.1f s", name, r.timings[name])

    staged = edition.folder
    trips, zones = get_trips(r), get_zones(r)
    shapes, weather, asked = get_shapes(r, zones), get_weather(r), get_complaints(r)
    stage("extract")
    if r.chaos == "missing_column":
        trips = trips.drop("pickup_datetime")
    if r.chaos == "duplicate_rows":
        trips = repeated_rows(trips)
    r.checks.append(quality.required_columns(trips.columns, tables.TRIP_COLUMNS, "hvfhv"))
    if r.checks[-1].status == FAIL:
        raise Blocked(r.checks[-1].detail)
    placed = None
    friction_open = not any(c.status == FAIL and c.scope == "friction" for c in r.checks)
    if asked is not None and shapes is not None and friction_open:
        placed = place(r, asked[0], shapes, zones).persist()
        r.checks += friction.complaint_checks(placed, asked[1], r.first, r.last, COMPLAINT_TYPE, r.thresholds.min_311_mapping_coverage)
    weather_open = not any(c.status == FAIL and c.scope == "weather" for c in r.checks)
    stage("place")

    # the journey is written to the edition at once, and all facts of the trips come out of that pass
    j = enrich.journey(lifecycle.with_lifecycle(trips), zones, weather if weather_open else None, r.thresholds.light_rain_max_mm).persist()

    def write(rides: DataFrame) -> int | None:
        if r.chaos != "none":
            return rides.write.format("noop").mode("overwrite").save()
        at = str(staged / "ride_journey.parquet")
        enrich.published(rides).write.option("compression", "zstd").parquet(at)
        return r.spark.read.parquet(at).count()

    facts = quality.observed_write(j, zones, [*quality.trip_facts(r.first, r.last, r.thresholds), *quality.population_facts()[1:]], write)
    r.checks += quality.checks_of(facts, quality.repeats(j, quality.NATURAL_KEY)[1] if facts.rows else 0, r.first, r.last, r.thresholds)
    gate = quality.gate(r.checks)
    if not gate["publish"]:
        raise Blocked(f"critical checks failed: {gate['blocking_failures']}")
    stage("model and validate")

    per_zone = friction.by_zone(placed, friction.pickups_by_zone(j), zones).persist() if placed is not None else None
    mapping = friction.mapping_summary(placed).first() if placed is not None else None
    sizes = Row(**{k: facts[k] for k in ("rows", "kpi_population", "stage_population", "zone_population", "zone_attributable_rides", "weather_matched", "whole_minute")})
    scene = Row(**{k: facts[k] for k in (*lifecycle.ON_SCENE, "observed_share")})
    found, zone_rows = figures(r, j, per_zone, mapping, scene.observed_share >= r.thresholds.min_on_scene_observed_share, gate)
    boroughs = friction.by_borough(per_zone).collect() if per_zone is not None else None
    r.checks += output_checks(found, sizes, boroughs, mapping.mapped if mapping else 0)
    gate = quality.gate(r.checks)
    if not gate["publish"]:
        raise Blocked(f"output checks failed: {gate['blocking_failures']}")
    if not gate["publish_friction_kpi"] and found[K5]["value"] is not None:
        found[K5] = {"value": None, "withheld": True, "reason": f"blocked by {gate['friction_kpi_blockers']}"}
    status = {c.check: c.status for c in r.checks}
    for k, v in found.items():
        v["validation_status"] = "WITHHELD" if v.get("withheld") else quality.worst([status[c] for c in DEPENDS[k] if c in status])
        v["definition"] = report.DEFINITIONS[k]
    support = supporting(r, j, placed, gate)
    stage("kpis")

    publish.small_csv(enrich.published(j).orderBy("ride_id").limit(1000), staged / "ride_journey_sample.csv")
    breakdown = friction.zone_breakdown(zone_rows, per_zone) if per_zone is not None else zone_rows
    publish.small_csv(breakdown.orderBy("pickup_zone_id"), staged / "zone_breakdown.csv")
    if placed is not None:
        cols = ["unique_key", "created_date", "descriptor", "descriptor_2", "category", "pickup_reliability_reason", "reported_borough", "zone_id", "zone", "zone_borough", "mapping"]
        publish.one_csv(placed.select(*cols), staged / "nyc311_complaints_mapped.csv")
    checks = [dict(zip(("check", "status", "scope", "category", "detail"), c.row(), strict=True)) | {"evidence": c.evidence} for c in r.checks]
    repeated = next(c.evidence["duplicates"] for c in r.checks if c.check == "hvfhv.trip_uniqueness")
    decided = quality.decisions(scene, r.thresholds, repeated)
    (staged / "metrics.json").write_json({
        "month": r.month, "mode": r.mode, "run_id": r.id, "kpis": found, "supporting_analyses": support,
        "sources": {k: m.get("sha256") or m.get("folder") for k, m in r.manifests.items()},
    })
    (staged / "validation_report.json").write_json({
        "month": r.month, "run_id": r.id, "gate": gate, "thresholds": r.thresholds.echo(), "decisions": decided, "on_scene": scene.asDict(), "checks": checks,
    })
    timed = {f"{c}_datetime": None for c in ("request", "on_scene", "pickup", "dropoff")}
    prof = quality.profile(j, {**{c: since_epoch for c in timed}, **dict.fromkeys(["PULocationID", "DOLocationID", "trip_miles", "trip_time", "base_passenger_fare"])})
    (staged / "profile.json").write_json({"columns": [p.asDict() for p in prof.collect()], "by_license": [p.asDict() for p in quality.license_profile(j).collect()]})
    (staged / "evidence_table.md").write(report.markdown(r.month, r.mode, found, support, checks, gate, sizes.asDict(), decided))
    stage("write")
    (staged / "run_summary.json").write_json({
        "run_id": r.id, "month": r.month, "mode": r.mode, "chaos": r.chaos, "decision": "PUBLISHED", "seconds": round(time.time() - started, 2),
        "stage_seconds": r.timings, "retries": r.retry.retried, "populations": sizes.asDict(), "gate": gate["status_counts"], "sources": r.manifests,
    })
    final = edition.publish()
    for d in (j, zone_rows, placed, per_zone, shapes):
        if d is not None:
            d.unpersist()
    return final


def run(r: Run) -> int:
    """0, 1 or 2; without 0 the month's folder stays as it was."""
    log = publish.logger(r.logs, r.month, r.id)
    try:
        final = _run(r, log)
        log.info("published %s", final)
        return 0
    except Blocked as e:
        decision, code, why = "BLOCKED_BY_VALIDATION", 2, str(e)
    except http.RetrievalError as e:
        decision, code, why = "RETRIEVAL_FAILED", 1, str(e)
    except Exception as e:
        decision, code, why = "FAILED", 1, repr(e)
        log.exception("the run failed")
    log.error("%s: %s; nothing was published", decision, why)
    at = r.logs / "failed_runs" / f"{r.month}_{r.id}.json"
    at.parent.mkdir(parents=True, exist_ok=True)
    record = {"run_id": r.id, "month": r.month, "chaos": r.chaos, "decision": decision, "reason": why, "stage_seconds": r.timings, "checks": [(*c.row(), c.evidence) for c in r.checks]}
    at.write_text(json.dumps(record, indent=2, default=str))
    return code
