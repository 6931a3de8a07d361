"""Data quality as data: one aggregate a source, rules over its single row, and the publish gate."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions import expressions as x
from .lifecycle import ON_SCENE, VALIDATION

PASS, WARN, FAIL, UNKNOWN = "PASS", "WARN", "FAIL", "UNKNOWN"
SEVERITY = {PASS: 0, WARN: 1, UNKNOWN: 2, FAIL: 3}


@dataclass
class Check:
    check: str
    status: str
    scope: str = "critical"
    detail: str = ""
    category: str = "technical"
    #: The numbers the status stands on.
    evidence: dict = field(default_factory=dict)

    def row(self) -> tuple:
        return self.check, self.status, self.scope, self.category, self.detail


ROW = "check string, status string, scope string, category string, detail string"


def gate(checks: list[Check]) -> dict:
    """A failure blocks what its scope says: critical everything, weather or friction their own output."""
    failed = {s: [c.check for c in checks if c.status == FAIL and c.scope == s] for s in ("critical", "weather", "friction")}
    open_ = not failed["critical"]
    return {
        "publish": open_,
        "publish_weather_analysis": open_ and not failed["weather"],
        "publish_friction_kpi": open_ and not failed["friction"],
        "blocking_failures": failed["critical"],
        "weather_analysis_blockers": failed["weather"],
        "friction_kpi_blockers": failed["friction"],
        "status_counts": {s: sum(c.status == s for c in checks) for s in (PASS, WARN, FAIL, UNKNOWN)},
    }


def worst(statuses: list[str]) -> str:
    return max(statuses, key=SEVERITY.__getitem__) if statuses else UNKNOWN


def required_columns(columns: list[str], required: list[str], name: str, scope: str = "critical") -> Check:
    missing = [c for c in required if c not in columns]
    return Check(f"{name}.required_columns", FAIL if missing else PASS, scope, f"missing: {missing}" if missing else f"{len(required)} present")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, different keys, and rows beyond the first of each key; nulls are values.

    A hash of the key, eight bytes a row, finds what may occur twice; only rows whose hash
    does are grouped by the key itself. Two shuffles whose rows were combined before."""
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_h"))
    counts = hashed.groupBy("_h").agg(F.count("*").alias("n"))
    all_ = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") == 1).alias("once"))
    again = hashed.join(counts.where("n > 1").select("_h"), "_h", "left_semi").groupBy(*keys).agg(F.count("*").alias("n"))
    more = again.agg(F.count("*").alias("others"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
    return all_.crossJoin(more).select("rows", (F.col("once") + F.col("others")).alias("keys"), "duplicate_rows")  # two single rows


NATURAL_KEY = ["hvfhs_license_num", "request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "trip_miles", "base_passenger_fare"]


def daily(rides: DataFrame, first, last) -> DataFrame:
    """Rides for each day of the calendar, empty days included."""
    spark = rides.sparkSession
    days = spark.sql(f"SELECT explode(sequence(DATE'{first}', DATE'{last}')) AS day")
    n = rides.where(F.col("pickup_datetime").isNotNull()).groupBy(F.to_date("pickup_datetime").alias("day")).agg(F.count("*").alias("rides"))
    return days.join(n, "day", "left").select("day", F.coalesce("rides", F.lit(0)).alias("rides"))


def coverage_facts() -> list:
    some = [F.avg(F.col(f"{c}_datetime").isNotNull().cast("int")).alias(f"{c}_share") for c in ("request", "on_scene", "pickup", "dropoff")]
    return [F.count("*").alias("rows"), *some, F.count_if(F.col("validation_status") == "missing_timestamp").alias("missing_core")]


def chronology_facts() -> list:
    early = F.col("validation_status") == VALIDATION[1]
    return [
        F.count_if(early).alias("pickup_before_request"), F.count_if(F.col("validation_status") == VALIDATION[2]).alias("dropoff_not_after_pickup"),
        F.try_divide(F.count_if(~F.col("in_kpi_population")), F.count("*")).alias("excluded_share"),
        (F.count_if(early & F.col("request_on_whole_minute")) / F.greatest(F.count_if(early), F.lit(1))).alias("whole_minute_share"),
    ]


def on_scene_facts() -> list:
    return [*[F.count_if(F.col("on_scene_status") == s).alias(s) for s in ON_SCENE], F.try_divide(F.count_if(F.col("on_scene_status") == "observed"), F.count("*")).alias("observed_share")]


def plausibility_facts(t: Thresholds) -> list:
    m = F.col("trip_miles")
    return [
        F.count_if(m <= 0).alias("miles_not_positive"), F.count_if(m > t.max_plausible_trip_miles).alias("miles_too_far"),
        F.count_if(F.col("base_passenger_fare") < 0).alias("fare_negative"),
        F.count_if(F.col("in_kpi_population") & (F.col("request_to_pickup_min") > t.max_plausible_request_to_pickup_min)).alias("wait_too_long"),
        F.count_if(F.col("trip_time_mismatch")).alias("trip_time_mismatch"),
    ]


def timestamp_coverage(rides: DataFrame) -> DataFrame:
    return rides.agg(*coverage_facts())


def chronology(rides: DataFrame) -> DataFrame:
    return rides.agg(*chronology_facts())


def on_scene(rides: DataFrame) -> DataFrame:
    return rides.agg(*on_scene_facts())


def location_integrity(rides: DataFrame, zones: DataFrame) -> DataFrame:
    """Null, unknown and placeholder ids of both ends."""
    z = zones.select(F.col("location_id").alias("id"), "is_placeholder")
    sides = None
    for side, c in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
        j = rides.select(F.col(c).alias("v")).groupBy("v").agg(F.count("*").alias("n")).join(z, F.col("v") == F.col("id"), "left")
        n = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
        one = j.agg(
            F.lit(side).alias("side"), F.sum("n").alias("rows"), n(F.col("v").isNull()).alias("null_ids"),
            n(F.col("v").isNotNull() & F.col("id").isNull()).alias("unmatched"), n(F.col("is_placeholder")).alias("placeholder"),
        )
        sides = one if sides is None else sides.union(one)
    return sides


def plausibility(rides: DataFrame, t: Thresholds) -> DataFrame:
    return rides.agg(*plausibility_facts(t))


def population_facts() -> list:
    """The sizes later checks reconcile with."""
    c = F.count_if
    return [
        F.count("*").alias("rows"), c(F.col("in_kpi_population")).alias("kpi_population"), c(F.col("in_stage_population")).alias("stage_population"),
        c(F.col("in_zone_population")).alias("zone_population"), c(~F.col("placeholder_pickup")).alias("zone_attributable_rides"),
        c(F.col("weather_matched")).alias("weather_matched"), c(F.col("request_on_whole_minute")).alias("whole_minute"),
    ]


def populations(journey: DataFrame) -> DataFrame:
    return journey.agg(*population_facts())


SIDES = {"pickup": "PULocationID", "dropoff": "DOLocationID"}


def day_facts(first, last) -> list:
    """Rides outside the calendar, and the calendar's days that have rides, a bit each."""
    day = F.to_date("pickup_datetime")
    inside = day.between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
    bit = F.when(inside, F.expr(f"shiftleft(1L, datediff(to_date(pickup_datetime), DATE'{first}'))"))
    return [F.count_if(~inside).alias("outside"), F.bit_count(F.coalesce(F.bit_or(bit), F.lit(0).cast("long"))).alias("days")]


def with_sides(rides: DataFrame, zones: DataFrame) -> DataFrame:
    """rides with _known and _unknown_place of both ends; zones are few and broadcast."""
    z = zones.groupBy("location_id").agg(F.bool_or("is_placeholder").alias("p"))
    for side, c in SIDES.items():
        one = F.broadcast(z.select(F.col("location_id").alias(f"_{side}"), F.col("p").alias(f"_{side}_placeholder")))
        rides = rides.join(one, F.col(c) == F.col(f"_{side}"), "left")
    return rides


def side_facts() -> list:
    out = []
    for side, c in SIDES.items():
        known, null = F.col(f"_{side}").isNotNull(), F.col(c).isNull()
        out += [
            F.count_if(null).alias(f"{side}_null_ids"), F.count_if(~null & ~known).alias(f"{side}_unmatched"),
            F.count_if(F.coalesce(F.col(f"_{side}_placeholder"), F.lit(False))).alias(f"{side}_placeholder"),
        ]
    return out


def repeats(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows, and rows beyond the first of each key. One pass; a second one reads the rows of
    hashes that occur twice, if there are any."""
    hashed = lambda d: d.select(*keys, F.xxhash64(*keys).alias("_h"))
    counts = hashed(df).groupBy("_h").agg(F.count("*").alias("n"))
    r = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("many")).first()
    if not r.many:
        return r.rows, 0
    again = hashed(df).join(counts.where("n > 1").select("_h"), "_h", "left_semi").groupBy(*keys).agg(F.count("*").alias("n"))
    return r.rows, again.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d")).first().d


def trip_facts(first, last, t: Thresholds) -> list:
    """Every number that rules about trips stand on, as aggregates of rows that have sides."""
    return [*coverage_facts(), *chronology_facts(), *on_scene_facts()[:-1], *plausibility_facts(t), *day_facts(first, last), *side_facts(), on_scene_facts()[-1]]


def trip_checks(rides: DataFrame, zones: DataFrame, first, last, t: Thresholds) -> list[Check]:
    """Every rule about the trips. The facts are observed in the pass that looks for duplicates;
    where a lost executor made it count rows twice, they are counted anew."""
    seen, facts = Observation("trips"), trip_facts(first, last, t)
    sided = with_sides(rides, zones)
    rows, dup = repeats(sided.observe(seen, *facts), NATURAL_KEY)
    f = observed(seen) if rows else None
    return checks_of(f if f and f.rows == rows else sided.agg(*facts).first(), dup, first, last, t)


def observed(seen: Observation) -> Row | None:
    """What was seen; nothing where Spark found that no rows can come and left the pass out."""
    try:
        return Row(**seen.get)
    except Py4JJavaError:
        return None


def observed_write(rides: DataFrame, zones: DataFrame, facts: list, write: Callable) -> Row:
    """The facts of rides, observed while write(rides) writes them; write returns how many rows
    there are then. Where the two don't agree the facts are counted anew."""
    seen, sided = Observation("rides"), with_sides(rides, zones)
    written = write(sided.observe(seen, *facts))
    f = observed(seen)
    return f if f and written in (None, f.rows) else sided.agg(*facts).first()


def checks_of(f, dup: int, first, last, t: Thresholds) -> list[Check]:
    """The rules over the facts' single row."""
    n = f.rows
    if not n:
        return [Check("hvfhv.file_readable", FAIL, detail="no rows", category="completeness")]
    out = [Check("hvfhv.file_readable", PASS, detail=f"rows={n}", category="completeness", evidence={"rows": n})]
    rule = lambda bad, some: FAIL if bad else WARN if some else PASS
    told = lambda *names: {k: f[k] for k in names}
    add = lambda name, status, evidence, category, scope="critical": out.append(Check(f"hvfhv.{name}", status, scope, ", ".join(f"{k} {v}" for k, v in evidence.items()), category, evidence))
    empty = (last - first).days + 1 - f.days
    add("month_coverage", rule(empty, f.outside), {"empty_days": empty, "outside": f.outside}, "completeness")
    add("timestamp_coverage", rule(f.missing_core / n > t.max_excluded_share, f.missing_core), told("missing_core", "request_share", "on_scene_share", "pickup_share", "dropoff_share"), "completeness")
    add("trip_uniqueness", rule(dup / n > t.max_duplicate_share, dup), {"duplicates": dup, "share": dup / n}, "uniqueness")
    add(
        "chronology_request_pickup_dropoff", rule(f.excluded_share > t.max_excluded_share, f.excluded_share),
        told("pickup_before_request", "dropoff_not_after_pickup", "excluded_share", "whole_minute_share"), "chronology",
    )
    add("on_scene_semantics", WARN if f.observed_share >= t.min_on_scene_observed_share else FAIL, told(*ON_SCENE, "observed_share"), "semantic", "info")
    for side in SIDES:
        facts = {k: f[f"{side}_{k}"] for k in ("null_ids", "unmatched", "placeholder")}
        bad = facts["null_ids"] + facts["unmatched"]
        add(f"{side}_location_integrity", rule(bad / n > t.max_excluded_share, bad or facts["placeholder"]), facts, "location")
    add("numeric_plausibility", WARN, told("miles_not_positive", "miles_too_far", "fare_negative", "wait_too_long"), "plausibility", "info")
    add("trip_time_consistency", WARN if f.trip_time_mismatch else PASS, told("trip_time_mismatch"), "semantic", "info")
    out.append(Check("hvfhv.request_semantics_scheduled_rides", UNKNOWN, "info", "the source doesn't tell booked from live requests", "semantic"))
    return out


def zone_checks(zones: DataFrame) -> list[Check]:
    r = zones.agg(F.count("*").alias("n"), F.countDistinct("location_id").alias("ids"), F.count_if(F.col("is_placeholder")).alias("p")).first()
    return [
        Check("zones.location_id_unique", PASS if r.n == r.ids else FAIL, detail=f"rows {r.n}, ids {r.ids}", category="uniqueness"),
        Check("zones.placeholder_codes", WARN if r.p else PASS, "info", f"{r.p} placeholders", "semantic"),
    ]


def download_complete(announced: int | None, kept: int, found: dict, more: dict) -> Check:
    """Whether a file has as many bytes as were announced; found: what its footer says."""
    whole = announced is None or announced == kept
    detail = ", ".join(f"{k.replace('_', ' ')} {v}" for k, v in ({"bytes": kept} | more | {"row_groups": found["row_groups"]}).items())
    return Check("hvfhv.download_complete", PASS if whole else FAIL, detail=detail, category="completeness", evidence=found | {"bytes": kept} | more)


def shape_checks(zones: DataFrame, shapes: DataFrame) -> list[Check]:
    """Zones without a geometry, and geometries that the lookup doesn't have."""
    known = zones.where("not is_placeholder").select("location_id")
    lacking = known.join(shapes, known["location_id"] == shapes["zone_id"], "left_anti").count()
    unknown = shapes.join(zones, shapes["zone_id"] == zones["location_id"], "left_anti").count()
    return [Check("zone_shapes.id_consistency", WARN if lacking or unknown else PASS, "friction", f"without geometry {lacking}, not in the lookup {unknown}", "completeness", {"without_geometry": lacking, "not_in_lookup": unknown})]


def weather_structure(response: DataFrame, variables: list[str], timezone: str) -> list[Check]:
    """Whether a response has all arrays, as long as its hours, and the time zone that was asked for."""
    held = [F.coalesce(F.max(F.size(f"hourly.{v}")), F.lit(-1)).alias(v) for v in ("time", *variables)]
    r = response.agg(F.max("timezone").alias("_zone"), *held).first()
    lacking = [v for v in ("time", *variables) if r[v] < 0]
    uneven = [v for v in variables if v not in lacking and r[v] != r.time]
    out = [Check("weather.structure", FAIL if lacking or uneven else PASS, "weather", f"missing {lacking}" + (f", of another length {uneven}" if uneven else ""), evidence={"missing": lacking, "uneven": uneven})]
    out.append(Check("weather.timezone", PASS if r["_zone"] == timezone else FAIL, "weather", f"got {r['_zone']}", "semantic"))
    return out


def hour_coverage(weather: DataFrame, first, last) -> DataFrame:
    """Hours expected from the day before the month, received, missing, repeated; nulls a variable."""
    spark = weather.sparkSession
    calendar = spark.sql(f"SELECT explode(sequence(TIMESTAMP_NTZ'{first} 00:00:00' - INTERVAL 1 DAY, TIMESTAMP_NTZ'{last} 23:00:00', INTERVAL 1 HOUR)) AS hour")
    missing = calendar.join(weather.select("hour"), "hour", "left_anti").agg(F.count("*").alias("missing_hours"))
    expected = calendar.agg(F.count("*").alias("expected_hours"))
    seen = weather.agg(
        F.count("*").alias("received"), (F.count("*") - F.countDistinct("hour")).alias("duplicate_hours"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("temperature_c", "precipitation_mm", "wind_speed_kmh")],
    )
    return expected.crossJoin(missing).crossJoin(seen)  # three single rows


def weather_checks(weather: DataFrame, first, last, t: Thresholds, offset_km: float | None = None) -> list[Check]:
    """Rules about the hours; offset_km: how far the answering grid point is from the place asked for."""
    r = hour_coverage(weather, first, last).first()
    coverage = 1 - r.missing_hours / r.expected_hours
    status = PASS if not r.missing_hours and not r.duplicate_hours else FAIL if coverage < t.min_weather_hour_coverage else WARN
    nulls = r.null_temperature_c + r.null_precipitation_mm + r.null_wind_speed_kmh
    away = "one grid point stands for the whole city" + ("" if offset_km is None else f"; it is {offset_km:.1f} km from the place asked for")
    return [
        Check("weather.hour_coverage", status, "weather", str(r.asDict()), "completeness", r.asDict()),
        Check("weather.variable_nulls", WARN if nulls else PASS, "weather", f"{nulls} nulls", "completeness", {"nulls": nulls}),
        Check("weather.grid_point_offset", WARN, "info", away, "semantic", {"offset_km": offset_km}),
    ]


def decisions(scene, t: Thresholds, duplicates: int) -> dict:
    """What the checks decided about the figures, with the numbers that decided it."""
    used = scene.observed_share >= t.min_on_scene_observed_share
    return {
        "on_scene": {"observed_share": scene.observed_share, "least_share": t.min_on_scene_observed_share, "statuses": {s: scene[s] for s in ON_SCENE}, "stages_are_published": used},
        "duplicates": {"rows_beyond_the_first": duplicates, "removed": False},
        "requests": {"booked_and_live_are_told_apart": False, "shown_as": "a second headline without whole-minute requests"},
    }


def together(*calls: Callable) -> list:
    """What the calls return; jobs that don't need each other run side by side."""
    with ThreadPoolExecutor(len(calls)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(c)) for c in calls]]


def as_frame(spark, checks: list[Check]) -> DataFrame:
    return spark.createDataFrame([c.row() for c in checks], ROW)


def profile(df: DataFrame, columns: dict[str, Callable | None]) -> DataFrame:
    """column_name, null_share, min_value, max_value of the columns as doubles, in one pass."""
    num = lambda c: (columns[c](c) if columns[c] else F.col(c)).cast("double")
    one = df.agg(*[e.alias(f"{k}_{i}") for i, c in enumerate(columns) for k, e in (("n", F.avg(F.col(c).isNull().cast("int"))), ("lo", F.min(num(c))), ("hi", F.max(num(c))))])
    parts = ", ".join(f"'{c}', n_{i}, lo_{i}, hi_{i}" for i, c in enumerate(columns))
    return one.selectExpr(f"stack({len(columns)}, {parts}) AS (column_name, null_share, min_value, max_value)")


def license_profile(rides: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("validation_status") == s).alias(s) for s in VALIDATION]
    return rides.groupBy("hvfhs_license_num").agg(
        F.count("*").alias("rides"), *counts, (F.lit(100.0) * F.count_if(F.col("on_scene_status") == "observed") / F.count("*")).alias("observed_pct"),
        (F.lit(100.0) * F.count_if(F.col("trip_time_mismatch")) / F.count("*")).alias("mismatch_pct"),
    )


def classify(df: DataFrame, column: str, canonical: list[str], confirm: list[str] = ()) -> DataFrame:
    """Each raw value with its count and what may be done with it; the raw value is kept."""
    v = F.col("value")
    normal = x.clean("value")
    what = F.when(v.isin(*canonical), "canonical").when(normal.isin(*confirm) if confirm else F.lit(False), "needs owner").when(normal.isin(*canonical), "safe to normalise").otherwise("needs owner")
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows")).withColumn("decision", what)
