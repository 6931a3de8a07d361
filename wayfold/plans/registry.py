"""Queries of the analytics side and the SQL that checks them, each pair side by side."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions import expressions as x
from ..functions import quantiles, segments
from ..operators import enrich, friction, geo, kpis, lifecycle, orders, quality
from ..sources import bucketed
from . import adapters as a

T = Thresholds(min_rides_per_zone=20)
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    from . import check_queries, order_queries, source_queries  # noqa: F401  they register theirs

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(ORACLES)


def life(s: SparkSession, d: str) -> DataFrame:
    return lifecycle.with_lifecycle(a.rides(s, d))


def journey(s: SparkSession, d: str, weather: bool = True) -> DataFrame:
    """weather: False for figures that need none, as no plan can tell that an hour has one row."""
    return enrich.journey(life(s, d), a.zones(s, d), a.weather(s, d) if weather else None, T.light_rain_max_mm)


LIFE, JOURNEY = f"WITH {a.RIDES_SQL} ", f"WITH {a.JOURNEY_SQL} "
WAIT = "request_to_pickup_min"
Q = lambda q, c=WAIT, f="": f"quantile_cont({c}, {q}){f' FILTER ({f})' if f else ''}"
R2 = lambda e: f"floor(({e}) * 100 + 0.5) / 100.0::DOUBLE"


# ---- rides: lifecycle, populations, enrichment -------------------------------------------


@query(LIFE + f"SELECT {Q(0.5)} AS median_min, {Q(0.9)} AS p90_min, count(*) AS population_rides FROM life WHERE in_kpi_population")
def kpi_headline(s, d):
    return kpis.headline(life(s, d))


@query(ORACLES["kpi_headline"])
def kpi_headline_scaled(s, d):
    return kpis.headline_scaled(life(s, d))


LIFE_COLS = ["l_orderkey", "l_linenumber", "request_to_pickup_min", "request_to_on_scene_min", "on_scene_to_pickup_min", "trip_duration_min", "validation_status", "on_scene_status", "request_on_whole_minute", "trip_time_mismatch", "in_kpi_population", "in_stage_population"]


@query(LIFE + f"SELECT {', '.join(LIFE_COLS)} FROM life")
def lifecycle_rows(s, d):
    return life(s, d).select(*LIFE_COLS)


@query(LIFE + "SELECT validation_status, on_scene_status, count(*) AS rides FROM life GROUP BY ALL")
def lifecycle_histogram(s, d):
    return life(s, d).groupBy("validation_status", "on_scene_status").agg(F.count("*").alias("rides"))


JOURNEY_COLS = ["l_orderkey", "l_linenumber", "pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough", "placeholder_pickup", "in_zone_population", "weather_hour", "precipitation_mm", "wind_speed_kmh", "weather_matched", "precip_band", "request_hour", "request_weekday", "is_weekend", "time_period"]


@query(JOURNEY + f"SELECT {', '.join(JOURNEY_COLS)} FROM journey")
def ride_journey(s, d):
    return journey(s, d).select(*[F.col(c).cast("int").alias(c) if c in ("request_hour", "request_weekday") else F.col(c) for c in JOURNEY_COLS])


@query(JOURNEY + """SELECT count(*) AS rows, count(*) FILTER (in_kpi_population) AS kpi_population, count(*) FILTER (in_stage_population) AS stage_population,
  count(*) FILTER (in_zone_population) AS zone_population, count(*) FILTER (NOT placeholder_pickup) AS zone_attributable_rides, count(*) FILTER (weather_matched) AS weather_matched,
  count(*) FILTER (request_on_whole_minute) AS whole_minute FROM journey""")
def populations(s, d):
    return quality.populations(journey(s, d))


# ---- rides: figures -----------------------------------------------------------------------


@query(LIFE + f"""SELECT 100.0::DOUBLE * sum(date_diff('microsecond', request_datetime, on_scene_datetime)) FILTER (in_stage_population) / sum(date_diff('microsecond',
  request_datetime, pickup_datetime)) FILTER (in_stage_population) AS arrival_share_pct,
  count(*) FILTER (in_stage_population) AS stage_rides, 100.0::DOUBLE * count(*) FILTER (in_stage_population) / count(*) FILTER (in_kpi_population) AS share_of_kpi_pct,
  count(*) FILTER (on_scene_status = 'observed') / count(*)::DOUBLE AS observed_share,
  {Q(0.5, 'request_to_on_scene_min', 'in_stage_population')} AS median_request_to_on_scene_min, {Q(0.9, 'request_to_on_scene_min', 'in_stage_population')} AS p90_request_to_on_scene_min,
  {Q(0.5, 'on_scene_to_pickup_min', 'in_stage_population')} AS median_on_scene_to_pickup_min, {Q(0.9, 'on_scene_to_pickup_min', 'in_stage_population')} AS p90_on_scene_to_pickup_min FROM life""")  # fmt: skip
def kpi_arrival_share(s, d):
    return kpis.arrival_share(life(s, d))


ZONES = JOURNEY[:-1] + f", zk AS (SELECT PULocationID AS pickup_zone_id, pickup_zone, pickup_borough, count(*) AS rides, {Q(0.5)} AS median_min, {Q(0.9)} AS p90_min, count(*) >= 20 AS ranked FROM journey WHERE in_zone_population GROUP BY 1, 2, 3) "


@query(ZONES + "SELECT * FROM zk")
def kpi_by_zone(s, d):
    return kpis.by_zone(journey(s, d, weather=False), T.min_rides_per_zone)


@query(ZONES[:-1] + f""", r AS (SELECT pickup_zone_id, {R2('p90_min')} AS p90 FROM zk WHERE ranked), b AS (SELECT 'best' AS side, CAST(row_number() OVER (ORDER BY p90, pickup_zone_id) AS INTEGER) AS place, * FROM r),
  w AS (SELECT 'worst' AS side, CAST(row_number() OVER (ORDER BY p90 DESC, pickup_zone_id DESC) AS INTEGER) AS place, * FROM r) SELECT * FROM b WHERE place <= 5 UNION ALL SELECT * FROM w WHERE place <= 5""")  # fmt: skip
def kpi_zone_extremes(s, d):
    return kpis.zone_extremes(kpis.by_zone(journey(s, d, weather=False), T.min_rides_per_zone))


@query(ZONES[:-1] + f""", c AS (SELECT {R2(Q(0.9))} AS city FROM life WHERE in_kpi_population), z AS (SELECT *, {R2('p90_min')} AS p90 FROM zk)
  SELECT count(*) FILTER (ranked) AS zones_ranked, count(*) FILTER (NOT ranked) AS zones_below_min_rides, min(p90) FILTER (ranked) AS best_p90, max(p90) FILTER (ranked) AS worst_p90, count(*) FILTER (ranked AND p90 > city * 1.5::DOUBLE) AS zones_over_1_5x FROM z, c""")  # fmt: skip
def kpi_zone_summary(s, d):
    return kpis.zone_summary(kpis.by_zone(journey(s, d, weather=False), T.min_rides_per_zone), kpis.headline(life(s, d)))


@query(JOURNEY + f"SELECT pickup_borough, count(*) AS rides, {Q(0.5)} AS median_min, {Q(0.9)} AS p90_min FROM journey WHERE in_zone_population GROUP BY 1 HAVING count(*) >= 20")
def kpi_by_borough(s, d):
    return kpis.grouped(journey(s, d, weather=False), ["pickup_borough"], F.col("in_zone_population"), T.min_rides_per_zone)


@query(LIFE + f"SELECT CASE hvfhs_license_num WHEN 'HV0003' THEN 'Uber' WHEN 'HV0005' THEN 'Lyft' ELSE 'unknown' END AS company, count(*) AS rides, {Q(0.5)} AS median_min, {Q(0.9)} AS p90_min FROM life WHERE in_kpi_population GROUP BY 1")
def kpi_by_company(s, d):
    label = F.when(F.col("hvfhs_license_num") == "HV0003", "Uber").when(F.col("hvfhs_license_num") == "HV0005", "Lyft").otherwise("unknown")
    return kpis.grouped(life(s, d).withColumn("company", label), ["company"], F.col("in_kpi_population"))


@query(JOURNEY + f"SELECT precip_band, count(*) AS rides, {Q(0.5)} AS median_min, {Q(0.9)} AS p90_min FROM journey WHERE in_kpi_population AND weather_matched AND precip_band <> 'weather_unavailable' GROUP BY 1")
def precipitation_bands(s, d):
    return kpis.band_figures(journey(s, d))


@query(JOURNEY[:-1] + f""", h AS (SELECT precip_band, request_hour, count(*) AS c, {R2(Q(0.5))} AS med FROM journey WHERE in_kpi_population AND weather_matched AND precip_band <> 'weather_unavailable' GROUP BY 1, 2)
  SELECT r.precip_band, sum(r.c * (r.med - y.med)) / sum(r.c) AS diff_min, count(*) AS hours FROM h r JOIN h y ON r.request_hour = y.request_hour AND y.precip_band = 'dry' WHERE r.precip_band <> 'dry' AND r.c >= 20 GROUP BY 1""")  # fmt: skip
def hour_matched_rain(s, d):
    return kpis.hour_matched(journey(s, d), T.min_rides_per_zone)


@query(LIFE + f"""SELECT count(*) AS rides, {Q(0.5)} AS median_min, {Q(0.9)} AS p90_min, count(*) FILTER (NOT request_on_whole_minute) AS rides_rest, {Q(0.5, f='NOT request_on_whole_minute')} AS median_rest_min,
  {Q(0.9, f='NOT request_on_whole_minute')} AS p90_rest_min FROM life WHERE in_kpi_population""")
def sensitivity_whole_minute(s, d):
    return kpis.sensitivity(life(s, d))


# ---- rides: quality -----------------------------------------------------------------------


@query(LIFE + """, n AS (SELECT count(*) AS n FROM rides GROUP BY hvfhs_license_num, request_datetime, on_scene_datetime, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles, base_passenger_fare)
  SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM n""".replace(", n AS", ", n AS", 1))  # fmt: skip
def trip_uniqueness(s, d):
    return quality.duplicates(a.rides(s, d), quality.NATURAL_KEY)


@query("WITH n AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM n")
def duplicate_keys(s, d):
    return quality.duplicates(a.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])


PROFILED = ["request_datetime", "on_scene_datetime", "pickup_datetime", "PULocationID", "trip_miles", "trip_time", "base_passenger_fare"]


@query(LIFE + " UNION ALL ".join(f"SELECT '{c}' AS column_name, avg(CAST({c} IS NULL AS INTEGER)) AS null_share, CAST(min({e}) AS DOUBLE) AS min_value, CAST(max({e}) AS DOUBLE) AS max_value FROM life" for c in PROFILED for e in [f"epoch_us({c})" if "datetime" in c else c]))
def column_profile(s, d):
    return quality.profile(life(s, d), {c: x.since_epoch if "datetime" in c else None for c in PROFILED})


@query(LIFE + f"""SELECT hvfhs_license_num, count(*) AS rides, {', '.join(f'''count(*) FILTER (validation_status = '{v}') AS {v}''' for v in lifecycle.VALIDATION)},
  100.0::DOUBLE * count(*) FILTER (on_scene_status = 'observed') / count(*) AS observed_pct, 100.0::DOUBLE * count(*) FILTER (trip_time_mismatch) / count(*) AS mismatch_pct
  FROM life GROUP BY 1""")
def license_profile(s, d):
    return quality.license_profile(life(s, d))


@query(LIFE + f"""SELECT CAST(day AS DATE) AS day, count(pickup_datetime) AS rides FROM (SELECT unnest(generate_series(DATE '{a.FIRST}', DATE '{a.LAST}',
  INTERVAL 1 DAY)) AS day) c LEFT JOIN rides ON CAST(pickup_datetime AS DATE) = CAST(day AS DATE) GROUP BY 1""")
def daily_rides(s, d):
    return quality.daily(a.rides(s, d), a.FIRST, a.LAST)


@query(LIFE + f"""SELECT count(*) AS rows, {', '.join(f'avg(CAST({c}_datetime IS NOT NULL AS INTEGER)) AS {c}_share' for c in ('request', 'on_scene', 'pickup', 'dropoff'))},
  count(*) FILTER (validation_status = 'missing_timestamp') AS missing_core FROM life""")
def timestamp_coverage(s, d):
    return quality.timestamp_coverage(life(s, d))


@query(LIFE + """SELECT count(*) FILTER (validation_status = 'pickup_before_request') AS pickup_before_request, count(*) FILTER (validation_status = 'dropoff_not_after_pickup') AS dropoff_not_after_pickup,
  count(*) FILTER (NOT in_kpi_population) / count(*)::DOUBLE AS excluded_share, count(*) FILTER (validation_status = 'pickup_before_request' AND request_on_whole_minute) / greatest(count(*) FILTER (validation_status = 'pickup_before_request'),
  1)::DOUBLE AS whole_minute_share FROM life""")
def chronology(s, d):
    return quality.chronology(life(s, d))


@query(LIFE + f"SELECT {', '.join(f'''count(*) FILTER (on_scene_status = '{v}') AS {v}''' for v in lifecycle.ON_SCENE)}, count(*) FILTER (on_scene_status = 'observed') / count(*)::DOUBLE AS observed_share FROM life")
def on_scene_decision(s, d):
    return quality.on_scene(life(s, d))


@query(f"WITH {a.RIDES_SQL}, {a.ZONES_SQL} " + " UNION ALL ".join(f"""SELECT '{n}' AS side, count(*) AS rows, count(*) FILTER ({c} IS NULL) AS null_ids, count(*) FILTER ({c} IS NOT NULL AND location_id IS NULL) AS unmatched,
  count(*) FILTER (is_placeholder) AS placeholder FROM rides LEFT JOIN zones ON {c} = location_id""" for n, c in (("pickup", "PULocationID"), ("dropoff", "DOLocationID"))))
def location_integrity(s, d):
    return quality.location_integrity(a.rides(s, d), a.zones(s, d))


@query(LIFE + """SELECT count(*) FILTER (trip_miles <= 0) AS miles_not_positive, count(*) FILTER (trip_miles > 100) AS miles_too_far, count(*) FILTER (base_passenger_fare < 0) AS fare_negative,
  count(*) FILTER (in_kpi_population AND request_to_pickup_min > 60) AS wait_too_long, count(*) FILTER (trip_time_mismatch) AS trip_time_mismatch
  FROM life""")
def plausibility(s, d):
    return quality.plausibility(life(s, d), T)


@query(f"""WITH {a.WEATHER_SQL}, cal AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS hour)
  SELECT (SELECT count(*) FROM cal) AS expected_hours, (SELECT count(*) FROM cal WHERE hour NOT IN (SELECT hour FROM weather)) AS missing_hours, count(*) AS received, count(*) - count(DISTINCT hour) AS duplicate_hours,
  count(*) FILTER (temperature_c IS NULL) AS null_temperature_c, count(*) FILTER (precipitation_mm IS NULL) AS null_precipitation_mm, count(*) FILTER (wind_speed_kmh IS NULL) AS null_wind_speed_kmh FROM weather""")  # fmt: skip
def weather_coverage(s, d):
    return quality.hour_coverage(a.weather(s, d), a.FIRST, a.LAST)


@query(f"""WITH {a.WEATHER_SQL}, cal AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS hour), kept AS (SELECT *, row_number() OVER (ORDER BY hour) - 1 AS i FROM weather)
  SELECT (SELECT count(*) FROM cal) AS expected_hours, (SELECT count(*) FROM cal WHERE hour NOT IN (SELECT hour FROM kept WHERE NOT i BETWEEN 100 AND 147)) AS missing_hours, count(*) AS received, count(*) - count(DISTINCT hour) AS duplicate_hours,
  count(*) FILTER (temperature_c IS NULL) AS null_temperature_c, count(*) FILTER (precipitation_mm IS NULL) AS null_precipitation_mm, count(*) FILTER (wind_speed_kmh IS NULL) AS null_wind_speed_kmh FROM kept WHERE NOT i BETWEEN 100 AND 147""")  # fmt: skip
def weather_gap(s, d):
    """The coverage again after a gap of two days was cut into the hours."""
    from .monthly import without_hours

    return quality.hour_coverage(without_hours(a.weather(s, d)), a.FIRST, a.LAST)


CHECKS = f"""WITH {a.JOURNEY_SQL}, g AS (SELECT count(*) AS n, count(*) FILTER (validation_status = 'missing_timestamp') AS miss, count(*) FILTER (NOT in_kpi_population) AS ex,
  count(*) FILTER (on_scene_status = 'observed') AS ob, count(*) FILTER (trip_time_mismatch) AS tm,
  count(*) FILTER (CAST(pickup_datetime AS DATE) NOT BETWEEN DATE '{a.FIRST}' AND DATE '{a.LAST}') AS outside, count(DISTINCT CAST(pickup_datetime AS DATE)) FILTER (CAST(pickup_datetime AS DATE) BETWEEN DATE '{a.FIRST}' AND DATE '{a.LAST}') AS days,
  count(*) FILTER (PULocationID IS NULL OR PULocationID NOT IN (SELECT location_id FROM zones)) AS pbad, count(*) FILTER (PULocationID = 24) AS pph,
  count(*) FILTER (DOLocationID IS NULL OR DOLocationID NOT IN (SELECT location_id FROM zones)) AS dbad, count(*) FILTER (DOLocationID = 24) AS dph
  FROM journey),
 u AS (SELECT CAST(sum(n - 1) AS BIGINT) AS dup FROM (SELECT count(*) AS n FROM rides GROUP BY hvfhs_license_num, request_datetime, on_scene_datetime, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles, base_passenger_fare)),
 checks AS (
 SELECT 'hvfhv.file_readable' AS "check", CASE WHEN n = 0 THEN 'FAIL' ELSE 'PASS' END AS status, 'critical' AS scope FROM g
 UNION ALL SELECT 'hvfhv.month_coverage', CASE WHEN days < 31 THEN 'FAIL' WHEN outside > 0 THEN 'WARN' ELSE 'PASS' END, 'critical' FROM g
 UNION ALL SELECT 'hvfhv.timestamp_coverage', CASE WHEN miss / n > 0.05 THEN 'FAIL' WHEN miss > 0 THEN 'WARN' ELSE 'PASS' END, 'critical' FROM g
 UNION ALL SELECT 'hvfhv.trip_uniqueness', CASE WHEN dup / n > 0.001 THEN 'FAIL' WHEN dup > 0 THEN 'WARN' ELSE 'PASS' END, 'critical' FROM g, u
 UNION ALL SELECT 'hvfhv.chronology_request_pickup_dropoff', CASE WHEN ex / n > 0.05 THEN 'FAIL' WHEN ex > 0 THEN 'WARN' ELSE 'PASS' END, 'critical' FROM g
 UNION ALL SELECT 'hvfhv.on_scene_semantics', CASE WHEN ob / n >= 0.8 THEN 'WARN' ELSE 'FAIL' END, 'info' FROM g
 UNION ALL SELECT 'hvfhv.pickup_location_integrity', CASE WHEN pbad / n > 0.05 THEN 'FAIL' WHEN pbad > 0 OR pph > 0 THEN 'WARN' ELSE 'PASS' END, 'critical' FROM g
 UNION ALL SELECT 'hvfhv.dropoff_location_integrity', CASE WHEN dbad / n > 0.05 THEN 'FAIL' WHEN dbad > 0 OR dph > 0 THEN 'WARN' ELSE 'PASS' END, 'critical' FROM g
 UNION ALL SELECT 'hvfhv.numeric_plausibility', 'WARN', 'info'
 UNION ALL SELECT 'hvfhv.trip_time_consistency', CASE WHEN tm > 0 THEN 'WARN' ELSE 'PASS' END, 'info' FROM g
 UNION ALL SELECT 'hvfhv.request_semantics_scheduled_rides', 'UNKNOWN', 'info'
 UNION ALL SELECT 'zones.location_id_unique', 'PASS', 'critical' UNION ALL SELECT 'zones.placeholder_codes', 'WARN', 'info'
 UNION ALL SELECT 'weather.hour_coverage', CASE WHEN c = 768 THEN 'PASS' WHEN c / 768.0 < 0.99 THEN 'FAIL' ELSE 'WARN' END, 'weather' FROM (SELECT count(*) AS c FROM weather WHERE hour >= TIMESTAMP '2023-12-31' AND hour < TIMESTAMP '2024-02-01')
 UNION ALL SELECT 'weather.variable_nulls', 'PASS', 'weather' UNION ALL SELECT 'weather.grid_point_offset', 'WARN', 'info') """


def all_checks(s, d) -> list[quality.Check]:
    rides, zones, first, last = life(s, d), a.zones(s, d), date.fromisoformat(a.FIRST), date.fromisoformat(a.LAST)
    parts = quality.together(
        lambda: quality.trip_checks(rides, zones, first, last, T), lambda: quality.zone_checks(zones), lambda: quality.weather_checks(a.weather(s, d), first, last, T),
    )
    return [c for p in parts for c in p]


@query(CHECKS + 'SELECT "check", status, scope FROM checks')
def quality_checks(s, d):
    return quality.as_frame(s, all_checks(s, d)).select("check", "status", "scope")


@query(CHECKS + "SELECT count(*) FILTER (status = 'FAIL' AND scope = 'critical') = 0 AS publish, count(*) FILTER (status = 'FAIL' AND scope IN ('critical', 'weather')) = 0 AS publish_weather, " + ", ".join(f"count(*) FILTER (status = '{v}') AS n_{v.lower()}" for v in ("PASS", "WARN", "FAIL", "UNKNOWN")) + " FROM checks")
def publish_gate(s, d):
    g = quality.gate(all_checks(s, d))
    n = g["status_counts"]
    return s.createDataFrame([(g["publish"], g["publish_weather_analysis"], n["PASS"], n["WARN"], n["FAIL"], n["UNKNOWN"])], "publish boolean, publish_weather boolean, n_pass long, n_warn long, n_fail long, n_unknown long")


@query("""SELECT CAST(props AS VARCHAR) AS value, count(*) AS rows, CASE WHEN props IN ('{"k": 1}', '{"k": 2}') THEN 'canonical' WHEN lower(trim(props)) = '{"k": 3}' THEN 'needs owner' WHEN lower(trim(props)) IN ('{"k": 1}',
  '{"k": 2}') THEN 'safe to normalise' ELSE 'needs owner' END AS decision FROM events GROUP BY 1, 3""")
def value_classes(s, d):
    return quality.classify(a.table(s, d, "events"), "props", ['{"k": 1}', '{"k": 2}'], ['{"k": 3}'])


# ---- complaints and points ----------------------------------------------------------------

PICKUPS = f"""{a.JOURNEY_SQL}, {a.COMPLAINTS_SQL}, pk AS (SELECT PULocationID AS zone_id, count(*) AS hvfhv_pickups FROM journey
  WHERE NOT placeholder_pickup GROUP BY 1), cz AS (SELECT zone_id, count(*) AS complaints_all, count(*) FILTER (category = 'passenger') AS complaints_passenger,
  count(*) FILTER (category = 'non_passenger') AS complaints_non_passenger, count(*) FILTER (pickup_reliability_reason) AS complaints_pickup_reliability
  FROM complaints WHERE zone_id IS NOT NULL GROUP BY 1), pz AS (SELECT coalesce(pk.zone_id, cz.zone_id) AS zone_id, coalesce(hvfhv_pickups,
  0) AS hvfhv_pickups, {', '.join(f'coalesce({c}, 0) AS {c}' for c in friction.COUNTERS)} FROM pk FULL JOIN cz ON pk.zone_id = cz.zone_id),
  pzz AS (SELECT pz.*, zone, borough FROM pz LEFT JOIN zones ON zone_id = location_id), pb AS (SELECT borough, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in ('hvfhv_pickups', *friction.COUNTERS))}
  FROM pzz GROUP BY 1)"""


def per_zone(s, d):
    return friction.by_zone(a.complaints(s, d), friction.pickups_by_zone(journey(s, d, weather=False)), a.zones(s, d))


@query(f"WITH {PICKUPS} SELECT * FROM pzz")
def complaints_by_zone(s, d):
    return per_zone(s, d)


@query(f"WITH {PICKUPS} SELECT *, CASE WHEN hvfhv_pickups > 0 THEN complaints_passenger * 100000.0::DOUBLE / hvfhv_pickups END AS rate_per_100k FROM pb")
def complaints_by_borough(s, d):
    return friction.by_borough(per_zone(s, d))


@query(f"""WITH {PICKUPS}, bw AS (SELECT pickup_borough, {Q(0.9)} AS p90_min FROM journey WHERE in_zone_population GROUP BY 1 HAVING count(*) >= 20)
  SELECT 'borough' AS level, borough, complaints_passenger, hvfhv_pickups, complaints_passenger * 100000.0::DOUBLE / hvfhv_pickups AS rate_per_100k, p90_min FROM pb LEFT JOIN bw ON borough IS NOT DISTINCT FROM pickup_borough WHERE hvfhv_pickups >= 20
  UNION ALL SELECT 'city', NULL, CAST(sum(complaints_passenger) AS BIGINT), CAST(sum(hvfhv_pickups) AS BIGINT), sum(complaints_passenger) * 100000.0::DOUBLE / sum(hvfhv_pickups), NULL FROM pb""")  # fmt: skip
def kpi_complaint_rate(s, d):
    j = journey(s, d, weather=False)
    waits = kpis.grouped(j, ["pickup_borough"], F.col("in_zone_population"), T.min_rides_per_zone)
    return friction.kpi5(per_zone(s, d), waits, T.min_rides_per_zone)


@query(f"""WITH {PICKUPS}, up AS (SELECT CASE WHEN grouping(borough) = 1 THEN 'city' WHEN grouping(zone_id) = 1 THEN 'borough' ELSE 'zone' END AS level, borough, zone_id,
    CAST(sum(complaints_passenger) AS BIGINT) AS complaints_passenger, CAST(sum(hvfhv_pickups) AS BIGINT) AS hvfhv_pickups FROM pzz GROUP BY ROLLUP (borough, zone_id)),
  w AS (SELECT 'city' AS level, NULL AS borough, NULL AS zone_id, count(*) AS rides, {Q(0.5)} AS median_min, {Q(0.9)} AS p90_min FROM journey WHERE in_zone_population
    UNION ALL SELECT 'borough', pickup_borough, NULL, count(*), {Q(0.5)}, {Q(0.9)} FROM journey WHERE in_zone_population GROUP BY pickup_borough
    UNION ALL SELECT 'zone', pickup_borough, PULocationID, count(*), {Q(0.5)}, {Q(0.9)} FROM journey WHERE in_zone_population GROUP BY pickup_borough, PULocationID)
  SELECT up.level, up.borough, up.zone_id, complaints_passenger, hvfhv_pickups, complaints_passenger * 100000.0::DOUBLE / hvfhv_pickups AS rate_per_100k, rides, median_min, p90_min
  FROM up LEFT JOIN w ON up.level = w.level AND up.borough IS NOT DISTINCT FROM w.borough AND up.zone_id IS NOT DISTINCT FROM w.zone_id
  WHERE up.level = 'city' OR hvfhv_pickups >= CASE up.level WHEN 'borough' THEN 50 ELSE 20 END""")
def kpi_levels(s, d):
    """Complaint rates and waits of the city, boroughs and zones, each with its own threshold."""
    up = friction.levels(per_zone(s, d), {"borough": 50, "zone": 20})
    w = kpis.by_level(journey(s, d, weather=False)).select(*[F.col(c).alias(f"_{c}") for c in ("level", "borough", "zone_id")], "rides", "median_min", "p90_min")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("level", "borough", "zone_id")]
    return up.join(w, same, "left").drop("_level", "_borough", "_zone_id")


@query(f"""WITH {PICKUPS}, zk AS (SELECT PULocationID AS pickup_zone_id, pickup_zone, pickup_borough, count(*) AS rides, {Q(0.5)} AS median_min, {Q(0.9)} AS p90_min, count(*) >= 20 AS ranked FROM journey WHERE in_zone_population GROUP BY 1, 2, 3)
  SELECT zk.*, coalesce(hvfhv_pickups, 0) AS hvfhv_pickups, {', '.join(f'coalesce({c}, 0) AS {c}' for c in friction.COUNTERS)}, CASE WHEN hvfhv_pickups > 0 THEN coalesce(complaints_passenger, 0) * 100000.0::DOUBLE / hvfhv_pickups END AS rate_per_100k FROM zk LEFT JOIN pz ON pickup_zone_id = zone_id""")  # fmt: skip
def zone_breakdown(s, d):
    return friction.zone_breakdown(kpis.by_zone(journey(s, d, weather=False), T.min_rides_per_zone), per_zone(s, d))


POINTS = """WITH p AS (SELECT vec_id AS point_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
 e(zone_id, xmin, xmax, ymin, ymax, xa, ya, xb, yb) AS (SELECT z, lo, hi, lo, hi, xa, ya, xb, yb FROM (VALUES
  (5, -0.2, 0.2, -0.2, -0.2, 0.2, -0.2), (5, -0.2, 0.2, -0.2, 0.2, -0.2, -0.2), (5, -0.2, 0.2, 0.2, 0.2, -0.2, 0.2), (5, -0.2, 0.2, 0.2, -0.2, 0.2, 0.2),
  (5, -0.2, 0.2, -0.05, -0.05, 0.05, -0.05), (5, -0.2, 0.2, -0.05, 0.05, -0.05, -0.05), (5, -0.2, 0.2, 0.05, 0.05, -0.05, 0.05), (5, -0.2, 0.2, 0.05, -0.05, 0.05, 0.05),
  (9, -0.2, 0.0, -0.2, -0.2, 0.0, -0.2), (9, -0.2, 0.0, -0.2, 0.0, -0.2, -0.2), (9, -0.2, 0.0, 0.0, 0.0, -0.2, 0.0), (9, -0.2, 0.0, 0.0, -0.2, 0.0, 0.0)) t(z, lo, hi, xa, ya, xb, yb)),
 c AS (SELECT point_id, zone_id FROM p JOIN e ON x BETWEEN xmin::DOUBLE AND xmax::DOUBLE AND y BETWEEN ymin::DOUBLE AND ymax::DOUBLE AND (ya::DOUBLE > y) <> (yb::DOUBLE > y)
  AND x < (xb::DOUBLE - xa::DOUBLE) * (y - ya::DOUBLE) / (yb::DOUBLE - ya::DOUBLE) + xa::DOUBLE GROUP BY 1, 2 HAVING count(*) % 2 = 1),
 h AS (SELECT point_id, min(zone_id) AS zone_id, count(*) > 1 AS ambiguous FROM c GROUP BY 1),
 m AS (SELECT p.point_id, h.zone_id, coalesce(ambiguous, false) AS ambiguous, CASE WHEN x IS NULL OR y IS NULL THEN 'no_coordinates' WHEN ambiguous THEN 'ambiguous_lowest_id' WHEN h.zone_id IS NOT NULL THEN 'mapped' ELSE 'outside_all_zones' END AS mapping FROM p LEFT JOIN h ON p.point_id = h.point_id) """


def located(s, d):
    return geo.mapping(geo.locate(a.points(s, d), a.polygons(s)))


@query(POINTS + "SELECT * FROM m")
def point_in_polygon(s, d):
    return located(s, d).select("point_id", "zone_id", "ambiguous", "mapping")


@query(f"""{POINTS} SELECT CAST(count(*) FILTER (x > -0.25 AND x < 0.25 AND y > -0.25 AND y < 0.25) > 0 AS BOOLEAN) AS some, true AS most_by_cell,
  (SELECT count(*) FROM (SELECT DISTINCT x, y FROM p SEMI JOIN h ON p.point_id = h.point_id)) AS inside FROM p""")
def polygon_lookups(s, d):
    """How places were decided: most of those that a zone holds by a cell alone."""
    r = geo.lookups(a.points(s, d), a.polygons(s))
    inside = located(s, d).where("zone_id is not null").select("x", "y").distinct().agg(F.count("*").alias("inside"))
    return r.select((F.col("places") > 0).alias("some"), (F.col("share_by_sides") < 0.5).alias("most_by_cell")).crossJoin(inside)


@query(POINTS + """SELECT count(*) AS rows, count(*) FILTER (mapping IN ('mapped', 'ambiguous_lowest_id')) AS mapped, count(*) FILTER (mapping = 'no_coordinates') AS no_coordinates,
  count(*) FILTER (mapping = 'outside_all_zones') AS outside_all_zones, count(*) FILTER (ambiguous) AS ambiguous, count(*) FILTER (point_id % 2 = 0) AS passenger_total,
  count(*) FILTER (point_id % 2 = 0 AND zone_id IS NULL) AS passenger_unmapped, count(*) FILTER (zone_id IS NOT NULL AND point_id % 3 <> 0) AS comparable,
  count(*) FILTER (zone_id = 5 AND point_id % 3 = 1) AS agree FROM m""")
def mapping_summary(s, d):
    p = located(s, d)
    return friction.mapping_summary(p.withColumns({"category": F.expr("if(point_id % 2 = 0, 'passenger', 'other')"), "zone_borough": F.expr("case zone_id when 5 then 'North' when 9 then 'South' end"), "reported_borough": F.expr("case point_id % 3 when 0 then 'Unspecified' when 1 then 'NORTH' else 'East' end")}))


@query("""SELECT field, CAST(missing AS BIGINT) AS missing FROM (SELECT count(*) FILTER (props IS NULL OR props = '') AS props, count(*) FILTER (event_type IS NULL OR event_type = '') AS event_type,
  count(*) FILTER (user_id IS NULL) AS user_id FROM events) UNPIVOT (missing FOR field IN (props, event_type, user_id))""")
def required_fields(s, d):
    return friction.required_fields(a.table(s, d, "events"), ["props", "event_type", "user_id"])


# ---- orders -------------------------------------------------------------------------------

ORDERS = f"WITH {a.ORDERS_SQL} "
LATE = "avg(CAST(coalesce(delay_min > 0, false) AS INTEGER))"


def valid(s, d):
    o = a.orders(s, d)
    return orders.with_delay(o.where(orders.delivered(o))).withColumn("promise_min", x.minutes("promised_eta", "created_at"))


@query(ORDERS + f"SELECT count(*) AS orders, count(*) FILTER (delay_min > 0) AS late, {LATE} AS late_rate, quantile_cont(delay_min, 0.5) FILTER (delay_min > 0) AS median_delay_late FROM valid")
def late_summary(s, d):
    return orders.late_summary(valid(s, d))


@query(ORDERS + """, c AS (SELECT count(*) FILTER (ok AND delay_min > 0) AS l, count(*) FILTER (ok) AS v, count(*) FILTER (final_status = 'delivered' AND delay_min > 0) AS le,
  count(*) FILTER (final_status = 'delivered' AND delay_min IS NOT NULL) AS ve, count(*) AS n,
  count(*) FILTER (lower(trim(final_status)) = 'delivered' AND delay_min IS NULL) AS u FROM (SELECT *, lower(trim(final_status)) = 'delivered' AND delay_min IS NOT NULL AS ok FROM delayed))
  SELECT 'delivered_with_times' AS variant, l / v::DOUBLE AS late_rate FROM c UNION ALL SELECT 'case_sensitive_status', le / ve::DOUBLE FROM c UNION ALL SELECT 'all_orders', l / n::DOUBLE FROM c UNION ALL SELECT 'lower_bound', l / (v + u)::DOUBLE FROM c UNION ALL SELECT 'upper_bound', (l + u) / (v + u)::DOUBLE FROM c""")  # fmt: skip
def late_variants(s, d):
    return orders.late_variants(a.orders(s, d))


@query(ORDERS + " UNION ALL ".join(f"SELECT {t} AS threshold_min, avg(CAST(delay_min > {t} AS INTEGER)) AS late_rate FROM valid" for t in (0, 5, 10, 15, 20)))
def late_curve(s, d):
    return orders.late_curve(valid(s, d), [0, 5, 10, 15, 20])


DELAY_EDGES, DELAY_LABELS = [0, 1e4, 1e5, 1e6, 1e7], ["to_1e4", "to_1e5", "to_1e6", "to_1e7"]


@query(ORDERS + """, b AS (SELECT CASE WHEN delay_min > 0 AND delay_min <= 1e4 THEN 'to_1e4' WHEN delay_min > 1e4 AND delay_min <= 1e5 THEN 'to_1e5' WHEN delay_min > 1e5 AND delay_min <= 1e6 THEN 'to_1e6' WHEN delay_min > 1e6 AND delay_min <= 1e7 THEN 'to_1e7' END AS delay_bin
  FROM valid)
  SELECT delay_bin, count(*) AS rows, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM b WHERE delay_bin IS NOT NULL GROUP BY 1""")  # fmt: skip
def delay_bins(s, d):
    return orders.shares(valid(s, d), x.bins("delay_min", DELAY_EDGES, DELAY_LABELS), "delay_bin")





@query(ORDERS + f"""SELECT CASE WHEN distance_km_estimate >= 0 AND distance_km_estimate < 5 THEN 'near' WHEN distance_km_estimate < 10 THEN 'middle' WHEN distance_km_estimate < 18 THEN 'far' WHEN distance_km_estimate < 24 THEN 'farthest' END AS distance_bin,
  count(*) AS orders, {LATE} AS late_rate, quantile_cont(delay_min, 0.5) AS median_delay, avg(promise_min) AS mean_promise
  FROM valid GROUP BY 1""")
def distance_summary(s, d):
    return orders.summarise(valid(s, d), x.bins("distance_km_estimate", [0, 5, 10, 18, 24], ["near", "middle", "far", "farthest"], right=False), "distance_bin")


@query(ORDERS + f"SELECT traffic_bucket, {', '.join(f'''{LATE} FILTER (weather_bucket = '{w}') AS {w}''' for w in 'FOP')} FROM valid GROUP BY 1")
def late_crosstab(s, d):
    return orders.crosstab(valid(s, d), "traffic_bucket", "weather_bucket", list("FOP"), x.share(orders.late()))


@query(ORDERS + f"SELECT traffic_bucket, {', '.join(f'''count(*) FILTER (weather_bucket = '{w}') AS {w}''' for w in 'FOP')} FROM ords GROUP BY 1")
def count_crosstab(s, d):
    return orders.crosstab(a.orders(s, d), "traffic_bucket", "weather_bucket", list("FOP"), F.count(F.lit(1)), 0)


@query(ORDERS + """SELECT count(delay_min) AS n, avg(delay_min) AS mean, stddev_samp(delay_min) AS std, min(delay_min) AS lo, quantile_cont(delay_min, 0.25) AS q25,
  quantile_cont(delay_min, 0.5) AS q50, quantile_cont(delay_min, 0.75) AS q75, max(delay_min) AS hi FROM valid""")
def describe_delay(s, d):
    return orders.describe(valid(s, d), "delay_min")


@query(ORDERS + "SELECT avg(CAST(distance_km_estimate = 18.0 AS INTEGER)) AS share_18km, count(*) AS orders FROM ords")
def exact_value_share(s, d):
    return a.orders(s, d).agg(x.share(F.col("distance_km_estimate") == 18.0).alias("share_18km"), F.count("*").alias("orders"))


COVER = lambda child, key, parent, pk, name: f"""SELECT '{name}' AS relationship, count(*) AS rows, count(*) FILTER ({key} IS NULL) AS null_keys, count(*) FILTER ({key} IS NOT NULL AND p IS NULL) AS unmatched,
  count(p) / count(*)::DOUBLE AS coverage FROM {child} LEFT JOIN (SELECT DISTINCT {pk} AS p FROM {parent}) x ON {key} = p"""  # noqa: E731


@query(ORDERS + COVER("ords", "customer_id", "(SELECT * FROM customer WHERE c_acctbal > 0)", "c_custkey", "order_customer") + " UNION ALL " + COVER("ords", "restaurant_id", "supplier", "s_suppkey", "order_restaurant") + " UNION ALL " + COVER("lineitem", "l_orderkey", "orders", "o_orderkey", "item_order"))
def reference_coverage(s, d):
    o, t = a.orders(s, d), lambda n: a.table(s, d, n)
    return orders.fk_coverage(o, "customer_id", t("customer").where("c_acctbal > 0"), "c_custkey", "order_customer").union(orders.fk_coverage(o, "restaurant_id", t("supplier"), "s_suppkey", "order_restaurant")).union(orders.fk_coverage(t("lineitem"), "l_orderkey", t("orders"), "o_orderkey", "item_order"))


KEYS = lambda t, k, n: f"""SELECT '{n}' AS table_name, CAST(sum(n) AS BIGINT) AS rows, max(n) <= 1 AS key_unique, CAST(coalesce(sum(n) FILTER (k IS NULL), 0) AS BIGINT) AS key_nulls,
  max(n) AS max_per_key FROM (SELECT {k} AS k, count(*) AS n FROM {t} GROUP BY 1)"""  # noqa: E731


@query(ORDERS + KEYS("ords", "order_id", "orders") + " UNION ALL " + KEYS("ords", "restaurant_id", "restaurants") + " UNION ALL " + KEYS("lineitem", "l_orderkey", "items"))
def key_report(s, d):
    o = a.orders(s, d)
    return orders.key_report(o, "order_id", "orders").union(orders.key_report(o, "restaurant_id", "restaurants")).union(orders.key_report(a.table(s, d, "lineitem"), "l_orderkey", "items"))


@query("SELECT rows_per_key, count(*) AS keys FROM (SELECT count(*) AS rows_per_key FROM lineitem GROUP BY l_orderkey) GROUP BY 1")
def cardinality(s, d):
    return orders.cardinality(a.table(s, d, "lineitem"), "l_orderkey")


@query("""WITH g AS (SELECT count(DISTINCT l_returnflag) > 1 AS a, count(DISTINCT l_linestatus) > 1 AS b, count(DISTINCT l_partkey) > 1 AS c
  FROM lineitem GROUP BY l_orderkey, l_linenumber) SELECT 'l_returnflag' AS column_name, count(*) FILTER (a) AS conflicting_keys
  FROM g UNION ALL SELECT 'l_linestatus', count(*) FILTER (b) FROM g UNION ALL SELECT 'l_partkey', count(*) FILTER (c)
  FROM g""")
def key_conflicts(s, d):
    return orders.key_conflicts(a.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_returnflag", "l_linestatus", "l_partkey"])


FIRST_ROWS = "row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate)"
ITEM_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, {FIRST_ROWS} AS n FROM lineitem) WHERE n = 1")
def keep_first(s, d):
    return orders.keep_first(a.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"], ITEM_ORDER).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def all_duplicated(s, d):
    return orders.duplicated(a.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(s, d):
    return a.table(s, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(ORDERS + "SELECT order_id, delay_min FROM valid ORDER BY delay_min DESC, order_id LIMIT 10")
def worst_delays(s, d):
    return valid(s, d).select("order_id", "delay_min").orderBy(F.desc("delay_min"), "order_id").limit(10)


@query("""WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) FILTER (event_type = 'view') AS request_datetime, min(ts) FILTER (event_type = 'click') AS on_scene_datetime,
  min(ts) FILTER (event_type = 'purchase') AS pickup_datetime, min(ts) FILTER (event_type = 'signup') AS dropoff_datetime
  FROM events GROUP BY 1, 2) SELECT * FROM e""")
def first_event_times(s, d):
    e = a.table(s, d, "events").withColumn("day", F.to_date("ts"))
    return orders.first_times(e, ["user_id", "day"], "event_type", "ts", {"view": "request_datetime", "click": "on_scene_datetime", "purchase": "pickup_datetime", "signup": "dropoff_datetime"})


@query("""WITH p AS (SELECT event_id, user_id, ts, 40.0::DOUBLE + (event_id % 100) / 100.0::DOUBLE AS lat, -74.0::DOUBLE + (event_id % 37) / 100.0::DOUBLE AS lon FROM events),
 l AS (SELECT *, lag(ts) OVER w AS t0, lag(lat) OVER w AS la, lag(lon) OVER w AS lo FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 k AS (SELECT *, date_diff('microsecond', t0, ts) / 60e6::DOUBLE AS gap_min, 111.0::DOUBLE * sqrt((lat - la) * (lat - la) + ((lon - lo) * cos(radians(lat))) * ((lon - lo) * cos(radians(lat)))) AS km FROM l)
 SELECT event_id, gap_min, round(km, 6) AS km, coalesce(km > 20, false) AS jump FROM k""")  # fmt: skip
def ping_gaps(s, d):
    e = a.table(s, d, "events").select("event_id", "user_id", "ts", F.expr("40.0D + (event_id % 100) / 100.0D").alias("lat"), F.expr("-74.0D + (event_id % 37) / 100.0D").alias("lon"))
    return orders.pings(e, "user_id", "ts", "event_id").select("event_id", "gap_min", F.round("km", 6).alias("km"), "jump")


HOT = """WITH p AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN -1 WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS k, ts,
  40.0::DOUBLE + (event_id % 100) / 100.0::DOUBLE AS lat, -74.0::DOUBLE + (event_id % 37) / 100.0::DOUBLE AS lon FROM events)"""


def hot_pings(s, d):
    """Half of all events under one key, a tenth under none."""
    k = F.expr("if(event_id % 2 = 0, -1, if(event_id % 5 = 0, null, user_id))").alias("k")
    return a.table(s, d, "events").select("event_id", k, "ts", F.expr("40.0D + (event_id % 100) / 100.0D").alias("lat"), F.expr("-74.0D + (event_id % 37) / 100.0D").alias("lon"))


@query(HOT + """, l AS (SELECT *, lag(ts) OVER w AS t0, lag(lat) OVER w AS la, lag(lon) OVER w AS lo FROM p WINDOW w AS (PARTITION BY k ORDER BY ts, event_id)),
 k AS (SELECT *, date_diff('microsecond', t0, ts) / 60e6::DOUBLE AS gap_min, 111.0::DOUBLE * sqrt((lat - la) * (lat - la) + ((lon - lo) * cos(radians(lat))) * ((lon - lo) * cos(radians(lat)))) AS km FROM l)
 SELECT event_id, gap_min, round(km, 6) AS km, coalesce(km > 20, false) AS jump FROM k""")  # fmt: skip
def hot_ping_gaps(s, d):
    """Gaps where one key is cut into segments of about a hundredth of all events."""
    e = hot_pings(s, d)
    return orders.pings(e, "k", "ts", "event_id", most=max(50, e.count() // 100)).select("event_id", "gap_min", F.round("km", 6).alias("km"), "jump")


@query(HOT + """, e AS (SELECT event_id, k, CASE WHEN event_id % 7 <> 0 THEN ts END AS event_time FROM p)
 SELECT event_id, k AS order_id, CAST(row_number() OVER (PARTITION BY k ORDER BY event_time NULLS LAST, event_id) AS INTEGER) AS position FROM e""")
def hot_timeline(s, d):
    """Positions in the same keys, a seventh of the times unknown."""
    e = hot_pings(s, d).select("event_id", F.col("k").alias("order_id"), F.expr("if(event_id % 7 <> 0, ts, null)").alias("event_time"))
    return segments.placed(e, "order_id", ["event_time", "event_id"], "position", max(50, e.count() // 100)).select("event_id", "order_id", "position")


SIDES = f"WITH {a.SIDES_SQL} "


def sides(s, d):
    o = a.orders(s, d)
    out = orders.with_delay(o).select("order_id", F.when(F.col("delay_min").isNotNull(), (F.col("delay_min") > 0).cast("int")).alias("late_flag"), "delay_min")
    return orders.journey(o.select("order_id", "restaurant_id", "actual_delivery_at"), out, a.actions(s, d), a.tickets(s, d), a.interventions(s, d))


JOUR = ["order_id", "late_flag", "n_actions", "eta_views", "cancelled", "n_tickets", "n_interventions", "reasons", "frustrated", "neglected", "intervention_timing"]


@query(SIDES + f"SELECT {', '.join(JOUR)} FROM jour")
def order_journey(s, d):
    return sides(s, d).select(*JOUR)


def in_buckets(s, d):
    """Orders and what belongs to them, written in buckets of the order's id."""
    o = a.orders(s, d)
    n = max(8, bucketed.buckets_for(o, a.actions(s, d)))
    delays = orders.with_delay(o).select("order_id", F.when(F.col("delay_min").isNotNull(), (F.col("delay_min") > 0).cast("int")).alias("late_flag"), "delay_min")
    return bucketed.journey_tables(s, n, orders=o, outcomes=delays, actions=a.actions(s, d), tickets=a.tickets(s, d), interventions=a.interventions(s, d))


@query(ORACLES["order_journey"])
def bucketed_journey(s, d):
    """The same rows from bucketed tables: no shuffle is left in the plan."""
    t = in_buckets(s, d)
    return orders.journey(t["orders"].select("order_id", "restaurant_id", "actual_delivery_at"), t["outcomes"], t["actions"], t["tickets"], t["interventions"]).select(*JOUR)


@query(f"""{SIDES}, c AS (SELECT order_id, count(*) AS n FROM actions GROUP BY 1), t AS (SELECT order_id, count(*) AS n FROM tickets WHERE order_id IS NOT NULL GROUP BY 1)
  SELECT order_id, coalesce(c.n, 0) AS n_actions, coalesce(t.n, 0) AS n_tickets, c.n IS NULL AS no_action, t.n IS NULL AS no_ticket FROM ords LEFT JOIN c USING (order_id) LEFT JOIN t USING (order_id)""")
def bucketed_coverage(s, d):
    """Which orders have actions and tickets, from the same buckets."""
    t = in_buckets(s, d)
    n = {k: t[k].groupBy("order_id").agg(F.count("*").alias(f"n_{k}")) for k in ("actions", "tickets")}
    out = t["orders"].select("order_id").join(n["actions"], "order_id", "left").join(n["tickets"], "order_id", "left")
    return out.select("order_id", *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in n], F.col("n_actions").isNull().alias("no_action"), F.col("n_tickets").isNull().alias("no_ticket"))


@query(SIDES + """SELECT late_flag = 1 AS is_late, count(*) AS orders, avg(CAST(n_tickets > 0 AS INTEGER)) AS with_ticket, avg(CAST(frustrated AS INTEGER)) AS frustrated_share,
  avg(CAST(n_interventions > 0 AS INTEGER)) AS with_intervention, avg(eta_views) AS mean_eta_views, quantile_cont(delay_min, 0.5) AS median_delay
  FROM jour WHERE late_flag IS NOT NULL GROUP BY 1""")
def journey_metrics(s, d):
    return orders.journey_metrics(sides(s, d))


@query(SIDES + "SELECT intervention_timing, count(*) AS orders, avg(late_flag) AS late_rate, quantile_cont(delay_min, 0.5) AS median_delay FROM jour GROUP BY 1")
def intervention_timing(s, d):
    shares = [F.count("*").alias("orders"), F.avg("late_flag").alias("late_rate")]
    return quantiles.summary(sides(s, d), ["intervention_timing"], shares, {"median_delay": ("delay_min", 0.5, None)})


@query(SIDES + "SELECT reason, " + ", ".join(f"count(*) FILTER (intervention_type = '{t}') AS {t}" for t in "FO") + " FROM inter GROUP BY 1")
def reason_crosstab(s, d):
    return orders.crosstab(a.interventions(s, d), "reason", "intervention_type", ["F", "O"], F.count(F.lit(1)), 0)


@query(SIDES + """SELECT restaurant_id, count(*) AS orders, CAST(sum(late_flag) AS BIGINT) AS late, avg(late_flag) AS late_rate, quantile_cont(delay_min,
  0.5) AS median_delay FROM jour WHERE restaurant_id IS NOT NULL GROUP BY 1 ORDER BY late DESC NULLS LAST, restaurant_id LIMIT 8""")
def restaurant_contribution(s, d):
    known, order = sides(s, d).where("restaurant_id is not null"), (F.desc_nulls_last("late"), "restaurant_id")
    counts = [F.count("*").alias("orders"), F.sum("late_flag").alias("late"), F.avg("late_flag").alias("late_rate")]
    most = known.groupBy("restaurant_id").agg(*counts).orderBy(*order).limit(8).select("restaurant_id")
    listed = known.join(F.broadcast(most), "restaurant_id", "left_semi")  # eight ids
    return quantiles.summary(listed, ["restaurant_id"], counts, {"median_delay": ("delay_min", 0.5, None)}).orderBy(*order)


EVENTS = ["order_id", "event_time", "event_type", "actor", "source_system"]


@query(SIDES + """SELECT *, CAST(row_number() OVER (PARTITION BY order_id ORDER BY event_time NULLS LAST, event_type, source_system, actor) AS INTEGER) AS position FROM (
  SELECT order_id, created_at AS event_time, 'created' AS event_type, 'customer' AS actor, 'orders' AS source_system FROM ords UNION ALL SELECT order_id, pickup_at, 'pickup', 'driver', 'orders' FROM ords
  UNION ALL SELECT order_id, actual_delivery_at, 'delivered', 'driver', 'orders' FROM ords
  UNION ALL SELECT order_id, action_at, action_type, 'customer', 'actions' FROM actions UNION ALL SELECT order_id, created_at, category, 'customer', 'tickets' FROM tickets WHERE order_id IS NOT NULL UNION ALL SELECT order_id, intervention_at, intervention_type, 'operations', 'interventions' FROM inter)""")  # fmt: skip
def order_timeline(s, d):
    o, row = a.orders(s, d), lambda df, at, kind, actor, source: df.select("order_id", F.col(at).alias("event_time"), kind.alias("event_type"), F.lit(actor).alias("actor"), F.lit(source).alias("source_system"))
    steps = [F.struct(F.col(f"{c}_at").alias("event_time"), F.lit(n).alias("event_type"), F.lit(who).alias("actor"), F.lit("orders").alias("source_system")) for c, n, who in (("created", "created", "customer"), ("pickup", "pickup", "driver"), ("actual_delivery", "delivered", "driver"))]
    own = o.select("order_id", F.inline(F.array(*steps)))  # orders are worked out once
    return orders.timeline(own, row(a.actions(s, d), "action_at", F.col("action_type"), "customer", "actions"), row(a.tickets(s, d).where("order_id is not null"), "created_at", F.col("category"), "customer", "tickets"), row(a.interventions(s, d), "intervention_at", F.col("intervention_type"), "operations", "interventions"))


@query(ORDERS + """SELECT count(*) FILTER (promised_eta < created_at) AS eta_before_creation, count(*) FILTER (pickup_at < created_at) AS pickup_before_creation,
  count(*) FILTER (actual_delivery_at < pickup_at) AS delivered_before_pickup, count(*) FILTER (lower(trim(final_status)) = 'cancelled' AND actual_delivery_at IS NOT NULL) AS cancelled_with_delivery
  FROM ords""")
def order_chronology(s, d):
    return orders.order_chronology(a.orders(s, d))


@query(ORDERS + """, b AS (SELECT count(*) FILTER (delay_min IS NOT NULL) AS orders_before, count(*) FILTER (delay_min > 0) AS late_before
  FROM delayed), c AS (SELECT date_diff('microsecond', promised_eta, coalesce(actual_delivery_at, second_delivery_at)) AS m
  FROM ords)
  SELECT b.*, (SELECT count(m) FROM c) AS orders_after, (SELECT count(*) FROM c WHERE m > 0) AS late_after FROM b""")  # fmt: skip
def reconciled_late_rate(s, d):
    o = a.orders(s, d)
    return orders.reconciled(o, o.select("order_id", F.col("second_delivery_at").alias("delivered_at")))


@query(ORDERS + "SELECT count(*) AS matched, count(*) FILTER (actual_delivery_at IS NULL OR second_delivery_at IS NULL OR actual_delivery_at <> second_delivery_at) AS different FROM ords")
def source_disagreement(s, d):
    o = a.orders(s, d)
    return orders.disagreement(o.select("order_id", F.col("actual_delivery_at").alias("t")), o.select("order_id", F.col("second_delivery_at").alias("t")), "order_id", "t")


@query(ORDERS + "SELECT order_id, abs(date_diff('microsecond', actual_delivery_at, second_delivery_at) / 60e6::DOUBLE) AS diff_min FROM ords WHERE abs(date_diff('microsecond', actual_delivery_at, second_delivery_at) / 60e6::DOUBLE) > 0.01")
def time_differences(s, d):
    return a.orders(s, d).select("order_id", F.abs(x.minutes("second_delivery_at", "actual_delivery_at")).alias("diff_min")).where("diff_min > 0.01")


@query(ORDERS + "SELECT order_id % 3 = 0 AS reassigned, driver_id % 2 = 0 AS new_model, count(*) AS orders, " + LATE + " AS late_rate FROM valid GROUP BY 1, 2")
def late_by_attribute(s, d):
    v = valid(s, d).withColumns({"reassigned": F.expr("order_id % 3 = 0"), "new_model": F.expr("driver_id % 2 = 0")})
    return v.groupBy("reassigned", "new_model").agg(F.count("*").alias("orders"), x.share(orders.late()).alias("late_rate"))


@query(ORDERS + "SELECT final_status, lower(trim(final_status)) AS status_clean, count(*) AS rows FROM ords GROUP BY 1, 2")
def status_values(s, d):
    return a.orders(s, d).withColumn("status_clean", x.clean("final_status")).groupBy("final_status", "status_clean").agg(F.count("*").alias("rows"))


@query("SELECT 'props' AS column_name, count(*) FILTER (props IS NOT NULL AND TRY_CAST(props AS TIMESTAMP) IS NULL) AS unparseable FROM events UNION ALL SELECT 't', 0")
def unparseable_times(s, d):
    return orders.unparseable(a.table(s, d, "events").select("props", F.col("ts").cast("string").alias("t")), ["props", "t"])


@query("""SELECT 'only_left' AS side, n FROM (SELECT count(*) AS n FROM (SELECT CAST(l_suppkey % 26 AS INTEGER) FROM lineitem EXCEPT SELECT n_nationkey
  FROM nation)) UNION ALL SELECT 'only_right', (SELECT count(*) FROM (SELECT n_nationkey FROM nation WHERE n_nationkey <> 24 EXCEPT SELECT CAST(l_suppkey % 20 AS INTEGER)
  FROM lineitem))""")
def id_differences(s, d):
    """Ids that only one of two sources knows, both ways."""
    n = a.table(s, d, "nation").select("n_nationkey")
    li = a.table(s, d, "lineitem")
    used, fewer = li.select(F.expr("cast(l_suppkey % 26 as int)").alias("n_nationkey")).distinct(), li.select(F.expr("cast(l_suppkey % 20 as int)").alias("n_nationkey")).distinct()
    left = used.join(n, "n_nationkey", "left_anti").agg(F.lit("only_left").alias("side"), F.count("*").alias("n"))
    return left.union(n.where("n_nationkey <> 24").join(fewer, "n_nationkey", "left_anti").agg(F.lit("only_right"), F.count("*")))


@query("""WITH p AS (SELECT min(ts) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id) AS first_purchase, * FROM events) SELECT count(*) FILTER (event_type IN ('view',
  'click') AND ts > first_purchase) AS written_after, count(*) FILTER (event_type = 'signup' AND ts < first_purchase) AS written_before,
  count(*) AS rows FROM p""")
def stale_updates(s, d):
    """Updates that came after the step they should precede: first step per key, joined back."""
    e = a.table(s, d, "events")
    first = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("first_purchase"))
    j, k = e.join(first, "user_id", "left"), F.col("event_type")
    return j.agg(F.count_if(k.isin("view", "click") & (F.col("ts") > F.col("first_purchase"))).alias("written_after"), F.count_if((k == "signup") & (F.col("ts") < F.col("first_purchase"))).alias("written_before"), F.count("*").alias("rows"))


@query(ORDERS + "SELECT traffic_bucket, weather_bucket, quantile_cont(delay_min, 0.5) AS median_delay, quantile_cont(promise_min, 0.5) AS median_promise, quantile_cont(distance_km_estimate, 0.5) AS median_distance FROM valid GROUP BY 1, 2")
def group_medians(s, d):
    medians = {f"median_{n}": (c, 0.5, None) for c, n in (("delay_min", "delay"), ("promise_min", "promise"), ("distance_km_estimate", "distance"))}
    return quantiles.summary(valid(s, d), ["traffic_bucket", "weather_bucket"], [F.count("*").alias("n")], medians).drop("n")


@query(ORDERS + "SELECT count(*) AS rows, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers, count(DISTINCT restaurant_id) AS restaurants FROM ords WHERE customer_id IS NOT NULL")
def distinct_counts(s, d):
    return a.orders(s, d).where("customer_id is not null").agg(F.count("*").alias("rows"), *[F.countDistinct(c).alias(n) for c, n in (("order_id", "orders"), ("customer_id", "customers"), ("restaurant_id", "restaurants"))])


@query(LIFE + "SELECT " + ", ".join(f"quantile_cont(request_to_pickup_min, {q}) AS q{str(q).replace('.', '')}" for q in (0.01, 0.1, 0.5, 0.9, 0.99, 0.999)) + " FROM life WHERE in_kpi_population")
def notebook_quantiles(s, d):
    qs = [0.01, 0.1, 0.5, 0.9, 0.99, 0.999]
    found = quantiles.by_rounds(life(s, d).where("in_kpi_population").select(F.col(WAIT).alias("v")), qs)
    return found.drop("n").toDF(*[f"q{str(q).replace('.', '')}" for q in qs])


@query(LIFE + "SELECT PULocationID, count(*) AS rides FROM rides GROUP BY 1 ORDER BY rides DESC, PULocationID LIMIT 10")
def top_pickup_zones(s, d):
    return a.rides(s, d, pruned=True).groupBy("PULocationID").agg(F.count("*").alias("rides")).orderBy(F.desc("rides"), "PULocationID").limit(10)


@query("SELECT window_start, event_type, count(*) AS events, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k_total FROM (SELECT *, date_trunc('hour', ts) AS window_start FROM events) GROUP BY 1, 2")
def hourly_event_windows(s, d):
    """Tumbling windows of an hour; streaming.windows has the same over a stream."""
    from ..streaming.windows import hourly_counts

    return hourly_counts(a.table(s, d, "events"))
