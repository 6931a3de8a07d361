"""Queries of the complaint and output checks, and of points that share an id or a place."""

from __future__ import annotations

from datetime import date
from types import SimpleNamespace

from pyspark.sql import functions as F

from .. import publish
from ..functions import expressions as x
from ..functions import quantiles
from ..operators import friction, geo, kpis, quality
from ..storage import work_folder
from . import adapters as a
from . import monthly
from .registry import PICKUPS, POINTS, Q, T, journey, life, per_zone, query

# ---- points ---------------------------------------------------------------------------------


@query(POINTS + "SELECT point_id // 4 AS point_id, zone_id, ambiguous, mapping FROM m UNION ALL SELECT point_id // 4, zone_id, ambiguous, mapping FROM m WHERE point_id % 5 = 0")
def point_in_polygon_repeated(s, d):
    """Four places under one id, and a fifth of the rows twice."""
    p = a.points(s, d)
    rows = p.union(p.where("point_id % 5 = 0")).withColumn("point_id", F.expr("point_id div 4"))
    return geo.mapping(geo.locate(rows, a.polygons(s))).select("point_id", "zone_id", "ambiguous", "mapping")


# ---- complaints -----------------------------------------------------------------------------

COMPLAINTS = POINTS[:-1] + f""", {a.COMPLAINT_ROWS_SQL}, z AS (SELECT *, CASE zone_id WHEN 5 THEN 'NORTH' WHEN 9 THEN 'SOUTH' END AS zb FROM cr),
 g AS (SELECT count(*) AS n, count(*) - count(DISTINCT unique_key) AS dup, count(*) FILTER (day IS NULL) AS outside, count(DISTINCT day) AS days,
  count(*) FILTER (early) AS early, count(*) FILTER (category = 'other') AS unknown, count(*) FILTER (reported = '') AS lacking,
  count(zone_id) AS mapped, count(*) FILTER (zb IS NOT NULL AND reported <> 'Unspecified') AS comparable, count(*) FILTER (zb IS NOT NULL AND reported <> 'Unspecified' AND zb = reported) AS agree FROM z) """


def complaints(s, d):
    placed = geo.mapping(geo.locate(friction.categorised(a.complaint_rows(s, d)), a.polygons(s)))
    return placed.withColumn("zone_borough", F.expr("case zone_id when 5 then 'North' when 9 then 'South' end"))


@query(COMPLAINTS + """SELECT 'nyc311.retrieval_complete' AS "check", CASE WHEN n = (SELECT count(*) FROM embeddings) THEN 'PASS' ELSE 'FAIL' END AS status, 'friction' AS scope FROM g
 UNION ALL SELECT 'nyc311.unique_key', CASE WHEN dup > 0 THEN 'FAIL' ELSE 'PASS' END, 'friction' FROM g UNION ALL SELECT 'nyc311.required_fields', CASE WHEN lacking > 0 THEN 'WARN' ELSE 'PASS' END, 'friction' FROM g
 UNION ALL SELECT 'nyc311.filter_semantics', 'PASS', 'friction' UNION ALL SELECT 'nyc311.date_coverage', CASE WHEN outside > 0 THEN 'FAIL' WHEN days < 31 THEN 'WARN' ELSE 'PASS' END, 'friction' FROM g
 UNION ALL SELECT 'nyc311.chronology_and_status', CASE WHEN early > 0 THEN 'WARN' ELSE 'PASS' END, 'info' FROM g UNION ALL SELECT 'nyc311.descriptor_classification', CASE WHEN unknown > 0 THEN 'WARN' ELSE 'PASS' END, 'info' FROM g
 UNION ALL SELECT 'nyc311.zone_mapping_coverage', CASE WHEN mapped / n::DOUBLE >= 0.95 THEN 'PASS' WHEN mapped / n::DOUBLE >= 0.01 THEN 'WARN' ELSE 'FAIL' END, 'friction' FROM g
 UNION ALL SELECT 'nyc311.zone_mapping_borough_agreement', CASE WHEN comparable > 0 AND agree / comparable::DOUBLE >= 0.98 THEN 'PASS' ELSE 'WARN' END, 'friction' FROM g""")  # fmt: skip
def complaint_checks(s, d):
    rows = complaints(s, d).persist()
    found = friction.complaint_checks(rows, a.table(s, d, "embeddings").count(), date.fromisoformat(a.FIRST), date.fromisoformat(a.LAST), monthly.COMPLAINT_TYPE, 0.01)
    rows.unpersist()
    return quality.as_frame(s, found).select("check", "status", "scope")


@query(COMPLAINTS + "SELECT category, count(*) AS complaints, count(*) FILTER (vec_id % 2 = 0) AS pickup_reliability, count(zone_id) AS mapped FROM z GROUP BY 1")
def complaint_categories(s, d):
    return complaints(s, d).groupBy("category").agg(F.count("*").alias("complaints"), F.count_if("pickup_reliability_reason").alias("pickup_reliability"), F.count("zone_id").alias("mapped"))


@query(COMPLAINTS + """SELECT CAST(unique_key AS VARCHAR) AS unique_key, concat('"', category, '", ', 'so') AS category, zone_id, CASE zone_id WHEN 5 THEN 'North' WHEN 9 THEN 'South' END AS zone_borough FROM z""")
def published_complaints(s, d):
    """Placed complaints in one CSV file, quotes and commas in their values, written and read again."""
    at = work_folder(s, "complaints-csv") / "nyc311_complaints_mapped.csv"
    quoted = F.concat(F.lit('"'), "category", F.lit('", so')).alias("category")
    publish.one_csv(complaints(s, d).select("unique_key", quoted, "zone_id", "zone_borough"), at)
    back = s.read.schema("unique_key string, category string, zone_id int, zone_borough string").option("header", True).option("escape", '"')
    return back.csv(str(at))


# ---- outputs --------------------------------------------------------------------------------


@query(f"""WITH {PICKUPS}, g AS (SELECT count(*) AS rows, count(*) FILTER (in_kpi_population) AS kpi, count(*) FILTER (in_zone_population) AS zp, count(*) FILTER (NOT placeholder_pickup) AS za FROM journey),
  h AS (SELECT {Q(0.5)} AS m, {Q(0.9)} AS p FROM journey WHERE in_kpi_population), zr AS (SELECT sum(n) AS n FROM (SELECT count(*) AS n FROM journey WHERE in_zone_population GROUP BY PULocationID, pickup_zone, pickup_borough)),
  s AS (SELECT 100.0::DOUBLE * sum(date_diff('microsecond', request_datetime, on_scene_datetime)) FILTER (in_stage_population) / sum(date_diff('microsecond', request_datetime, pickup_datetime)) FILTER (in_stage_population) AS share FROM journey),
  b AS (SELECT sum(complaints_all) AS c, sum(hvfhv_pickups) AS n FROM pb), mc AS (SELECT count(*) AS n FROM complaints WHERE zone_id IS NOT NULL)
  SELECT 'output.headline_consistency' AS "check", CASE WHEN m >= 0 AND m <= p THEN 'PASS' ELSE 'FAIL' END AS status FROM h UNION ALL SELECT 'output.population_bounds', CASE WHEN kpi > 0 AND kpi <= rows THEN 'PASS' ELSE 'FAIL' END FROM g
  UNION ALL SELECT 'output.stage_share_bounds', CASE WHEN share BETWEEN 0 AND 100 THEN 'PASS' ELSE 'FAIL' END FROM s UNION ALL SELECT 'output.zone_reconciliation', CASE WHEN zr.n = zp THEN 'PASS' ELSE 'FAIL' END FROM zr, g
  UNION ALL SELECT 'output.friction_reconciliation', CASE WHEN c = mc.n AND b.n = za THEN 'PASS' ELSE 'FAIL' END FROM b, mc, g UNION ALL SELECT 'output.metric_count', 'PASS'""")  # fmt: skip
def output_checks(s, d):
    """Nothing of a ride is kept between figures: each reads the columns it needs, none needs weather."""
    j, pz, c = journey(s, d, weather=False), per_zone(s, d), a.complaints(s, d)
    placed = c.agg(F.count("zone_id").alias("mapped"), F.count("*").alias("passenger_total"), F.lit(0).alias("passenger_unmapped")).first()
    found, _ = monthly.figures(SimpleNamespace(thresholds=T), j, pz, placed, True, {"publish_friction_kpi": True})
    checks = monthly.output_checks(found, quality.populations(j).first(), friction.by_borough(pz).collect(), placed.mapped)
    return quality.as_frame(s, checks).select("check", "status")


# ---- figures by counts ------------------------------------------------------------------------


@query(f"WITH {a.RIDES_SQL} SELECT hvfhs_license_num, on_scene_status, {Q(0.25)} AS q25, {Q(0.5)} AS q50, {Q(0.9)} AS q90, count(request_to_pickup_min) AS n FROM life GROUP BY 1, 2")
def waits_by_status(s, d):
    """Exact quantiles of groups without a task that holds a group's values."""
    rows = life(s, d).select("hvfhs_license_num", "on_scene_status", F.col(kpis.WAIT).alias("v"))
    groups = life(s, d).select("hvfhs_license_num", "on_scene_status").distinct()
    by = ["hvfhs_license_num", "on_scene_status"]
    found = groups.join(quantiles.by_rounds(rows, [0.25, 0.5, 0.9], by), by, "left").fillna(0, ["n"])
    return found.toDF("hvfhs_license_num", "on_scene_status", "q25", "q50", "q90", "n")


# ---- first looks at the trips -----------------------------------------------------------------


@query(f"""WITH {a.RIDES_SQL} SELECT hvfhs_license_num, count(*) AS rides, avg(CAST(coalesce(on_scene_datetime = pickup_datetime, false) AS INTEGER)) AS same_as_pickup,
  avg(CAST(coalesce(on_scene_datetime < request_datetime, false) AS INTEGER)) AS before_request, avg(CAST(coalesce(on_scene_datetime > pickup_datetime, false) AS INTEGER)) AS after_pickup FROM rides GROUP BY 1""")
def on_scene_by_license(s, d):
    at, c = F.col("on_scene_datetime"), x.share
    return a.rides(s, d).groupBy("hvfhs_license_num").agg(
        F.count("*").alias("rides"), c(at == F.col("pickup_datetime")).alias("same_as_pickup"), c(at < F.col("request_datetime")).alias("before_request"), c(at > F.col("pickup_datetime")).alias("after_pickup"),
    )


@query(f"""WITH {a.RIDES_SQL}, t AS (SELECT coalesce(pickup_datetime < request_datetime, false) AS early, coalesce(epoch_us(request_datetime) % 60000000 = 0, false) AS whole FROM rides)
  SELECT early, count(*) AS rides, avg(CAST(whole AS INTEGER)) AS whole_minute_share, 1 / 60.0::DOUBLE AS by_chance FROM t GROUP BY 1""")
def whole_minute_test(s, d):
    """Whether rides picked up before they were asked for were booked: requests on a whole minute, against chance."""
    early = F.coalesce(F.col("pickup_datetime") < F.col("request_datetime"), F.lit(False)).alias("early")
    return a.rides(s, d).groupBy(early).agg(F.count("*").alias("rides"), x.share(x.whole_minute("request_datetime")).alias("whole_minute_share"), F.lit(1 / 60).alias("by_chance"))


@query(f"WITH {a.RIDES_SQL}, d AS (SELECT CAST(pickup_datetime AS DATE) AS day, count(*) AS n FROM rides WHERE pickup_datetime IS NOT NULL GROUP BY 1) SELECT count(*) AS days, min(n) AS least, max(n) AS most FROM d")
def rides_a_day(s, d):
    n = a.rides(s, d).where("pickup_datetime is not null").groupBy(F.to_date("pickup_datetime")).agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("days"), F.min("n").alias("least"), F.max("n").alias("most"))


@query("SELECT count(DISTINCT day) + max(CASE WHEN day IS NULL THEN 1 ELSE 0 END) AS values_with_null, count(DISTINCT day) AS values, count(*) FILTER (day IS NULL) AS nulls FROM (SELECT CASE WHEN event_id % 9 <> 0 THEN CAST(ts AS DATE) END AS day FROM events)")
def distinct_with_null(s, d):
    """Different values with and without null as one of them."""
    e = a.table(s, d, "events").select(F.when(F.expr("event_id % 9 <> 0"), F.to_date("ts")).alias("day"))
    per = e.groupBy("day").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("values_with_null"), F.count("day").alias("values"), F.coalesce(F.sum(F.when(F.col("day").isNull(), F.col("n"))), F.lit(0)).alias("nulls"))
