"""The shared tables seen as rides, zones, weather, complaints, points and orders.

Whole-number arithmetic only, so that any SQL engine gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST, LAST, MONTH = "2024-01-01", "2024-01-31", "2024-01"
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rides(spark: SparkSession, sf_dir: str, pruned: bool = False) -> DataFrame:
    """A line item as a ride of January 2024.

    Rows are generated whole, as filters on the derived times would else repeat their arithmetic
    (figures of waits take three times as long without). pruned: for a query that needs few
    columns and no filter, so that its scan reads only what they derive from."""
    li = table(spark, sf_dir, "lineitem").select(*KEYS)
    at = lambda seconds: F.expr(f"timestampadd(SECOND, cast({seconds} as int), TIMESTAMP_NTZ'2024-01-01 00:00:00')")
    li = li.withColumn("_s", F.expr("(l_orderkey * 7919 + l_partkey * 31 + l_linenumber * 104729) % 2678400"))
    li = li.withColumn("_s", F.expr("if(l_orderkey % 40 = 0, _s - _s % 60, _s)")).withColumn("_w", F.expr("(l_partkey * 37 + l_suppkey * 11 + l_orderkey) % 900 - 10"))
    li = li.withColumn("_d", F.expr("if(l_quantity = 50, 0, cast(l_quantity as bigint) * 60)")).withColumn("_c", F.expr("(l_orderkey + l_linenumber) % 20"))
    scene = F.when(F.col("_c") == 0, at("_s + _w")).when(F.col("_c") == 2, F.lit(None)).when(F.col("_c") == 3, at("_s + _w + 30")).otherwise(at("_s + _w - (l_suppkey % 60 + 1)"))
    derived = [
        "l_orderkey", "l_linenumber",
        F.expr("if(l_orderkey % 4 = 0, 'HV0003', 'HV0005')").alias("hvfhs_license_num"),
        at("_s").alias("request_datetime"), scene.alias("on_scene_datetime"),
        F.when(F.expr("l_orderkey % 500 <> 0"), at("_s + _w")).alias("pickup_datetime"), at("_s + _w + _d").alias("dropoff_datetime"),
        F.expr("cast(l_suppkey % 26 as int)").alias("PULocationID"), F.expr("cast(l_partkey % 26 as int)").alias("DOLocationID"),
        F.col("l_quantity").alias("trip_miles"), F.expr("_d + if(l_partkey % 10 = 0, 120, 0)").alias("trip_time"), F.col("l_extendedprice").alias("base_passenger_fare"),
    ]
    return li.select(*derived) if pruned else li.select(F.inline(F.array(F.struct(*derived))))


RIDES_SQL = """
base AS (
  SELECT *, (l_orderkey * 7919 + l_partkey * 31 + l_linenumber * 104729) % 2678400 AS s0,
    (l_partkey * 37 + l_suppkey * 11 + l_orderkey) % 900 - 10 AS w,
    CASE WHEN l_quantity = 50 THEN 0 ELSE CAST(l_quantity AS BIGINT) * 60 END AS dd, (l_orderkey + l_linenumber) % 20 AS c
  FROM lineitem
), timed AS (
  SELECT *, CASE WHEN l_orderkey % 40 = 0 THEN s0 - s0 % 60 ELSE s0 END AS s FROM base
), rides AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 4 = 0 THEN 'HV0003' ELSE 'HV0005' END AS hvfhs_license_num,
    TIMESTAMP '2024-01-01' + to_seconds(s) AS request_datetime,
    CASE c WHEN 0 THEN TIMESTAMP '2024-01-01' + to_seconds(s + w) WHEN 2 THEN NULL WHEN 3 THEN TIMESTAMP '2024-01-01' + to_seconds(s + w + 30)
      ELSE TIMESTAMP '2024-01-01' + to_seconds(s + w - (l_suppkey % 60 + 1)) END AS on_scene_datetime,
    CASE WHEN l_orderkey % 500 <> 0 THEN TIMESTAMP '2024-01-01' + to_seconds(s + w) END AS pickup_datetime,
    TIMESTAMP '2024-01-01' + to_seconds(s + w + dd) AS dropoff_datetime,
    CAST(l_suppkey % 26 AS INTEGER) AS PULocationID, CAST(l_partkey % 26 AS INTEGER) AS DOLocationID,
    l_quantity AS trip_miles, dd + CASE WHEN l_partkey % 10 = 0 THEN 120 ELSE 0 END AS trip_time, l_extendedprice AS base_passenger_fare
  FROM timed
), spans AS (
  SELECT *, date_diff('microsecond', request_datetime, pickup_datetime) / 60e6::DOUBLE AS request_to_pickup_min,
    date_diff('microsecond', request_datetime, on_scene_datetime) / 60e6::DOUBLE AS request_to_on_scene_min,
    date_diff('microsecond', on_scene_datetime, pickup_datetime) / 60e6::DOUBLE AS on_scene_to_pickup_min,
    date_diff('microsecond', pickup_datetime, dropoff_datetime) / 60e6::DOUBLE AS trip_duration_min
  FROM rides
), statuses AS (
  SELECT *, CASE WHEN request_datetime IS NULL OR pickup_datetime IS NULL OR dropoff_datetime IS NULL THEN 'missing_timestamp'
      WHEN request_to_pickup_min < 0 THEN 'pickup_before_request' WHEN trip_duration_min <= 0 THEN 'dropoff_not_after_pickup' ELSE 'valid' END AS validation_status,
    CASE WHEN on_scene_datetime IS NULL OR request_datetime IS NULL OR pickup_datetime IS NULL THEN 'missing' WHEN on_scene_to_pickup_min < 0 THEN 'after_pickup'
      WHEN request_to_on_scene_min < 0 THEN 'before_request' WHEN on_scene_to_pickup_min = 0 THEN 'same_as_pickup' ELSE 'observed' END AS on_scene_status,
    coalesce(epoch_us(request_datetime) % 60000000 = 0, false) AS request_on_whole_minute,
    coalesce(abs(trip_time - trip_duration_min * 60) > 60, false) AS trip_time_mismatch
  FROM spans
), life AS (
  SELECT *, validation_status = 'valid' AS in_kpi_population, validation_status = 'valid' AND on_scene_status = 'observed' AS in_stage_population FROM statuses
)"""


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation as a zone, its region as the borough; 24 stands for an unknown place."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    return j.select(
        F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("zone"), F.col("r_name").alias("borough"), F.lit("zone").alias("service_zone"),
        (F.col("n_nationkey") == 24).alias("is_placeholder"),
    )


ZONES_SQL = "zones AS (SELECT n_nationkey AS location_id, n_name AS zone, r_name AS borough, n_nationkey = 24 AS is_placeholder FROM nation JOIN region ON n_regionkey = r_regionkey)"


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An hour of events as an hour of weather."""
    e = table(spark, sf_dir, "events").groupBy(F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("n"), F.avg("value").alias("temperature_c"))
    return e.select("hour", "temperature_c", F.expr("if(n % 3 = 0, 0.0D, (n % 10) * 0.5D)").alias("precipitation_mm"), (F.col("n") % 7).cast("double").alias("wind_speed_kmh"))


WEATHER_SQL = """weather AS (
  SELECT date_trunc('hour', ts) AS hour, avg(value) AS temperature_c, CASE WHEN count(*) % 3 = 0 THEN 0.0::DOUBLE ELSE (count(*) % 10) * 0.5::DOUBLE END AS precipitation_mm,
    CAST(count(*) % 7 AS DOUBLE) AS wind_speed_kmh FROM events GROUP BY 1
)"""

JOURNEY_SQL = f"""{RIDES_SQL}, {ZONES_SQL}, {WEATHER_SQL}, journey AS (
  SELECT l.*, p.zone AS pickup_zone, p.borough AS pickup_borough, d.zone AS dropoff_zone, d.borough AS dropoff_borough,
    coalesce(p.is_placeholder, true) AS placeholder_pickup, l.in_kpi_population AND NOT coalesce(p.is_placeholder, true) AS in_zone_population,
    date_trunc('hour', request_datetime) AS weather_hour, CAST(w.precipitation_mm AS FLOAT) AS precipitation_mm, CAST(w.wind_speed_kmh AS FLOAT) AS wind_speed_kmh,
    w.precipitation_mm IS NOT NULL AS weather_matched,
    CASE WHEN w.precipitation_mm IS NULL THEN 'weather_unavailable' WHEN w.precipitation_mm = 0 THEN 'dry' WHEN w.precipitation_mm > 0 AND w.precipitation_mm < 2.5 THEN 'light_rain'
      WHEN w.precipitation_mm >= 2.5 THEN 'moderate_or_heavy_rain' ELSE 'weather_unavailable' END AS precip_band,
    CAST(hour(request_datetime) AS INTEGER) AS request_hour, CAST(isodow(request_datetime) - 1 AS INTEGER) AS request_weekday, isodow(request_datetime) >= 6 AS is_weekend,
    CASE WHEN hour(request_datetime) < 6 THEN 'overnight_00_05' WHEN hour(request_datetime) < 10 THEN 'am_peak_06_09' WHEN hour(request_datetime) < 16 THEN 'midday_10_15'
      WHEN hour(request_datetime) < 20 THEN 'pm_peak_16_19' ELSE 'evening_20_23' END AS time_period
  FROM life l LEFT JOIN zones p ON l.PULocationID = p.location_id LEFT JOIN zones d ON l.DOLocationID = d.location_id
    LEFT JOIN weather w ON date_trunc('hour', request_datetime) = w.hour
)"""


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as complaints that know their zone."""
    e = table(spark, sf_dir, "events").where("event_type = 'error'")
    return e.select(
        F.col("event_id").cast("string").alias("unique_key"), F.expr("cast(get_json_object(props, '$.k') as int) % 30").alias("zone_id"),
        F.expr("if(event_id % 2 = 0, 'passenger', 'non_passenger')").alias("category"), F.expr("event_id % 5 = 0").alias("pickup_reliability_reason"),
    )


COMPLAINTS_SQL = """complaints AS (SELECT CAST(event_id AS VARCHAR) AS unique_key, CAST(json_extract_string(props, '$.k') AS INTEGER) % 30 AS zone_id, CASE WHEN event_id % 2 = 0 THEN 'passenger' ELSE 'non_passenger' END AS category,
  event_id % 5 = 0 AS pickup_reliability_reason FROM events WHERE event_type = 'error')"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point_id"), F.expr("cast(embedding[0] as double)").alias("x"), F.expr("cast(embedding[1] as double)").alias("y"))


def polygons(spark: SparkSession) -> DataFrame:
    """A square with a hole (5), and one that overlaps it (9)."""
    square = lambda a, b: [(a, a), (a, b), (b, b), (b, a)]
    return spark.createDataFrame([(5, [square(-0.2, 0.2), square(-0.05, 0.05)]), (9, [square(-0.2, 0.0)])], "zone_id int, rings array<array<struct<x: double, y: double>>>")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line item of an order as a delivery order, with the flaws such data has."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    first = li.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("ship"), F.max("l_shipdate").alias("last_ship"), F.min("l_suppkey").alias("supp"), F.min("l_partkey").alias("part"))
    j = o.join(first, o["o_orderkey"] == first["l_orderkey"])
    k = "o_orderkey"
    return j.select(
        F.col(k).alias("order_id"), F.expr(f"if({k} % 97 = 0, null, o_custkey)").alias("customer_id"), F.expr(f"if({k} % 89 = 0, null, supp)").alias("restaurant_id"), (F.col("part") % 50).alias("driver_id"),
        F.col("o_orderdate").alias("created_at"), F.expr("o_orderdate + make_dt_interval(cast(part % 900 as int), 0, 0, 0)").alias("promised_eta"), F.expr("o_orderdate + make_dt_interval(cast(part % 300 as int), 0, 0, 0)").alias("pickup_at"),
        F.expr(f"if({k} % 37 = 0, null, ship)").alias("actual_delivery_at"), F.col("last_ship").alias("second_delivery_at"),
        F.expr(f"case when {k} % 211 = 0 then 'Delivered' when {k} % 13 = 0 then 'cancelled' when {k} % 101 = 0 then ' delivered' else 'delivered' end").alias("final_status"),
        F.col("o_orderpriority").alias("traffic_bucket"), F.col("o_orderstatus").alias("weather_bucket"), F.expr(f"if({k} % 10 = 0, 18.0D, cast(part % 20 as double))").alias("distance_km_estimate"),
    )


ORDERS_SQL = """
firsts AS (SELECT l_orderkey, min(l_shipdate) AS ship, max(l_shipdate) AS last_ship, min(l_suppkey) AS supp, min(l_partkey) AS part FROM lineitem GROUP BY 1),
ords AS (
  SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS customer_id, CASE WHEN o_orderkey % 89 <> 0 THEN supp END AS restaurant_id, part % 50 AS driver_id,
    o_orderdate AS created_at, o_orderdate + to_days(CAST(part % 900 AS INTEGER)) AS promised_eta, o_orderdate + to_days(CAST(part % 300 AS INTEGER)) AS pickup_at,
    CASE WHEN o_orderkey % 37 <> 0 THEN ship END AS actual_delivery_at, last_ship AS second_delivery_at,
    CASE WHEN o_orderkey % 211 = 0 THEN 'Delivered' WHEN o_orderkey % 13 = 0 THEN 'cancelled' WHEN o_orderkey % 101 = 0 THEN ' delivered' ELSE 'delivered' END AS final_status,
    o_orderpriority AS traffic_bucket, o_orderstatus AS weather_bucket, CASE WHEN o_orderkey % 10 = 0 THEN 18.0::DOUBLE ELSE CAST(part % 20 AS DOUBLE) END AS distance_km_estimate
  FROM orders JOIN firsts ON o_orderkey = l_orderkey
), delayed AS (
  SELECT *, date_diff('microsecond', promised_eta, actual_delivery_at) / 60e6::DOUBLE AS delay_min, date_diff('microsecond', created_at, promised_eta) / 60e6::DOUBLE AS promise_min FROM ords
), valid AS (
  SELECT * FROM delayed WHERE lower(trim(final_status)) = 'delivered' AND actual_delivery_at IS NOT NULL AND promised_eta IS NOT NULL
)"""


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as customer actions of their order."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.expr("case l_linenumber % 3 when 0 then 'eta_view' when 1 then 'eta_view' else if(l_partkey % 40 = 0, 'cancel', 'contact') end").alias("action_type"),
        F.col("l_shipdate").alias("action_at"),
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_linenumber <= 2")
    return li.select(
        F.expr("l_orderkey * 10 + l_linenumber").alias("ticket_id"), F.expr("if(l_partkey % 50 = 0, null, l_orderkey)").alias("order_id"),
        F.col("l_shipdate").alias("created_at"), F.col("l_linestatus").alias("category"),
    )


def interventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where("l_quantity > 45")
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_returnflag").alias("reason"), F.col("l_shipdate").alias("intervention_at"), F.col("l_linestatus").alias("intervention_type"))


SIDES_SQL = f"""{ORDERS_SQL},
actions AS (SELECT l_orderkey AS order_id, CASE l_linenumber % 3 WHEN 0 THEN 'eta_view' WHEN 1 THEN 'eta_view' ELSE CASE WHEN l_partkey % 40 = 0 THEN 'cancel' ELSE 'contact' END END AS action_type, l_shipdate AS action_at FROM lineitem),
tickets AS (SELECT l_orderkey * 10 + l_linenumber AS ticket_id, CASE WHEN l_partkey % 50 <> 0 THEN l_orderkey END AS order_id, l_shipdate AS created_at, l_linestatus AS category FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber <= 2),
inter AS (SELECT l_orderkey AS order_id, l_returnflag AS reason, l_shipdate AS intervention_at, l_linestatus AS intervention_type FROM lineitem WHERE l_quantity > 45),
outcomes AS (SELECT order_id, CASE WHEN delay_min IS NULL THEN NULL WHEN delay_min > 0 THEN 1 ELSE 0 END AS late_flag, delay_min FROM delayed),
acts AS (SELECT order_id, count(*) AS n_actions, count(*) FILTER (action_type = 'eta_view') AS eta_views, bool_or(action_type = 'cancel') AS cancelled FROM actions GROUP BY 1),
ticks AS (SELECT order_id, count(DISTINCT ticket_id) AS n_tickets FROM tickets WHERE order_id IS NOT NULL GROUP BY 1),
inters AS (SELECT order_id, count(*) AS n_interventions, string_agg(DISTINCT reason, ', ' ORDER BY reason) AS reasons, min(intervention_at) AS first_intervention_at FROM inter GROUP BY 1),
jour0 AS (
  SELECT o.order_id, o.restaurant_id, o.actual_delivery_at, u.late_flag, u.delay_min, coalesce(n_actions, 0) AS n_actions, coalesce(eta_views, 0) AS eta_views, coalesce(cancelled, false) AS cancelled,
    coalesce(n_tickets, 0) AS n_tickets, coalesce(n_interventions, 0) AS n_interventions, coalesce(reasons, '') AS reasons, first_intervention_at
  FROM ords o LEFT JOIN outcomes u USING (order_id) LEFT JOIN acts USING (order_id) LEFT JOIN ticks USING (order_id) LEFT JOIN inters USING (order_id)
), jour1 AS (SELECT *, n_tickets > 0 OR cancelled OR eta_views >= 3 AS frustrated FROM jour0),
jour AS (SELECT *, frustrated AND coalesce(late_flag = 1, false) AND n_interventions = 0 AS neglected,
  CASE WHEN n_interventions = 0 THEN 'none' WHEN first_intervention_at > actual_delivery_at THEN 'post-delivery' ELSE 'pre-delivery' END AS intervention_timing FROM jour1)"""


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as they came: some rows twice, the copy with another bucket."""
    o = orders(spark, sf_dir)
    return o.union(o.where("order_id % 53 = 0").withColumn("traffic_bucket", F.lit("copy")))


def dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second source's current estimate of most orders."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("part"), F.min("l_suppkey").alias("supp"))
    o = table(spark, sf_dir, "orders").join(li, F.col("o_orderkey") == F.col("l_orderkey")).where("o_orderkey % 7 <> 0")
    day = lambda e: F.expr(f"o_orderdate + make_dt_interval(cast({e} as int), 0, 0, 0)")
    return o.select(
        F.col("o_orderkey").alias("order_id"), day("part % 900 + part % 11 - 5").alias("current_delivery_eta"),
        F.when(F.col("supp") % 3 == 0, day("part % 300")).alias("reassigned_at"), F.expr("if(part % 2 = 0, 'v1', 'v2')").alias("eta_model_version"),
    )


def restaurant_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One status record for some orders, some late and some from before their order."""
    o = orders(spark, sf_dir).where("order_id % 3 = 0")
    return o.select(
        "order_id", "restaurant_id", F.expr("case order_id % 4 when 0 then 'preparing' when 1 then ' Ready' else 'handed_off' end").alias("status"),
        F.expr("if(order_id % 71 = 0, created_at - make_dt_interval(1, 0, 0, 0), created_at + make_dt_interval(cast(order_id % 250 as int), 0, 0, 0))").alias("last_updated_at"),
    )


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("restaurant_id"), F.expr("s_suppkey % 3 = 0").alias("manual_status_updates"))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delays as another table states them: to the minute's hundredth, and some wrong or missing."""
    d = F.expr("timestampdiff(MICROSECOND, promised_eta, actual_delivery_at) / 60e6D")
    return orders(spark, sf_dir).select("order_id", F.when(F.expr("order_id % 43 <> 0"), d + F.expr("if(order_id % 29 = 0, 0.5D, 0.01D)")).alias("delay_min"))


MORE_SQL = f"""{SIDES_SQL},
raw AS (SELECT * FROM ords UNION ALL SELECT * REPLACE ('copy' AS traffic_bucket) FROM ords WHERE order_id % 53 = 0),
dispatch AS (SELECT o_orderkey AS order_id, o_orderdate + to_days(CAST(part % 900 + part % 11 - 5 AS INTEGER)) AS current_delivery_eta, CASE WHEN supp % 3 = 0 THEN o_orderdate + to_days(CAST(part % 300 AS INTEGER)) END AS reassigned_at,
  CASE WHEN part % 2 = 0 THEN 'v1' ELSE 'v2' END AS eta_model_version FROM orders JOIN (SELECT l_orderkey, min(l_partkey) AS part, min(l_suppkey) AS supp FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey WHERE o_orderkey % 7 <> 0),
status AS (SELECT order_id, restaurant_id, CASE order_id % 4 WHEN 0 THEN 'preparing' WHEN 1 THEN ' Ready' ELSE 'handed_off' END AS status,
  CASE WHEN order_id % 71 = 0 THEN created_at - to_days(1) ELSE created_at + to_days(CAST(order_id % 250 AS INTEGER)) END AS last_updated_at
  FROM ords WHERE order_id % 3 = 0),
rests AS (SELECT s_suppkey AS restaurant_id, s_suppkey % 3 = 0 AS manual_status_updates FROM supplier),
outs AS (SELECT order_id, CASE WHEN order_id % 43 <> 0 THEN delay_min + CASE WHEN order_id % 29 = 0 THEN 0.5::DOUBLE ELSE 0.01::DOUBLE END END AS delay_min FROM delayed)"""


def complaint_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaints with all their columns and flaws, at the points of the embeddings."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.expr("cast(embedding[0] as double)").alias("x"), F.expr("cast(embedding[1] as double)").alias("y"))
    return e.select(
        F.expr("cast(if(vec_id % 97 = 1, vec_id - 1, vec_id) as string)").alias("unique_key"),
        F.expr("if(vec_id % 83 = 0, 'soon', concat('2024-01-', lpad(cast(1 + vec_id % 31 as string), 2, '0'), 'T10:00:00'))").alias("created_date"),
        F.expr("if(vec_id % 61 = 0, '2023-12-01T00:00:00', '2024-03-01T00:00:00')").alias("closed_date"),
        F.lit("For Hire Vehicle Complaint").alias("complaint_type"),
        F.expr("case vec_id % 5 when 0 then 'Driver Complaint - Passenger' when 1 then 'Driver Complaint - Non Passenger' when 2 then 'Noise' else 'Car Service Company Complaint' end").alias("descriptor"),
        F.expr("if(vec_id % 2 = 0, 'Denied Request', 'x')").alias("descriptor_2"),
        F.expr("case when vec_id % 71 = 0 then '' when vec_id % 3 = 0 then 'Unspecified' when vec_id % 3 = 1 then 'NORTH' else 'East' end").alias("borough"),
        "x", "y",
    ).withColumn("reported_borough", F.col("borough"))


COMPLAINT_ROWS_SQL = """cr AS (SELECT CASE WHEN vec_id % 97 = 1 THEN vec_id - 1 ELSE vec_id END AS unique_key, vec_id, CASE WHEN vec_id % 83 <> 0 THEN DATE '2024-01-01' + CAST(vec_id % 31 AS INTEGER) END AS day,
  vec_id % 61 = 0 AND vec_id % 83 <> 0 AS early,
  CASE vec_id % 5 WHEN 0 THEN 'passenger' WHEN 1 THEN 'non_passenger' WHEN 2 THEN 'other' ELSE 'passenger' END AS category, CASE WHEN vec_id % 71 = 0 THEN '' WHEN vec_id % 3 = 0 THEN 'Unspecified' WHEN vec_id % 3 = 1 THEN 'NORTH' ELSE 'EAST' END AS reported,
  m.*
  FROM embeddings JOIN m ON vec_id = m.point_id)"""
