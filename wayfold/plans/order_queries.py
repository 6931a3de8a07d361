"""More queries of the order side: second sources, tickets, explicit orders, grain, and the gate tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as x
from ..functions import quantiles
from ..operators import order_gate, orders
from . import adapters as a
from .registry import LATE, query, valid

MORE = f"WITH {a.MORE_SQL} "
SEEN = MORE[:-1] + """, seen AS (SELECT v.*, current_delivery_eta, date_diff('microsecond', v.promised_eta, current_delivery_eta) / 60e6::DOUBLE AS eta_drift_min,
  coalesce(v.actual_delivery_at > current_delivery_eta, false) AS late_vs_current, reassigned_at IS NOT NULL AS reassigned, eta_model_version FROM valid v LEFT JOIN dispatch USING (order_id)) """
PLACES = ["5-LOW", "3-MEDIUM", "0-NONE", "1-URGENT"]


def seen(s, d):
    return orders.with_dispatch(valid(s, d), a.dispatch(s, d))


@query(SEEN + "SELECT order_id, eta_drift_min, late_vs_current, reassigned, eta_model_version FROM seen")
def dispatch_view(s, d):
    return seen(s, d).select("order_id", "eta_drift_min", "late_vs_current", "reassigned", "eta_model_version")


@query(SEEN + f"""SELECT reassigned, eta_model_version, count(*) AS orders, {LATE} AS late_rate, avg(CAST(late_vs_current AS INTEGER)) AS late_rate_current,
  avg(eta_drift_min) AS mean_drift, min(eta_drift_min) AS least_drift, max(eta_drift_min) AS most_drift FROM seen
  GROUP BY 1, 2""")
def late_by_dispatch(s, d):
    drift = "eta_drift_min"
    return seen(s, d).groupBy("reassigned", "eta_model_version").agg(
        F.count("*").alias("orders"), x.share(orders.late()).alias("late_rate"), x.share(F.col("late_vs_current")).alias("late_rate_current"),
        F.avg(drift).alias("mean_drift"), F.min(drift).alias("least_drift"), F.max(drift).alias("most_drift"),
    )


VIEW = MORE[:-1] + """, tv AS (SELECT t.*, v.delay_min, CASE WHEN v.delay_min > -1e9 AND v.delay_min <= 0 THEN 'on time' WHEN v.delay_min > 0 AND v.delay_min <= 10 THEN 'late 0-10' WHEN v.delay_min > 10 AND v.delay_min <= 1e9 THEN 'late >10'
  ELSE 'no delivery time / no order' END AS system_view FROM (SELECT DISTINCT * FROM tickets) t LEFT JOIN (SELECT o.order_id, w.delay_min FROM ords o LEFT JOIN valid w USING (order_id)) v USING (order_id)) """


def ticket_views(s, d):
    return orders.system_view(a.tickets(s, d), a.orders(s, d), valid(s, d))


@query(VIEW + "SELECT category, system_view, count(*) AS tickets FROM tv GROUP BY 1, 2")
def ticket_view_counts(s, d):
    return ticket_views(s, d).groupBy("category", "system_view").agg(F.count("*").alias("tickets"))


@query(VIEW + "SELECT category, count(delay_min) AS known, quantile_cont(delay_min, 0.5) AS median_delay FROM tv GROUP BY 1")
def ticket_delays(s, d):
    return quantiles.summary(ticket_views(s, d), ["category"], [F.count("delay_min").alias("known")], {"median_delay": ("delay_min", 0.5, None)})


@query(MORE + f"""SELECT CAST(place AS INTEGER) AS place, t.traffic_bucket, g.orders, g.late_rate FROM (VALUES {', '.join(f'({i}, {c!r})' for i, c in enumerate(PLACES))}) t(place,
  traffic_bucket) LEFT JOIN (SELECT traffic_bucket, count(*) AS orders, {LATE} AS late_rate FROM valid GROUP BY 1) g USING (traffic_bucket)""")
def late_in_order(s, d):
    summary = valid(s, d).groupBy("traffic_bucket").agg(F.count("*").alias("orders"), x.share(orders.late()).alias("late_rate"))
    return orders.in_order(summary, "traffic_bucket", PLACES)


@query(MORE + """SELECT 'late' AS label, min(order_id) AS order_id FROM valid WHERE delay_min > 0 UNION ALL SELECT 'on_time', min(order_id) FROM valid WHERE delay_min <= 0 UNION ALL SELECT 'intervention', min(order_id) FROM inter
  UNION ALL SELECT 'late_with_contact', min(v.order_id) FROM valid v JOIN actions c ON v.order_id = c.order_id WHERE delay_min > 0 AND action_type = 'contact'
  UNION ALL SELECT 'helped_in_time', min(i.order_id) FROM inter i JOIN ords o ON i.order_id = o.order_id WHERE intervention_at < actual_delivery_at UNION ALL SELECT 'none', NULL""")
def example_orders(s, d):
    v, i = valid(s, d), a.interventions(s, d)
    named = lambda name, df: df.agg(F.min("order_id").alias("order_id")).select(F.lit(name).alias("label"), "order_id")
    met = lambda name, rows, other: named(name, orders.first_match(rows, other, "order_id"))
    in_time = i.join(a.orders(s, d).select("order_id", "actual_delivery_at"), "order_id").where("intervention_at < actual_delivery_at")
    found = [named("late", v.where("delay_min > 0")), named("on_time", v.where("delay_min <= 0")), named("intervention", i)]
    found += [met("late_with_contact", v.where("delay_min > 0"), a.actions(s, d).where("action_type = 'contact'")), named("helped_in_time", in_time), met("none", v, i.where("order_id < 0"))]
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


@query(MORE + """SELECT count(*) FILTER (d.delay_min IS NOT NULL AND o.delay_min IS NOT NULL) AS classifiable, count(*) FILTER (abs(d.delay_min - o.delay_min) < 0.02) AS agreeing,
  count(*) FILTER ((d.delay_min IS NULL) <> (o.delay_min IS NULL)) AS known_to_one FROM delayed d JOIN outs o USING (order_id)""")
def recomputed_outcomes(s, d):
    return orders.recomputed(a.orders(s, d), a.outcomes(s, d))


JOURNEY_ROWS = "SELECT count(*) AS rows, count(DISTINCT order_id) AS keys, (SELECT count(DISTINCT order_id) FROM ords) AS expected FROM "


@query(MORE + f"SELECT *, rows = keys AND keys = expected AS holds FROM ({JOURNEY_ROWS} jour)")
def journey_grain(s, d):
    o = valid(s, d).withColumn("late_flag", F.when(F.col("delay_min") > 0, 1).otherwise(0)).select("order_id", "late_flag", "delay_min")
    base = a.orders(s, d)
    j = orders.journey(base, o, a.actions(s, d), a.tickets(s, d), a.interventions(s, d))
    return orders.grain(j, "order_id", base)


@query(MORE + f"SELECT *, rows = keys AND keys = expected AS holds FROM ({JOURNEY_ROWS} raw)")
def raw_grain(s, d):
    return orders.grain(a.raw_orders(s, d), "order_id", a.orders(s, d))


@query(MORE + """SELECT 'pages_recount_to_total' AS "check", (SELECT count(*) FROM dispatch) = (SELECT count(*) FROM ords) AS passed UNION ALL SELECT 'no_key_twice', (SELECT coalesce(max(n),
  0) <= 1 FROM (SELECT count(*) AS n FROM dispatch GROUP BY order_id)) UNION ALL SELECT 'every_known_key_found', NOT EXISTS (SELECT 1
  FROM ords WHERE order_id NOT IN (SELECT order_id FROM dispatch)) UNION ALL SELECT 'every_found_key_known', NOT EXISTS (SELECT 1
  FROM dispatch WHERE order_id NOT IN (SELECT order_id FROM ords))""")
def page_completeness(s, d):
    known = a.orders(s, d)
    return orders.page_completeness(a.dispatch(s, d), "order_id", known.count(), known)


@query(MORE + """SELECT manual_status_updates, count(*) AS records, count(*) FILTER (lower(trim(status)) = 'preparing' AND last_updated_at > pickup_at) AS stale_preparing,
  count(*) FILTER (lower(trim(status)) = 'ready' AND last_updated_at > pickup_at) AS stale_ready,
  count(*) FILTER (last_updated_at < created_at) AS before_order, quantile_cont(date_diff('microsecond', created_at, last_updated_at) / 60e6::DOUBLE, 0.5) AS median_age_min FROM status s LEFT JOIN ords USING (order_id) LEFT JOIN rests r ON s.restaurant_id = r.restaurant_id GROUP BY 1""")
def status_freshness(s, d):
    return orders.status_freshness(a.restaurant_status(s, d), a.orders(s, d), a.restaurants(s, d))


@query(MORE + "SELECT order_id, date_diff('microsecond', created_at, pickup_at) / 60e6::DOUBLE AS order_to_pickup_min, date_diff('microsecond', pickup_at, actual_delivery_at) / 60e6::DOUBLE AS pickup_to_delivery_min FROM ords")
def order_durations(s, d):
    return orders.durations(a.orders(s, d)).select("order_id", "order_to_pickup_min", "pickup_to_delivery_min")


@query(MORE + """SELECT order_id, 'traffic_bucket' AS column_name, string_agg(DISTINCT traffic_bucket, '|' ORDER BY traffic_bucket) AS held, count(*) FILTER (traffic_bucket IS NULL) AS nulls
  FROM raw GROUP BY order_id HAVING count(DISTINCT traffic_bucket) > 1""")
def conflicting_values(s, d):
    found = orders.conflicting_values(a.raw_orders(s, d), ["order_id"], ["traffic_bucket", "weather_bucket", "customer_id"])
    return found.withColumn("held", F.array_join("held", "|"))


PIVOT = "e AS (SELECT l_orderkey AS order_id, min(l_shipdate) FILTER (l_returnflag = 'A') AS first_a, min(l_shipdate) FILTER (l_returnflag = 'N') AS first_n FROM lineitem GROUP BY 1)"


@query(MORE[:-1] + f", {PIVOT} SELECT order_id, first_a, first_n, date_diff('microsecond', created_at, coalesce(first_a, first_n)) / 60e6::DOUBLE AS since_order_min, pickup_at > first_n AS picked_up_later FROM ords LEFT JOIN e USING (order_id)")
def first_events_of_orders(s, d):
    e = a.table(s, d, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_returnflag", "l_shipdate")
    times = orders.first_times(e, ["order_id"], "l_returnflag", "l_shipdate", {"A": "first_a", "N": "first_n"})
    j = a.orders(s, d).join(times, "order_id", "left")
    return j.select(
        "order_id", "first_a", "first_n", x.minutes(F.coalesce("first_a", "first_n"), "created_at").alias("since_order_min"),
        (F.col("pickup_at") > F.col("first_n")).alias("picked_up_later"),
    )


# ---- the gate tables ------------------------------------------------------------------------

CLEAN = "lower(trim(final_status))"
FACTS = MORE[:-1] + f""", f AS (SELECT * FROM (SELECT count(*) - count(DISTINCT order_id) AS extra_rows FROM raw),
  (SELECT count(*) AS orders, count(*) FILTER (ok) AS classifiable, count(*) FILTER (ok AND delay_min > 0) AS late_any, count(*) FILTER (ok AND delay_min > 10) AS late_over_10,
     count(*) FILTER ({CLEAN} = 'delivered' AND actual_delivery_at IS NULL) AS without_completion, count(*) FILTER (promised_eta < created_at) AS eta_before_creation, count(*) FILTER (actual_delivery_at < pickup_at) AS delivered_before_pickup,
     count(*) FILTER (restaurant_id IS NULL OR driver_id IS NULL) AS null_references, count(*) FILTER (final_status IN ('delivered', 'cancelled')) AS agreed_values,
     count(*) FILTER (final_status NOT IN ('delivered', 'cancelled') AND {CLEAN} IN ('delivered', 'cancelled')) AS variant_values, count(*) FILTER ({CLEAN} NOT IN ('delivered', 'cancelled')) AS unknown_values
   FROM (SELECT *, {CLEAN} = 'delivered' AND actual_delivery_at IS NOT NULL AND promised_eta IS NOT NULL AS ok FROM delayed)),
  (SELECT count(*) FILTER (order_id IS NULL) AS tickets_without_order FROM (SELECT DISTINCT * FROM tickets)),
  (SELECT count(DISTINCT order_id) AS orders_with_status, count(*) FILTER (lower(trim(status)) IN ('preparing', 'ready') AND last_updated_at > pickup_at) AS stale_states, count(*) FILTER (last_updated_at < created_at) AS updates_before_order
   FROM status LEFT JOIN ords USING (order_id))),
 g AS (SELECT *, without_completion + eta_before_creation + delivered_before_pickup AS flawed FROM f) """


def facts(s, d):
    return order_gate.facts(a.raw_orders(s, d), a.orders(s, d), a.tickets(s, d), a.restaurant_status(s, d))


@query(FACTS + "SELECT * FROM f")
def order_facts(s, d):
    return facts(s, d)


@query(FACTS + """SELECT 'one row is one order' AS assumption, extra_rows AS violations, 'data team' AS asked FROM g UNION ALL SELECT 'delivered orders have a completion time', without_completion, 'order platform' FROM g
  UNION ALL SELECT 'the promise follows the order', eta_before_creation, 'dispatch' FROM g UNION ALL SELECT 'delivery follows pickup', delivered_before_pickup, 'platform engineering' FROM g UNION ALL SELECT 'late has one definition', late_any - late_over_10, 'leadership' FROM g""")
def order_contract(s, d):
    return order_gate.contract(facts(s, d))


STATES = "stale_states + updates_before_order"


@query(FACTS + f"""SELECT 'business_grain' AS "check", CASE WHEN extra_rows = 0 THEN 'PASS' ELSE 'WARN' END AS status, extra_rows AS found FROM g
  UNION ALL SELECT 'timestamp_chronology', CASE WHEN flawed = 0 THEN 'PASS' WHEN flawed > 0.05 * orders THEN 'FAIL' ELSE 'WARN' END,
  flawed FROM g UNION ALL SELECT 'kpi_definition', CASE WHEN late_any = late_over_10 THEN 'PASS' ELSE 'FAIL' END, late_any - late_over_10
  FROM g
  UNION ALL SELECT 'category_semantics', CASE WHEN variant_values + unknown_values = 0 THEN 'PASS' ELSE 'WARN' END, variant_values + unknown_values
  FROM g UNION ALL SELECT 'cross_source_mapping', CASE WHEN null_references + tickets_without_order = 0 THEN 'PASS' ELSE 'WARN' END, null_references + tickets_without_order
  FROM g
  UNION ALL SELECT 'freshness', CASE WHEN orders_with_status = 0 THEN 'UNKNOWN' WHEN {STATES} = 0 THEN 'PASS' ELSE 'FAIL' END, {STATES} FROM g""")
def order_gate_rows(s, d):
    return order_gate.gate(facts(s, d))


@query(FACTS + """SELECT 'weekly analytics' AS use_case, 'hours to days' AS freshness_needed, CASE WHEN orders_with_status = orders THEN 'PASS' ELSE 'WARN' END AS status, orders - orders_with_status AS found FROM g
  UNION ALL SELECT 'live customer eta', 'seconds to minutes', CASE WHEN stale_states = 0 THEN 'PASS' ELSE 'FAIL' END, stale_states FROM g
  UNION ALL SELECT 'restaurant accountability', 'an accurate history of events', CASE WHEN updates_before_order + null_references = 0 THEN 'PASS' ELSE 'FAIL' END, updates_before_order + null_references FROM g""")
def order_fitness(s, d):
    return order_gate.fitness(facts(s, d))
