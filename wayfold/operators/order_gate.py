"""What an order table can be used for: its contract, its fitness for each use, and the gate.

Facts are counted once; rules turn them into PASS, WARN, FAIL or UNKNOWN rows. A row
says what was found and who has to clear it up; nothing is repaired here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as x
from .orders import delivered, late, with_delay

#: Statuses as they are agreed on; a variant differs in case or white space only.
AGREED = ["delivered", "cancelled"]


def facts(raw: DataFrame, orders: DataFrame, tickets: DataFrame, status: DataFrame) -> DataFrame:
    """One row of counts. raw: the table as it came; orders: one row an order."""
    c, o = F.count_if, with_delay(orders)
    done, ok = x.clean("final_status") == "delivered", delivered(o)
    is_late = lambda t: F.coalesce(late(t), F.lit(False))
    grain = raw.groupBy("order_id").agg(F.count("*").alias("n")).agg((F.sum("n") - F.count("*")).alias("extra_rows"))
    own = o.agg(
        F.count("*").alias("orders"), c(ok).alias("classifiable"), c(ok & is_late(0)).alias("late_any"), c(ok & is_late(10)).alias("late_over_10"),
        c(done & F.col("actual_delivery_at").isNull()).alias("without_completion"), c(F.col("promised_eta") < F.col("created_at")).alias("eta_before_creation"),
        c(F.col("actual_delivery_at") < F.col("pickup_at")).alias("delivered_before_pickup"), c(F.col("restaurant_id").isNull() | F.col("driver_id").isNull()).alias("null_references"),
        c(F.col("final_status").isin(*AGREED)).alias("agreed_values"), c(~F.col("final_status").isin(*AGREED) & x.clean("final_status").isin(*AGREED)).alias("variant_values"), c(~x.clean("final_status").isin(*AGREED)).alias("unknown_values"),
    )
    lone = tickets.distinct().agg(c(F.col("order_id").isNull()).alias("tickets_without_order"))
    j = status.join(orders.select("order_id", "created_at", "pickup_at"), "order_id", "left")
    s, after = x.clean("status"), F.col("last_updated_at") > F.col("pickup_at")
    fresh = j.agg(F.countDistinct("order_id").alias("orders_with_status"), c(s.isin("preparing", "ready") & after).alias("stale_states"), c(F.col("last_updated_at") < F.col("created_at")).alias("updates_before_order"))
    return grain.crossJoin(own).crossJoin(lone).crossJoin(fresh)  # four single rows


def rows(one: DataFrame, names: str, listed: list[tuple]) -> DataFrame:
    return one.selectExpr(f"stack({len(listed)}, {', '.join(', '.join(r) for r in listed)}) AS ({names})")


CONTRACT = [
    ("'one row is one order'", "extra_rows", "'data team'"),
    ("'delivered orders have a completion time'", "without_completion", "'order platform'"),
    ("'the promise follows the order'", "eta_before_creation", "'dispatch'"),
    ("'delivery follows pickup'", "delivered_before_pickup", "'platform engineering'"),
    ("'late has one definition'", "if(late_any = late_over_10, 0, late_any - late_over_10)", "'leadership'"),
]
FLAWED = "(without_completion + eta_before_creation + delivered_before_pickup)"
GATE = [
    ("'business_grain'", "if(extra_rows = 0, 'PASS', 'WARN')", "extra_rows"),
    ("'timestamp_chronology'", f"if({FLAWED} = 0, 'PASS', if({FLAWED} > 0.05 * orders, 'FAIL', 'WARN'))", FLAWED),
    ("'kpi_definition'", "if(late_any = late_over_10, 'PASS', 'FAIL')", "late_any - late_over_10"),
    ("'category_semantics'", "if(variant_values + unknown_values = 0, 'PASS', 'WARN')", "variant_values + unknown_values"),
    ("'cross_source_mapping'", "if(null_references + tickets_without_order = 0, 'PASS', 'WARN')", "null_references + tickets_without_order"),
    ("'freshness'", "if(orders_with_status = 0, 'UNKNOWN', if(stale_states + updates_before_order = 0, 'PASS', 'FAIL'))", "stale_states + updates_before_order"),
]
FITNESS = [
    ("'weekly analytics'", "'hours to days'", "if(orders_with_status = orders, 'PASS', 'WARN')", "orders - orders_with_status"),
    ("'live customer eta'", "'seconds to minutes'", "if(stale_states = 0, 'PASS', 'FAIL')", "stale_states"),
    ("'restaurant accountability'", "'an accurate history of events'", "if(updates_before_order + null_references = 0, 'PASS', 'FAIL')", "updates_before_order + null_references"),
]


def contract(one: DataFrame) -> DataFrame:
    """assumption, violations, asked: what was taken for granted, how often it doesn't hold, who can say."""
    return rows(one, "assumption, violations, asked", [(a, f"cast({v} as bigint)", w) for a, v, w in CONTRACT])


def gate(one: DataFrame) -> DataFrame:
    """check, status, found of the six rules; any FAIL keeps the late rate from being published."""
    return rows(one, "check, status, found", [(a, s, f"cast({v} as bigint)") for a, s, v in GATE])


def fitness(one: DataFrame) -> DataFrame:
    """use_case, freshness_needed, status, found: the same table may serve one use and not another."""
    return rows(one, "use_case, freshness_needed, status, found", [(a, n, s, f"cast({v} as bigint)") for a, n, s, v in FITNESS])
