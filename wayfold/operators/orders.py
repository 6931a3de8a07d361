"""Order journeys: deduplication, lateness, bins, coverage, timelines, pings and interventions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as x
from ..functions import quantiles, segments


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row a key: the first in the given order (a file's row order, or columns)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def key_conflicts(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """column_name, keys whose rows differ in it (null is a value). One pass, combined before it is shuffled."""
    differs = lambda c: (F.min(c) != F.max(c)) | ((F.count(c) != 0) & (F.count(c) != F.count("*")))
    sizes = df.groupBy(*keys).agg(*[F.coalesce(differs(c), F.lit(False)).alias(c) for c in columns])
    one = sizes.agg(*[F.count_if(F.col(c)).alias(c) for c in columns])
    return one.selectExpr("stack({}, {}) AS (column_name, conflicting_keys)".format(len(columns), ", ".join(f"'{c}', `{c}`" for c in columns)))


def conflicting_values(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """keys, column_name, held (different values as text, ascending), nulls: what the rows of one
    key disagree in. Only rows of repeated keys are taken apart."""
    parts = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    tall = duplicated(df, keys).selectExpr(*[f"`{k}`" for k in keys], f"stack({len(columns)}, {parts}) AS (column_name, value)")
    held = tall.groupBy(*keys, "column_name").agg(F.array_sort(F.collect_set("value")).alias("held"), F.count_if(F.col("value").isNull()).alias("nulls"))
    return held.where((F.size("held") > 1) | ((F.size("held") == 1) & (F.col("nulls") > 0)))


def duplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    many = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return df.join(many, keys, "left_semi")


def delivered(orders: DataFrame) -> Column:
    return (x.clean("final_status") == "delivered") & F.col("actual_delivery_at").isNotNull() & F.col("promised_eta").isNotNull()


def late(threshold: float = 0) -> Column:
    return F.col("delay_min") > threshold


def with_delay(orders: DataFrame) -> DataFrame:
    return orders.withColumn("delay_min", x.minutes("actual_delivery_at", "promised_eta"))


def late_summary(valid: DataFrame) -> DataFrame:
    counts = [F.count("*").alias("orders"), F.count_if(late()).alias("late"), x.share(late()).alias("late_rate")]
    return quantiles.summary(valid, [], counts, {"median_delay_late": ("delay_min", 0.5, late())})


def late_variants(orders: DataFrame) -> DataFrame:
    """The late rate under different denominators, and its bounds if unknown times were all on time or all late."""
    o = with_delay(orders)
    ok, exact = delivered(o), (F.col("final_status") == "delivered") & F.col("delay_min").isNotNull()
    is_late = F.coalesce(late(), F.lit(False))
    done = x.clean("final_status") == "delivered"
    open_ = done & F.col("delay_min").isNull()
    n = F.count_if
    one = o.agg(n(ok & is_late).alias("l"), n(ok).alias("v"), n(exact & is_late).alias("le"), n(exact).alias("ve"), F.count("*").alias("all"), n(open_).alias("u"))
    rows = [("delivered_with_times", "l / v"), ("case_sensitive_status", "le / ve"), ("all_orders", "l / all"), ("lower_bound", "l / (v + u)"), ("upper_bound", "(l + u) / (v + u)")]
    parts = ", ".join(f"'{k}', try_divide(cast({e.split(' / ')[0]} as double), {e.split(' / ')[1]})" for k, e in rows)
    return one.selectExpr(f"stack({len(rows)}, {parts}) AS (variant, late_rate)")


def late_curve(valid: DataFrame, thresholds: list[int]) -> DataFrame:
    one = valid.agg(*[x.share(late(t)).alias(f"t{t}") for t in thresholds])
    return one.selectExpr("stack({}, {}) AS (threshold_min, late_rate)".format(len(thresholds), ", ".join(f"{t}, t{t}" for t in thresholds)))


def shares(df: DataFrame, by: Column, name: str) -> DataFrame:
    """Rows a group and their share of all grouped rows; null has no group."""
    g = df.groupBy(by.alias(name)).agg(F.count("*").alias("rows")).where(F.col(name).isNotNull())
    return g.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy()))  # one row a group


def summarise(valid: DataFrame, by: Column, name: str) -> DataFrame:
    counts = [F.count("*").alias("orders"), x.share(late()).alias("late_rate"), F.avg("promise_min").alias("mean_promise")]
    return quantiles.summary(valid.withColumn(name, by), [name], counts, {"median_delay": ("delay_min", 0.5, None)})


def crosstab(df: DataFrame, row: str, column: str, values: list, cell: Column, fill=None) -> DataFrame:
    """A column for each of the given values, known beforehand so that no extra pass finds them."""
    out = df.groupBy(row).pivot(column, values).agg(cell)
    return out.fillna(fill) if fill is not None else out


def describe(df: DataFrame, column: str) -> DataFrame:
    plain = [F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).alias("lo"), F.max(column).alias("hi")]
    return quantiles.summary(df, [], plain, {n: (column, q, None) for n, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))})


def fk_coverage(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Of the child's rows: how many keys are null, unmatched, matched. Keys are counted before they join."""
    keys = child.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias("p")).where("p is not null").distinct()
    j = keys.join(known, F.col("k") == F.col("p"), "left")
    s = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    m = s(F.col("p").isNotNull())
    return j.agg(
        F.lit(name).alias("relationship"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), s(F.col("k").isNull()).alias("null_keys"),
        s(F.col("k").isNotNull() & F.col("p").isNull()).alias("unmatched"), F.try_divide(m.cast("double"), F.sum("n")).alias("coverage"),
    )


def key_report(df: DataFrame, key: str, name: str) -> DataFrame:
    g = df.groupBy(key).agg(F.count("*").alias("n"))
    return g.agg(
        F.lit(name).alias("table_name"), F.sum("n").alias("rows"), (F.max("n") <= 1).alias("key_unique"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("key_nulls"), F.max("n").alias("max_per_key"),
    )


def cardinality(df: DataFrame, key: str) -> DataFrame:
    """How many keys have how many rows."""
    return df.groupBy(key).agg(F.count("*").alias("rows_per_key")).groupBy("rows_per_key").agg(F.count("*").alias("keys"))


def disagreement(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """Matched rows, and those whose values differ; a null on either side differs."""
    j = a.select(key, F.col(column).alias("_a")).join(b.select(key, F.col(column).alias("_b")), key)
    return j.agg(F.count("*").alias("matched"), F.count_if(x.differs("_a", "_b")).alias("different"))


def first_times(events: DataFrame, keys: list[str], kind: str, at: str, kinds: dict[str, str]) -> DataFrame:
    """Event kinds as columns with their first time."""
    out = events.groupBy(*keys).pivot(kind, list(kinds)).agg(F.min(at))
    return out.select(*keys, *[F.col(k).alias(v) for k, v in kinds.items()])


def pings(events: DataFrame, key: str, at: str, tie: str, most: int | None = None) -> DataFrame:
    """Minutes and kilometres since the same key's last ping; jumps over 20 km are implausible.
    Keys with more than `most` pings are worked on in segments of time."""
    out = segments.lagged(events, key, [at, tie], [at, "lat", "lon"], "_last", most)
    out = out.withColumns({"gap_min": x.minutes(F.col(at), F.col(f"_last.{at}")), "km": x.flat_km(F.col("lat"), F.col("lon"), F.col("_last.lat"), F.col("_last.lon"))})
    return out.withColumn("jump", F.coalesce(F.col("km") > 20, F.lit(False))).drop("_last")


def timeline(*sources: DataFrame, most: int | None = None) -> DataFrame:
    """order_id, event_time, event_type, actor, source_system of all orders, with each event's
    position in its order: by time, unknown times last. Orders with more than `most` events are
    worked on in segments of time."""
    every = reduce(DataFrame.unionByName, sources)
    return segments.placed(every, "order_id", ["event_time", "event_type", "source_system", "actor"], "position", most)


def durations(orders: DataFrame) -> DataFrame:
    """Minutes from order to pickup and from pickup to delivery (transit)."""
    return orders.withColumns({"order_to_pickup_min": x.minutes("pickup_at", "created_at"), "pickup_to_delivery_min": x.minutes("actual_delivery_at", "pickup_at")})


def with_dispatch(valid: DataFrame, dispatch: DataFrame) -> DataFrame:
    """The second source's view of each order: how its estimate drifted from the promise, lateness
    against that estimate, whether a driver was exchanged, and the estimating model."""
    known = dispatch.select("order_id", "current_delivery_eta", "reassigned_at", "eta_model_version")
    j = valid.join(known, "order_id", "left")
    return j.withColumns({
        "eta_drift_min": x.minutes("current_delivery_eta", "promised_eta"),
        "late_vs_current": F.coalesce(F.col("actual_delivery_at") > F.col("current_delivery_eta"), F.lit(False)),
        "reassigned": F.col("reassigned_at").isNotNull(),
    })


def system_view(tickets: DataFrame, orders: DataFrame, valid: DataFrame) -> DataFrame:
    """Each different ticket with its order's delay; where the order or its delay is unknown, it says so."""
    seen = orders.select("order_id").join(valid.select("order_id", "delay_min"), "order_id", "left")
    view = x.bins("delay_min", [-1e9, 0, 10, 1e9], ["on time", "late 0-10", "late >10"], other="no delivery time / no order")
    return tickets.distinct().join(seen, "order_id", "left").withColumn("system_view", view)


def in_order(summary: DataFrame, column: str, categories: list) -> DataFrame:
    """The summary's rows for just these categories, in this order, those without rows included."""
    listed = summary.sparkSession.createDataFrame(list(enumerate(categories)), f"place int, _category {dict(summary.dtypes)[column]}")
    rest = [c for c in summary.columns if c != column]
    j = F.broadcast(listed).join(summary, F.col("_category") == F.col(column), "left")
    return j.select("place", F.col("_category").alias(column), *rest).orderBy("place")


def first_match(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """The smallest key that both sides have; null if there is none."""
    return rows.join(other.select(key).distinct(), key, "left_semi").agg(F.min(key).alias(key))


def recomputed(orders: DataFrame, outcomes: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """How many stated delays agree with the times, of those where both are known."""
    j = with_delay(orders).select("order_id", F.col("delay_min").alias("_own")).join(outcomes.select("order_id", "delay_min"), "order_id")
    both = F.col("_own").isNotNull() & F.col("delay_min").isNotNull()
    return j.agg(
        F.count_if(both).alias("classifiable"), F.count_if(both & (F.abs(F.col("_own") - F.col("delay_min")) < tolerance)).alias("agreeing"),
        F.count_if(F.col("_own").isNull() != F.col("delay_min").isNull()).alias("known_to_one"),
    )


def grain(df: DataFrame, key: str, base: DataFrame) -> DataFrame:
    """Rows, different keys and the base's different keys, and whether all three agree."""
    g = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("keys"))
    expected = base.select(key).distinct().agg(F.count("*").alias("expected"))
    return g.crossJoin(expected).withColumn("holds", (F.col("rows") == F.col("keys")) & (F.col("keys") == F.col("expected")))  # two single rows


def assert_grain(df: DataFrame, key: str, base: DataFrame) -> DataFrame:
    """df, or an error if a join before it has multiplied or lost rows."""
    r = grain(df, key, base).first()
    if not r.holds:
        raise ValueError(f"one row a {key} is broken: {r.rows} rows, {r.keys} of {r.expected} keys")
    return df


def page_completeness(pages: DataFrame, key: str, announced: int, known: DataFrame) -> DataFrame:
    """check, passed: stored pages re-counted against the announced total, keys once, and
    membership both ways with another source."""
    c = pages.groupBy(key).agg(F.count("*").alias("n"))
    there = known.select(F.col(key).alias("_k")).distinct()
    j = c.join(there, F.col(key) == F.col("_k"), "full").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), (F.coalesce(F.max("n"), F.lit(0)) <= 1).alias("once"),
        (F.count_if(F.col("n").isNull()) == 0).alias("found"), (F.count_if(F.col("_k").isNull()) == 0).alias("expected"),
    )
    return j.selectExpr(f"stack(4, 'pages_recount_to_total', rows = {announced}, 'no_key_twice', once, 'every_known_key_found', found, 'every_found_key_known', expected) AS (check, passed)")


def status_freshness(status: DataFrame, orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """By how restaurants report: records, states written after the pickup that ends them, records
    from before their order, and the median age of a record."""
    j = status.join(orders.select("order_id", "created_at", "pickup_at"), "order_id", "left").join(restaurants, "restaurant_id", "left")
    s, after = x.clean("status"), F.col("last_updated_at") > F.col("pickup_at")
    c = F.count_if
    aged = j.withColumn("_age", x.minutes("last_updated_at", "created_at"))
    counts = [F.count("*").alias("records"), c((s == "preparing") & after).alias("stale_preparing"), c((s == "ready") & after).alias("stale_ready"), c(F.col("_age") < 0).alias("before_order")]
    return quantiles.summary(aged, ["manual_status_updates"], counts, {"median_age_min": ("_age", 0.5, None)})


def journey(orders: DataFrame, outcomes: DataFrame, actions: DataFrame, tickets: DataFrame, interventions: DataFrame) -> DataFrame:
    """One row an order: each many-side is summed up by order before it joins."""
    c = F.count_if
    kind = F.col("action_type")
    acts = actions.groupBy("order_id").agg(F.count("*").alias("n_actions"), c(kind == "eta_view").alias("eta_views"), F.bool_or(kind == "cancel").alias("cancelled"))
    tick = tickets.where("order_id is not null").groupBy("order_id").agg(F.countDistinct("ticket_id").alias("n_tickets"))
    inter = interventions.groupBy("order_id").agg(
        F.count("*").alias("n_interventions"), F.array_join(F.sort_array(F.collect_set("reason")), ", ").alias("reasons"),
        F.min("intervention_at").alias("first_intervention_at"),
    )
    out = reduce(lambda a, b: a.join(b, "order_id", "left"), [outcomes, acts, tick, inter], orders)
    out = out.fillna({"n_actions": 0, "eta_views": 0, "cancelled": False, "n_tickets": 0, "n_interventions": 0, "reasons": ""})
    frustrated = (F.col("n_tickets") > 0) | F.col("cancelled") | (F.col("eta_views") >= 3)
    out = out.withColumn("frustrated", frustrated)
    timing = F.when(F.col("n_interventions") == 0, "none").when(F.col("first_intervention_at") > F.col("actual_delivery_at"), "post-delivery").otherwise("pre-delivery")
    return out.withColumns({"neglected": F.col("frustrated") & F.coalesce(F.col("late_flag") == 1, F.lit(False)) & (F.col("n_interventions") == 0), "intervention_timing": timing})


def journey_metrics(j: DataFrame) -> DataFrame:
    """Five figures for late orders and the rest."""
    is_late = F.col("late_flag") == 1
    shares = [
        F.count("*").alias("orders"), x.share(F.col("n_tickets") > 0).alias("with_ticket"), x.share(F.col("frustrated")).alias("frustrated_share"),
        x.share(F.col("n_interventions") > 0).alias("with_intervention"), F.avg("eta_views").alias("mean_eta_views"),
    ]
    return quantiles.summary(j.where("late_flag is not null").withColumn("is_late", is_late), ["is_late"], shares, {"median_delay": ("delay_min", 0.5, None)})


def reconciled(orders: DataFrame, second: DataFrame) -> DataFrame:
    """The late rate if missing delivery times came from a second source; nothing is written back."""
    j = orders.join(second.select("order_id", F.col("delivered_at").alias("_second")), "order_id", "left")
    what_if = with_delay(j.withColumn("actual_delivery_at", F.coalesce("actual_delivery_at", "_second")))
    both = with_delay(j).agg(x.share(late()).alias("_"), F.count_if(F.col("delay_min").isNotNull()).alias("orders_before"), F.count_if(late()).alias("late_before"))
    after = what_if.agg(F.count_if(F.col("delay_min").isNotNull()).alias("orders_after"), F.count_if(late()).alias("late_after"))
    return both.drop("_").crossJoin(after)  # two single rows


def order_chronology(o: DataFrame) -> DataFrame:
    c = F.count_if
    return o.agg(
        c(F.col("promised_eta") < F.col("created_at")).alias("eta_before_creation"),
        c(F.col("pickup_at") < F.col("created_at")).alias("pickup_before_creation"),
        c(F.col("actual_delivery_at") < F.col("pickup_at")).alias("delivered_before_pickup"),
        c((x.clean("final_status") == "cancelled") & F.col("actual_delivery_at").isNotNull()).alias("cancelled_with_delivery"),
    )


def unparseable(df: DataFrame, columns: list[str]) -> DataFrame:
    one = df.agg(*[F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS TIMESTAMP_NTZ)").isNull()).alias(c) for c in columns])
    return one.selectExpr("stack({}, {}) AS (column_name, unparseable)".format(len(columns), ", ".join(f"'{c}', `{c}`" for c in columns)))
