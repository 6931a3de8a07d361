"""Single operators against figures worked out by hand."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wayfold.config import Thresholds, month_bounds
from wayfold.functions import expressions as x
from wayfold.functions import quantiles, segments
from wayfold.operators import enrich, friction, geo, kpis, lifecycle, orders, quality

RIDE = "ride_id long, hvfhs_license_num string, request_datetime timestamp_ntz, on_scene_datetime timestamp_ntz, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int, trip_miles double, trip_time long, base_passenger_fare double"
T0 = dt.datetime(2024, 1, 5, 8, 0, 17)


def ride(i, wait=5.0, scene=1.0, minutes=10.0, zone=1, request=T0, trip_time=None, lic="HV0003"):
    """scene: minutes between arrival and pickup; None leaves the time out."""
    pickup = None if wait is None else request + dt.timedelta(minutes=wait)
    on = None if scene is None or pickup is None else pickup - dt.timedelta(minutes=scene)
    drop = (pickup or request) + dt.timedelta(minutes=minutes)
    return (i, lic, request, on, pickup, drop, zone, zone, 2.0, int(minutes * 60) if trip_time is None else trip_time, 10.0)


def rides(spark, rows):
    return spark.createDataFrame(rows, RIDE)


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(1, "One", "A", False), (2, "Two", "A", False), (3, "Three", "B", False), (264, "N/A", "Unknown", True)], "location_id int, zone string, borough string, is_placeholder boolean")


def test_lifecycle_statuses(spark):
    rows = [ride(0), ride(1, scene=0), ride(2, scene=None), ride(3, scene=-1), ride(4, wait=5, scene=6), ride(5, wait=None), ride(6, wait=-1, scene=None), ride(7, minutes=0), ride(8, trip_time=9999), ride(9, request=dt.datetime(2024, 1, 5, 8, 0))]
    got = {r.ride_id: r for r in lifecycle.with_lifecycle(rides(spark, rows)).collect()}
    assert [got[i].validation_status for i in range(8)] == ["valid"] * 5 + ["missing_timestamp", "pickup_before_request", "dropoff_not_after_pickup"]
    assert [got[i].on_scene_status for i in range(6)] == ["observed", "same_as_pickup", "missing", "after_pickup", "before_request", "missing"]
    assert [got[i].trip_time_mismatch for i in (0, 5, 8)] == [False, False, True]
    assert got[9].request_on_whole_minute and not got[0].request_on_whole_minute
    assert got[0].in_stage_population and not got[1].in_stage_population and got[1].in_kpi_population
    assert got[0].request_to_pickup_min == 5.0 and got[5].request_to_pickup_min is None


def test_headline_example(spark):
    life = lifecycle.with_lifecycle(rides(spark, [ride(0, 4, 1), ride(1, 6, 1.5), ride(2, 10, 2.5)]))
    h, s = kpis.headline(life).first(), kpis.arrival_share(life).first()
    assert (h.median_min, h.population_rides, s.arrival_share_pct) == (6.0, 3, 75.0)
    assert h.p90_min == pytest.approx(9.2)
    assert tuple(kpis.headline_scaled(life).first()) == pytest.approx(tuple(h))


def test_quantiles_by_rounds_match_numpy(spark):
    v = np.random.default_rng(3).integers(0, 10**10, 997).tolist() + [5] * 300
    got = quantiles.by_rounds(spark.createDataFrame([(int(i),) for i in v], "v long"), [0.0, 0.37, 0.5, 0.9, 1.0]).first()
    assert [got[f"q{i}"] for i in range(5)] == pytest.approx(np.quantile(v, [0, 0.37, 0.5, 0.9, 1]).tolist())
    empty = quantiles.by_rounds(spark.createDataFrame([], "v long"), [0.5]).first()
    assert (empty.q0, empty.n) == (None, 0)


def test_quantiles_of_groups(spark):
    """A hot group, null groups, groups of one value and of nulls, several measures."""
    r = np.random.default_rng(4)
    rows = [("hot", None, float(x)) for x in r.normal(0, 50, 4000).round(2)] + [(None, 1, float(x)) for x in r.integers(-9, 9, 50)] + [("one", 2, 7.5), ("null", 3, None)]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(7)
    got = {(x.g, x.h): x for x in quantiles.summary(df, ["g", "h"], [F.count("*").alias("rows")], {"med": ("v", 0.5, None), "p90": ("v", 0.9, None), "pos": ("v", 0.25, F.col("v") > 0)}).collect()}
    assert set(got) == {(g, h) for g, h, _ in rows}
    for k, x in got.items():
        v = [c for a, b, c in rows if (a, b) == k and c is not None]
        assert x.rows == sum((a, b) == k for a, b, _ in rows)
        if v:
            assert (x.med, x.p90) == pytest.approx((np.quantile(v, 0.5), np.quantile(v, 0.9)))
            assert x.pos == pytest.approx(np.quantile([c for c in v if c > 0], 0.25))
        else:
            assert (x.med, x.p90, x.pos) == (None, None, None)


def test_quantiles_of_any_range_in_rounds(spark, monkeypatch):
    """Eighteen orders of magnitude, half of the rows one value, nulls, groups of one row, both
    signs, infinities: with stretches so small that rounds follow rounds, and by way of a table."""
    r = np.random.default_rng(4)
    wide = np.concatenate([10.0 ** r.uniform(-9, 9, 3000) * r.choice([-1, 1], 3000), np.full(3000, 7.25)])
    near = 1e9 + np.arange(2000) * 2.0**-20  # one stretch of the first round
    rows = [("wide", float(v)) for v in wide] + [("near", float(v)) for v in near] + [("one", 3.0), ("none", None), (None, 2.0), (None, 4.0)]
    rows += [("ends", v) for v in (float("-inf"), -1.0, 0.0, -0.0, 5e-324, float("inf"), float("inf"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    qs = [0.0, 0.1, 0.25, 0.5, 0.731, 0.9, 1.0]
    for small, local in ((10**6, 10**4), (40, 10**4), (1, 3)):
        for name, value in (("SMALL", small), ("LOCAL", local)):
            monkeypatch.setattr(quantiles, name, value)
        got = {x.g: x for x in quantiles.by_rounds(df, qs, ["g"]).collect()}
        assert set(got) == {"wide", "near", "one", None, "ends"}
        for g, v in (("wide", wide), ("near", near), ("one", [3.0]), (None, [2.0, 4.0])):
            assert got[g].n == len(v) and [got[g][f"q{i}"] for i in range(7)] == pytest.approx(np.quantile(v, qs).tolist(), rel=1e-12)
        assert [got["ends"][f"q{i}"] for i in (0, 3, 6)] == [float("-inf"), 0.0, float("inf")]
        alone = quantiles.by_rounds(df.where("g = 'wide'"), qs).first()
        assert alone.n == 6000 and [alone[f"q{i}"] for i in range(7)] == pytest.approx(np.quantile(wide, qs).tolist(), rel=1e-12)


def test_no_task_of_a_quantile_reads_more_than_its_share(spark, monkeypatch):
    """Half of 40,000 rows are one value, the rest spread widely: what is looked at value by value,
    and what a window holds, stays within SMALL."""
    monkeypatch.setattr(quantiles, "SMALL", 500)
    v = np.concatenate([np.full(20_000, 1.5), 10.0 ** np.random.default_rng(2).uniform(-9, 9, 20_000)])
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    q = quantiles.by_rounds(df, [0.05, 0.5, 0.95])
    found = q.first()
    assert [found.q0, found.q1, found.q2] == pytest.approx(np.quantile(v, [0.05, 0.5, 0.95]).tolist())
    rows = df.select(quantiles.octave(F.col("v")).alias("b"), "v")
    assert rows.groupBy("b").count().count() < 64 * 34 and rows.select("b").distinct().count() > 1000


def test_rate_and_rounding(spark):
    r = spark.range(1).select(x.per_100k(F.lit(1), F.lit(3)).alias("a"), x.per_100k(F.lit(1), F.lit(0)).alias("b"), x.round2(F.lit(2.375)).alias("c")).first()
    assert round(r.a, 2) == 33333.33 and r.b is None and r.c == 2.38


def test_haversine_and_flat(spark):
    r = spark.range(1).select(x.haversine_km(F.lit(40.0), F.lit(-74.0), F.lit(41.0), F.lit(-74.0)).alias("a"), x.flat_km(F.lit(40.0), F.lit(-74.0), F.lit(40.0), F.lit(-73.0)).alias("b")).first()
    assert r.a == pytest.approx(6371 * math.pi / 180) and r.b == pytest.approx(111 * math.cos(math.radians(40)))


def test_bins(spark):
    d = spark.createDataFrame([(v,) for v in (0.0, 5.0, 5.1, 10.0, 11.0, None)], "v double")
    right = [r[0] for r in d.select(x.bins("v", [0, 5, 10], ["a", "b"])).collect()]
    left = [r[0] for r in d.select(x.bins("v", [0, 5, 10], ["a", "b"], right=False)).collect()]
    assert right == [None, "a", "b", "b", None, None] and left == ["a", "b", "b", None, None, None]


def test_duplicates_count_nulls_as_values(spark):
    d = spark.createDataFrame([(1, None), (1, None), (1, None), (2, 3), (None, None), (None, None)], "a int, b int")
    assert tuple(quality.duplicates(d, ["a", "b"]).first()) == (6, 3, 3)


def test_time_parts_and_missing_request(spark):
    d = spark.createDataFrame([(dt.datetime(2026, 7, 4, h),) for h in (5, 6, 10, 16, 20)] + [(None,)], "t timestamp_ntz").withColumns(lifecycle.time_parts(F.col("t")))
    rows = d.collect()
    assert [r.time_period for r in rows] == lifecycle.PERIODS + [None]
    assert rows[0].is_weekend and rows[0].request_weekday == 5 and rows[-1].request_hour is None


def test_weather_join_and_bands(spark):
    w = spark.createDataFrame([(dt.datetime(2024, 1, 5, 8), 1.0, 0.0, 2.0), (dt.datetime(2024, 1, 5, 9), 1.0, 2.5, 2.0), (dt.datetime(2024, 1, 5, 10), 1.0, None, 2.0), (dt.datetime(2024, 1, 5, 11), 1.0, -1.0, 2.0)], "hour timestamp_ntz, temperature_c double, precipitation_mm double, wind_speed_kmh double")
    r = rides(spark, [ride(i, request=T0 + dt.timedelta(hours=i)) for i in range(5)])
    got = {q.ride_id: (q.precip_band, q.weather_matched, q.temperature_c) for q in enrich.with_weather(r, w).collect()}
    assert got == {0: ("dry", True, 1.0), 1: ("moderate_or_heavy_rain", True, 1.0), 2: ("weather_unavailable", False, 1.0), 3: ("weather_unavailable", True, 1.0), 4: ("weather_unavailable", False, None)}
    assert {q.precip_band for q in enrich.with_weather(r, None).collect()} == {"weather_unavailable"}


def test_repeated_hours_keep_the_first(spark):
    w = spark.createDataFrame([(0, dt.datetime(2024, 1, 1), 5.0), (1, dt.datetime(2024, 1, 1), 9.0)], "place int, hour timestamp_ntz, precipitation_mm double")
    assert [r.precipitation_mm for r in enrich.hourly_once(w, "place").collect()] == [5.0]


def test_hour_floor_stays_without_zone_in_a_clock_change(spark):
    d = spark.createDataFrame([(dt.datetime(2026, 3, 8, 2, 30),)], "t timestamp_ntz").select(x.floor_hour("t").alias("h"))
    assert d.first().h == dt.datetime(2026, 3, 8, 2) and dict(d.dtypes)["h"] == "timestamp_ntz"


def test_zones_missing_and_placeholder(spark, zones):
    r = enrich.with_zones(rides(spark, [ride(0, zone=1), ride(1, zone=264), ride(2, zone=999), ride(3, zone=None)]), zones)
    got = {q.ride_id: (q.pickup_zone, q.placeholder_pickup) for q in r.collect()}
    assert got == {0: ("One", False), 1: ("N/A", True), 2: (None, True), 3: (None, True)}
    raw = spark.createDataFrame([(1, "Queens", "Corona", "z"), (2, "N/A", "Outside of NYC", "N/A"), (3, "Unknown", "N/A", "N/A")], "LocationID int, Borough string, Zone string, service_zone string")
    assert [z.is_placeholder for z in enrich.zone_dimension(raw).orderBy("location_id").collect()] == [False, True, True]


def square(a, b):
    return [(a, a), (a, b), (b, b), (b, a)]


@pytest.mark.parametrize("cells", [1, 40, 256])
def test_points_in_donut_and_overlap(spark, monkeypatch, cells):
    monkeypatch.setattr(geo, "CELLS", cells)
    p = spark.createDataFrame([(5, [square(0.0, 10.0), square(4.0, 6.0)]), (9, [square(0.0, 3.0)])], "zone_id int, rings array<array<struct<x: double, y: double>>>")
    pts = spark.createDataFrame([("a", 1.0, 1.0), ("b", 5.0, 5.0), ("c", 8.0, 8.0), ("d", None, 1.0), ("e", float("nan"), 1.0)], "point_id string, x double, y double")
    got = {r.point_id: (r.zone_id, r.ambiguous, r.mapping) for r in geo.mapping(geo.locate(pts, p)).collect()}
    assert got == {"a": (5, True, "ambiguous_lowest_id"), "b": (None, False, "outside_all_zones"), "c": (5, False, "mapped"), "d": (None, False, "no_coordinates"), "e": (None, False, "no_coordinates")}


def test_friction_keeps_zeros(spark, zones):
    pick = spark.createDataFrame([(1, 1000), (2, 500), (3, 200)], "zone_id int, hvfhv_pickups long")
    c = spark.createDataFrame([(1, "passenger", True), (1, "non_passenger", False), (2, "passenger", False), (None, "passenger", False), (99, "other", False)], "zone_id int, category string, pickup_reliability_reason boolean")
    z = {r.zone_id: r for r in friction.by_zone(c, pick, zones).collect()}
    assert z[3].complaints_all == 0 and z[1].complaints_passenger == 1 and z[1].complaints_pickup_reliability == 1 and z[99].hvfhv_pickups == 0
    b = {r.borough: r for r in friction.by_borough(friction.by_zone(c, pick, zones)).collect()}
    assert (b["A"].complaints_all, b["A"].hvfhv_pickups, b["B"].complaints_all, b[None].rate_per_100k) == (3, 1500, 0, None)


def month_of_rides(spark, per_day=3):
    first, last = month_bounds("2024-01")
    days = [first + dt.timedelta(days=d) for d in range((last - first).days + 1)]
    return [ride(k * per_day + i, wait=2 + (k + i) % 8, zone=1 + i % 3, request=dt.datetime(d.year, d.month, d.day, 8 + i, 3, 17)) for k, d in enumerate(days) for i in range(per_day)]


def status(checks):
    return {c.check: c.status for c in checks}


def test_trip_checks_and_gate(spark, zones):
    first, last = month_bounds("2024-01")
    rows = month_of_rides(spark)
    check = lambda rows: quality.trip_checks(lifecycle.with_lifecycle(rides(spark, rows)), zones, first, last, Thresholds())
    good = check(rows)
    assert quality.gate(good)["publish"] and status(good)["hvfhv.month_coverage"] == "PASS" and status(good)["hvfhv.request_semantics_scheduled_rides"] == "UNKNOWN"
    gap = status(check([r for r in rows if r[2].day != 7]))
    assert gap["hvfhv.month_coverage"] == "FAIL"
    twice = check(rows + rows[:7])
    assert status(twice)["hvfhv.trip_uniqueness"] == "FAIL" and quality.gate(twice)["blocking_failures"] == ["hvfhv.trip_uniqueness"]
    unknown = status(check([(*r[:6], 999, *r[7:]) for r in rows]))
    assert unknown["hvfhv.pickup_location_integrity"] == "FAIL" and unknown["hvfhv.dropoff_location_integrity"] == "PASS"
    assert status(check([]))["hvfhv.file_readable"] == "FAIL"


def test_scopes_of_the_gate():
    c = quality.Check
    g = quality.gate([c("a", "FAIL", "weather"), c("b", "WARN"), c("c", "FAIL", "info")])
    assert g["publish"] and not g["publish_weather_analysis"] and g["publish_friction_kpi"]
    g = quality.gate([c("a", "FAIL")])
    assert not g["publish"] and not g["publish_friction_kpi"]
    assert quality.worst(["PASS", "UNKNOWN", "WARN"]) == "UNKNOWN" and quality.worst([]) == "UNKNOWN"


def test_weather_gap_blocks_weather_only(spark):
    first, last = month_bounds("2024-01")
    start = dt.datetime(2023, 12, 31)
    w = spark.createDataFrame([(start + dt.timedelta(hours=h), 1.0, 0.0, 1.0) for h in range(768)], "hour timestamp_ntz, temperature_c double, precipitation_mm double, wind_speed_kmh double")
    assert status(quality.weather_checks(w, first, last, Thresholds()))["weather.hour_coverage"] == "PASS"
    gap = w.where((F.col("hour") < "2024-01-10") | (F.col("hour") >= "2024-01-12"))
    checks = quality.weather_checks(gap, first, last, Thresholds())
    assert status(checks)["weather.hour_coverage"] == "FAIL" and quality.gate(checks)["publish"]


def test_zone_order_and_ties(spark):
    z = spark.createDataFrame([(i, f"z{i}", "A", 50, 5.0, p, True) for i, p in ((1, 9.0), (2, 7.001), (3, 7.004), (4, 12.0), (5, 12.0), (6, 8.0))], "pickup_zone_id int, pickup_zone string, pickup_borough string, rides long, median_min double, p90_min double, ranked boolean")
    got = [(r.side, r.pickup_zone_id) for r in kpis.zone_extremes(z, 2).orderBy("side", "place").collect()]
    assert got == [("best", 2), ("best", 3), ("worst", 5), ("worst", 4)]


def test_hour_matched_difference(spark):
    rows = [(True, True, b, h, w) for b, h, w in (("dry", 8, 4.0), ("dry", 9, 6.0), ("light_rain", 8, 5.0), ("light_rain", 9, 6.0), ("light_rain", 9, 8.0), ("light_rain", 10, 99.0))]
    d = spark.createDataFrame(rows, "in_kpi_population boolean, weather_matched boolean, precip_band string, request_hour int, request_to_pickup_min double")
    r = kpis.hour_matched(d, 1).first()
    assert (r.precip_band, r.diff_min, r.hours) == ("light_rain", pytest.approx((1 * 1 + 2 * 1) / 3), 2)


def test_order_helpers(spark):
    d = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (2, "z", 5), (None, "n", 1)], "k int, v string, o int")
    assert {(r.k, r.v) for r in orders.keep_first(d, ["k"], ["o"]).collect()} == {(1, "y"), (2, "z"), (None, "n")}
    assert [r.conflicting_keys for r in orders.key_conflicts(spark.createDataFrame([(1, None), (1, "a"), (2, None), (2, None)], "k int, v string"), ["k"], ["v"]).collect()] == [1]
    c = orders.fk_coverage(d, "k", spark.createDataFrame([(1,), (1,), (None,)], "p int"), "p", "x").first()
    assert (c.rows, c.null_keys, c.unmatched, c.coverage) == (4, 1, 1, 0.5)
    a, b = spark.createDataFrame([(1, None), (2, "u"), (3, "v")], "k int, v string"), spark.createDataFrame([(1, None), (2, "u"), (3, "w")], "k int, v string")
    assert tuple(orders.disagreement(a, b, "k", "v").first()) == (3, 2)


def ring(r, n, x, y, low, high):
    """A star with n corners around (x, y)."""
    turn = np.sort(r.uniform(0, 2 * math.pi, n))
    far = r.uniform(low, high, n)
    return [(float(x + f * math.cos(t)), float(y + f * math.sin(t))) for t, f in zip(turn, far, strict=True)]


def test_covering_decides_as_all_sides_would(spark):
    """Stars with holes, tiny and huge, overlapping and far apart, and points on corners and edges of cells."""
    r = np.random.default_rng(8)
    zones = [(1, [ring(r, 60, 0, 0, 3, 5), ring(r, 9, 0, 0, 0.5, 1)]), (2, [ring(r, 7, 2, 1, 1, 4)]), (3, [ring(r, 300, 1e6, -2e6, 900, 1000)]), (4, [ring(r, 5, 0.1, 0.1, 1e-6, 2e-6)]), (5, [ring(r, 40, -3, 2, 0.01, 6), ring(r, 30, 4, 4, 1, 2)]), (6, [[(1.0, 1.0), (1.0, 1.0), (1.0, 1.0)]])]
    polygons = spark.createDataFrame([(i, [[{"x": x, "y": y} for x, y in g] for g in rings]) for i, rings in zones], "zone_id int, rings array<array<struct<x: double, y: double>>>")
    pts = [tuple(map(float, p)) for p in r.uniform(-7, 7, (1500, 2))] + [tuple(map(float, p)) for p in r.uniform(-1100, 1100, (500, 2)) + [1e6, -2e6]]
    pts += [(float(x), float(y)) for x in np.arange(-4, 4.5, 0.5) for y in np.arange(-4, 4.5, 0.5)] + [p for _, rings in zones for g in rings for p in g[:20]] + [(0.1, 0.1), (1e300, 5.0), (float("inf"), 0.0), (float("nan"), 1.0), (None, 2.0)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "i int, x double, y double")

    def inside(x, y, rings):
        crossed = 0
        for g in rings:
            for (xa, ya), (xb, yb) in zip(g, [g[-1], *g[:-1]], strict=True):
                crossed += (ya > y) != (yb > y) and x < xa + (xb - xa) * (y - ya) / (yb - ya)
        return crossed % 2 == 1

    want = {}
    for i, (x, y) in enumerate(pts):
        held = [] if x is None or math.isnan(x) else [z for z, rings in zones if inside(x, y, rings)]
        want[i] = (min(held, default=None), len(held) > 1)
    assert {p.i: (p.zone_id, p.ambiguous) for p in geo.locate(points, polygons).collect()} == want
    cells = geo.covering(geo.edges(polygons)).collect()
    assert max(sum(c.zone_id == z for c in cells) for z, _ in zones) < 4 * geo.CELLS
    found = geo.lookups(points, polygons).first()
    assert found.places == found.by_cell + found.by_sides and found.share_by_sides < 0.6
    assert geo.locate(points, polygons.limit(0)).where("zone_id is not null").count() == 0


def test_pings(spark):
    e = spark.createDataFrame([("o", dt.datetime(2024, 1, 1, 0, m), 40.0 + m / 10, -74.0, m) for m in (0, 1, 5)], "k string, t timestamp_ntz, lat double, lon double, i int")
    got = orders.pings(e, "k", "t", "i").orderBy("t").collect()
    assert [r.gap_min for r in got] == [None, 1.0, 4.0] and [r.jump for r in got] == [False, False, True]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_segments_give_what_one_window_gives(spark, kind):
    """Half of all rows under one key, one time repeated a thousand times, null keys and times."""
    r = np.random.default_rng(6)
    start = dt.datetime(2024, 1, 1)
    rows = [(None if i % 11 == 0 else 0 if i % 2 else int(i % 40), None if i % 13 == 0 else start + dt.timedelta(seconds=int(r.integers(0, 9000))), i) for i in range(8000)]
    rows += [(0, start + dt.timedelta(seconds=500), 8000 + i) for i in range(1000)]
    df = spark.createDataFrame(rows, f"k int, t {kind}, i int").repartition(5)
    w = Window.partitionBy("k").orderBy("t", "i")
    want = sorted(map(tuple, df.withColumn("b", F.lag(F.struct("i")).over(w)["i"]).select("i", "b").collect()))
    last = Window.partitionBy("k").orderBy(F.asc_nulls_last("t"), "i")
    places = sorted(map(tuple, df.withColumn("p", F.row_number().over(last)).select("i", "p").collect()))
    for most in (100, 700, 10**6):
        assert sorted(map(tuple, segments.lagged(df, "k", ["t", "i"], ["i"], "x", most).select("i", "x.i").collect())) == want
        assert sorted(map(tuple, segments.placed(df, "k", ["t", "i"], "p", most).select("i", "p").collect())) == places
    assert segments.lagged(df.limit(0), "k", ["t", "i"], ["i"], "x", 1).count() == 0


def test_no_task_gets_a_hot_key(spark, monkeypatch):
    """Half of all events belong to one order: tasks of the window stay within twice the median."""
    n = 40_000
    df = spark.range(n).select(F.expr("if(id % 2 = 0, -1, id % 997)").alias("k"), F.expr("timestampadd(SECOND, cast(id * 7919 % 40000 as int), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("t"), F.col("id").alias("i"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        sizes = lambda d: sorted(r["count"] for r in d.groupBy(F.spark_partition_id()).agg(F.count("*").alias("count"), F.max("x")).collect())
        plain = sizes(df.withColumn("x", F.lag("i").over(Window.partitionBy("k").orderBy("t", "i"))))
        cut = sizes(segments.lagged(df, "k", ["t", "i"], ["i"], "x", 400))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sum(cut) == n and plain[-1] > 4 * np.median(plain) and cut[-1] < 2 * np.median(cut)


@pytest.mark.parametrize("name", ["bucketed_journey", "bucketed_coverage"])
def test_buckets_leave_no_shuffle(spark, name):
    from wayfold.plans import registry
    from wayfold.sources import bucketed

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = registry.queries()[name](spark, "/root/testdata/sf0.001")
        plain = registry.queries()["order_journey"](spark, "/root/testdata/sf0.001")
        assert bucketed.shuffles(df) == 0 and bucketed.shuffles(plain) >= 5
        assert df.count() == plain.count()
        before = {t.name for t in spark.catalog.listTables()}
        assert not [t for t in before if t.startswith("bucketed_")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert bucketed.buckets_for(spark.range(100), spark.range(3000), rows=1000) == 4 and bucketed.buckets_for(spark.range(3)) == 1


def test_levels(spark):
    z = spark.createDataFrame([(1, "A", 10, 2), (2, "A", 90, 1), (3, None, 5, 4), (4, "B", 0, 1)], "zone_id int, borough string, hvfhv_pickups long, complaints_passenger long")
    got = {(r.level, r.borough, r.zone_id): (r.complaints_passenger, r.hvfhv_pickups, r.rate_per_100k) for r in friction.levels(z, {"borough": 5, "zone": 10}).collect()}
    assert got == {("city", None, None): (8, 105, pytest.approx(8e5 / 105)), ("borough", "A", None): (3, 100, 3000.0), ("borough", None, None): (4, 5, 80000.0), ("zone", "A", 1): (2, 10, 20000.0), ("zone", "A", 2): (1, 90, pytest.approx(1e5 / 90))}
    waits = spark.createDataFrame([("A", 4.0), (None, 7.0)], "pickup_borough string, p90_min double")
    both = {(r.level, r.borough): r.p90_min for r in friction.kpi5(z, waits, 5).collect()}
    assert both == {("city", None): None, ("borough", "A"): 4.0, ("borough", None): 7.0}
    plan = friction.kpi5(z, waits, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("hvfhv_pickups#") and plan.count("Expand") == 1 and "Union" not in plan  # one aggregate of the zones


def test_classification(spark):
    d = spark.createDataFrame([("ready",), ("ready ",), ("READY",), ("hold",), (None,)], "s string")
    got = {r.value: r.decision for r in quality.classify(d, "s", ["ready"], ["hold"]).collect()}
    assert got == {"ready": "canonical", "ready ": "safe to normalise", "READY": "safe to normalise", "hold": "needs owner", None: "needs owner"}


def test_thresholds_from_environment():
    assert Thresholds.from_env({"MIN_RIDES_PER_ZONE": "7", "MAX_EXCLUDED_SHARE": "0.2"}).echo()["min_rides_per_zone"] == 7
    assert month_bounds("2024-12") == (dt.date(2024, 12, 1), dt.date(2024, 12, 31))


def test_streaming_windows_match_the_table(spark, tmp_path):
    from wayfold.streaming.windows import hourly_counts

    rows = [(i, dt.datetime(2024, 1, 1, i % 5, i % 60), "view" if i % 2 else "click", f'{{"k": {i}}}') for i in range(200)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, props string").write.parquet(str(tmp_path / "in"))
    src = spark.read.parquet(str(tmp_path / "in"))
    q = hourly_counts(spark.readStream.schema(src.schema).parquet(str(tmp_path / "in")), "1 hour").writeStream.format("memory").queryName("win").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.table("win").collect())) == sorted(map(tuple, hourly_counts(src).collect()))
