"""Sources and sinks on files made from the shared tables: what is written comes back the same."""

from __future__ import annotations

import io
import sqlite3
import struct
import tempfile
import zipfile
from functools import reduce
from pathlib import Path
from urllib.parse import urlsplit

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import publish
from ..functions.expressions import haversine_km
from ..operators import enrich, kpis, lifecycle, orders, quality
from ..sources import http, shapefiles, tables
from ..storage import Place, work_folder
from . import adapters as a
from .registry import LIFE, ZONES, T, journey, query


def local_path(place: Place) -> str | None:
    """The path of a place on this machine's disk."""
    parts = urlsplit(place.uri)
    return parts.path if parts.scheme == "file" else None


# ---- sources --------------------------------------------------------------------------------


@query("SELECT count(*) AS rows, CAST((SELECT count(*) FROM (DESCRIBE lineitem)) AS INTEGER) AS columns FROM lineitem")
def trip_footer(s, d):
    """A file's footer, and no row of it."""
    found = tables.footer(s, f"{d}/lineitem.parquet")
    return s.createDataFrame([(found["rows"], found["columns"])], "rows long, columns int")


ODD_NAMES = "SELECT n_nationkey AS LocationID, CASE n_nationkey % 5 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'N/A' ELSE n_name END AS Borough, CASE WHEN n_nationkey % 7 = 0 THEN 'N/A' ELSE n_name END AS Zone FROM nation"


@query(f"SELECT LocationID AS location_id, Zone AS zone, Borough AS borough, Borough IN ('Unknown', 'N/A') OR Zone = 'N/A' AS is_placeholder FROM ({ODD_NAMES})")
def zone_lookup_file(s, d):
    """A lookup with a byte-order mark; "N/A" and "Unknown" stay text and mark placeholders."""
    rows = a.table(s, d, "nation").selectExpr("n_nationkey AS LocationID", "CASE n_nationkey % 5 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'N/A' ELSE n_name END AS Borough", "CASE WHEN n_nationkey % 7 = 0 THEN 'N/A' ELSE n_name END AS Zone", "'z' AS service_zone")
    at = work_folder(s, "zones") / "zones.csv"
    at.write("﻿" + publish.csv_text([r.asDict() for r in rows.collect()]))
    return enrich.zone_dimension(tables.zones(s, str(at))).drop("service_zone")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_file(s, d):
    """A CSV file whose types are inferred."""
    at = work_folder(s, "csv")
    a.table(s, d, "nation").select("n_nationkey", "n_name", "n_regionkey").write.option("header", True).csv(str(at / "n"))
    return tables.csv(s, str(at / "n"))


@query("SELECT r_regionkey AS id, r_name AS name FROM region")
def json_file(s, d):
    """One JSON array over several lines."""
    at = work_folder(s, "json") / "r.json"
    at.write_json([{"id": r.r_regionkey, "name": r.r_name} for r in a.table(s, d, "region").collect()])
    return tables.json(s, str(at), "id int, name string")


@query("SELECT date_trunc('hour', ts) AS hour, CAST(count(*) AS DOUBLE) AS temperature_c, CAST(count(*) % 3 AS DOUBLE) AS precipitation_mm, CAST(count(*) % 7 AS DOUBLE) AS wind_speed_kmh FROM events GROUP BY 1")
def weather_file(s, d):
    """The service's parallel arrays, as rows."""
    hours = a.table(s, d, "events").groupBy(F.date_format(F.date_trunc("HOUR", "ts"), "yyyy-MM-dd'T'HH:mm").alias("h")).agg(F.count("*").alias("n")).collect()  # a month's hours
    hourly = {"time": [r.h for r in hours], "temperature_2m": [float(r.n) for r in hours], "precipitation": [float(r.n % 3) for r in hours], "wind_speed_10m": [float(r.n % 7) for r in hours]}
    at = work_folder(s, "weather") / "w.json"
    at.write_json({"latitude": 40.7, "longitude": -74.0, "timezone": "America/New_York", "hourly": hourly})
    return tables.weather(tables.weather_response(s, str(at))).drop("place")


class Shelf:
    """Pages that Spark has written, handed out to tasks under their numbers, as a service would."""

    def __init__(self, spark, rows, order: str, record, size: int):
        place, self.size = work_folder(spark, "shelf"), size
        sorted_rows = rows.repartitionByRange(order).sortWithinPartitions(order)
        sorted_rows.write.parquet(str(place / "rows"))
        numbered = tables.numbered(spark, str(place / "rows"), name="_at")
        self.total = numbered.count()
        page = F.floor(F.col("_at") / size)
        pages = numbered.groupBy(page.alias("page")).agg(F.sort_array(F.collect_list(F.struct("_at", record.alias("r")))).alias("rs"))  # size rows each
        pages.select("page", F.to_json(F.transform("rs", lambda x: x["r"])).alias("value")).write.parquet(str(place / "pages"))
        self.pages = spark.read.parquet(str(place / "pages"))

    def fetch(self, numbers):
        """The pages of these numbers; one after the last is empty."""
        held = F.broadcast(numbers) if self.total <= self.size * self.SENT else numbers
        found = self.pages.join(held, F.col("page") == F.col("number")).select("number", self.body(F.col("value")).alias("body"))
        beyond = numbers.where(F.col("number") * self.size >= self.total).select("number", self.body(F.lit("[]")).alias("body"))
        return found.unionByName(beyond)

    #: Numbers that are sent along to every task at most.
    SENT = 1_000_000

    def body(self, value):
        return value


@query("SELECT event_id % 40 AS page_of, count(*) AS rows, count(DISTINCT unique_key) AS keys, count(x) AS with_x FROM (SELECT event_id, CAST(event_id AS VARCHAR) AS unique_key, CASE WHEN event_id % 3 <> 0 THEN event_id / 2.0 END AS x FROM events WHERE event_type = 'error') GROUP BY 1")
def complaint_pages(s, d):
    """Pages fetched until a short one, kept as they came, counted again from where they are kept."""
    rows = a.table(s, d, "events").where("event_type = 'error'").select("event_id")
    record = F.expr("named_struct('unique_key', cast(event_id as string), 'descriptor', cast(event_id % 40 as string), 'x_coordinate_state_plane', if(event_id % 3 = 0, '?', cast(event_id / 2 as string)))")
    service = Shelf(s, rows, "event_id", record, 501)
    folder = work_folder(s, "pages")
    m = http.gathered(s, service.fetch, http.listed(service.size), folder / "p", service.total, service.size)
    if not http.unharmed(s, folder, m) or m["received"] != m["expected"]:
        raise ValueError("the pages aren't what was announced")
    kept = tables.complaints_of(http.bodies(s, folder, m))
    return kept.groupBy(F.col("descriptor").cast("long").alias("page_of")).agg(F.count("*").alias("rows"), F.countDistinct("unique_key").alias("keys"), F.count("x").alias("with_x"))


@query("""SELECT 'pages_recount_to_total' AS "check", true AS passed UNION ALL SELECT 'no_key_twice', true UNION ALL SELECT 'every_known_key_found', (SELECT count(*) FROM orders WHERE o_orderkey % 11 = 0) = 0
  UNION ALL SELECT 'every_found_key_known', true""")
def dispatch_pages(s, d):
    """Numbered pages that say whether more follow; what is kept is counted again and held against the orders."""

    class Service(Shelf):
        def body(self, value):
            more = (F.col("number") + 1) * self.size < self.total
            return F.concat(F.lit('{"data": '), value, F.lit(', "has_more": '), more.cast("string"), F.lit(f', "total_records": {self.total}}}'))

    known = a.table(s, d, "orders").select(F.col("o_orderkey").alias("order_id"))
    service = Service(s, known.where("order_id % 11 <> 0"), "order_id", F.expr("named_struct('order_id', order_id, 'eta_model_version', concat('v', order_id % 2))"), 1000)
    folder = work_folder(s, "dispatch")
    m = http.gathered(s, service.fetch, http.announcing(), folder / "p")
    kept = tables.rows_of(http.bodies(s, folder, m), "order_id: long, eta_model_version: string")
    return orders.page_completeness(kept, "order_id", m["expected"], known)


@query("SELECT user_id % 7 AS driver_id, event_type AS type, count(*) AS events, count(DISTINCT user_id) AS orders FROM events GROUP BY 1, 2")
def nested_events(s, d):
    """Events nested by driver and hour, one JSON object a line, written and read by Spark."""
    event = F.struct(F.col("user_id").cast("string").alias("order_id"), F.col("event_type").alias("type"), F.col("ts").cast("string").alias("timestamp"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"))
    drivers = a.table(s, d, "events").groupBy((F.col("user_id") % 7).cast("string").alias("driver_id"), F.date_trunc("HOUR", "ts").alias("hour")).agg(F.collect_list(event).alias("events"))
    at = str(work_folder(s, "nested") / "events")
    drivers.select("driver_id", "events").write.json(at)
    return tables.driver_events(s, at, lines=True).groupBy(F.col("driver_id").cast("long").alias("driver_id"), "type").agg(F.count("*").alias("events"), F.countDistinct("order_id").alias("orders"))


def square_file(keys: list[tuple[int, str]]) -> bytes:
    """A shapefile with a square for each key, by the format's description."""
    shp, dbf, width = b"", b"", (12, 25, 5)
    for n, (k, name) in enumerate(keys, 1):
        lo, hi = float(10 * k), float(10 * k + 10)
        ring = struct.pack("<10d", lo, lo, lo, hi, hi, hi, hi, lo, lo, lo)
        body = struct.pack("<i4d3i", 5, lo, lo, hi, hi, 1, 5, 0) + ring
        shp += struct.pack(">2i", n, len(body) // 2) + body
        dbf += b" " + b"".join(v.encode().ljust(w) for v, w in zip((str(k), name, "B"), width, strict=True))
    fields = b"".join(n.ljust(11, b"\0") + b"C" + bytes(4) + bytes([w]) + bytes(15) for n, w in zip((b"LocationID", b"zone", b"borough"), width, strict=True))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("z.shp", struct.pack(">i20xi", 9994, (100 + len(shp)) // 2) + bytes(72) + shp)
        z.writestr("z.dbf", b"\3" + bytes(3) + struct.pack("<IHH", len(keys), 33 + len(fields), 1 + sum(width)) + bytes(20) + fields + b"\r" + dbf)
    return out.getvalue()


@query("SELECT CAST(n_nationkey AS INTEGER) AS zone_id, n_name AS zone, 'B' AS borough, 1 AS rings, 5 AS points, 10.0::DOUBLE * n_nationkey AS least FROM nation")
def shape_file(s, d):
    """A shapefile that is read in several parts, by ranges of records."""
    at = work_folder(s, "shapes") / "z.zip"
    at.write(square_file([(r.n_nationkey, r.n_name) for r in a.table(s, d, "nation").collect()]))
    points = F.flatten("rings")
    return shapefiles.read(s, str(at), part_bytes=1000).select("zone_id", "zone", "borough", F.size("rings").alias("rings"), F.size(points).alias("points"), F.array_min(F.transform(points, lambda p: p["x"])).alias("least"))


@query("SELECT s_suppkey, s_name, s_acctbal, s_suppkey % 3 = 0 AS third FROM supplier")
def sqlite_file(s, d):
    folder = work_folder(s, "sqlite")
    at = Path(local_path(folder) or tempfile.mkdtemp(prefix="wayfold-")) / "s.db"  # SQLite writes files of a disk, here the driver's
    with sqlite3.connect(at) as c:
        c.execute("CREATE TABLE supplier (k INTEGER, name TEXT, balance REAL)")
        c.executemany("INSERT INTO supplier VALUES (?, ?, ?)", [tuple(r) for r in a.table(s, d, "supplier").select("s_suppkey", "s_name", "s_acctbal").collect()])
    return tables.sqlite(s, str(at), "supplier", parts=3).selectExpr("k AS s_suppkey", "name AS s_name", "balance AS s_acctbal", "k % 3 = 0 AS third")


#: Rows that a task is dealt to sort or group, about.
DEALT = 500_000


def lines_as_files(s, d):
    """The line items in order of their keys, as a table of several files."""
    at = str(work_folder(s, "lines") / "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = a.table(s, d, "lineitem").select(*keys)
    lines.repartitionByRange(max(7, -(-lines.count() // DEALT)), *keys).sortWithinPartitions(*keys).write.option("maxRecordsPerFile", 20_000).parquet(at)
    return at


@query("SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS ride_id, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem")
def ride_ordinals(s, d):
    """Places of rows in a table of several files."""
    return tables.numbered(s, lines_as_files(s, d))


@query("SELECT 0 AS first, count(*) - 1 AS last, count(*) AS different, count(*) AS both_reads FROM lineitem")
def ordinals_of_rides(s, d):
    """The rides' own numbering: no gap, and the same when files are read in other splits."""
    at, other = lines_as_files(s, d), s.newSession()
    for k, v in (("maxPartitionBytes", "8m"), ("openCostInBytes", "256k")):
        other.conf.set(f"spark.sql.files.{k}", v)
    once, again = (tables.numbered(session, at) for session in (s, other))
    values = [c for c in once.columns if c != "ride_id"]
    reads = once.withColumn("_read", F.lit(0)).unionByName(again.withColumn("_read", F.lit(1)))
    dealt = reads.repartition(max(11, -(-once.count() // DEALT)), "ride_id")
    alike = reduce(lambda x, y: x & y, [F.min(c) == F.max(c) for c in values])
    each = dealt.groupBy("ride_id").agg(F.count_if(F.col("_read") == 0).alias("once"), F.count_if(F.col("_read") == 1).alias("again"), alike.alias("alike"))
    mine = F.when(F.col("once") > 0, F.col("ride_id"))
    both = F.coalesce(F.sum(F.when(F.col("alike"), F.col("once") * F.col("again"))), F.lit(0))
    return each.agg(F.min(mine).cast("int").alias("first"), F.max(mine).alias("last"), F.count(mine).alias("different"), both.alias("both_reads"))


@query("SELECT CAST((SELECT count(*) // 2 FROM lineitem) AS BIGINT) AS rows, true AS different, true AS ascending, true AS again, true AS smallest")
def exact_sample(s, d):
    """Half of the rides: exactly as many as asked for, in the order of their ids, the same for
    another partitioning, and those whose hashes are the smallest."""
    rides = tables.numbered(s, lines_as_files(s, d)).select("ride_id")
    n = rides.count() // 2
    drawn, again = tables.sample(rides, n), tables.sample(rides.repartition(13), n).withColumnRenamed("ride_id", "other")
    kept = drawn.withColumns({"p": F.spark_partition_id(), "m": F.monotonically_increasing_id()})
    ascending = kept.withColumn("before", F.lag("ride_id").over(Window.partitionBy("p").orderBy("m"))).agg(F.coalesce(F.bool_and(F.col("ride_id") > F.col("before")), F.lit(True)).alias("ascending"))
    one = drawn.agg(F.count("*").alias("rows"), (F.countDistinct("ride_id") == F.count("*")).alias("different"))
    other = drawn.join(again, F.col("ride_id") == F.col("other"), "full").agg(F.bool_and(F.col("ride_id").isNotNull() & F.col("other").isNotNull()).alias("again"))
    hashed = rides.join(again, F.col("ride_id") == F.col("other"), "left").withColumn("h", F.xxhash64(F.lit(42), "ride_id"))
    ends = hashed.agg((F.max(F.when(F.col("other").isNotNull(), F.col("h"))) < F.min(F.when(F.col("other").isNull(), F.col("h")))).alias("smallest"))
    return one.crossJoin(ascending).crossJoin(other).crossJoin(ends)  # single rows


@query("SELECT n_nationkey, round(2 * 6371.0 * asin(sqrt(pow(sin(radians(n_nationkey - 10.0) / 2), 2) + cos(radians(10.0)) * cos(radians(CAST(n_nationkey AS DOUBLE))) * pow(sin(radians(n_regionkey - 1.0) / 2), 2))), 6) AS km FROM nation")
def grid_distance(s, d):
    far = haversine_km(F.lit(10.0), F.lit(1.0), F.col("n_nationkey").cast("double"), F.col("n_regionkey").cast("double"))
    return a.table(s, d, "nation").select("n_nationkey", F.round(far, 6).alias("km"))


# ---- sinks ----------------------------------------------------------------------------------


def numbered_journey(s, d, at):
    """Rides from a raw table of several files, numbered by their places, on their way to a journey."""
    return enrich.journey(lifecycle.with_lifecycle(tables.numbered(s, at)), a.zones(s, d), a.weather(s, d), T.light_rain_max_mm)


@query(LIFE + """SELECT count(*) AS rows, 33 AS columns, count(*) FILTER (in_kpi_population) AS kpi_population, count(*) AS ride_ids, count(*) - 1 AS last_ride_id,
  CAST(sum(CASE WHEN in_kpi_population THEN date_diff('microsecond', request_datetime, pickup_datetime) // 60000000 END) AS BIGINT) AS whole_minutes FROM life""")
def published_journey(s, d):
    """A month's rides as they are published: zstd Parquet in an edition that follows the one before."""
    output, at = work_folder(s, "month"), str(work_folder(s, "rides") / "trips")
    a.rides(s, d).write.option("maxRecordsPerFile", 20_000).parquet(at)
    for run in ("first", "second"):  # a rerun replaces and doesn't append
        edition = publish.Edition(output, a.MONTH, run)
        enrich.published(numbered_journey(s, d, at)).write.option("compression", "zstd").parquet(str(edition.folder / "ride_journey.parquet"))
        edition.publish()
    back = s.read.parquet(str(publish.current(output, a.MONTH) / "ride_journey.parquet"))
    whole = F.sum(F.when(F.col("in_kpi_population"), F.expr("timestampdiff(MICROSECOND, request_datetime, pickup_datetime) div 60000000")))
    return back.agg(F.count("*").alias("rows"), F.lit(len(back.columns)).alias("columns"), F.count_if("in_kpi_population").alias("kpi_population"), F.countDistinct("ride_id").alias("ride_ids"), F.max("ride_id").alias("last_ride_id"), whole.alias("whole_minutes"))


@query(ZONES + "SELECT CAST(pickup_zone_id AS BIGINT) AS pickup_zone_id, rides, ranked FROM zk")
def published_zones(s, d):
    """The zone file, written and read again."""
    at = work_folder(s, "zone-csv") / "zone_breakdown.csv"
    publish.small_csv(kpis.by_zone(journey(s, d), T.min_rides_per_zone), at)
    return tables.csv(s, str(at)).select(F.col("pickup_zone_id").cast("long").alias("pickup_zone_id"), F.col("rides").cast("long").alias("rides"), "ranked")


@query(f"""WITH {a.ZONES_SQL}, shapes AS (SELECT 5 AS zone_id UNION ALL SELECT 9)
  SELECT 'hvfhv.download_complete' AS "check", 'PASS' AS status, (SELECT count(*) FROM lineitem) AS counted
  UNION ALL SELECT 'hvfhv.required_columns', 'PASS', 10 UNION ALL SELECT 'zones.required_columns', 'PASS', 4
  UNION ALL SELECT 'zone_shapes.id_consistency', CASE WHEN lacking + unknown > 0 THEN 'WARN' ELSE 'PASS' END, lacking FROM (SELECT
    (SELECT count(*) FROM zones WHERE NOT is_placeholder AND location_id NOT IN (SELECT zone_id FROM shapes)) AS lacking,
    (SELECT count(*) FROM shapes WHERE zone_id NOT IN (SELECT location_id FROM zones)) AS unknown)
  UNION ALL SELECT 'weather.structure', 'PASS', (SELECT count(DISTINCT date_trunc('hour', ts)) FROM events) UNION ALL SELECT 'weather.timezone', 'PASS', 1""")
def source_checks(s, d):
    """What is checked of each source before its rows are: of files that Spark wrote from the tables."""
    folder = work_folder(s, "sources")
    a.rides(s, d).write.parquet(str(folder / "trips"))
    trips = tables.numbered(s, str(folder / "trips"), tables.TRIP_COLUMNS)
    files = [n for n in (folder / "trips").names() if n.endswith(".parquet")]
    feet = [tables.footer(s, str(folder / "trips" / n)) for n in files]
    found = {k: sum(f[k] for f in feet) for k in ("rows", "row_groups")}
    kept = sum((folder / "trips").sizes().get(n, 0) for n in files)
    zones = a.zones(s, d)
    lookup = zones.select(F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone").alias("Zone"), "service_zone")
    hours = a.table(s, d, "events").groupBy(F.date_format(F.date_trunc("HOUR", "ts"), "yyyy-MM-dd'T'HH:mm").alias("time")).agg(F.count("*").cast("double").alias("n"))
    parallel = hours.agg(F.sort_array(F.collect_list(F.struct("time", "n"))).alias("h"))  # a month's hours
    arrays = [F.transform("h", lambda x: x["time"]).alias("time"), *[F.transform("h", lambda x: x["n"]).alias(v) for v in tables.WEATHER_VARIABLES]]
    parallel.select(F.lit(40.7).alias("latitude"), F.lit(-74.0).alias("longitude"), F.lit("America/New_York").alias("timezone"), F.struct(*arrays).alias("hourly")).coalesce(1).write.json(str(folder / "weather"))
    response = tables.weather_response(s, str(folder / "weather"))
    counted = {"hvfhv.download_complete": found["rows"], "hvfhv.required_columns": len(tables.TRIP_COLUMNS), "zones.required_columns": len(tables.ZONE_COLUMNS)}
    checks = [
        quality.download_complete(kept, kept, found, {}), quality.required_columns(trips.columns, tables.TRIP_COLUMNS, "hvfhv"), quality.required_columns(lookup.columns, tables.ZONE_COLUMNS, "zones"),
        *quality.shape_checks(zones, a.polygons(s)), *quality.weather_structure(response, list(tables.WEATHER_VARIABLES), "America/New_York"),
    ]
    counted |= {"zone_shapes.id_consistency": checks[3].evidence["without_geometry"], "weather.structure": tables.weather(response).count(), "weather.timezone": response.count()}
    return s.createDataFrame([(c.check, c.status, counted[c.check]) for c in checks], "check string, status string, counted long")


@query("SELECT 'zones.location_id_unique' AS \"check\", 'PASS' AS status UNION ALL SELECT 'zones.placeholder_codes', 'WARN'")
def published_checks(s, d):
    """Checks as JSON, written and read again."""
    at = work_folder(s, "report") / "validation_report.json"
    at.write_json([{"check": c.check, "status": c.status, "evidence": c.evidence} for c in quality.zone_checks(a.zones(s, d))])
    return tables.json(s, str(at), "`check` string, status string")
