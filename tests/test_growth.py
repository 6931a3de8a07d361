"""Steps whose work is dealt out by the size of the tables."""

import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from wayfold.functions import segments
from wayfold.operators import enrich
from wayfold.plans import adapters, registry, source_queries
from wayfold.sources import http as web
from wayfold.sources import tables
from wayfold.storage import Place

SF = "/root/testdata/sf0.001"


def driver_is_passed_by(monkeypatch):
    def refuse(self, *args):
        raise AssertionError("a page came by the driver")

    for name in ("read", "write"):
        monkeypatch.setattr(Place, name, refuse)


def served(pages):
    """A fetch from given bodies; a page that isn't there doesn't come."""
    def fetch(numbers):
        made = numbers.sparkSession.createDataFrame(list(enumerate(pages)), "n long, body string")
        return numbers.join(made, F.col("n") == F.col("number")).select("number", "body")

    return fetch


def announced(data, more, total):
    return json.dumps({"data": data, "has_more": more, "total_records": total})


def test_dispatch_pages_reach_tasks_alone(spark, monkeypatch):
    driver_is_passed_by(monkeypatch)
    assert registry.queries()["dispatch_pages"](spark, SF).count() == 4


def test_gathered_pages_are_those_of_a_client_that_asks_one_by_one(spark, tmp_path):
    here = Place(spark, tmp_path)
    got = lambda name, pages, says, **kw: web.gathered(spark, served(pages), says, here / name, **kw)
    pages = [announced([{"k": 2 * i}, {"k": 2 * i + 1}], i < 4, 10) for i in range(5)]
    m = got("whole", pages, web.announcing())
    assert (m["pages"], m["received"], m["expected"], len(m["waves"])) == (5, 10, 10, 2)
    assert sorted(r.k for r in tables.rows_of(web.bodies(spark, here, m), "k: long").collect()) == list(range(10))
    assert [r.body for r in web.bodies(spark, here, m).orderBy("number").collect()] == pages and web.unharmed(spark, here, m)
    one = got("one", [announced([{"k": 1}], False, 9)] + pages[1:], web.announcing())
    assert (one["pages"], one["received"], one["expected"]) == (1, 1, 9)
    early = got("early", [*pages[:2], announced([], False, 10), *pages[3:]], web.announcing())
    assert (early["pages"], early["received"]) == (3, 4) and web.unharmed(spark, here, early)
    more = got("more", [*pages[:4], announced([{"k": 8}, {"k": 9}], True, 10), announced([{"k": 10}], False, 10)], web.announcing())
    assert (more["pages"], more["received"], len(more["waves"])) == (6, 11, 3)
    for name, bad in (("total", [*pages[:3], announced([{"k": 6}], True, 11), pages[4]]), ("lost", pages[:4]), ("torn", [*pages[:3], pages[3][:-5], pages[4]])):
        with pytest.raises(web.RetrievalError):
            got(name, bad, web.announcing())
    short = got("short", ["[1, 2]", "[3, 4]", "[]"], web.listed(2), expected=4, size=2)
    assert (short["pages"], short["received"], short["expected"], len(short["waves"])) == (3, 4, 4, 1)
    spark.createDataFrame([(0, "[1, 7]")], "number long, body string").write.mode("append").parquet(str(here / "short" / short["waves"][0]))
    assert not web.unharmed(spark, here, short)


def test_tasks_fetch_over_http_with_retries(spark, tmp_path):
    failed = set()

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            n = int(self.path[1:])
            again = n in failed or n % 2 == 0
            failed.add(n)
            self.send_response(200 if again else 503)
            self.end_headers()
            if again:
                self.wfile.write(announced([{"k": n}], n < 6, 7).encode())

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        fetch = web.over_http(f"http://127.0.0.1:{server.server_port}/{{}}".format, web.Retry(base=0.0))
        m = web.gathered(spark, fetch, web.announcing(), Place(spark, tmp_path) / "p")
    finally:
        server.shutdown()
    assert (m["pages"], m["received"], m["expected"]) == (7, 7, 7)
    assert sorted(r.k for r in tables.rows_of(web.bodies(spark, Place(spark, tmp_path), m), "k: long").collect()) == list(range(7))


def test_output_checks_keep_no_rides(spark, monkeypatch):
    """What is persisted holds a value and its groups, not a ride's whole row."""
    kept, frame = [], type(spark.range(0))
    real = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *level: kept.append(len(self.columns)) or real(self, *level))
    assert registry.queries()["output_checks"](spark, SF).count() == 6
    assert kept and max(kept) < 10


def test_windows_are_dealt_by_rows(spark, monkeypatch):
    """No task sorts more for a larger table, whether or not a key is cut."""
    monkeypatch.setattr(segments, "DEALT", 500)
    df = spark.range(20_000).selectExpr("id", "if(id < 4000, 0, id % 900) AS k", "id AS t")
    for most in (None, 700):
        for f in (segments.placed, segments.lagged):
            args = (df, "k", ["t", "id"], "p", most) if f is segments.placed else (df, "k", ["t", "id"], ["id"], "p", most)
            at = f(*args).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
            assert len(at) > 15 and sum(r["count"] for r in at) == 20_000


def test_lines_are_sorted_and_compared_in_tasks_by_rows(spark, monkeypatch):
    """Ranges grow in number, not in rows, and the comparison sees a second read that differs."""
    monkeypatch.setattr(source_queries, "DEALT", 200)
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    at = source_queries.lines_as_files(spark, SF)
    tasks = {f.rsplit("/", 1)[1].split("-")[1] for f in spark.read.parquet(at).inputFiles()}
    assert len(tasks) >= n // 400
    ask = registry.queries()["ordinals_of_rides"]
    assert tuple(ask(spark, SF).first()) == (0, n - 1, n, n)
    real, reads = tables.numbered, []

    def shifted(session, *args, **kw):
        reads.append(session)
        df = real(session, *args, **kw)
        return df if len(reads) == 1 else df.withColumn("l_partkey", F.expr("if(ride_id = 7, l_partkey + 1, l_partkey)"))

    monkeypatch.setattr(tables, "numbered", shifted)
    assert tuple(ask(spark, SF).first()) == (0, n - 1, n, n - 1) and reads[0] is not reads[1]


def test_complaint_pages_reach_tasks_alone(spark, monkeypatch):
    driver_is_passed_by(monkeypatch)
    assert registry.queries()["complaint_pages"](spark, SF).agg(F.sum("rows")).first()[0] == spark.read.parquet(f"{SF}/events.parquet").where("event_type = 'error'").count()


def test_published_journey_writes_its_rides_once_and_shuffles_none(spark, monkeypatch):
    made, real = [], adapters.rides
    monkeypatch.setattr(adapters, "rides", lambda *args, **kw: made.append(args) or real(*args, **kw))
    assert registry.queries()["published_journey"](spark, SF).first().columns == 33
    assert len(made) == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        weather = spark.range(3).selectExpr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) AS hour", "1.0D AS temperature_c", "0.0D AS precipitation_mm", "2.0D AS wind_speed_kmh")
        joined = enrich.with_weather(real(spark, SF), weather.groupBy("hour").agg(*[F.max(c).alias(c) for c in weather.columns[1:]]))
        assert "SortMergeJoin" not in joined._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
