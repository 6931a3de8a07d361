"""Whole months against a small local server, with faults and drills."""

import datetime as dt
import hashlib
import http.server
import io
import json
import struct
import threading
import urllib.parse
import zipfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from urllib.parse import urlsplit

import pytest

from tests.test_operators import RIDE, month_of_rides, ride
from wayfold import publish
from wayfold.config import Thresholds
from wayfold.operators import quality
from wayfold.plans import monthly
from wayfold.sources import http as web
from wayfold.sources import offline, shapefiles, tables
from wayfold.storage import Place

ZONES = '﻿"LocationID","Borough","Zone","service_zone"\n1,"A","One","z"\n2,"A","Two","z"\n3,"B","Three","z"\n264,"Unknown","N/A","N/A"\n'


def shape_zip(zones):
    """Squares as a zipped shape file: zones is (id, name, borough, low, high)."""
    shp, dbf = b"", b""
    for k, (i, name, borough, a, b) in enumerate(zones):
        pts = [(a, a), (a, b), (b, b), (b, a), (a, a)]
        body = struct.pack("<i4d2i1i", 5, a, a, b, b, 1, len(pts), 0) + b"".join(struct.pack("<2d", *p) for p in pts)
        shp += struct.pack(">ii", k + 1, len(body) // 2) + body
        dbf += b" " + str(i).encode().ljust(10) + name.encode().ljust(20) + borough.encode().ljust(20)
    fields = b"".join(n.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([w]) + b"\0" * 15 for n, w in (("LocationID", 10), ("zone", 20), ("borough", 20)))
    head = b"\3\0\0\0" + struct.pack("<IHH", len(zones), 32 + len(fields) + 1, 51) + b"\0" * 20
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("t/zones.shp", b"\0" * 24 + struct.pack(">i", (100 + len(shp)) // 2) + b"\0" * 72 + shp)
        z.writestr("t/zones.dbf", head + fields + b"\r" + dbf)
    return out.getvalue()


def weather_json(drop=0):
    start = dt.datetime(2023, 12, 31)
    hours = [start + dt.timedelta(hours=h) for h in range(768)][drop:]
    rain = [3.0 if h.hour == 8 else 0.5 if h.hour == 9 else 0.0 for h in hours]
    return {
        "latitude": 40.7, "longitude": -74.0, "timezone": "America/New_York",
        "hourly": {"time": [h.strftime("%Y-%m-%dT%H:%M") for h in hours], "temperature_2m": [1.0] * len(hours), "precipitation": rain, "wind_speed_10m": [2.0] * len(hours)},
    }


def complaint_rows(n=62):
    kinds = ["Driver Complaint - Passenger", "Driver Complaint - Non Passenger", "Car Service Company Complaint"]
    return [{
        "unique_key": f"{i:05d}", "created_date": f"2024-01-{1 + i % 31:02d}T10:00:00.000", "complaint_type": monthly.COMPLAINT_TYPE,
        "descriptor": kinds[i % 3], "descriptor_2": "Refused Pick-Up" if i % 6 == 0 else "x", "borough": "B" if i % 3 == 2 else "A", "agency": "TLC",
        "status": "Closed", "x_coordinate_state_plane": str(10 * (i % 3) + 5), "y_coordinate_state_plane": str(10 * (i % 3) + 5),
    } for i in range(n)]


class Server:
    def __init__(self, files, weather, complaints):
        self.files, self.weather, self.complaints, self.hits, self.fail = files, weather, complaints, [], {}
        outer = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                url = urllib.parse.urlsplit(self.path)
                outer.hits.append(url.path)
                if outer.fail.get(url.path):
                    self.send_response(outer.fail[url.path].pop(0))
                    self.end_headers()
                    return
                q = dict(urllib.parse.parse_qsl(url.query))
                if url.path == "/weather":
                    body = json.dumps(outer.weather).encode()
                elif url.path == "/complaints":
                    rows = outer.complaints
                    body = json.dumps([{"count": str(len(rows))}] if "$select" in q else rows[int(q["$offset"]) : int(q["$offset"]) + int(q["$limit"])]).encode()
                else:
                    body = outer.files.get(url.path)
                if body is None:
                    self.send_response(404)
                    self.end_headers()
                    return
                self.send_response(200)
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *a):
                pass

        self.http = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.http.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.http.server_port}"


@pytest.fixture(scope="module")
def trip_file(spark, tmp_path_factory):
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = month_of_rides(spark, per_day=9)
    names = [c.split()[0] for c in RIDE.split(", ")][1:]
    df = pd.DataFrame([r[1:] for r in rows], columns=names)
    t = pa.Table.from_pandas(df.astype({"PULocationID": "int32", "DOLocationID": "int32"}), preserve_index=False)
    for c in names:
        if c.endswith("datetime"):
            t = t.set_column(names.index(c), c, t[c].cast(pa.timestamp("us")))
    out = tmp_path_factory.mktemp("trips") / "t.parquet"
    pq.write_table(t, out)
    return out.read_bytes()


@pytest.fixture
def server(trip_file):
    s = Server(
        {"/trips_2024-01.parquet": trip_file, "/zones.csv": ZONES.encode(), "/zones.zip": shape_zip([(1, "One", "A", 0.0, 10.0), (2, "Two", "A", 10.0, 20.0), (3, "Three", "B", 20.0, 30.0)])},
        weather_json(), complaint_rows(),
    )
    yield s
    s.http.shutdown()


def make(spark, server, tmp_path, **kw):
    feeds = monthly.Feeds(f"{server.url}/trips_{{month}}.parquet", f"{server.url}/zones.csv", f"{server.url}/zones.zip", f"{server.url}/weather", f"{server.url}/complaints", 25)
    return monthly.Run(
        spark, kw.pop("month", "2024-01"), feeds, tmp_path / "data", tmp_path / "out", tmp_path / "logs", Thresholds(min_rides_per_zone=5),
        retry=web.Retry(base=0.01, sleep=lambda s: None), **kw
    )


def seen(spark, folder, month="2024-01"):
    """Where readers find the month: a path of this machine."""
    return Path(urlsplit(publish.current(Place(spark, folder), month).uri).path)


def test_publishes_and_repeats(spark, server, tmp_path):
    r = make(spark, server, tmp_path)
    assert monthly.run(r) == 0
    final = seen(spark, tmp_path / "out")
    m = json.loads((final / "metrics.json").read_text())
    k = m["kpis"]
    assert k[monthly.K1]["population_rides"] == 279 and 0 < k[monthly.K1]["value"] <= k[monthly.K2]["value"]
    assert k[monthly.K4]["value"]["zones_ranked"] == 3 and k[monthly.K5]["value"]["citywide_passenger_complaints"] == 41
    assert k[monthly.K5]["value"]["by_borough"]["B"]["hvfhv_pickups"] == 93
    assert m["supporting_analyses"]["precipitation_association"]["by_band"]["dry"]["rides"] > 0
    v = json.loads((final / "validation_report.json").read_text())
    assert v["gate"]["publish"] and not [c for c in v["checks"] if c["status"] == "FAIL"]
    j = spark.read.parquet(f"file://{final}/ride_journey.parquet")
    assert j.count() == 279 and len(j.columns) == 33 and dict(j.dtypes)["request_to_pickup_min"] == "float"
    assert "One" in (final / "zone_breakdown.csv").read_text() and "## Checks" in (final / "evidence_table.md").read_text()
    before = [h for h in server.hits]
    assert monthly.run(make(spark, server, tmp_path)) == 0  # all raw inputs are there already
    assert server.hits == before and seen(spark, tmp_path / "out") != final and len(list((tmp_path / "out" / "2024-01" / "editions").iterdir())) == 2
    assert all(json.loads((at / "metrics.json").read_text())["kpis"] == k for at in (final, seen(spark, tmp_path / "out")))


def test_drills(spark, server, tmp_path):
    assert monthly.run(make(spark, server, tmp_path)) == 0
    kept = (seen(spark, tmp_path / "out") / "metrics.json").read_text()
    assert monthly.run(make(spark, server, tmp_path, chaos="missing_column")) == 2
    assert monthly.run(make(spark, server, tmp_path, chaos="duplicate_rows")) == 2
    assert monthly.run(make(spark, server, tmp_path, chaos="weather_gap")) == 0
    gap = json.loads((seen(spark, tmp_path / "out" / "_chaos_weather_gap") / "metrics.json").read_text())
    assert gap["supporting_analyses"]["precipitation_association"]["withheld"] and gap["kpis"][monthly.K1]["value"]
    flaky = make(spark, server, tmp_path, chaos="api_flaky")
    assert monthly.run(flaky) == 0 and flaky.retry.retried == 2
    assert (seen(spark, tmp_path / "out") / "metrics.json").read_text() == kept
    assert len(list((tmp_path / "logs" / "failed_runs").glob("*.json"))) == 2


def test_missing_sources(spark, server, tmp_path):
    del server.files["/zones.zip"]
    server.weather = {"reason": "no"}
    assert monthly.run(make(spark, server, tmp_path)) == 0
    m = json.loads((seen(spark, tmp_path / "out") / "metrics.json").read_text())
    assert m["kpis"][monthly.K5]["validation_status"] == "WITHHELD" and m["supporting_analyses"]["precipitation_association"]["withheld"]
    assert monthly.run(make(spark, server, tmp_path, month="2024-02")) == 1  # no such file
    server.files["/zones.csv"] = b"LocationID,Borough\n1,A\n"
    assert monthly.run(make(spark, server, tmp_path / "other")) == 2


def test_a_month_on_another_file_system(spark, server, tmp_path):
    """Inputs and outputs under an address that no pathlib knows."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    (tmp_path / "far").mkdir()
    conf.set("fs.viewfs.mounttable.months.link./far", f"file://{tmp_path}/far")
    r = make(spark, server, tmp_path)
    r.data, r.output = Place(spark, "viewfs://months/far/data"), Place(spark, "viewfs://months/far/out")
    assert monthly.run(r) == 0
    final = publish.current(r.output, "2024-01")
    assert spark.read.parquet(str(final / "ride_journey.parquet")).count() == 279
    assert (final / "metrics.json").read_json()["kpis"][monthly.K1]["value"] > 0
    before = len(server.hits)
    again = make(spark, server, tmp_path)
    again.data, again.output = r.data, r.output
    assert monthly.run(again) == 0 and len(server.hits) == before
    assert publish.current(r.output, "2024-01").uri != final.uri and not (tmp_path / "out").exists()


def test_a_sample_runs_without_a_network(spark, server, tmp_path):
    import dataclasses

    assert monthly.run(make(spark, server, tmp_path)) == 0
    about = offline.draw(spark, Place(spark, tmp_path / "data"), "2024-01", Place(spark, tmp_path / "small"), rides=250)
    assert about["rides"] == 250 and about["source_rows"] == 279
    hits = len(server.hits)
    r = make(spark, server, tmp_path, mode="sample")
    r.feeds = dataclasses.replace(r.feeds, **offline.feeds(tmp_path / "small"))
    r.data, r.output = Place(spark, tmp_path / "data2"), Place(spark, tmp_path / "out2")
    assert monthly.run(r) == 0 and len(server.hits) == hits
    m = (publish.current(r.output, "2024-01") / "metrics.json").read_json()
    assert m["mode"] == "sample" and m["kpis"][monthly.K1]["population_rides"] <= 250 and m["kpis"][monthly.K5]["value"]["citywide_passenger_complaints"] == 41
    v = (publish.current(r.output, "2024-01") / "validation_report.json").read_json()
    by = {c["check"]: c["evidence"] for c in v["checks"]}
    assert by["hvfhv.download_complete"]["rows"] == 250 and by["hvfhv.download_complete"]["row_groups"] >= 1
    assert 0 < by["weather.grid_point_offset"]["offset_km"] < 20 and v["decisions"]["on_scene"]["stages_are_published"] in (True, False)
    text = (publish.current(r.output, "2024-01") / "evidence_table.md").read().decode()
    assert "km from the place asked for" in text and "## Decisions" in text


def test_retries_and_checksums(spark, server, tmp_path):
    here = Place(spark, tmp_path)
    server.fail["/zones.csv"] = [500, 503]
    waits = []
    retry = web.Retry(base=1, cap=1.5, sleep=waits.append)
    m, used = web.preserved(f"{server.url}/zones.csv", here / "z.csv", retry)
    assert not used and waits == [1, 1.5] and m["bytes"] == len(ZONES.encode())
    assert web.preserved(f"{server.url}/zones.csv", here / "z.csv", retry)[1]
    (tmp_path / "z.csv").write_text("changed")
    assert not web.preserved(f"{server.url}/zones.csv", here / "z.csv", retry)[1]
    with pytest.raises(web.RetrievalError):
        retry.get(f"{server.url}/nothing", lambda r: r.read())
    server.fail["/zones.csv"] = [503] * 9
    with pytest.raises(web.RetrievalError):
        web.Retry(attempts=3, sleep=lambda s: None).get(f"{server.url}/zones.csv", lambda r: r.read())
    server.fail["/zones.csv"] = [404]
    with pytest.raises(web.RetrievalError):
        retry.get(f"{server.url}/zones.csv", lambda r: r.read())


def test_pauses():
    asked = lambda *sent, **kw: [p.send(x) for p in [web.pauses(9, **kw)] if next(p) == 0 for x in sent]
    assert asked(None, None, None, base=1, cap=3) == [1, 2, 3]
    assert asked(4.0, None, 40.0, base=1, cap=9) == [4, 2, 9]
    assert web.Miss("x", asked="soon").asked is None and web.Miss("x", asked="7").asked == 7
    assert list(web.pauses(1, 1, 1)) == [0.0]
    assert web.request_key("http://a:1/x?q=2") == web.request_key("http://b/x?q=2")


def test_changing_total_is_refused(spark, tmp_path):
    here = Place(spark, tmp_path)
    pages = [{"data": [1], "has_more": True, "total_records": 2}, {"data": [2], "has_more": False, "total_records": 3}]
    retry = web.Retry()
    retry.get = lambda url, handle: json.dumps(pages[int(url) - 1]).encode()
    with pytest.raises(web.RetrievalError):
        web.numbered_pages(str, here / "p", retry)
    pages[1]["total_records"] = 2
    assert web.numbered_pages(str, here / "p", retry)["received"] == 2
    m = web.pages(lambda o, s: "1", 5, here / "q", type("R", (), {"get": lambda self, u, h: b"[1, 2]"})(), 2)
    assert web.intact(here, m | {"folder": "q"}) and not web.intact(here, m | {"folder": "none"}) and not web.intact(here, None)


def test_an_edition_is_published_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    """Whatever step of a writer fails, and between any two steps, readers see one whole edition."""
    out = Place(spark, tmp_path / "out")
    steps, fails = [0], [None]

    def whole():
        at = publish.current(out, "m")
        texts = {(at / f"{k}.txt").read() for k in range(3)} if at else set()
        assert len(texts) <= 1
        return texts.pop().decode() if texts else None

    for name in ("write", "create", "delete", "mkdir"):
        real = getattr(Place, name)

        def step(self, *args, real=real):
            whole()
            steps[0] += 1
            if steps[0] == fails[0]:
                raise OSError("the file system is gone")
            made = real(self, *args)
            whole()
            return made

        monkeypatch.setattr(Place, name, step)

    def attempt(text, at=None):
        steps[0], fails[0] = 0, at
        edition = publish.Edition(out, "m", f"{text}-{at}")
        for k in range(3):
            (edition.folder / f"{k}.txt").write(text)
        edition.publish()
        return steps[0]

    assert whole() is None
    n = attempt("first")
    assert whole() == "first" and n >= 5
    for k in range(1, n + 4):
        before = whole()
        try:
            attempt(f"try{k}", k)
            assert whole() == f"try{k}"  # what failed, if anything, was tidying
        except OSError:
            assert whole() == before
    fails[0] = None
    month = out / "m"
    (month / "log" / "99999999.json").write('{"edition": "half a mani')  # a writer that died
    assert whole() == f"try{n + 3}"
    monkeypatch.setattr(publish.Edition, "STALE_H", 0.0)
    attempt("last")
    assert whole() == "last" and len((month / "editions").names()) == 2
    assert publish.csv_text([]) == ""


def test_writers_at_the_same_time(spark, tmp_path):
    out = Place(spark, tmp_path / "out")
    editions = [publish.Edition(out, "m", str(k)) for k in range(6)]
    for k, e in enumerate(editions):
        (e.folder / "a").write(str(k))
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda e: e.publish(), editions))
    known = publish.numbers(out / "m")
    assert known[-1] == 6 and (publish.current(out, "m") / "a").read().decode() == publish.manifest(out / "m", 6)["edition"]
    with pytest.raises(FileExistsError):
        publish.Edition(out, "m", publish.manifest(out / "m", 6)["edition"])


def test_facts_are_observed_in_the_pass_that_writes(spark, tmp_path):
    from wayfold.plans import adapters as a
    from wayfold.plans.registry import T, journey, life

    first, last = dt.date.fromisoformat(a.FIRST), dt.date.fromisoformat(a.LAST)
    j, zones = journey(spark, "/root/testdata/sf0.001"), a.zones(spark, "/root/testdata/sf0.001")
    facts = [*quality.trip_facts(first, last, T), *quality.population_facts()[1:]]
    want = quality.with_sides(j, zones).agg(*facts).first().asDict()

    def write(rides):
        rides.select("l_orderkey").write.parquet(f"file://{tmp_path}/{len(list(tmp_path.iterdir()))}")
        return want["rows"]

    assert quality.observed_write(j, zones, facts, write).asDict() == pytest.approx(want)
    counted_twice = quality.observed_write(j.unionByName(j.limit(5)), zones, facts, write)  # not what was written: counted anew
    assert counted_twice.rows == want["rows"] + 5
    rides = life(spark, "/root/testdata/sf0.001")
    one = {c.check: (c.status, c.evidence) for c in quality.trip_checks(rides, zones, first, last, T)}
    assert one["hvfhv.file_readable"][1] == {"rows": want["rows"]} and len(one) == 11
    assert quality.repeats(rides, quality.NATURAL_KEY)[1] == quality.duplicates(rides, quality.NATURAL_KEY).first().duplicate_rows
    twice = quality.repeats(rides.unionByName(rides.limit(7)), quality.NATURAL_KEY)
    assert twice == (want["rows"] + 7, quality.repeats(rides, quality.NATURAL_KEY)[1] + 7)
    assert [c.status for c in quality.trip_checks(rides.limit(0), zones, first, last, T)] == ["FAIL"]


def test_places(spark, tmp_path):
    here = Place(spark, tmp_path)
    (here / "f" / "a.json").write_json({"x": 1})
    assert (here / "f" / "a.json").read_json() == {"x": 1} and (here / "f" / "none").read_json() is None
    (here / "f" / "b.json").write("{")
    assert (here / "f" / "b.json").read_json() is None and (here / "f").names() == ["a.json", "b.json"]
    assert (here / "f" / "b.json").sha256() == hashlib.sha256(b"{").hexdigest()
    with pytest.raises(FileExistsError):
        (here / "f" / "a.json").move(here / "f" / "b.json")
    (tmp_path / "local").write_bytes(b"abc")
    (here / "f" / "c").put(tmp_path / "local")
    assert (here / "f" / "c").read() == b"abc" and (here / "f" / "c").parent.name == "f" and (here / "none").names() == []


def test_readers(spark, tmp_path):
    import sqlite3

    with sqlite3.connect(tmp_path / "d.db") as c:
        c.execute("CREATE TABLE orders (id, status)")
        c.executemany("INSERT INTO orders VALUES (?, ?)", [(1, "a"), (2, None)])
        c.execute("CREATE TABLE kinds (i INTEGER, f REAL, mixed, n NUMERIC, b BLOB, empty)")
        c.executemany("INSERT INTO kinds VALUES (?, ?, ?, ?, ?, ?)", [(1, 0.5, "x", 1, b"a", None), (2, None, 7, 2.5, None, None), (None, 3.0, 0.5, None, b"", None)])
        c.execute("CREATE TABLE none (a)")
    assert tables.sqlite_tables(str(tmp_path / "d.db"))[0] == "kinds"
    at = str(tmp_path / "d.db")
    assert sorted(map(tuple, tables.sqlite(spark, at, "orders", parts=3).collect())) == [(1, "a"), (2, None)]
    k = tables.sqlite(spark, at, "kinds")
    assert [t for _, t in k.dtypes] == ["bigint", "double", "string", "double", "binary", "string"]
    assert sorted(((r.i, r.f, r.mixed, r.n, r.b and bytes(r.b), r.empty) for r in k.collect()), key=repr) == sorted(
        [(1, 0.5, "x", 1.0, b"a", None), (2, None, "7", 2.5, None, None), (None, 3.0, "0.5", None, b"", None)], key=repr,
    )
    assert tables.sqlite(spark, at, "none").count() == 0
    (tmp_path / "z.csv").write_text(ZONES)
    z = tables.zones(spark, str(tmp_path / "z.csv"))
    assert z.columns == tables.ZONE_COLUMNS and sorted(r.Zone for r in z.collect()) == ["N/A", "One", "Three", "Two"]
    assert dict(tables.csv(spark, str(tmp_path / "z.csv")).dtypes)["LocationID"] == "int"
    (tmp_path / "p.json").write_text('[{"a": 1, "b": "x"}, {"a": 2}]')
    assert sorted(map(tuple, tables.json(spark, str(tmp_path / "p.json"), "a int, b string").collect())) == [(1, "x"), (2, None)]
    assert tables.json(spark, str(tmp_path / "p.json")).count() == 2
    (tmp_path / "e.json").write_text(json.dumps([{"driver_id": "d", "events": [{"order_id": "o", "type": "t", "timestamp": "2024-01-01T00:00:00", "lat": 1.0, "lon": 2.0}]}]))
    assert tables.driver_events(spark, str(tmp_path / "e.json")).first().order_id == "o"
    d = tables.order_times(spark.createDataFrame([("2024-01-01 10:00:00",), ("x",)], "t string"), ["t"])
    assert [r.t for r in d.collect()] == [dt.datetime(2024, 1, 1, 10), None]
    (tmp_path / "z.zip").write_bytes(shape_zip([(7, "Seven", "B", 1.0, 2.0)]))
    z = shapefiles.read(spark, str(tmp_path / "z.zip")).first()
    assert (z.zone_id, z.zone, len(z.rings[0])) == (7, "Seven", 5)
    assert len(tables.checksums(spark, str(tmp_path / "z.zip")).first().sha256) == 64
    s = tables.sample(spark.range(1000).withColumnRenamed("id", "ride_id"), 100)
    ids = [r.ride_id for r in s.collect()]
    assert len(ids) == 100 and ids == sorted(ids)
    assert [r.ride_id for r in monthly.repeated_rows(spark.createDataFrame([ride(i) for i in range(40)], RIDE)).orderBy("ride_id").collect()][:4] == [0, 0, 1, 1]
