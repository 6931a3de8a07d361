"""Bounded HTTP retrieval: retries, checksums, and raw copies that are kept. Files and a few pages come by the
driver, one after another; many pages by tasks, side by side."""

from __future__ import annotations

import hashlib
import http.client
import json
import tempfile
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Generator
from contextlib import suppress
from dataclasses import dataclass, field
from pathlib import Path
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import Place

#: Statuses that may pass if one asks again.
PASSING = frozenset({429, 500, 502, 503, 504})


class RetrievalError(RuntimeError):
    pass


class Miss(Exception):
    """One attempt that failed: why, whether another may succeed, and how long the server asks to wait."""

    def __init__(self, why: str, passing: bool = True, asked: str | None = None):
        super().__init__(why)
        self.passing, self.asked = passing, None
        with suppress(TypeError, ValueError):
            self.asked = float(asked)


def fetched(url: str, timeout: float, handle: Callable):
    """One attempt; handle reads the open response, and a network error while it reads is a miss too."""
    request = urllib.request.Request(url, headers={"User-Agent": "wayfold"})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return handle(response)
    except urllib.error.HTTPError as e:
        raise Miss(f"status {e.code}", e.code in PASSING, (e.headers or {}).get("Retry-After")) from e
    except (OSError, http.client.HTTPException) as e:
        raise Miss(f"{type(e).__name__}: {e}") from e


def pauses(attempts: int, base: float, cap: float) -> Generator[float, float | None, None]:
    """Before each further attempt the seconds to wait: what was sent in, if anything, else twice
    the last time's, and never over the cap. The first value only starts it."""
    asked = yield 0.0
    for doubled in range(attempts - 1):
        asked = yield min(cap, base * 2**doubled if asked is None else asked)


@dataclass
class Retry:
    """How often and how long to wait; faults is a list of statuses to fail with first, for drills."""

    attempts: int = 4
    base: float = 1.0
    cap: float = 30.0
    timeout: float = 60.0
    sleep: Callable[[float], None] = time.sleep
    faults: list[int] = field(default_factory=list)
    retried: int = 0

    def get(self, url: str, handle: Callable):
        times = pauses(self.attempts, self.base, self.cap)
        next(times)
        while True:
            try:
                if self.faults:
                    raise Miss(f"status {(status := self.faults.pop(0))}, a drill", status in PASSING)
                return fetched(url, self.timeout, handle)
            except Miss as miss:
                if not miss.passing:
                    raise RetrievalError(f"{url}: {miss}") from miss
                self.retried += 1
                try:
                    pause = times.send(miss.asked)
                except StopIteration:
                    raise RetrievalError(f"{url}: {self.attempts} attempts failed, the last with {miss}") from miss
            self.sleep(pause)


def request_key(url: str) -> str:
    """What was asked for, whoever served it."""
    parts = urlsplit(url)
    return f"{parts.path}?{parts.query}"


def download(url: str, to: Place, retry: Retry) -> dict:
    """Streams to the driver, checks the length the server announced, then puts the whole file in place."""
    with tempfile.TemporaryDirectory(prefix="wayfold-") as folder:
        local = Path(folder) / "body"

        def handle(response):
            announced, digest = response.headers.get("Content-Length"), hashlib.sha256()
            with local.open("wb") as f:
                for chunk in iter(lambda: response.read(1 << 22), b""):
                    digest.update(chunk)
                    f.write(chunk)
            size = local.stat().st_size
            if announced is not None and int(announced) != size:
                raise ConnectionError(f"{size} of {announced} bytes")
            return {"content_length": announced, "bytes": size, "sha256": digest.hexdigest()}

        facts = retry.get(url, handle)
        to.put(local)
    return {"url": url, "file": to.name} | facts


def preserved(url: str, to: Place, retry: Retry) -> tuple[dict, bool]:
    """The file's manifest, and whether the kept copy still had its checksum and was used again."""
    at = to.parent / f"_{to.name}.manifest.json"
    manifest = at.read_json()
    if manifest and to.exists() and to.sha256() == manifest["sha256"]:
        return manifest, True
    manifest = download(url, to, retry)
    at.write_json(manifest)
    return manifest, False


def stored_page(folder: Place, number: int, body: bytes, rows: int) -> dict:
    name = f"page_{number:05d}.json"
    (folder / name).write(body)
    return {"file": name, "rows": rows, "sha256": hashlib.sha256(body).hexdigest()}


def pages(url_of: Callable[[int, int], str], size: int, folder: Place, retry: Retry, expected: int | None = None) -> dict:
    """Fetches pages until a short one; each is stored as it came."""
    out: list[dict] = []
    while not out or out[-1]["rows"] >= size:
        body = retry.get(url_of(len(out) * size, size), lambda r: r.read())
        out.append(stored_page(folder, len(out), body, len(json.loads(body))))
    return {"folder": folder.name, "pages": out, "received": sum(p["rows"] for p in out), "expected": expected}


def numbered_pages(url_of: Callable[[int], str], folder: Place, retry: Retry) -> dict:
    """Pages of {data, has_more, total_records}; a total that changes on the way ends it."""
    out: list[dict] = []
    totals, more = set(), True
    while more:
        body = retry.get(url_of(len(out) + 1), lambda r: r.read())
        page = json.loads(body)
        totals.add(page["total_records"])
        if len(totals) > 1:
            raise RetrievalError(f"the total changed between pages: {sorted(totals)}")
        out.append(stored_page(folder, len(out), body, len(page["data"])))
        more = page["has_more"]
    return {"folder": folder.name, "pages": out, "received": sum(p["rows"] for p in out), "expected": totals.pop()}


def intact(folder: Place, manifest: dict | None) -> bool:
    """Whether every stored page is there and as it was."""
    try:
        kept = folder / manifest["folder"]
        return all((f := kept / p["file"]).exists() and f.sha256() == p["sha256"] for p in manifest["pages"])
    except (TypeError, KeyError):
        return False


# ---- pages by tasks -------------------------------------------------------------------------


def over_http(url_of: Callable[[int], str], retry: Retry) -> Callable[[DataFrame], DataFrame]:
    """A fetch for `gathered`: tasks ask for the addresses of their pages, with their own retries."""

    def ask(batches):
        import pyarrow as pa

        for b in batches:
            for n in b.column(0).to_pylist():
                body = retry.get(url_of(n), lambda r: r.read())
                yield pa.RecordBatch.from_pydict({"number": [n], "body": [body.decode()]}, pa.schema([("number", pa.int64()), ("body", pa.string())]))

    return lambda numbers: numbers.mapInArrow(ask, "number long, body string")


def listed(size: int) -> dict[str, Column]:
    """What a page that is one array says: its rows, and that more follow unless it is a short one."""
    rows = F.json_array_length("body").cast("long")
    return {"rows": rows, "more": rows >= size, "total": F.lit(None).cast("long")}


def announcing() -> dict[str, Column]:
    """What a page of {data, has_more, total_records} says."""
    page = F.from_json("body", "data array<string>, has_more boolean, total_records long")
    return {"rows": F.when(page["data"].isNotNull(), F.size(page["data"])).cast("long"), "more": page["has_more"], "total": page["total_records"]}


#: Pages that a task fetches, about.
TASK_PAGES = 100


def gathered(spark: SparkSession, fetch: Callable[[DataFrame], DataFrame], says: dict[str, Column], folder: Place, expected: int | None = None, size: int | None = None) -> dict:
    """Fetches pages 0, 1, ... until one says that none follows; each is stored as it came.

    fetch: from a frame of number to number and body, by tasks. How many pages there are follows
    from the rows expected and a page's size, or else from the total and the rows of the first
    page, which is fetched alone; that many are fetched side by side. Where the last of these
    still says that more follow, they are fetched one by one. Pages after the first that says
    none follows aren't kept. A page that is missing or can't be read, and a total that differs
    between pages, end it. Bodies lie in rows of `folder`, checksums in a folder beside it.
    """
    waves: list[str] = []

    def wave(start: int, end: int):
        at = folder / f"from={start}"
        asked = fetch(spark.range(start, end, 1, -(-(end - start) // TASK_PAGES)).toDF("number"))
        asked.select("number", "body", *[c.alias(k) for k, c in says.items()], F.sha2("body", 256).alias("sha256")).write.parquet(str(at))
        waves.append(str(at))
        got = spark.read.parquet(str(at)).agg(F.count("rows").alias("n"), F.countDistinct("number").alias("different"), F.min("number").alias("low"), F.max("number").alias("high"), F.count("more").alias("told")).first()
        if (got.n, got.different, got.told, got.low, got.high) != (end - start, end - start, end - start, start, end - 1):
            raise RetrievalError(f"of pages {start} to {end - 1} only {got.n} could be read")
        kept = spark.read.parquet(*waves)
        return kept.agg(F.min(F.when(~F.col("more"), F.col("number"))).alias("last"), F.min("total").alias("total"), F.max(F.when(F.col("number") == 0, F.col("rows"))).alias("first")).first()

    end = 1 if expected is None or not size else expected // size + 1
    known = wave(0, end)
    while known.last is None:
        planned = -(-known.total // known.first) if end == 1 and known.total and known.first else 0
        known, end = wave(end, max(end + 1, planned)), max(end + 1, planned)
    kept = spark.read.parquet(*waves).where(F.col("number") <= known.last)
    told = kept.agg(F.min("total").alias("total"), F.max("total").alias("other"), F.sum("rows").alias("rows")).first()
    if told.total != told.other:
        raise RetrievalError(f"the total changed between pages: {[told.total, told.other]}")
    kept.select("number", "rows", "sha256").write.parquet(str(folder.parent / f"{folder.name}-checksums"))
    return {"folder": folder.name, "waves": [w.rsplit("/", 1)[1] for w in waves], "pages": known.last + 1, "received": told.rows, "expected": told.total if expected is None else expected}


def bodies(spark: SparkSession, folder: Place, manifest: dict) -> DataFrame:
    """number and body of the pages that a manifest of `gathered` tells of."""
    at = [str(folder / manifest["folder"] / w) for w in manifest["waves"]]
    return spark.read.parquet(*at).where(F.col("number") < manifest["pages"]).select("number", "body")


def unharmed(spark: SparkSession, folder: Place, manifest: dict) -> bool:
    """Whether every gathered page is there and as it was."""
    known = spark.read.parquet(str(folder / f"{manifest['folder']}-checksums")).select("number", F.col("sha256").alias("_known"))
    found = bodies(spark, folder, manifest).select("number", F.sha2("body", 256).alias("_found"))
    r = known.join(found, "number", "full").agg(F.count("*").alias("n"), F.count_if(F.col("_known") == F.col("_found")).alias("same")).first()
    return r.n == r.same == manifest["pages"]
