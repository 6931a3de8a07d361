"""Polygons of zipped shapefiles as a data source: a file is read in parts by ranges of its records.

Planning reads the index (.shx; without one, the records' own headers) and the attributes'
header, and cuts the records where their bytes add up to a part. A task opens the archive, goes
to its records and its rows of attributes, and turns them into Arrow batches of bounded size.
Members that are stored as they are are entered at once; of compressed ones a task unpacks, and
drops, what comes before its part.

Defined results: record n belongs to row n of the attributes, whatever order the records lie in;
a deleted row and its record are left out; a null record has no rings; records that are no
polygons and files whose records and rows don't pair up raise.
"""

from __future__ import annotations

import io
import json
import zipfile
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed values of the shapefile and dBASE formats: kinds of polygon records (plain, with heights,
#: with measures), which all begin alike; field descriptors; the end of these; a deleted row's mark.
POLYGON_KINDS = {5, 15, 25}
DBF_HEAD = np.dtype([("kind", "u1"), ("date", "V3"), ("rows", "<u4"), ("start", "<u2"), ("width", "<u2")])
DBF_FIELD = np.dtype([("name", "S11"), ("kind", "S1"), ("address", "V4"), ("size", "u1"), ("rest", "V15")])
DBF_END, DBF_DELETED = 0x0D, b"*"
SHP_HEADER = 100

#: Bytes of records of a part, and records, at most (one record may be larger); points of a batch, about.
PART_BYTES, PART_RECORDS, BATCH_POINTS = 32 << 20, 100_000, 500_000

COLUMNS = {"zone_id": "int", "zone": "string", "borough": "string", "rings": "array<array<struct<x: double, y: double>>>"}
POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
TYPES = {"zone_id": pa.int32(), "zone": pa.string(), "borough": pa.string(), "rings": pa.list_(pa.list_(POINT))}


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """What opens an address on any machine; raises where Arrow knows no such file system."""
    path = uri.removeprefix("file:")
    if path.startswith("/"):
        return fs.LocalFileSystem(), "/" + path.lstrip("/")  # as Spark names it, which encodes nothing
    return fs.FileSystem.from_uri(uri)


class Archive:
    """A zipped shapefile that is open: where its records lie, and some of its rows and rings."""

    def __init__(self, file):
        self.zip = zipfile.ZipFile(file)
        self.members = {name.rpartition(".")[2].lower(): name for name in self.zip.namelist()}
        with self.zip.open(self.members["dbf"]) as f:
            head = f.read(32)
            self.rows, self.start, width = (int(np.frombuffer(head, DBF_HEAD, 1)[0][k]) for k in ("rows", "start", "width"))
            described = f.read(self.start - 32).partition(bytes([DBF_END]))[0]
        fields = np.frombuffer(described, DBF_FIELD, len(described) // DBF_FIELD.itemsize)
        self.names = [bytes(f["name"]).partition(b"\0")[0].decode() for f in fields]
        sizes = [1, *(int(f["size"]) for f in fields)]  # the first byte marks deleted rows
        offsets = np.cumsum([0, *sizes[:-1]]).tolist()
        self.layout = np.dtype({"names": ["_deleted", *self.names], "formats": [f"S{n}" for n in sizes], "offsets": offsets, "itemsize": width})

    def index(self) -> np.ndarray:
        """Start and bytes of the content of records 1 to n, which are as many as rows."""
        found = self._indexed() if "shx" in self.members else self._walked()
        if len(found) != self.rows:
            raise ValueError(f"{len(found)} records and {self.rows} rows of attributes don't belong together")
        return found

    def _indexed(self) -> np.ndarray:
        data = self.zip.read(self.members["shx"])[SHP_HEADER:]
        return np.frombuffer(data, ">i4", len(data) // 8 * 2).reshape(-1, 2).astype(np.int64) * 2 + [8, 0]

    def _walked(self) -> np.ndarray:
        at, found = SHP_HEADER, []
        with self.zip.open(self.members["shp"]) as f:
            end = 2 * int.from_bytes(f.read(28)[24:], "big")  # in words of two bytes, like all lengths
            while at + 8 <= end:
                f.seek(at)
                head = f.read(8)
                if len(head) < 8:
                    break
                number, words = np.frombuffer(head, ">i4").tolist()
                found.append((number, at + 8, 2 * words))
                at += 8 + 2 * words
        found.sort()
        if [n for n, _, _ in found] != list(range(1, len(found) + 1)):
            raise ValueError("records and rows of attributes don't belong together: numbers have gaps or repeat")
        return np.array([x[1:] for x in found], np.int64).reshape(-1, 2)

    def attributes(self, first: int, n: int) -> tuple[np.ndarray, dict[str, list[str]]]:
        """Which of n rows are kept, and their values as text."""
        with self.zip.open(self.members["dbf"]) as f:
            f.seek(self.start + first * self.layout.itemsize)
            table = np.frombuffer(f.read(n * self.layout.itemsize), self.layout, n)
        kept = table["_deleted"] != DBF_DELETED
        return kept, {c: np.char.strip(np.char.decode(table[c][kept], "utf-8", "replace")).tolist() for c in self.names}

    def contents(self, first: int, places: np.ndarray):
        """The contents of records, whose headers must name them."""
        with self.zip.open(self.members["shp"]) as f:
            for k, (at, size) in enumerate(places.tolist(), first + 1):
                f.seek(at - 8)
                data = f.read(8 + size)
                if len(data) < 8 + size or np.frombuffer(data, ">i4", 1)[0] != k:
                    raise ValueError(f"the index doesn't belong to the records: no record {k} at {at - 8}")
                yield memoryview(data)[8:]


def rings_of(content: memoryview) -> tuple[np.ndarray, np.ndarray]:
    """Points of each ring of a polygon's record, and all points; a null record has none."""
    kind = int(np.frombuffer(content, "<i4", 1)[0])
    if kind == 0:
        return np.empty(0, np.int64), np.empty((0, 2))
    if kind not in POLYGON_KINDS:
        raise ValueError(f"a record of kind {kind} is no polygon")
    rings, total = np.frombuffer(content, "<i4", 2, 36).tolist()
    starts = np.frombuffer(content, "<i4", rings, 44)
    points = np.frombuffer(content, "<f8", 2 * total, 44 + starts.nbytes).reshape(-1, 2)
    return np.diff(starts, append=total).astype(np.int64), points


def nested(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """Rings of several records as one Arrow column."""
    offsets = lambda lengths: pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    points = np.concatenate([np.empty((0, 2)), *(p for _, p in found)])
    sizes = np.concatenate([np.empty(0, np.int64), *(n for n, _ in found)])
    pairs = pa.StructArray.from_arrays([pa.array(points[:, k].copy()) for k in (0, 1)], fields=list(POINT))
    return pa.ListArray.from_arrays(offsets([len(n) for n, _ in found]), pa.ListArray.from_arrays(offsets(sizes), pairs))


def batches(archive: Archive, first: int, places: np.ndarray, columns: list[str]):
    """The polygons of some records, in Arrow batches of about BATCH_POINTS points."""
    kept, text = archive.attributes(first, len(places))
    of = {"zone_id": [int(float(v)) for v in text["LocationID"]] if "zone_id" in columns else [], "zone": text["zone"], "borough": text["borough"]}

    def batch(a: int, found: list, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([nested(found).cast(TYPES[c]) if c == "rings" else pa.array(of[c][a : a + n], TYPES[c]) for c in columns], names=columns)

    if "rings" not in columns:
        yield batch(0, [], int(kept.sum()))
        return
    done, held, points = 0, [], 0
    for stays, content in zip(kept.tolist(), archive.contents(first, places), strict=True):
        if stays:
            held.append(rings_of(content))
            points += len(held[-1][1])
        if points >= BATCH_POINTS:
            yield batch(done, held, len(held))
            done, held, points = done + len(held), [], 0
    if held:
        yield batch(done, held, len(held))


def ranges(index: np.ndarray, part_bytes: int = PART_BYTES) -> list[tuple[int, int]]:
    """Records from, to (exclusive) of each part."""
    taken = np.concatenate([[0], np.cumsum(index[:, 1] + 8)])
    out, a = [], 0
    while a < len(index):
        e = int(np.searchsorted(taken, taken[a] + part_bytes, "right")) - 1
        e = min(max(e, a + 1), a + PART_RECORDS)
        out.append((a, e))
        a = e
    return out


@dataclass
class Records(InputPartition):
    """Some records in a row of a file, by the places of their contents."""

    uri: str
    first: int
    places: np.ndarray


class Reader(DataSourceReader):
    def __init__(self, files: list[str], columns: list[str], part_bytes: int):
        self.files, self.columns, self.part_bytes = files, columns, part_bytes

    @contextmanager
    def opened(self, uri: str):
        system, path = file_system(uri)
        with system.open_input_file(path) as f:
            yield Archive(f)

    def partitions(self):
        out = []
        for uri in self.files:
            with self.opened(uri) as archive:
                index = archive.index()
            out += [Records(uri, a, index[a:e]) for a, e in ranges(index, self.part_bytes)]
        return out

    def read(self, partition):
        if partition is None:  # no records at all
            return
        with self.opened(partition.uri) as archive:
            yield from batches(archive, partition.first, partition.places, self.columns)


class ZippedShapes(DataSource):
    """Options: files (a list as JSON), columns (likewise), part_bytes."""

    @classmethod
    def name(cls):
        return "zipped_shapes"

    def schema(self):
        return ", ".join(f"{c} {COLUMNS[c]}" for c in json.loads(self.options["columns"]))

    def reader(self, schema):
        return Reader(json.loads(self.options["files"]), json.loads(self.options["columns"]), int(self.options["part_bytes"]))


def whole(data: bytes, columns: list[str]):
    """All polygons of an archive that was read as one piece."""
    archive = Archive(io.BytesIO(data))
    index = archive.index()
    for a, e in ranges(index):
        yield from batches(archive, a, index[a:e], columns)


def read(spark: SparkSession, path: str, columns: list[str] | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """Polygons of zipped shapefiles: a file, a folder or a pattern.

    Without rings among the columns, no record is read. Where Arrow can't open the file system,
    Spark reads each file as one piece, in a task of its own.
    """
    columns = list(COLUMNS) if columns is None else columns
    listed = spark.read.format("binaryFile").load(path)
    files = sorted(r.path for r in listed.select("path").collect())  # names only: contents aren't read
    try:
        for uri in files[:1]:
            file_system(uri)
    except (pa.ArrowException, ImportError, OSError):
        def parse(pieces):
            for b in pieces:
                for data in b.column(0):
                    yield from whole(data.as_py(), columns)

        return listed.select("content").mapInArrow(parse, ", ".join(f"{c} {COLUMNS[c]}" for c in columns))
    spark.dataSource.register(ZippedShapes)
    options = {"files": json.dumps(files), "columns": json.dumps(columns), "part_bytes": str(part_bytes)}
    return spark.read.format("zipped_shapes").options(**options).load()
