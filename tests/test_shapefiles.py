"""Shapefiles in parts, against the records and rows they were made of."""

import io
import struct
import zipfile

import numpy as np
import pytest

from wayfold.sources import shapefiles


def square(a, b):
    return [(a, a), (a, b), (b, b), (b, a), (a, a)]


def shapefile(records, rows, deleted=(), index=False, order=None, numbers=None, packed=False):
    """Records of (kind, rings) and rows of (id, name) as the bytes of a zip, by the format's description."""
    bodies = []
    for kind, rings in records:
        pts = [p for r in rings for p in r]
        body = struct.pack("<i", kind)
        if kind:
            first = [sum(len(r) for r in rings[:i]) for i in range(len(rings))]
            body += struct.pack("<4d2i", 0, 0, 0, 0, len(rings), len(pts)) + struct.pack(f"<{len(first)}i", *first) + b"".join(struct.pack("<2d", *p) for p in pts)
            if kind in (15, 25):
                body += struct.pack(f"<{2 + len(pts)}d", *[0.0] * (2 + len(pts)))
        bodies.append(body)
    shp, places = b"", {}
    for k in order or range(len(bodies)):
        places[k] = (100 + len(shp), len(bodies[k]))
        shp += struct.pack(">ii", numbers[k] if numbers else k + 1, len(bodies[k]) // 2) + bodies[k]
    shp = struct.pack(">i20x", 9994) + struct.pack(">i", (100 + len(shp)) // 2) + b"\0" * 72 + shp + b"past the end"
    shx = bytes(100) + b"".join(struct.pack(">ii", places[k][0] // 2, places[k][1] // 2) for k in range(len(bodies)))
    widths = (("LocationID", b"N", 12), ("zone", b"C", 9), ("borough", b"C", 5))
    fields = b"".join(n.encode().ljust(11, b"\0") + t + b"\0" * 4 + bytes([w]) + b"\0" * 15 for n, t, w in widths)
    dbf = b"\3\0\0\0" + struct.pack("<IHH", len(rows), 32 + len(fields) + 1, 27) + b"\0" * 20 + fields + b"\r"
    for k, (i, name) in enumerate(rows):
        dbf += (b"*" if k in deleted else b" ") + str(i).rjust(12).encode() + name.encode().ljust(9)[:9] + b"B".ljust(5)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED if packed else zipfile.ZIP_STORED) as z:
        z.writestr("a/Z.SHP", shp)
        z.writestr("a/Z.dbf", dbf + b"\x1a")
        if index:
            z.writestr("a/Z.shx", shx)
    return out.getvalue()


def rows_of(data, columns=None):
    return [r for b in shapefiles.whole(data, columns or list(shapefiles.COLUMNS)) for r in b.to_pylist()]


def test_records():
    two = [square(0.0, 9.0), square(2.0, 3.0)]
    data = shapefile([(5, two), (0, []), (15, [square(1.0, 2.0)]), (25, two[:1])], [("1", "Né"), ("2.000", ""), ("3", "C"), ("4", "D")], deleted=(3,))
    got = rows_of(data)
    assert [(r["zone_id"], r["zone"], r["borough"], [len(x) for x in r["rings"]]) for r in got] == [(1, "Né", "B", [5, 5]), (2, "", "B", []), (3, "C", "B", [5])]
    assert [(p["x"], p["y"]) for p in got[0]["rings"][1]] == two[1]
    with pytest.raises(ValueError, match="no polygon"):
        rows_of(shapefile([(1, two)], [("1", "a")]))
    with pytest.raises(ValueError, match="belong together"):
        rows_of(shapefile([(5, two)], [("1", "a"), ("2", "b")]))
    with pytest.raises(ValueError, match="belong"):
        rows_of(shapefile([(5, two), (5, two)], [("1", "a"), ("2", "b")], index=True, numbers=[2, 1]))
    assert rows_of(shapefile([], [])) == []


def test_ranges():
    index = np.array([(0, 92)] * 10 + [(0, 5_000)] + [(0, 92)] * 3, np.int64)
    got = shapefiles.ranges(index, 300)
    assert got[0] == (0, 3) and (10, 11) in got
    assert [k for a, e in got for k in range(a, e)] == list(range(14))
    assert shapefiles.ranges(index[:0]) == []


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("index", [False, True])
def test_parts(spark, tmp_path, packed, index):
    rng = np.random.default_rng(5)
    n = 300
    records = [(5, [square(float(k), float(k + j + 1)) for j in range(rng.integers(1, 6))]) if k % 11 else (0, []) for k in range(n)]
    rows = [(k + 1, f"z{k}") for k in range(n)]
    data = shapefile(records, rows, deleted=(0, 7, 299), index=index, order=rng.permutation(n).tolist(), packed=packed)
    (tmp_path / "b b%20.zip").write_bytes(data)
    df = shapefiles.read(spark, str(tmp_path), part_bytes=9_000)
    assert df.rdd.getNumPartitions() > 5
    key = lambda r: r[0]
    got = sorted(((r.zone_id, r.zone, r.borough, [[tuple(p) for p in ring] for ring in r.rings]) for r in df.collect()), key=key)
    assert got == [(k + 1, f"z{k}", "B", rings) for k, (_, rings) in enumerate(records) if k not in (0, 7, 299)]
    few = shapefiles.read(spark, str(tmp_path), ["zone", "zone_id"], part_bytes=9_000)
    assert few.columns == ["zone", "zone_id"] and sorted(few.collect(), key=lambda r: r.zone_id) == [(g[1], g[0]) for g in got]


def test_small_batches_of_points(monkeypatch):
    data = shapefile([(5, [square(0.0, float(k))]) for k in range(1, 8)], [(k, "z") for k in range(7)], deleted=(2,))
    monkeypatch.setattr(shapefiles, "BATCH_POINTS", 10)
    sizes = [b.num_rows for b in shapefiles.whole(data, list(shapefiles.COLUMNS))]
    assert sizes == [2, 2, 2] and [r["zone_id"] for r in rows_of(data)] == [0, 1, 3, 4, 5, 6]


def test_several_files_and_none_of_a_kind_arrow_knows(spark, tmp_path, monkeypatch):
    for k in range(3):
        (tmp_path / f"{k}.zip").write_bytes(shapefile([(5, [square(0.0, 1.0)])] * k, [(10 * k + i, "z") for i in range(k)], index=k == 2))
    ids = lambda df: sorted(r.zone_id for r in df.collect())
    assert ids(shapefiles.read(spark, str(tmp_path / "*.zip"))) == [10, 20, 21]
    assert shapefiles.read(spark, str(tmp_path / "0.zip")).count() == 0

    def unknown(uri):
        raise OSError(uri)

    monkeypatch.setattr(shapefiles, "file_system", unknown)
    assert ids(shapefiles.read(spark, str(tmp_path / "*.zip"))) == [10, 20, 21]
