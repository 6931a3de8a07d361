"""Exact top-k search by inner product with vector-approximation files.

Components become integers floor(scale * x). One pass writes the approximation file: blocks
of vectors with an 8-bit cell for each component next to the exact ones. A search meets
groups of blocks with groups of queries, both of bounded size: one single-precision product
of the queries with a block's cells bounds every score from above, exact vectors are read
in the order of these bounds, and a block is done for a query once its kth best exact score
is above every bound that is left. So the result is exact. Groups pass on k rows a query. How
much is read depends on how many blocks a group has: of one group of 2,000 vectors (the tests'
sf0.1) 1.9 % of all (query, vector) pairs, of one of 40,000 vectors 0.2 %.

Queries and candidates are rows of tables from start to end; the driver sees two counts.

Defined results: vectors that are null or hold nulls, NaN or infinities, and rows with a
null id, take no part. Vectors of unequal length are compared as if padded with zeros.
Only the query's own row is no candidate, others with its id are. Repeated rows all count,
as queries too; equal scores go to the smaller id. Fewer than k candidates give fewer rows.
Scores that leave 64 bits are held at its ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, ship, stored

CELLS = 255
#: Vectors of a block; the best bounds of a block that are looked at together.
BLOCK, STEP = 256, 8
#: Bytes of exact vectors in a group of queries, and in a group of candidates, about.
QUERY_BYTES, GROUP_BYTES = 8 << 20, 64 << 20
FAR_SCORE = np.iinfo(np.int64).min


def integers(column, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their integer vectors (as float64 where beyond 2**31)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    if not n:
        return np.empty(0, np.int64), np.empty((0, 0))
    flat, starts = column.flatten(), column.value_lengths()
    lengths = np.asarray(pc.fill_null(starts, 0)).astype(np.int64)
    ok = np.asarray(column.is_valid())
    values = np.asarray(pc.fill_null(flat.cast(pa.float64()), float("nan")), dtype=np.float64)
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ok &= (bad[ends] - bad[ends - lengths]) == 0
    at = np.nonzero(ok)[0]
    width = int(lengths[at].max()) if len(at) else 0
    out = np.zeros((len(at), width))
    if width:
        if (lengths == width).all():
            out[:] = np.floor(scale * values.reshape(n, width)[at])
        else:
            for k, i in enumerate(at):
                out[k, : lengths[i]] = np.floor(scale * values[ends[i] - lengths[i] : ends[i]])
    return at, out


def padded(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in whole numbers."""
    top = max(float(np.abs(q).max(initial=0)), 1.0) * max(float(np.abs(v).max(initial=0)), 1.0)
    if top * max(q.shape[-1], 1) < 2.0**53:
        return np.einsum("...d,...d->...", q, v).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    total = (whole(q) * whole(v)).sum(axis=-1)
    return np.clip(total, -(2**63), 2**63 - 1).astype(np.int64)


class Best:
    """The k best of each query so far; empty places have the lowest score and id -1."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), FAR_SCORE, np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        self.full = np.zeros((n, k), bool)

    def kth(self) -> np.ndarray:
        return np.where(self.full[:, -1], self.score[:, -1].astype(np.float64), -np.inf)

    def add(self, rows, score, ids, valid) -> None:
        s = np.concatenate([self.score[rows], np.where(valid, score, FAR_SCORE)], 1)
        i = np.concatenate([self.id[rows], ids], 1)
        f = np.concatenate([self.full[rows], valid], 1)
        down = np.where(s == FAR_SCORE, np.iinfo(np.int64).max, -np.maximum(s, FAR_SCORE + 1))
        order = np.lexsort((i, down, ~f), axis=-1)[:, : self.k]
        self.score[rows], self.id[rows], self.full[rows] = (np.take_along_axis(x, order, 1) for x in (s, i, f))


def cells_of(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each component's lowest value, the width of its cells, and the cells of a block."""
    low, high = v.min(axis=0), v.max(axis=0)
    step = np.maximum((high - low) / CELLS, 1.0)
    return low, step, np.minimum(np.floor((v - low) / step), CELLS).astype(np.uint8)


def upper_bounds(q: np.ndarray, low: np.ndarray, step: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """No score of a query with a vector of the block is above its bound."""
    scaled = q * step
    top = np.abs(scaled).max(initial=0)
    shrink = 1.0 if top < 1e30 else 1e30 / top  # single precision must hold it
    rough = (scaled * shrink).astype(np.float32) @ cells.T.astype(np.float32)
    error = (q.shape[1] + 4) * 2.0**-22 * CELLS * np.abs(scaled).sum(axis=1)  # of rounding, with room to spare
    error += 1e-9 * (np.abs(q) @ (np.abs(low) + CELLS * step)) + 1e-6
    return rough.astype(np.float64) / shrink + (q @ low + np.maximum(scaled, 0).sum(axis=1) + error)[:, None]


def scan_block(best: Best, quid: np.ndarray, q: np.ndarray, uid: np.ndarray, ids: np.ndarray, v: np.ndarray, approximation: tuple | None = None) -> int:
    """One block of candidates against some queries; returns the exact vectors read."""
    upper = upper_bounds(q, *(approximation or cells_of(v)))
    upper[quid[:, None] == uid[None, :]] = -np.inf
    read, rows = 0, np.arange(len(q))
    floor = lambda rows: np.maximum(best.kth()[rows], -np.finfo(np.float64).max)
    while True:
        rows = rows[upper[rows].max(axis=1, initial=-np.inf) >= floor(rows)]
        if not len(rows):
            return read
        m = min(len(ids), STEP if best.full[rows, -1].all() else max(STEP, best.k))
        first = np.argpartition(-upper[rows], m - 1, axis=1)[:, :m]
        asked = np.take_along_axis(upper[rows], first, 1) >= floor(rows)[:, None]  # no other vector is read
        at, place = np.nonzero(asked)
        score = np.full(asked.shape, FAR_SCORE, np.int64)
        score[at, place] = exact(q[rows[at]], v[first[at, place]])
        best.add(rows, score, ids[first], asked)
        read += len(at)
        upper[rows[:, None], first] = -np.inf


FILE = "uid long, n int, width int, ids binary, asks binary, low binary, step binary, cells binary, vectors binary"
ROWS = pa.schema([("uid", pa.int64()), ("n", pa.int32()), ("width", pa.int32())] + [(k, pa.binary()) for k in ("ids", "asks", "low", "step", "cells", "vectors")])
GRID = "g int, h int, kind int, " + FILE
GRID_COLS = ["g", "h", "kind", *ROWS.names]


def approximate(scale: float):
    """Rows (id, vector, asks) to rows of the approximation file; uid numbers all vectors."""

    def run(batches):
        at = TaskContext.get().partitionId() << 40
        held: list[tuple] = []

        def block():
            nonlocal at, held
            width = max(v.shape[1] for _, _, v in held)
            v = np.concatenate([padded(v, width) for _, _, v in held])
            low, step, cells = cells_of(v)
            binary = [np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), low, step, cells, v]
            row = {"uid": [at], "n": [len(v)], "width": [width]} | {k: [x.tobytes()] for k, x in zip(ROWS.names[3:], binary, strict=True)}
            at, held = at + len(v), []
            return pa.RecordBatch.from_pydict(row, schema=ROWS)

        for b in batches:
            b = b.filter(b.column(0).is_valid())
            rows, v = integers(b.column(1), scale)
            ids = np.asarray(b.column(0).take(pa.array(rows)), dtype=np.int64)
            asks = np.asarray(pc.fill_null(b.column(2).take(pa.array(rows)), False)).astype(np.uint8)
            a = 0
            while a < len(ids):
                e = min(len(ids), a + BLOCK - sum(len(h[0]) for h in held))
                held.append((ids[a:e], asks[a:e], v[a:e]))
                a = e
                if sum(len(h[0]) for h in held) >= BLOCK:
                    yield block()
        if held:
            yield block()

    return run


def asking(batches):
    """Blocks of the file with only the vectors that ask; their uids are in cells."""
    for b in batches:
        for row in b.to_pylist():
            at = np.nonzero(np.frombuffer(row["asks"], np.uint8))[0]
            if len(at):
                v = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], row["width"])[at]
                ids = np.frombuffer(row["ids"], np.int64)[at]
                out = row | {"n": len(at), "ids": ids.tobytes(), "asks": b"", "low": b"", "step": b"", "cells": (row["uid"] + at).astype(np.int64).tobytes(), "vectors": v.tobytes()}
                yield pa.RecordBatch.from_pydict({k: [x] for k, x in out.items()}, schema=ROWS)


def search(k: int):
    """Rows of GRID, sorted by g, h and kind: a group's queries (kind 0), then its candidates."""

    def run(batches):
        group, held, best, quid, qid, q = None, [], None, None, None, None

        def found():
            if best is None:
                return
            row, place = np.nonzero(best.full)
            yield pa.RecordBatch.from_pydict({
                "q": pa.array(quid[row], pa.int64()), "query_id": pa.array(qid[row], pa.int64()), "vec_id": pa.array(best.id[row, place], pa.int64()),
                "score": pa.array(best.score[row, place], pa.int64()),
            })

        for b in batches:
            for row in b.to_pylist():
                if (row["g"], row["h"]) != group:
                    yield from found()
                    group, held, best = (row["g"], row["h"]), [], None
                v = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], row["width"])
                ids = np.frombuffer(row["ids"], np.int64)
                if row["kind"] == 0:
                    held.append((np.frombuffer(row["cells"], np.int64), ids, v))
                    continue
                if held:
                    width = max(x.shape[1] for _, _, x in held)
                    quid, qid, q = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]), np.concatenate([padded(x[2], width) for x in held])
                    held, best = [], Best(len(quid), k)
                if best is None:
                    continue  # no queries here
                width, uid = max(q.shape[1], v.shape[1]), row["uid"] + np.arange(row["n"])
                low, step = (np.frombuffer(row[x], np.float64) for x in ("low", "step"))
                cells = np.frombuffer(row["cells"], np.uint8).reshape(row["n"], row["width"])
                more = width - row["width"]
                near = (np.pad(low, (0, more)), np.pad(step, (0, more)), np.pad(cells, ((0, 0), (0, more))))
                for a in range(0, len(quid), 512):
                    part = Best.__new__(Best)
                    part.k, part.score, part.id, part.full = k, best.score[a : a + 512], best.id[a : a + 512], best.full[a : a + 512]
                    scan_block(part, quid[a : a + 512], padded(q[a : a + 512], width), uid, ids, padded(v, width), near)
        yield from found()

    return run


def top_k(rows: DataFrame, asks: Column, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row where asks holds.

    asks: a condition on the id column, under its name.
    """
    ship(rows.sparkSession)
    picked = pick(rows, id_col, vec_col)
    file = stored(picked.withColumn("_asks", asks).mapInArrow(approximate(scale), FILE), "vector-file")
    queries = stored(file.mapInArrow(asking, FILE), "vector-queries")
    sizes = lambda df: df.agg(F.coalesce(F.sum(F.length("vectors")), F.lit(0)).alias("bytes"), F.count("*").alias("blocks")).first()
    given, asked = sizes(file), sizes(queries)
    # groups of bounded size, and no fewer than the cluster works on at once
    gs = max(1, -(-given.bytes // GROUP_BYTES), min(given.blocks, rows.sparkSession.sparkContext.defaultParallelism))
    hs = max(1, -(-asked.bytes // QUERY_BYTES))
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    own = lambda n, name: F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int").alias(name)
    left = queries.select(own(hs, "h"), F.lit(0).alias("kind"), *ROWS.names).select("*", every(gs, "g")).select(GRID_COLS)
    right = file.select(own(gs, "g"), F.lit(1).alias("kind"), *ROWS.names).select("*", every(hs, "h")).select(GRID_COLS)
    grid = left.union(right).repartition("g", "h").sortWithinPartitions("g", "h", "kind")
    found = grid.mapInArrow(search(k), "q long, query_id long, vec_id long, score long")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
