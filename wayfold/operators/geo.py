"""Points in polygons by the even-odd rule: each polygon is covered by cells of its own sizes."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import kept_small


def edges(polygons: DataFrame) -> DataFrame:
    """zone_id, the polygon's bounds and xa, ya, xb, yb for each side of each ring.

    polygons: zone_id, rings array<array<struct<x, y>>>. A point joins the one before it,
    the first the last. Holes need no mark: what counts is the parity of all crossings."""
    p = polygons.withColumn("pts", F.flatten("rings"))
    lo = lambda c: F.array_min(F.transform("pts", lambda q: q[c]))
    hi = lambda c: F.array_max(F.transform("pts", lambda q: q[c]))
    p = p.select("zone_id", lo("x").alias("xmin"), hi("x").alias("xmax"), lo("y").alias("ymin"), hi("y").alias("ymax"), F.explode("rings").alias("ring"))
    p = p.select("*", F.posexplode("ring").alias("i", "a"))
    last = F.element_at("ring", -1)
    before = F.when(F.col("i") == 0, last).otherwise(F.element_at("ring", F.greatest(F.col("i"), F.lit(1))))
    return p.select("zone_id", "xmin", "xmax", "ymin", "ymax", F.col("a.x").alias("xa"), F.col("a.y").alias("ya"), before["x"].alias("xb"), before["y"].alias("yb"))


#: Sides and cells of zones that are sent along to every task at most.
BROADCAST_SIDES = 2_000_000
#: A zone's cells, about, and how often its first ones are quartered at most.
CELLS, DEEP = 256, 12


def crosses(x, y, xa, ya, xb, yb):
    """Whether the ray from (x, y) to the right crosses a side; numbers or arrays."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return ((ya > y) != (yb > y)) & (x < xa + (xb - xa) * (y - ya) / (yb - ya))


def cover(sides: pd.DataFrame) -> pd.DataFrame:
    """One zone's cells: squares of a grid whose side is 2 ** level, found by quartering.

    The first cells are as large as the zone. A cell that no side touches lies wholly inside or
    outside; those inside are kept, marked inner. Others are quartered, smallest steps last, as
    long as the zone has fewer than CELLS; what is left is its border.
    """
    xa, ya, xb, yb = (sides[c].to_numpy(float) for c in ("xa", "ya", "xb", "yb"))
    x0, x1, y0, y1 = xa.min(), xa.max(), ya.min(), ya.max()
    far = max(abs(v) for v in (x0, x1, y0, y1))
    level = math.ceil(math.log2(max(x1 - x0, y1 - y0, far * 2.0**-40, 2.0**-60)))
    lo_x, hi_x, lo_y, hi_y = np.minimum(xa, xb), np.maximum(xa, xb), np.minimum(ya, yb), np.maximum(ya, yb)

    def touching(cx: int, cy: int, near: np.ndarray) -> np.ndarray:
        """Which of the sides may touch the cell: none that isn't found lies within rounding of it."""
        size = math.ldexp(1.0, level)
        a, b, c, d = cx * size, (cx + 1) * size, cy * size, (cy + 1) * size
        slack = 1e-9 * size + 1e-12 * far
        near = near[(lo_x[near] <= b + slack) & (hi_x[near] >= a - slack) & (lo_y[near] <= d + slack) & (hi_y[near] >= c - slack)]
        if not len(near):
            return near
        ex, ey = xb[near] - xa[near], yb[near] - ya[near]
        side = np.array([ex * (v - ya[near]) - ey * (u - xa[near]) for u in (a, b) for v in (c, d)])
        rough = slack * (np.abs(ex) + np.abs(ey))
        return near[(side.min(axis=0) <= rough) & (side.max(axis=0) >= -rough)]

    every, out = np.arange(len(xa)), []
    size = math.ldexp(1.0, level)
    cells = [(cx, cy, every) for cx in range(math.floor(x0 / size), math.floor(x1 / size) + 1) for cy in range(math.floor(y0 / size), math.floor(y1 / size) + 1)]
    for depth in range(DEEP + 1):
        border = []
        for cx, cy, near in cells:
            near = touching(cx, cy, near)
            if len(near):
                border.append((cx, cy, near))
            elif crosses((cx + 0.5) * math.ldexp(1.0, level), (cy + 0.5) * math.ldexp(1.0, level), xa, ya, xb, yb).sum() % 2:
                out.append((level, cx, cy, True))
        if depth == DEEP or len(out) + 4 * len(border) > CELLS:
            out += [(level, cx, cy, False) for cx, cy, _ in border]
            break
        level -= 1
        cells = [(2 * cx + i, 2 * cy + j, near) for cx, cy, near in border for i in (0, 1) for j in (0, 1)]
    return pd.DataFrame([(sides["zone_id"].iloc[0], *c) for c in out], columns=["zone_id", "level", "cx", "cy", "inner"])


def covering(sides: DataFrame) -> DataFrame:
    """zone_id, level, cx, cy, inner: every zone's cells, each found from its own sides alone."""
    kind = dict(sides.dtypes)["zone_id"]
    return sides.select("zone_id", "xa", "ya", "xb", "yb").groupBy("zone_id").applyInPandas(cover, f"zone_id {kind}, level int, cx long, cy long, inner boolean")


def looked_up(points: DataFrame, polygons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Different places with the zones whose cells hold them (x, y, zone_id, inner), and the sides.

    Cells of a zone don't overlap and each level is a grid, so a place has at most one cell of a
    zone, found by an equal join on level and cell."""
    e = edges(polygons)
    held = kept_small(covering(e))
    known = held.select("level").distinct().collect()  # a row a power of two
    there = points.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where("x is not null and y is not null and not isnan(x) and not isnan(y)").distinct()
    at = lambda level: F.struct(F.lit(level).alias("level"), *[F.floor(F.col(c) / math.ldexp(1.0, level)).alias(f"c{c}") for c in ("x", "y")])
    levels = F.array(*[at(r.level) for r in sorted(known)]) if known else F.array().cast("array<struct<level:int,cx:bigint,cy:bigint>>")
    near = there.select("x", "y", F.explode(levels).alias("c")).select("x", "y", "c.*").join(held, ["level", "cx", "cy"])
    return near.select("x", "y", "zone_id", "inner"), e


def locate(points: DataFrame, polygons: DataFrame) -> DataFrame:
    """All rows and columns of points with zone_id (the lowest that holds the point) and ambiguous
    (several do).

    points: any columns, x and y among them. Each different place is looked up once, whoever is
    there: a place in an inner cell of a zone lies in it; only places in border cells meet the
    zone's sides. Points without coordinates or zone keep a null."""
    near, e = looked_up(points, polygons)
    few = e.count() <= BROADCAST_SIDES
    sides = e.select(F.col("zone_id").alias("z"), "xa", "ya", "xb", "yb")
    at = F.col("xa") + F.try_divide((F.col("xb") - F.col("xa")) * (F.col("y") - F.col("ya")), F.col("yb") - F.col("ya"))
    above = lambda c: F.col(c) > F.col("y")
    met = near.where("not inner").join(F.broadcast(sides) if few else sides, F.col("zone_id") == F.col("z"))
    crossed = met.where((above("ya") != above("yb")) & (F.col("x") < at))
    inside = crossed.groupBy("x", "y", "zone_id").agg(F.count("*").alias("n")).where("n % 2 = 1")
    inside = inside.select("x", "y", "zone_id").unionByName(near.where("inner").select("x", "y", "zone_id"))
    hits = inside.groupBy(F.col("x").alias("_x"), F.col("y").alias("_y")).agg(F.min("zone_id").alias("zone_id"), (F.count("*") > 1).alias("_several"))
    same = (points["x"].cast("double") == F.col("_x")) & (points["y"].cast("double") == F.col("_y"))
    return points.join(hits, same, "left").select(*points.columns, "zone_id", F.coalesce("_several", F.lit(False)).alias("ambiguous"))


def lookups(points: DataFrame, polygons: DataFrame) -> DataFrame:
    """places (a zone's cell holds them), by_cell (decided by it alone), by_sides and the share of
    places that met sides."""
    near, _ = looked_up(points, polygons)
    c = F.count_if
    return near.agg(F.count("*").alias("places"), c("inner").alias("by_cell"), c(~F.col("inner")).alias("by_sides"), F.try_divide(c(~F.col("inner")), F.count("*")).alias("share_by_sides"))


def mapping(located: DataFrame) -> DataFrame:
    """Adds how a point was placed."""
    no_xy = F.col("x").isNull() | F.col("y").isNull() | F.isnan("x") | F.isnan("y")
    return located.withColumn("mapping", F.when(no_xy, "no_coordinates").when(F.col("ambiguous"), "ambiguous_lowest_id").when(F.col("zone_id").isNotNull(), "mapped").otherwise("outside_all_zones"))
