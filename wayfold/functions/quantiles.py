"""Exact quantiles of groups by selection in rounds, for values of any range.

`percentile` keeps a map of all values a group in one task. Here a group of up to SMALL rows is
one stretch. Larger ones, and rows of few groups at once, are counted by 1/32 octave of their values'
size, with each stretch's least and greatest value; running counts say which stretches hold the
wanted places. A stretch of one value is decided. Others with more than SMALL rows are cut
again, evenly between their ends, and again, where only rows of wanted stretches take part; a
double's digits are used up after a few rounds. What is left is counted value by value. A
shuffle moves at most the stretches of a task and the values of stretches with SMALL rows, and
no task or window gets more of a group than that.

The rounds run when a figure is asked for, as each depends on the one before it. Meanwhile
groups and values are kept in memory and on the executors' disks, so that whatever they derive
from is read once; a lost executor's part is derived anew. They are released with the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import work_folder

#: Stretches of an octave and of a later round; rows of a stretch that is looked at value by value.
OCTAVE, CUTS, SMALL = 32, 1024, 1_000_000
#: Wanted stretches that go by way of the driver; more are written to the shared folder.
LOCAL = 10_000


def same(left: str, right: str, keys: list[str]) -> Column:
    """Equal keys of two aliases; nulls are equal, and without keys everything is."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys], F.lit(True))


def octave(v: Column) -> Column:
    """A whole number that never falls as v grows; infinities and NaN have their own."""
    size = F.floor(F.log2(F.abs(v)) * OCTAVE) + 1100 * OCTAVE
    return (
        F.when(F.isnan(v), 10**6).when(v == float("inf"), 10**6 - 1).when(v == float("-inf"), -(10**6)).when(v == 0, 0).when(v > 0, size).otherwise(-size).cast("long")
    )


def kept_small(df: DataFrame) -> DataFrame:
    """df, worked out once: in the driver where it has few rows, else in the shared folder."""
    rows = df.limit(LOCAL + 1).toArrow()
    if rows.num_rows <= LOCAL:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
    at = work_folder(df.sparkSession, "stretches") / "s"
    df.write.parquet(str(at))
    return df.sparkSession.read.schema(df.schema).parquet(str(at))


def wanted(cut: DataFrame, keys: list[str], qs: list[float], first: bool) -> DataFrame:
    """Of counted stretches (keys, b, c, lo, hi and, unless nothing was counted before, n and base)
    those that hold a wanted place, with before: rows below them in the group."""
    run = Window.partitionBy(*keys, *([] if first else ["base"])).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("c").over(run), F.lit(0))
    n = F.sum("c").over(Window.partitionBy(*keys)) if first else F.col("n")
    at = cut.select(*keys, "c", "lo", "hi", n.alias("n"), (below if first else below + F.col("base")).alias("before"))
    return at.where(reduce(lambda a, b: a | b, [held(p, F.col("before"), F.col("c")) for p in places(qs)]))


def spots(qs: list[float]) -> list[Column]:
    return [F.lit(float(q)) * (F.col("n") - 1) for q in qs]


def places(qs: list[float]) -> list[Column]:
    return [f(s) for s in spots(qs) for f in (F.floor, F.ceil)]


def held(place: Column, low: Column, c: Column) -> Column:
    return (place >= low) & (place < low + c)


def by_rounds(values: DataFrame, qs: list[float], by: list[str] | None = None, few: bool = False) -> DataFrame:
    """The columns by, then q0, q1, ... and n of a column v, with linear interpolation.

    Null values don't count; a group of nothing else isn't there, and without groups it has null
    quantiles and n 0. NaN is above all other values. few: groups are so few, and likely large,
    that their sizes aren't looked at first."""
    by = by or []
    keys = [f"_g{i}" for i in range(len(by))]
    rows = values.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col("v").cast("double").alias("v")).where("v is not null")
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = kept_small(selected(rows, keys, qs, few or not by))
    finally:
        rows.unpersist()
    return found.select(*[F.col(k).alias(c) for c, k in zip(by, keys, strict=True)], *[f"q{i}" for i in range(len(qs))], "n")


def selected(rows: DataFrame, keys: list[str], qs: list[float], few: bool) -> DataFrame:
    """keys, q0, q1, ... and n of the rows (keys, v)."""
    facts = [F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    one_value = F.col("lo").eqNullSafe(F.col("hi"))
    large = ~one_value & (F.col("c") > SMALL)
    inside = lambda to: rows.alias("r").join(to.alias("k"), same("r", "k", keys) & (F.col("r.v") >= F.col("k.lo")) & (F.col("r.v") <= F.col("k.hi")))
    if few:
        near = kept_small(wanted(rows.groupBy(*keys, octave(F.col("v")).alias("b")).agg(*facts), keys, qs, True))
        part = None
    else:
        near = kept_small(rows.groupBy(*keys).agg(*facts).select(*keys, "c", "lo", "hi", F.col("c").alias("n"), F.lit(0).cast("long").alias("before")))
        part = octave(F.col("r.v"))
    while not near.where(large).isEmpty():
        if part is None:
            part = F.floor((F.col("r.v") - F.col("k.lo")) / (F.col("k.hi") - F.col("k.lo")) * CUTS).cast("long")
        cut = inside(near.where(large)).select(*[F.col(f"r.`{k}`") for k in keys], F.col("k.before").alias("base"), F.col("k.n"), part.alias("b"), "r.v")
        cut = cut.groupBy(*keys, "base", "n", "b").agg(*facts)
        near, part = kept_small(near.where(~large).unionByName(wanted(cut, keys, qs, False).select(*near.columns))), None
    decided = near.where(one_value).select(*keys, "n", F.col("before").alias("_at"), "c", F.col("lo").alias("v"))
    counts = inside(near.where(~one_value)).groupBy(*[F.col(f"r.`{k}`") for k in keys], F.col("k.n"), F.col("k.before"), F.col("r.v")).agg(F.count("*").alias("c"))
    inner = Window.partitionBy(*keys, "n", "before").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    looked = counts.select(*keys, "n", (F.col("before") + F.coalesce(F.sum("c").over(inner), F.lit(0))).alias("_at"), "c", "v")
    picks = [F.max(F.when(held(p, F.col("_at"), F.col("c")), F.col("v"))).alias(f"_p{i}") for i, p in enumerate(places(qs))]
    found = decided.unionByName(looked).groupBy(*keys).agg(*picks, F.coalesce(F.max("n"), F.lit(0)).alias("n"))
    whole = lambda s: s == F.floor(s)  # noqa: E731  no step between two values, which may be infinite
    between = [F.when(whole(s), F.col(f"_p{2 * i}")).otherwise(F.col(f"_p{2 * i}") + (F.col(f"_p{2 * i + 1}") - F.col(f"_p{2 * i}")) * (s - F.floor(s))) for i, s in enumerate(spots(qs))]
    return found.select(*keys, *[q.alias(f"q{i}") for i, q in enumerate(between)], "n")


def summary(df: DataFrame, by: list[str], aggregates: list[Column], measures: dict[str, tuple]) -> DataFrame:
    """The columns by, the aggregates, and the measures: name -> (values, quantile, or None or
    a condition on the rows that count)."""
    plain = df.groupBy(*by).agg(*aggregates)
    kinds: list = []  # different values and conditions are counted once
    of = {}
    for name, (values, q, where) in measures.items():
        alike = lambda k, v=values, w=where: (k[0] is v or isinstance(v, str) and isinstance(k[0], str) and k[0] == v) and k[1] is w
        kind = next((i for i, k in enumerate(kinds) if alike(k)), None)
        if kind is None:
            kind = len(kinds)
            kinds.append((values, where))
        of[name] = (kind, q)
    qs = sorted({q for _, q in of.values()})
    column = lambda v: F.col(v) if isinstance(v, str) else v
    one = lambda i, v, w: F.struct(F.lit(i).alias("kind"), (column(v) if w is None else F.when(w, column(v))).cast("double").alias("v"))
    tall = df.select(*by, F.explode(F.array(*[one(i, v, w) for i, (v, w) in enumerate(kinds)])).alias("_x")).select(*by, "_x.kind", "_x.v")
    found = by_rounds(tall, qs, [*by, "kind"], few=not by)
    wide = found.groupBy(*by).agg(*[F.max(F.when(F.col("kind") == kind, F.col(f"q{qs.index(q)}"))).alias(name) for name, (kind, q) in of.items()])
    j = plain.alias("p").join(wide.alias("w"), same("p", "w", by), "left")
    return j.select("p.*", *[f"w.{name}" for name in measures])
