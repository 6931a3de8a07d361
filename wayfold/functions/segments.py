"""Windows over keys that may hold any share of all rows: segmented scans.

A key with more than `most` rows is cut into segments of its order: quantile sketches of the
order give the cuts, so segments hold about `most` rows each, rows of one time stay together,
and a segment lies wholly after the one before it. Windows then hold a segment. What a segment
needs from those before it, its last row or a count, is one row a segment; a small join brings
it. Keys with fewer rows are one segment. Tasks are as many as the rows need, so that what one of
them sorts doesn't grow with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .expressions import since_epoch

MOST = 1_000_000
#: Segments whose last rows are sent along to every task at most.
BROADCAST_SEGMENTS = 100_000
#: Rows that a task is dealt, about.
DEALT = 500_000


def whole(df: DataFrame, at: str) -> Column:
    """A time as a whole number in its order; numbers are what they are."""
    kind = dict(df.dtypes)[at]
    return F.unix_micros(at) if kind == "timestamp" else since_epoch(at) if kind == "timestamp_ntz" else F.col(at)


def cut(df: DataFrame, key: str, at: str, most: int | None = None, nulls_last: bool = False) -> tuple[DataFrame, int]:
    """df with _seg, and how many segments of cut keys there are at most (0: no key is that large).

    Null keys are one key; null times lie first, or last."""
    most = most or MOST
    sizes = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    counts = sizes.where(F.col("_n") > most)
    r = sizes.agg(F.count_if(F.col("_n") > most).alias("keys"), F.max("_n").alias("n"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")).first()
    if not r.keys:
        return dealt(df, r.rows, key).withColumn("_seg", F.lit(0)), 0
    parts = min(10_000, -(-2 * r.n // most))  # twice as many as are needed, as sketches are inexact
    few = F.broadcast(counts) if r.keys <= BROADCAST_SEGMENTS else counts
    hot = df.join(few, F.col(key).eqNullSafe(F.col("_key"))).where(F.col(at).isNotNull()).select("_key", whole(df, at).alias("_at"))
    cuts = hot.groupBy("_key").agg(F.array_distinct(F.percentile_approx("_at", [i / parts for i in range(1, parts)], 10 * parts)).alias("_cuts"))
    cuts = F.broadcast(cuts) if r.keys * parts <= BROADCAST_SEGMENTS else cuts
    edge = parts if nulls_last else -1
    place = F.when(F.col("_cuts").isNull(), 0).when(F.col(at).isNull(), edge).otherwise(F.size(F.filter("_cuts", lambda c: c < whole(df, at))))
    joined = df.join(cuts, F.col(key).eqNullSafe(F.col("_key")), "left")
    return dealt(joined.select(*[F.col(c) for c in df.columns], place.alias("_seg")), r.rows, key, "_seg"), r.keys * (parts + 1)


def dealt(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """df in tasks of DEALT rows, where Spark would make fewer of them: it joins small partitions as
    long as every core has one, and goes by their bytes as they are compressed."""
    spark, tasks = df.sparkSession, -(-rows // DEALT)
    few = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *by) if tasks > few else df


def joined_on(df: DataFrame, small: DataFrame, key: str, segments: int) -> DataFrame:
    few = F.broadcast(small) if segments <= BROADCAST_SEGMENTS else small
    return df.join(few, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_seg") == F.col("_s")), "left").drop("_k", "_s")


def lagged(df: DataFrame, key: str, order: list[str], columns: list[str], name: str, most: int | None = None) -> DataFrame:
    """df with the struct `name` of the given columns of the key's row before it, null for the
    first. order: columns, ascending, the first of which cuts large keys."""
    rows, segments = cut(df, key, order[0], most)
    own = F.struct(*columns)
    w = Window.partitionBy(key, "_seg").orderBy(*order)
    out = rows.withColumn(name, F.lag(own).over(w))
    if not segments:
        return out.drop("_seg")
    last = rows.groupBy(F.col(key).alias("_k"), F.col("_seg").alias("_s")).agg(F.max_by(own, F.struct(*order)).alias("_last"))
    before = last.withColumn("_before", F.lag("_last").over(Window.partitionBy("_k").orderBy("_s"))).drop("_last")
    return joined_on(out, before.where("_before is not null"), key, segments).withColumn(name, F.coalesce(name, "_before")).drop("_before", "_seg")


def placed(df: DataFrame, key: str, order: list[str], name: str, most: int | None = None) -> DataFrame:
    """df with each row's place in its key, from 1. The first column of order cuts large keys, and
    its nulls come last; the others ascend, nulls first."""
    rows, segments = cut(df, key, order[0], most, nulls_last=True)
    w = Window.partitionBy(key, "_seg").orderBy(F.asc_nulls_last(order[0]), *order[1:])
    out = rows.withColumn(name, F.row_number().over(w))
    if not segments:
        return out.drop("_seg")
    sizes = rows.groupBy(F.col(key).alias("_k"), F.col("_seg").alias("_s")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("_before", F.sum("_n").over(earlier)).drop("_n").where("_before is not null")
    return joined_on(out, before, key, segments).withColumn(name, (F.col(name) + F.coalesce("_before", F.lit(0))).cast("int")).drop("_before", "_seg")
