"""Mixing sources to target weights by systematic sampling.

Within a source every document expects target / source_size copies. Documents are laid
on a line in the order of size, id and a hash of the text, each as long as its expected copies; with one
random offset a source, a document is emitted once for each whole number its stretch
crosses. The order by size makes the taken words follow the target closely.

Defined results: a null text has size 0; a null source is a source of its own, after the
others; a source without words has target 0 and takes nothing; of rows alike in source,
size, id and text it doesn't matter which is taken; an empty table gives an empty result.
The offsets depend on the seed and the source's name alone, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, shuffle_partitions, stored

CAP = 3
SEED = "mix-1"
#: Ids with their copies that are sent along to every task at most.
BROADCAST_ROWS = 1_000_000


def word_count(col):
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, cap: int = CAP, cycle: int = 3) -> DataFrame:
    """source, source_size -> also weight and target; targets fill up like water.

    totals has one row a source, so its windows hold no document; they have no partition, and
    one task sorts all sources, which holds for some millions of them. Sources reach their
    cap in the order of cap over weight; the level is what the rest share by weight.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    w = totals.withColumn("weight", ((F.row_number().over(by_name) - 1) % cycle + 1).cast("long"))
    w = w.withColumn("_cap", F.lit(cap).cast("long") * F.col("source_size")).withColumn("_ratio", F.col("_cap") / F.col("weight"))
    everything = Window.partitionBy()
    before = Window.orderBy("_ratio", F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    w = (
        w.withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("_level", F.col("_left").cast("double") / F.col("_weights"))
        .withColumn("_capped", F.col("_ratio") < F.col("_level"))
    )
    # past the last capped source the level stays the same: take it at the first one below its cap
    level = F.min(F.when(~F.col("_capped"), F.struct("_ratio", F.struct(F.col("source").isNull(), "source"), "_level"))).over(everything)["_level"]
    return w.withColumn("target", F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(level * F.col("weight"))).select("source", "source_size", "weight", "target")


def mix(docs: DataFrame, cap: int = CAP, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, and the columns named in keep.

    One range shuffle puts the documents in the order of source, size and id; positions
    within partitions plus the sums of what lies before (a row a partition and source)
    give every document its place, so that a hot source is spread over many tasks.
    """
    spark = docs.sparkSession
    held = [f"_k{i}" for i in range(len(keep))]  # by place, as kept names may clash with those here
    place = [docs.columns.index(c) for c in keep]
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    own = dict(zip(("doc_id", "source", "text"), [F.col(f"_c{docs.columns.index(c)}") for c in ("doc_id", "source", "text")], strict=True))
    rows = plain.select(
        own["doc_id"].alias("doc_id"), own["source"].alias("source"), word_count(own["text"]).alias("_size"), F.xxhash64(own["text"]).alias("_hash"),
        *[F.col(f"_c{i}").alias(h) for i, h in zip(place, held, strict=True)],
    )
    if not keep:
        rows = stored(rows, "mix-sizes")  # narrow from here on: the texts are read once
    order = [F.asc_nulls_last("source"), F.asc("_size"), F.asc("doc_id"), F.asc("_hash")]
    ranged = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = stored(ranged.withColumn("_block", F.shiftright("_at", 33)), "mix-order")
    parts = ranged.groupBy("source", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"), F.sum("_size").alias("_words"))
    parts = stored(parts, "mix-parts")
    before = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    goals = targets(parts.groupBy("source").agg(F.sum("_words").alias("source_size")), cap)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))), 1, 5), 16, 10).cast("double") / F.lit(1048576.0)
    goals = goals.withColumn("_u", offset).withColumn("_e", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    parts = parts.alias("p").join(goals.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source"))).select(
        "p.source", "p._block", "p._first", "p._before", "g.source_size", "g.target", "g._u", "g._e",
    )
    r, p = ranged.alias("r"), parts.alias("q")
    full = r.join(p, (F.col("r._block") == F.col("q._block")) & F.col("r.source").eqNullSafe(F.col("q.source"))).select(
        "r.doc_id", "r.source", "r._size", *[F.col(f"r.{h}") for h in held], "q.source_size", "q.target", "q._u", "q._e",
        (F.col("r._at") - F.col("q._first") + F.col("q._before")).alias("_i"),
    )
    i, e, u = F.col("_i").cast("double"), F.col("_e"), F.col("_u")
    copies = F.least(F.floor((i + 1) * e + u) - F.floor(i * e + u), F.lit(cap).cast("long")).cast("long")
    return full.select("doc_id", "source", F.col("_size").alias("size"), "source_size", "target", copies.alias("copies"), *held)


def emit(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """One row a copy of what mix(keep=columns) kept: what the mix holds."""
    held = [f"_k{i}" for i in range(len(columns))]
    copies = mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copies.select(*held).toDF(*columns)


def mixed_rows(docs: DataFrame) -> DataFrame:
    """What the mix of docs holds, with all columns of docs.

    Where ids tell the rows apart, only ids and copies meet the texts again, and by a
    broadcast if they are few: then no text is shuffled. Otherwise rows go through whole.
    """
    names, at = docs.columns, docs.columns.index("doc_id")
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    ids = plain.groupBy(f"_c{at}").agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.count_if(F.col(f"_c{at}").isNull()).alias("nulls"), F.count("*").alias("ids")).first()
    if (ids.most or 0) > 1 or ids.nulls:
        return emit(mix(docs, keep=tuple(names)), names)
    taken = mix(docs).where("copies > 0").select(F.col("doc_id").alias("_id"), "copies")
    taken = F.broadcast(taken) if ids.ids <= BROADCAST_ROWS else taken
    both = plain.join(taken, F.col(f"_c{at}") == F.col("_id"))
    copies = both.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copies.select(*[f"_c{i}" for i in range(len(names))]).toDF(*names)


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST((row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight FROM totals
), capped AS (
  SELECT *, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / weight AS ratio FROM weighed
), levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY ratio, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
  FROM capped
), goals AS (
  SELECT source, source_size,
    CASE WHEN ratio < level THEN CAST(cap AS DOUBLE) ELSE
      (SELECT arg_min(l.level, l.ratio) FROM levels l WHERE l.ratio >= l.level) * weight END AS target,
    CAST(('0x' || substr(md5('mix-1|' || coalesce('s' || source, 'n')), 1, 5)) AS BIGINT) / 1048576.0::DOUBLE AS u
  FROM levels
), placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.u,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS e,
    CAST(row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id NULLS FIRST) AS DOUBLE) AS i
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * least(floor(i * e + u) - floor((i - 1) * e + u), 3) AS BIGINT) AS taken
FROM placed
"""


def op7(spark, sf_dir):
    from .common import documents

    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
