"""Prefix trie of rebuilt conversations, with subtree sums by heavy-path decomposition.

A turn is the SHA-256 of its role and text; a prefix is named by a polynomial hash of its turns
modulo 2^127 - 1, which a part of a conversation can compute by itself and combine with what
lies before it. So a conversation of any length is spread over range partitions, one row a
partition goes through the driver, and a rebuilt prefix follows from hashes of the two
conversations that it is made of. Nodes are groups of equal (depth, hash).

Subtree sums: the child with the most conversations (ties: the smallest conversation) continues
its parent's path, all others head a path of their own. A light child has at most half of its
parent's conversations, so a node lies under at most log2(conversations) light ones, its level.
From the deepest level to the root's, paths are arrays by depth whose suffix sums are the
subtrees' sums, and each head's sum is attached to its parent's node before the next round.
Windows over conversations and paths take STRETCH depths at a time where any is longer.

Defined results: rows with a null conv_id take no part; turns that tie are ordered by their
SHA-256; repeated rows are turns of their own; c - c % 5 goes towards zero for negative ids, as
% does. An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import new_folder, pick, ship, stored

PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"wayfold trie").digest()[:15], "big")
#: The most turns that a conversation takes over; depths of a window; ids that are joined in one row.
TAKEN, STRETCH, IDS = 8, 4096, 8192
ROOT = bytes(16)
KEY = ["depth", "hash"]
POWERS = [pow(BASE, k, PRIME) for k in range(64)]


def power(k: int) -> int:
    return POWERS[k] if k < 64 else pow(BASE, k, PRIME)


def number(x: bytes) -> int:
    return int.from_bytes(x, "big")


def name(x: int) -> bytes:
    return (x % PRIME).to_bytes(16, "big")


NUMBERED = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("conv_id", pa.int64()), ("nth", pa.int64()), ("size", pa.int64()), ("before", pa.binary()), ("hash", pa.binary())])
NUMBERED_SQL = "part int, kind int, conv_id long, nth long, size long, before binary, hash binary"


def numbered(batches):
    """Sorted turns (conv_id, digest, size) with their place and hashes as if each partition began
    anew, then the partition's first run (kind 1) and its last (kind 2, or 3 if it is the first)."""
    part, first, conv, n, h = TaskContext.get().partitionId(), None, None, 0, 0
    row = lambda kind, c, n, h: pa.RecordBatch.from_pydict({"part": [part], "kind": [kind], "conv_id": [c], "nth": [n], "size": [0], "before": [ROOT], "hash": [name(h)]}, schema=NUMBERED)
    for b in batches:
        nth, before, after = [], [], []
        for c, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if c != conv:
                if conv is not None and first is None:
                    first = (conv, n, h)
                conv, n, h = c, 0, 0
            before.append(name(h))
            n, h = n + 1, (h * BASE + number(d) + 1) % PRIME
            nth.append(n)
            after.append(name(h))
        k = b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([part] * k, pa.int32()), pa.array([0] * k, pa.int32()), b.column(0), pa.array(nth, pa.int64()), b.column(2), pa.array(before, pa.binary()), pa.array(after, pa.binary())], schema=NUMBERED)
    if first:
        yield row(1, *first)
    if conv is not None:
        yield row(2 if first else 3, conv, n, h)


def carries(runs: list) -> dict[int, tuple[int, int, int]]:
    """For each partition whose first conversation began earlier: its id, turns and hash so far."""
    out, last = {}, None
    for r in sorted(runs, key=lambda r: (r.part, r.kind)):
        n, h = r.nth, number(bytes(r.hash))
        if r.kind != 2 and last and last[0] == r.conv_id:
            out[r.part] = last
            n, h = last[1] + n, last[2] * power(n) + h
        last = (r.conv_id, n, h % PRIME)
    return out


def continued(carry: dict):
    """Numbered turns with their places and hashes in the whole conversation."""

    def run(batches):
        for b in batches:
            part, conv, nth = (b.column(i).to_pylist() for i in (0, 2, 3))
            before, after = b.column(5).to_pylist(), b.column(6).to_pylist()
            for i, p in enumerate(part):
                had = carry.get(p)
                if had and had[0] == conv[i]:
                    at, k = power(nth[i] - 1), nth[i]
                    before[i], after[i] = name(had[2] * at + number(before[i])), name(had[2] * at * BASE + number(after[i]))
                    nth[i] = had[1] + k
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array(nth, pa.int64()), b.column(4), pa.array(before, pa.binary()), pa.array(after, pa.binary())], names=["conv_id", "nth", "size", "before", "hash"])

    return run


ROWS_SQL = "conv_id long, depth long, hash binary, parent binary, size long, last boolean"


def rebuilt(batches):
    """Own turns (conv_id, depth, k, size, last, before, hash, skipped, taken): the k-th turn after
    those that are left out, on top of the ones taken from another conversation."""
    for b in batches:
        before, after = [], []
        for k, g, h, skipped, taken in zip(*[b.column(i).to_pylist() for i in (2, 5, 6, 7, 8)], strict=True):
            if skipped != taken:
                more, at = number(taken) - number(skipped), power(k - 1)
                g, h = name(number(g) + more * at), name(number(h) + more * at * BASE)
            before.append(g)
            after.append(h)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(after, pa.binary()), pa.array(before, pa.binary()), b.column(3), b.column(4)], names=["conv_id", "depth", "hash", "parent", "size", "last"])


def digests(batches):
    """Rows (depth, hash, ids) in order: one digest a node over all its rows, joined by commas."""
    node, sha, found = None, None, []

    def out():
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary()), pa.array([f[2] for f in found], pa.string())], names=[*KEY, "ends"])

    for b in batches:
        for depth, h, ids in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
            if (depth, h) != node:
                if node:
                    found.append((*node, sha.hexdigest()))
                node, sha = (depth, h), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if len(found) > 4096:
            yield out()
            found = []
    if node:
        found.append((*node, sha.hexdigest()))
    if found:
        yield out()


def prefixes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All (conv_id, depth, hash, parent, size, last) of rebuilt conversations from depth 1 on, and
    (conv_id, length) of every conversation."""
    spark = conversations.sparkSession
    ship(spark)
    own = lambda c: F.coalesce(F.col(c), F.lit(""))
    turns = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", own("role").alias("role"), own("text").alias("text"))
    digest = F.unhex(F.substring(F.sha2(F.concat_ws("", F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256), 1, 32))
    short = stored(turns.select("conv_id", "turn", digest.alias("digest"), F.octet_length("text").cast("long").alias("size")), "trie-turns")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    ranged = short.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "size")
    parts = stored(ranged.mapInArrow(numbered, NUMBERED_SQL), "trie-parts")
    carry = carries(parts.where("kind > 0").collect())
    whole = stored(parts.where("kind = 0").mapInArrow(continued(carry), "conv_id long, nth long, size long, before binary, hash binary"), "trie-whole")

    few = F.when(F.col("nth") <= TAKEN, F.struct("nth", "before", "hash", "size"))
    each = whole.groupBy("conv_id").agg(F.max("nth").alias("n"), F.sort_array(F.collect_list(few)).alias("first"))
    each = each.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (TAKEN + 1)).cast("int")).withColumn("b", F.col("conv_id") - F.col("conv_id") % 5)
    each = stored(each, "trie-each")
    base = each.select(F.col("conv_id").alias("base_id"), F.col("first").alias("others"))
    m = F.least(F.col("h"), F.coalesce(F.size("others"), F.lit(0)))
    hash_at = lambda a, i: F.when(i > 0, F.element_at(F.col(a), F.greatest(i, F.lit(1)))["hash"]).otherwise(F.lit(bytearray(ROOT)))
    both = each.join(base, F.col("b") == F.col("base_id"), "left").withColumn("m", F.when(F.col("others").isNull(), 0).otherwise(m))
    both = both.withColumn("length", F.col("m") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    both = stored(both.select("conv_id", "h", "m", "length", F.slice("others", F.lit(1), F.col("m")).alias("others"), F.when(F.col("n") > F.col("h"), hash_at("first", F.col("h"))).alias("skipped"), hash_at("others", F.col("m")).alias("taken")), "trie-both")
    from_others = both.where("m > 0").select("conv_id", "length", F.explode("others").alias("t")).select("conv_id", F.col("t.nth").alias("depth"), "t.hash", F.col("t.before").alias("parent"), "t.size", (F.col("t.nth") == F.col("length")).alias("last"))
    kept = whole.join(both.select(F.col("conv_id").alias("id"), "h", "m", "length", "skipped", "taken"), F.col("conv_id") == F.col("id")).where(F.col("nth") > F.col("h"))
    depth = F.col("m") + F.col("nth") - F.col("h")
    own_rows = kept.select("conv_id", depth.alias("depth"), (F.col("nth") - F.col("h")).alias("k"), "size", (depth == F.col("length")).alias("last"), "before", "hash", "skipped", "taken").mapInArrow(rebuilt, ROWS_SQL)
    return stored(from_others.unionByName(own_rows), "trie-rows"), both.select("conv_id", "length")


def in_stretches(df: DataFrame, keys: list[str], sums: dict, down: bool, deepest: int) -> DataFrame:
    """df with running aggregates by depth (from the deepest on if down) within keys.

    sums: a name for the pair (aggregate, column). Where depths go beyond STRETCH, windows hold
    one stretch, and what earlier stretches add up to is joined on.
    """
    order = F.desc("depth") if down else F.asc("depth")
    if deepest < STRETCH:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[f(c).over(w).alias(a) for a, (f, c) in sums.items()])
    df = df.withColumn("stretch", F.floor(F.col("depth") / STRETCH))
    w = Window.partitionBy(*keys, "stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    step = F.desc("stretch") if down else F.asc("stretch")
    earlier = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    each = df.groupBy(*keys, "stretch").agg(*[f(c).alias(f"_{a}") for a, (f, c) in sums.items()])
    before = each.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("stretch").alias("_stretch"), *[f(f"_{a}").over(earlier).alias(f"_{a}") for a, (f, _) in sums.items()])
    inside = df.select("*", *[f(c).over(w).alias(a) for a, (f, c) in sums.items()])
    joined = inside.join(before, [F.col(k) == F.col(f"_{k}") for k in [*keys, "stretch"]], "left")
    total = lambda a, f: F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(f"_{a}"), F.lit(0)) if f is F.sum else F.greatest(F.col(a), F.col(f"_{a}"))
    return joined.select(*df.drop("stretch").columns, *[total(a, f).alias(a) for a, (f, _) in sums.items()])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    spark = conversations.sparkSession
    rows, each = prefixes(conversations)
    root_hash = F.lit(bytearray(ROOT))
    node = F.first("parent").alias("parent"), F.first("size").alias("size")
    grouped = rows.groupBy(*KEY).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *node)
    top = each.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    nodes = stored(grouped.unionByName(top.select(F.lit(0).cast("long").alias("depth"), root_hash.alias("hash"), "n_convs", "conv_id", F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("size"))), "trie-nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0

    # each node's children: how many, and which continues its path
    biggest = F.max(F.struct("n_convs", -F.col("conv_id"), "hash"))["hash"]
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("hash")).agg(F.count("*").alias("n_children"), biggest.alias("heavy"))
    with_children = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    with_children = stored(with_children, "trie-children")
    above = with_children.where("n_children > 0").select((F.col("depth") + 1).alias("d"), F.col("hash").alias("above"), F.col("conv_id").alias("parent_conv_id"), F.col("heavy").alias("goes_on"))
    known = with_children.drop("heavy").join(above, (F.col("depth") == F.col("d")) & (F.col("parent") == F.col("above")), "left")
    light = F.coalesce(F.col("goes_on") != F.col("hash"), F.lit(False))
    known = stored(known.select(*KEY, "parent", "conv_id", "parent_conv_id", "n_convs", "n_children", "size", light.cast("int").alias("light")), "trie-known")

    # from the root to each leaf once: the last light node above is the head of a node's path
    ways = known.where("n_children = 0 and depth > 0").select(F.col("conv_id").alias("way"))
    steps = rows.join(ways, F.col("conv_id") == F.col("way"), "left_semi").select(F.col("conv_id").alias("way"), *KEY)
    steps = steps.join(known, KEY).withColumn("mark", F.when(F.col("light") == 1, F.struct(*KEY)))
    placed = in_stretches(stored(steps, "trie-steps"), ["way"], {"level": (F.sum, "light"), "head": (F.max, "mark")}, False, deepest)
    facts = ["parent", "conv_id", "parent_conv_id", "n_convs", "n_children", "size", "level", "head"]
    paths = placed.select(*KEY, *facts).groupBy(*KEY).agg(*[F.first(c).alias(c) for c in facts])
    roots = known.where("depth = 0").select(*KEY, *facts[:-2], F.lit(0).cast("long").alias("level"), F.lit(None).cast("struct<depth:bigint,hash:binary>").alias("head"))
    start = F.coalesce("head", F.struct(F.lit(0).cast("long").alias("depth"), root_hash.alias("hash")))
    tree = paths.unionByName(roots).select(*KEY, *facts[:-1], start["depth"].alias("head_depth"), start["hash"].alias("head_hash"), (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    folder = new_folder(spark, "trie-paths")
    tree.write.partitionBy("level").parquet(folder)
    tree = spark.read.schema(tree.schema).parquet(folder)

    # path by path from the deepest level up; each head's sums go to its parent's node
    levels = sorted((r.level for r in tree.select("level").distinct().collect()), reverse=True)
    done, attached = [], None
    for level in levels:
        part = tree.where(F.col("level") == level).drop("level")
        if attached is not None:
            part = part.join(attached, KEY, "left").select(*[c for c in part.columns if c not in ("leaf", "saved")], *[(F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))).alias(c) for c in ("leaf", "saved")])
            part = stored(part, "trie-attached") if deepest >= STRETCH else part
        sums = {"n_leaves": (F.sum, "leaf"), "saved_tokens": (F.sum, "saved")}
        part = stored(in_stretches(part, ["head_depth", "head_hash"], sums, True, deepest), "trie-level")
        done.append(part)
        heads = part.where((F.col("depth") == F.col("head_depth")) & (F.col("depth") > 0))
        attached = heads.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("hash")).agg(F.sum("n_leaves").alias("more_leaf"), F.sum("saved_tokens").alias("more_saved"))
    if not done:
        done = [tree.drop("level").withColumns({"n_leaves": F.lit(0).cast("long"), "saved_tokens": F.lit(0).cast("long")})]
    summed = done[0]
    for part in done[1:]:
        summed = summed.unionByName(part)

    # a node's ends: ids of a slice meet in one row, slices of a node are read in order
    ends = rows.where("last").select(*KEY, "conv_id").unionByName(each.where("length = 0").select(F.lit(0).cast("long").alias("depth"), root_hash.alias("hash"), "conv_id"))
    slices = ends.groupBy(*KEY, F.floor(F.col("conv_id") / IDS).alias("slice")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    ended = slices.repartition(*KEY).sortWithinPartitions(*KEY, "slice").select(*KEY, "ids").mapInArrow(digests, "depth long, hash binary, ends string")
    out = summed.join(ended, KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


TRIE_SQL = """
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab
), t AS (
  SELECT conv_id, coalesce(text, '') AS text, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS turn_key,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS nth
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS b, max(nth) AS n,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, x: xor(tab[1 + (xor(c, x) & 255)], c >> 8))) % 9 AS h
  FROM t, crc GROUP BY conv_id, tab
), c AS (
  SELECT i.conv_id, i.b, i.h, least(i.h, coalesce(o.n, 0)) AS m FROM ids i LEFT JOIN ids o ON o.conv_id = i.b
), r AS (
  SELECT c.conv_id, t.nth AS depth, t.text, t.turn_key FROM c JOIN t ON t.conv_id = c.b AND t.nth <= c.h
  UNION ALL
  SELECT c.conv_id, c.m + t.nth - c.h, t.text, t.turn_key FROM c JOIN t ON t.conv_id = c.conv_id AND t.nth > c.h
), p AS (
  SELECT conv_id, depth, strlen(text) AS size, string_agg(sha256(turn_key), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM c
), lengths AS (
  SELECT conv_id, max(depth) AS length FROM p GROUP BY conv_id
), nodes AS (
  SELECT path, depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE depth = length), '')) AS ends_sha256
  FROM p JOIN lengths USING (conv_id) GROUP BY path, depth
), children AS (
  SELECT left(path, 64 * (CAST(depth AS INTEGER) - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), full_nodes AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN children k USING (path)
), under AS (
  SELECT left(path, 64 * a) AS path, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT *, unnest(range(CAST(depth AS INTEGER) + 1)) AS a FROM full_nodes) GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, o.conv_id AS parent_conv_id, n.n_convs, CAST(n.n_children AS BIGINT) AS n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves,
  CAST(u.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN under u USING (path) LEFT JOIN nodes o ON n.depth > 0 AND o.path = left(n.path, 64 * (CAST(n.depth AS INTEGER) - 1))
"""


def op12(spark, sf_dir):
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
