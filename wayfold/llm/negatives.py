"""Hard negatives by branch and bound in ball trees.

Vectors become integers floor(scale * x). Each partition grows trees over vectors of one label,
of up to TREE vectors: balls with a centre and a radius, halved along the line between two far
points down to leaves of LEAF. An inner product with a query lies within |query| * radius of the
one with the centre, so a ball bounds scores above and below.

Two searches meet groups of trees with groups of anchors, both of bounded size. The first finds
an anchor's best rows of its own label and goes down only where the upper bound is not strictly
beneath the current kth. Each of them opens a window of scores, and the second search goes
through the trees of all other labels: a ball is left out unless it can hold a score in a window
that is not strictly beneath that window's current kth. So the results are exact.

Only counts and bytes by label stay apart; trees and anchors of a label are dealt to as many
groups as their bytes ask for, so a hot label is many tasks. Groups pass on k rows a query.

Defined results: rows with a null id or label, a null vector, or null or non-finite components
take no part. Vectors of unequal length are compared as if padded with zeros. An anchor's own
row is no candidate, others with its id are; repeated rows all count, as anchors too, whose rows
then repeat. Equal scores go to the smaller id. Anchors without rows of their label, windows
without rows, and all windows of negative scores give no rows. Scores that leave 64 bits are
held at its ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, ship, stored
from .topk import Best, exact, integers, padded

#: Vectors of a tree and of a leaf; vectors that a task holds before it closes trees.
TREE, LEAF, HELD = 2048, 64, 1 << 15
#: Bytes of vectors in a group of trees and in a group of anchors, about; anchors in one descent.
GROUP_BYTES, ANCHOR_BYTES, TOGETHER = 32 << 20, 8 << 20, 512
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def halves(n: int) -> list[tuple[int, int]]:
    """Spans of a tree's nodes: node i has the children 2 * i + 1 and 2 * i + 2."""
    spans, row = [(0, n)], [(0, n)]
    while row[0][1] - row[0][0] > LEAF:
        row = [part for a, e in row for part in ((a, (a + e) // 2), ((a + e) // 2, e))]
        spans += row
    return spans


def grown(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of vectors in the tree's leaves, and centres and radii of its balls."""
    order, spans = np.arange(len(v)), halves(len(v))
    centre, radius = np.zeros((len(spans), v.shape[1])), np.zeros(len(spans))
    for i, (a, e) in enumerate(spans):
        own = v[order[a:e]]
        if not len(own):
            continue
        centre[i] = own.mean(axis=0)
        off = ((own - centre[i]) ** 2).sum(axis=1)
        radius[i] = np.sqrt(off.max()) * (1 + 1e-9)
        if 2 * i + 2 < len(spans):
            far = own[off.argmax()]
            other = own[((own - far) ** 2).sum(axis=1).argmax()]
            order[a:e] = order[a:e][np.argsort(own @ (other - far), kind="stable")]
    return order, centre, radius


class Tree:
    def __init__(self, row: dict, width: int):
        n, w = row["n"], row["width"]
        whole = lambda x: padded(np.frombuffer(row[x], np.float64).reshape(-1, w), width)
        self.v, self.centre, self.radius = whole("vectors"), whole("centres"), np.frombuffer(row["radii"], np.float64)
        self.id, self.uid, self.label = np.frombuffer(row["ids"], np.int64), row["uid"] + np.arange(n), row["label"]
        self.spans = halves(n)

    def bounds(self, i: int, q: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c = self.centre[i]
        mid, reach = q @ c, norm * self.radius[i]
        reach = reach + 1e-9 * (norm * np.sqrt(c @ c) + reach) + 1e-6
        return np.clip(mid - reach, LOWEST, HIGHEST), np.clip(mid + reach, LOWEST, HIGHEST)  # as scores are

    def descend(self, q: np.ndarray, norm: np.ndarray, rows: np.ndarray, wanted, take) -> int:
        """Calls take(rows, leaf's place, scores) where wanted(rows, low, high) holds, the child
        with the higher bounds first; returns how many scores were computed."""
        read, stack = 0, [(0, rows, *self.bounds(0, q[rows], norm[rows]))]
        while stack:
            i, rows, low, high = stack.pop()
            open_ = wanted(rows, low, high)  # anew, as the kth has risen meanwhile
            rows, low, high = rows[open_], low[open_], high[open_]
            if not len(rows):
                continue
            if 2 * i + 2 >= len(self.spans):
                at = slice(*self.spans[i])
                read += len(rows) * (at.stop - at.start)
                take(rows, at, scores(q[rows], self.v[at]))
                continue
            children = []
            for k in (2 * i + 1, 2 * i + 2):
                a, b = self.bounds(k, q[rows], norm[rows])
                children.append((k, rows, np.maximum(a, low), np.minimum(b, high)))
            stack += sorted(children, key=lambda c: c[3].mean())
        return read


def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    top = max(float(np.abs(q).max(initial=0)), 1.0) * max(float(np.abs(v).max(initial=0)), 1.0)
    return (q @ v.T).astype(np.int64) if top * max(q.shape[1], 1) < 2.0**53 else exact(q[:, None, :], v[None, :, :])


class Anchors:
    """Anchors of a group: uids, labels, vectors, and what was found for them."""

    def __init__(self, held: list[dict], width: int):
        self.uid = np.array([r["uid"] for r in held], np.int64)
        self.label = np.array([r["label"] for r in held], np.int64)
        self.q = np.concatenate([padded(np.frombuffer(r["vectors"], np.float64).reshape(1, -1), width) for r in held])
        self.norm = np.sqrt((self.q**2).sum(axis=1))


def best_of(anchors: Anchors, tree: Tree, best: Best) -> int:
    """The own label's rows."""

    def take(rows, at, score):
        valid = (tree.uid[at][None, :] != anchors.uid[rows][:, None]) & (score >= best.kth()[rows][:, None])
        some = valid.any(axis=1)
        if some.any():
            best.add(rows[some], score[some], np.broadcast_to(tree.id[at], score[some].shape), valid[some])

    wanted = lambda rows, low, high: high >= best.kth()[rows]
    mine = np.nonzero(anchors.label == tree.label)[0]
    return sum(tree.descend(anchors.q, anchors.norm, mine[a : a + TOGETHER], wanted, take) for a in range(0, len(mine), TOGETHER))


def best_in_windows(anchors: Anchors, tree: Tree, best: Best, low: np.ndarray, high: np.ndarray) -> int:
    """Other labels' rows; low and high: a column a window, which is row `anchor * windows + j` of best."""
    windows = low.shape[1]

    def floors(rows):  # what a score must reach, a column a window
        return np.maximum(low[rows], best.kth().reshape(-1, windows)[rows])

    def take(rows, at, score):
        for j in range(windows):
            valid = (score >= floors(rows)[:, j][:, None]) & (score <= high[rows, j][:, None])
            some = valid.any(axis=1)
            if some.any():
                best.add(rows[some] * windows + j, score[some], np.broadcast_to(tree.id[at], score[some].shape), valid[some])

    wanted = lambda rows, a, b: ((b[:, None] >= floors(rows)) & (a[:, None] <= high[rows])).any(axis=1)
    others = np.nonzero(anchors.label != tree.label)[0]
    return sum(tree.descend(anchors.q, anchors.norm, others[a : a + TOGETHER], wanted, take) for a in range(0, len(others), TOGETHER))


TREES = pa.schema([("uid", pa.int64()), ("n", pa.int32()), ("width", pa.int32()), ("label", pa.int64())] + [(k, pa.binary()) for k in ("ids", "asks", "vectors", "centres", "radii")])
TREES_SQL = "uid long, n int, width int, label long, ids binary, asks binary, vectors binary, centres binary, radii binary"


def plant(scale: float):
    """Rows (id, vector, label, asks) to trees, each of one label; uid numbers all vectors."""

    def run(batches):
        at = TaskContext.get().partitionId() << 40
        held: dict[int, list] = {}
        size: dict[int, int] = {}

        def tree(label):
            nonlocal at
            parts = held.pop(label)
            del size[label]
            width = max(v.shape[1] for _, _, v in parts)
            ids, asks, v = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([padded(p[2], width) for p in parts])
            for a in range(0, len(v), TREE):
                order, centre, radius = grown(v[a : a + TREE])
                order = order + a
                row = {"uid": [at], "n": [len(order)], "width": [width], "label": [label]}
                at += len(order)
                yield pa.RecordBatch.from_pydict(row | {k: [x.tobytes()] for k, x in (("ids", ids[order]), ("asks", asks[order]), ("vectors", v[order]), ("centres", centre), ("radii", radius))}, schema=TREES)

        for b in batches:
            b = b.filter(pc.and_(b.column(0).is_valid(), b.column(2).is_valid()))
            rows, v = integers(b.column(1), scale)
            take = pa.array(rows)
            ids, labels = (np.asarray(b.column(i).take(take), dtype=np.int64) for i in (0, 2))
            asks = np.asarray(pc.fill_null(b.column(3).take(take), False)).astype(np.uint8)
            for label in np.unique(labels).tolist():
                own = labels == label
                held.setdefault(label, []).append((ids[own], asks[own], v[own]))
                size[label] = size.get(label, 0) + int(own.sum())
                if size[label] >= TREE:
                    yield from tree(label)
            while sum(size.values()) > HELD:
                yield from tree(max(size, key=size.get))
        for label in sorted(held):
            yield from tree(label)

    return run


ANCHORS_SQL = "uid long, id long, label long, width int, vectors binary"


def asking(batches):
    """One row an anchor."""
    for b in batches:
        for row in b.to_pylist():
            at = np.nonzero(np.frombuffer(row["asks"], np.uint8))[0]
            v = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], row["width"])[at]
            k, ids = len(at), np.frombuffer(row["ids"], np.int64)[at]
            if k:
                yield pa.RecordBatch.from_arrays([pa.array(row["uid"] + at, pa.int64()), pa.array(ids), pa.array([row["label"]] * k, pa.int64()), pa.array([row["width"]] * k, pa.int32()), pa.array([x.tobytes() for x in v], pa.binary())], names=["uid", "id", "label", "width", "vectors"])


def bounds_of(score: int, low: int, high: int) -> tuple[int, int]:
    """The whole scores n with low * score <= 100 * n <= high * score."""
    held = lambda x: max(LOWEST, min(HIGHEST, x))
    return held(-(-low * score // 100)), held(high * score // 100)


def search(k: int, low: int | None = None, high: int | None = None):
    """Rows of a grid sorted by g, h and kind: a group's anchors (kind 0), then its trees. With
    low and high the anchors' window scores are given, else the own label's best are found."""
    names = ["uid", "window", "vec_id", "score"]

    def run(batches):
        group, held, anchors, best, spans, width = None, [], None, None, None, 0

        def found():
            if best is None:
                return
            row, place = np.nonzero(best.full)
            each = 1 if spans is None else spans[0].shape[1]
            cols = [anchors.uid[row // each], row % each, best.id[row, place], best.score[row, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

        for b in batches:
            for row in b.to_pylist():
                if (row["g"], row["h"], row["owner"]) != group:
                    yield from found()
                    group, held, anchors, best = (row["g"], row["h"], row["owner"]), [], None, None
                if row["kind"] == 0:
                    held.append(row)
                    continue
                if held and (anchors is None or row["width"] > width):
                    old, width = best, max(row["width"], *[r["width"] for r in held])
                    anchors = Anchors(held, width)
                    if low is not None:
                        most = max(len(r["windows"]) for r in held)
                        spans = [np.full((len(held), most), x, np.int64) for x in (HIGHEST, LOWEST)]
                        for i, r in enumerate(held):
                            for j, s in enumerate(r["windows"]):
                                spans[0][i, j], spans[1][i, j] = bounds_of(s, low, high)
                    best = old or Best(len(held) * (spans[0].shape[1] if spans else 1), k)
                if anchors is None:
                    continue  # no anchors here
                tree = Tree(row, width)
                if spans is None:
                    best_of(anchors, tree, best)
                else:
                    best_in_windows(anchors, tree, best, *spans)
        yield from found()

    return run


FOUND = "uid long, window long, vec_id long, score long"
GRID = ["g", "h", "owner", "kind", "uid", "n", "width", "label", "ids", "vectors", "centres", "radii", "windows"]


def met(anchors: DataFrame, trees: DataFrame, step, parts: int) -> DataFrame:
    """Searches each group of trees for each group of anchors. Both have owner (a label, or 0 for
    all), gs and hs: how many groups the owner's trees and anchors are dealt to."""
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(name)
    own = lambda n, name: F.pmod(F.xxhash64("uid"), F.col(n)).cast("int").alias(name)
    none = lambda *names: [F.lit(None).cast("binary").alias(c) for c in names]
    left = anchors.select(own("hs", "h"), "owner", F.lit(0).alias("kind"), "uid", F.lit(1).alias("n"), "width", "label", *none("ids"), "vectors", *none("centres", "radii"), "windows", every("gs", "g")).select(GRID)
    right = trees.select(own("gs", "g"), "owner", F.lit(1).alias("kind"), "uid", "n", "width", "label", "ids", "vectors", "centres", "radii", F.lit(None).cast("array<bigint>").alias("windows"), every("hs", "h")).select(GRID)
    grid = left.union(right).repartition(parts, "g", "h", "owner").sortWithinPartitions("g", "h", "owner", "kind")
    return grid.mapInArrow(step, FOUND)


def first_rows(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("uid", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, asks: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    asks: a condition on the id column, under its name: which rows are anchors. Negatives of a
    positive score s have other labels and scores from low to high percent of s.
    """
    spark = rows.sparkSession
    ship(spark)
    picked = pick(rows, id_col, vec_col, label_col)
    picked = picked.select(F.col(id_col).cast("long").alias(id_col), vec_col, F.col(label_col).cast("long").alias(label_col))
    trees = stored(picked.withColumn("_asks", asks).mapInArrow(plant(scale), TREES_SQL), "ball-trees")
    anchors = stored(trees.mapInArrow(asking, ANCHORS_SQL), "ball-anchors")
    cores = spark.sparkContext.defaultParallelism
    bytes_of = lambda df, name: df.groupBy("label").agg(F.sum(F.length("vectors")).alias(name))
    total = lambda df: df.agg(F.coalesce(F.sum(F.length("vectors")), F.lit(0)), F.count("*")).first()
    (given, planted), (asked, _) = total(trees), total(anchors)

    # the own label's best: trees and anchors of a label are dealt by its share of all bytes
    whole = lambda x: F.greatest(F.lit(1), F.ceil(x)).cast("int")
    dealt = bytes_of(trees, "tree_bytes").join(bytes_of(anchors, "anchor_bytes").withColumnRenamed("label", "asked_label"), F.col("label") == F.col("asked_label"))
    share = F.col("tree_bytes") / max(given, 1)
    dealt = dealt.select(F.col("label").alias("owner"), whole(F.greatest(F.col("tree_bytes") / GROUP_BYTES, F.least(share * cores, share * planted))).alias("gs"), whole(F.col("anchor_bytes") / ANCHOR_BYTES).alias("hs"))
    dealt = stored(dealt, "ball-groups")
    of_label = lambda df: df.join(dealt, F.col("label") == F.col("owner"))
    parts = min(max(cores, -(-given // GROUP_BYTES)), 1 << 15)
    no_windows = F.lit(None).cast("array<bigint>").alias("windows")
    near = first_rows(met(of_label(anchors).select("*", no_windows), of_label(trees), search(positives), parts), positives)
    near = stored(near.select("uid", (F.col("rank") - 1).cast("long").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "ball-positives")

    # windows: all trees, as labels differ
    gs = max(1, -(-given // GROUP_BYTES), min(planted, cores))
    hs = max(1, -(-asked // ANCHOR_BYTES))
    everything = lambda df: df.select("*", F.lit(0).cast("long").alias("owner"), F.lit(gs).alias("gs"), F.lit(hs).alias("hs"))
    windows = near.groupBy(F.col("uid").alias("of")).agg(F.transform(F.sort_array(F.collect_list(F.struct("window", "positive_score"))), lambda x: x["positive_score"]).alias("windows"))
    ready = stored(anchors.join(windows, F.col("uid") == F.col("of")).drop("of"), "ball-windows")
    far = first_rows(met(everything(ready), everything(trees), search(negatives, low, high), min(gs * hs, 1 << 15)), negatives)
    named = near.join(anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id")), F.col("uid") == F.col("anchor")).drop("anchor")
    out = far.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(named, ["uid", "window"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS rid, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.rid, a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.rid <> a.rid
), p AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS nth FROM s WHERE same QUALIFY nth <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.rid, p.nth ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
    s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.rid = p.rid AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT * FROM n WHERE rank <= 5
"""


def op13(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(moved, F.col("vec_id") % 100 == 0)
