"""Near-duplicate documents by MinHash: one permutation, optimal densification, star edges.

Each distinct word sequence, told by its SHA-256, is one node (exact copies never meet each
other). Its shingles are hashed once; the top bits choose one of BINS bins, which keep their
least hash. An empty bin takes the value of the bin that a second hash points to, tried again
until that one is filled. BINS // r bands of r bins are bucketed, r being the largest
that misses a pair at the threshold with a probability under MISS.

In every bucket only star edges run from its smallest node, the centre, to the others. A
centre meets its members on the words of their texts, in slices of bounded size that each
carry the centre along; that confirms the star's links. What a star can't see, a link between
two members of which the centre has at most one, follows from how the members differ from
the centre: with R removed and P added shingles,
    |z & x| = |c| - |Rz| - |Rx| + |Rz & Rx| + |Pz & Px|,
so only these short differences are compared, for members without a link to the centre,
and no pair is emitted but links that join something. Within a slice the differences are
exact; across slices they are hashes, and what they propose is confirmed on the words.

Joins meet tables that were written before, so that adaptive execution can split the
partition of a hot centre, bucket, label or copied text.

Defined results: a text without words has an empty set and is linked with nothing;
fewer words than a shingle form one shingle; rows with equal ids are one document; rows
with a null id take their component from their text's other rows, and are kept if there
are none; equal word sequences are always linked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, release, ship, slices, stored, text_chunks
from .shingles import U, exact_sets, mix, sequence, shingle_sets

BINS, MISS = 128, 1e-6
#: Shingles of a slice of a star's members, ROW more for each, and elements of a slice of their
#: differences, about: a slice has some hundred members, beside which the centre counts little.
SLICE, ROW, PART = 150_000, 500, 600_000
#: Bytes of text that are hashed together, about.
TEXT = 1 << 20
#: Ids sent along to every task at most (three numbers each).
BROADCAST_ROWS = 1_000_000


def rows_per_band(percent: int) -> int:
    t = percent / 100
    return max(r for r in range(1, 9) if r == 1 or (1 - t**r) ** (BINS // r) <= MISS)


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The densified bins of each set; sets are ascending runs of counts hashes. Not for empty sets."""
    n = len(counts)
    owner = np.repeat(np.arange(n), counts)
    shift = U(64 - (BINS.bit_length() - 1))
    at = owner * BINS + (hashes >> shift).astype(np.int64)
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1]
    sig = np.zeros(n * BINS, U)
    full = np.zeros(n * BINS, bool)
    sig[at[first]], full[at[first]] = hashes[first], True
    empty = np.nonzero(~full)[0]
    empty = empty[counts[empty // BINS] > 0]
    attempt = 0
    while len(empty):
        attempt += 1
        probe = mix((empty % BINS).astype(U) * U(0x9E3779B97F4A7C15) + U(attempt * 0xD1342543DE82EF95 & (2**64 - 1)))
        source = empty - empty % BINS + (probe >> shift).astype(np.int64)
        found = full[source]
        sig[empty[found]] = sig[source[found]]
        empty = empty[~found]
    return sig.reshape(n, BINS)


def bands(sig: np.ndarray, r: int) -> np.ndarray:
    b = BINS // r
    out = np.full((len(sig), b), 7, U)
    part = sig[:, : b * r].reshape(len(sig), b, r)
    for i in range(r):
        out = mix(out * U(0xA0761D6478BD642F) + part[:, :, i])
    return out


def sketch(width: int, r: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for b in text_chunks(batches, TEXT):
            texts = b.column(1).to_pylist()
            hashes, counts = shingle_sets(texts, width)
            m = bands(signatures(hashes, counts), r).astype(np.int64)
            ends = np.arange(len(counts) + 1, dtype=np.int32) * m.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(m.ravel()))
            keys = [hashlib.sha256(sequence(t)).digest() if n else None for t, n in zip(texts, counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(counts.astype(np.int64)), pa.array(keys, pa.binary()), lists], schema=schema)

    return run


def split_sets(texts: list[str], width: int) -> list[np.ndarray]:
    out = []
    for a, b in slices(np.array([len(t) for t in texts]), TEXT):
        hashes, counts = shingle_sets(texts[a:b], width)
        out += np.split(hashes, np.cumsum(counts)[:-1])
    return out


class Forest:
    """Joined labels; join() tells whether two were apart."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, a: int) -> int:
        while (b := self.up.setdefault(a, a)) != a:
            self.up[a] = self.up[b]
            a = b
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def links_between(queries: list[tuple], targets: list[tuple], n_center: int, percent: int, forest: Forest):
    """Links of queries with targets that join something, found from differences to one centre.

    Both are (node, n, removed, added); a node isn't linked with itself.
    """
    if not queries or not targets:
        return
    nodes = np.array([m[0] for m in targets])
    n = np.array([m[1] for m in targets])
    removed = np.array([len(m[2]) for m in targets])
    added = lambda x: np.asarray(x, np.int64) ^ np.int64(0x5555555555555555)  # noqa: E731  apart from what was removed
    owner = np.concatenate([np.full(len(m[2]) + len(m[3]), i) for i, m in enumerate(targets)])
    element = np.concatenate([x for m in targets for x in (np.asarray(m[2], np.int64), added(m[3]))])
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    for z, z_n, z_removed, z_added in queries:
        mine = np.concatenate([np.asarray(z_removed, np.int64), added(z_added)])
        a, b = np.searchsorted(element, mine, "left"), np.searchsorted(element, mine, "right")
        ends = np.cumsum(b - a)
        rows = owner[np.repeat(a - (ends - (b - a)), b - a) + np.arange(int(ends[-1]) if len(ends) else 0)]
        both = n_center - len(z_removed) - removed + np.bincount(rows, minlength=len(targets))
        hit = (100 * both >= percent * (z_n + n - both)) & (nodes != z)
        for x in nodes[hit].tolist():
            if forest.join(int(z), x):
                yield int(z), x


STAR = "center long, node long, other long, n_center long, n long, linked boolean, removed array<long>, added array<long>"
STAR_ROWS = pa.schema([(k, pa.int64()) for k in ("center", "node", "other", "n_center", "n")] + [("linked", pa.bool_()), ("removed", pa.list_(pa.int64())), ("added", pa.list_(pa.int64()))])


def groups_of(batches, keys: int) -> Iterator[list[tuple]]:
    """Rows of one group after another; they come sorted by their first keys columns."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if held and held[0][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def star(center: int, slices_: int, members: list[tuple[int, str]], width: int, percent: int) -> Iterator[tuple]:
    """Rows of STAR of one slice of a star: its links on the words, and if it isn't the only
    slice, its members' differences to the centre. members: (node, text), the centre among them."""
    members = sorted(set(members))
    nodes = np.array([m[0] for m in members])
    codes, counts = exact_sets([m[1] for m in members], width)
    ends = np.cumsum(counts)
    base = int(np.nonzero(nodes == center)[0][0])
    c = codes[ends[base] - counts[base] : ends[base]]
    owner = np.repeat(np.arange(len(nodes)), counts)
    shared = np.isin(codes, c)
    both = np.bincount(owner[shared], minlength=len(nodes))
    linked = (100 * both >= percent * (len(c) + counts - both)) | (nodes == center)
    forest = Forest()
    for node in nodes[linked & (nodes != center)].tolist():
        forest.join(node, center)
        yield center, node, center, None, None, None, None, None
    if slices_ == 1:
        if len(members) < 3 or linked.all():
            return
        sets = np.split(codes, ends[:-1])
        apart = [(node, len(x), c[~np.isin(c, x, assume_unique=True)], x[~np.isin(x, c, assume_unique=True)]) for node, x in zip(nodes.tolist(), sets, strict=True)]
        for a, b in links_between([m for m, k in zip(apart, linked.tolist(), strict=True) if not k], apart, len(c), percent, forest):
            yield center, a, b, None, None, None, None, None
        return
    hashes = split_sets([m[1] for m in members], width)
    c = hashes[base]
    for i, (node, s) in enumerate(zip(nodes.tolist(), hashes, strict=True)):
        if i != base:
            gone = c[~np.isin(c, s, assume_unique=True)].view(np.int64)
            more = s[~np.isin(s, c, assume_unique=True)].view(np.int64)
            yield center, node, None, len(c), len(s), bool(linked[i]), gone.tolist(), more.tolist()


def star_links(width: int, percent: int):
    """Rows (center, slice, slices, node, text), sorted by center and slice."""

    def run(batches):
        out, seen = [], 0
        for rows in groups_of(text_chunks(batches), 2):
            out += star(rows[0][0], rows[0][2], [r[3:5] for r in rows], width, percent)
            if len(out) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), STAR_ROWS.types, strict=True)], schema=STAR_ROWS)
                out = []
            seen += sum(len(r[4]) for r in rows)
            if seen > 1 << 24:
                seen = 0
                release()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), STAR_ROWS.types, strict=True)], schema=STAR_ROWS)

    return run


def part_links(percent: int):
    """Rows (center, i, j, asks, node, n_center, n, removed, added), sorted by center, i and j."""

    def run(batches):
        for rows in groups_of(batches, 3):
            rows = sorted(rows, key=lambda r: (r[4], r[6], r[7], r[8]))
            of = lambda asks: [(r[4], *r[6:9]) for r in rows if r[3] == asks]
            found = list(links_between(of(True), of(False), rows[0][5], percent, Forest()))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def stars(docs: DataFrame, pairs: DataFrame, sizes: DataFrame, width: int, percent: int) -> DataFrame:
    """Rows of STAR for pairs center, node, in slices of about SLICE."""
    weigh = pairs.join(sizes, "node").groupBy("center").agg(F.ceil(F.sum(F.col("n") + ROW) / F.lit(SLICE)).cast("int").alias("slices"))
    weigh = stored(weigh, "near-slices")
    members = pairs.join(weigh, "center").select("center", "node", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int").alias("slice"), "slices")
    centers = weigh.select("center", F.col("center").alias("node"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "slices")
    wanted = stored(members.union(centers), "near-wanted")
    # few of the documents are in a star: their ids go to the texts if their number is small
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    rows = docs.where("text is not null").join(side, docs["doc_id"] == wanted["node"]).select("center", "slice", "slices", "node", "text")
    return rows.repartition("center", "slice").sortWithinPartitions("center", "slice").mapInArrow(star_links(width, percent), STAR)


def confirmed(docs: DataFrame, pairs: DataFrame, sizes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links a, b of the stars: pairs has center, node."""
    met = stored(stars(docs, pairs, sizes, width, percent), "near-stars")
    links = met.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    # only stars of several slices are left; their members without a link meet all members
    weight = lambda c: F.sum(F.when(c, F.size("removed") + F.size("added") + 1000).otherwise(0)) / F.lit(PART)
    apart = met.where("other is null")
    if apart.isEmpty():
        return links
    parts = apart.groupBy("center").agg(F.ceil(weight(F.lit(True))).cast("int").alias("js"), F.ceil(weight(~F.col("linked"))).cast("int").alias("is")).where("is > 0")
    parts = stored(parts, "near-parts")
    if parts.isEmpty():
        return links
    apart = apart.join(parts, "center").withColumn("own", F.xxhash64("node", "n"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["asks", "node", "n_center", "n", "removed", "added"]
    asked = apart.withColumn("asks", F.lit(False)).withColumn("j", F.pmod("own", "js").cast("int")).select("center", every("is").alias("i"), "j", *cols)
    asking = apart.where("not linked").withColumn("asks", F.lit(True)).withColumn("i", F.pmod("own", "is").cast("int")).select("center", "i", every("js").alias("j"), *cols)
    placed = asked.union(asking).repartition("center", "i", "j").sortWithinPartitions("center", "i", "j")
    found = stored(placed.mapInArrow(part_links(percent), "a long, b long").distinct(), "near-found")
    again = stars(docs, found.select(F.col("a").alias("center"), F.col("b").alias("node")), sizes, width, percent)
    return links.union(again.where("center = other").select("node", "other"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node with an edge.

    Each turn every node takes the least label around it and then that label's label, so
    the number of turns grows with the logarithm of a chain's length.
    """
    both = stored(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "near-labels")
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("m"))
        taken = labels.join(around, labels["node"] == around["a"]).select("node", F.col("component").alias("was"), F.least("component", "m").alias("c"))
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("cc"))
        new = stored(taken.join(jump, "c", "left").select("node", "was", F.coalesce("cc", "c").alias("component")), "near-labels")
        labels = new.select("node", "component")
        if new.where("was <> component").isEmpty():
            return labels


def same_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links a, b between the classes of ids whose rows hold different texts; there are few."""
    ids = rows.where("n_shingles > 0 and doc_id is not null").groupBy(F.col("doc_id").alias("_id"))
    ids = stored(ids.agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").select("_id"), "near-ids")
    if ids.isEmpty():
        return classes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    of = rows.where("n_shingles > 0").join(ids, F.col("doc_id") == F.col("_id")).select("_id", "key").distinct()
    nodes = stored(of.join(classes.select("key", "node"), "key").select("_id", "node").distinct(), "near-same")
    least = stored(nodes.groupBy("_id").agg(F.min("node").alias("a")), "near-least")
    return nodes.join(least, "_id").select("a", F.col("node").alias("b")).where("a <> b")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Documents are linked where 100 * |A & B| >= percent * |A | B| of their sets of
    shingles of width words. Production: width 5 and 80; a contract may ask otherwise.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = pick(docs, "doc_id", "text")
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = stored(docs.mapInArrow(sketch(width, rows_per_band(percent)), "doc_id long, n_shingles long, key binary, bands array<long>"), "near-rows")
    classes = rows.where("key is not null").groupBy("key").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("s"), F.min("doc_id").alias("node"))
    # min of the structs may be that of a null id: its bands are the same, the sequence being the same
    classes = stored(classes.select("key", "node", F.col("s.n_shingles").alias("n"), "s.bands"), "near-classes")
    nodes = classes.where("node is not null")
    sizes = nodes.groupBy("node").agg(F.max("n").alias("n"))
    spread = nodes.select("node", F.posexplode("bands").alias("band", "hash"))
    centers = spread.groupBy("band", "hash").agg(F.min("node").alias("center"), F.count("*").alias("n")).where("n > 1").select("band", "hash", "center")
    centers = stored(centers, "near-centers")
    pairs = stored(spread.join(centers, ["band", "hash"]).where("node <> center").select("center", "node").distinct(), "near-pairs")
    links = stored(confirmed(docs, pairs, sizes, width, percent), "near-links")
    comp = components(spark, links.union(same_ids(rows, classes)))
    named = classes.join(comp, "node", "left").select("key", F.coalesce("component", "node").alias("component"))
    out = rows.select("doc_id", "n_shingles", "key").join(named, "key", "left")
    out = out.withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words
), grams AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), lowest AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN lowest ON a = doc_id
"""
