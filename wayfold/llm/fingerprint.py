"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs are its lines, cut further at sentence ends; each distinct one gives a
64-bit digest. A sketch has three equal tables of cells; a digest falls into one cell of
each, which keeps how many fell there, the exclusive or of the digests and that of their
checks. Subtracting two sketches cell by cell leaves only what differs; a cell that holds
one digest gives it away, and taking it out of its other cells frees more (peeling).
Where cells remain, both texts are sketched anew with GROW times the cells and other hashes,
until every difference is peeled.

All of it is DataFrame work. Documents lie in blocks of neighbouring ids, each wholly in
one partition: the next document, sketches, differences and every round of peeling need
no further shuffle, and no text moves more than once. There are as many blocks as the text
needs; null ids, and an id that very many rows share, are spread over blocks by a hash of
the text.

sketch_table keeps the cells themselves, and differences subtracts two such tables, of
two versions of a collection say, that were made at any time.

Defined results: a null text is empty; null ids come first; rows with equal ids follow in
the order of a hash of their texts; the last row's next is the first, so a single row
is its own next; two texts without paragraphs are alike (1.0).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, shuffle_partitions, stored

TABLES, CELLS, GROW = 3, 64, 8
#: Rounds of peeling, a table each: for all pairs, and for those that are sketched anew.
ROUNDS, MORE_ROUNDS = 9, 12
#: Characters a block has, and paragraph digests a partition of the sketching work, about.
BLOCK_CHARS, DIGESTS = 2_000_000, 150_000
#: Quantiles of the ids that are fetched; more blocks divide their gaps evenly.
QUANTILES = 1024
#: Quantiles that are looked at together.
STEP = 32
#: Blocks whose first rows' ids are sent along to every task at most.
BROADCAST_BLOCKS = 500_000
BREAKS = "\\n|(?<=[.!?])[ \\t\\r]+"


def digests(text):
    parts = F.filter(F.split(text, BREAKS, -1), lambda x: F.length(x) > 0)
    return F.array_distinct(F.transform(parts, lambda x: F.xxhash64(x)))


def blocks(rows: DataFrame, n: int) -> DataFrame:
    return with_blocks(rows, n)(rows)


def with_blocks(keys: DataFrame, n: int) -> Callable[[DataFrame], DataFrame]:
    """What adds a block to rows with doc_id and tie: a step function of these with about equal
    numbers of the keys' rows a block.

    An id that takes up several quantiles is spread by tie, a 64-bit hash; so are null ids.
    """
    coarse = min(n, QUANTILES)
    nulls, total = keys.agg(F.count_if(F.col("doc_id").isNull()), F.count("*")).first()
    quantiles = keys.where("doc_id is not null").select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", [i / coarse for i in range(coarse + 1)], 0.2 / coarse)
    fine, bounds = -(-n // coarse), sorted(set(quantiles))
    times = [quantiles.count(b) for b in bounds]
    share = (F.col("tie") / F.lit(2.0**64) + 0.5) * F.lit(1 - 1e-12)  # from 0 to 1
    apart = lambda k: F.floor(share * k).cast("long")
    of_null = F.lit(-(1 << 40)).cast("long") + apart(F.lit(max(1, -(-n * int(nulls or 0) // max(int(total or 0), 1)))))
    if not bounds:
        return lambda rows: rows.withColumn("block", of_null)
    edges, held, some = (F.array(*[F.lit(x) for x in xs]) for xs in (bounds, [fine * t for t in times], bounds[::STEP]))
    below = lambda among: F.size(F.filter(among, lambda b: b <= F.col("doc_id")))
    before = F.greatest(below(some) - 1, F.lit(0)) * STEP
    at = F.col("_at")
    low, high = F.element_at(edges, F.greatest(at, F.lit(1))), F.element_at(edges, F.least(at + 1, F.lit(len(bounds))))
    inside = F.when((at < 1) | (F.col("_high") <= F.col("_low")), 0).otherwise(F.least(F.floor((F.col("doc_id") - F.col("_low")) / (F.col("_high") - F.col("_low")) * fine), F.lit(fine - 1)))
    # an id with a block of its own: a step before the ids that follow it
    width = fine * (max(times) + 1)
    heavy = (at >= 1) & (F.col("doc_id") == F.col("_low")) & (F.col("_held") > 2 * fine)
    block = F.when(F.col("doc_id").isNull(), of_null).when(heavy, at * width + apart(F.col("_held"))).otherwise(at * width + fine * max(times) + inside)

    def add(rows: DataFrame) -> DataFrame:
        # a column each, so that nothing is searched for twice
        found = rows.withColumn("_before", before)
        found = found.withColumn("_at", F.col("_before") + below(F.slice(edges, F.col("_before") + 1, F.lit(STEP))))
        found = found.withColumns({"_low": low, "_high": high, "_held": F.element_at(held, F.greatest(at, F.lit(1)))})
        return found.withColumn("block", block.cast("long")).drop("_before", "_at", "_low", "_high", "_held")

    return add


def with_next(docs: DataFrame) -> DataFrame:
    """block, rid (place in the block), doc_id, text, next; the block's last row is followed by
    a row without id and next, which stands for the first row of the next block."""
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    # what places a row, without its text, which is read twice more: for first rows, and for all
    keys = stored(rows.select("doc_id", "tie", F.length("text").alias("chars")), "print-keys")
    chars = keys.agg(F.sum("chars")).first()[0] or 0
    placed = with_blocks(keys, max(4 * shuffle_partitions(docs.sparkSession), int(chars // BLOCK_CHARS)))
    rows = placed(rows)
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")
    least = placed(keys).groupBy("block").agg(F.min(order).alias("m")).select(F.col("block").alias("b"), F.col("m.doc_id").alias("least"), F.col("m.tie").alias("least_tie"))
    least = stored(least, "print-firsts")
    small = (lambda df: F.broadcast(df)) if least.count() <= BROADCAST_BLOCKS else (lambda df: df)
    side = small(least)
    first = rows.join(side, (F.col("block") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("least")) & (F.col("tie") == F.col("least_tie"))).groupBy("block").agg(F.min("text").alias("text"))
    by_block = Window.orderBy("b")  # block numbers only; first texts follow by an equal join
    follows = least.select(F.col("b").alias("own"), F.coalesce(F.lead("b").over(by_block), F.first("b").over(by_block)).alias("then"))
    ends = first.join(small(follows), F.col("block") == F.col("then")).select(F.col("own").alias("block"), "text")
    every = rows.select("block", F.lit(0).alias("end"), "doc_id", "tie", "text").union(ends.select("block", F.lit(1), F.lit(None).cast("long"), F.lit(0).cast("long"), "text"))
    w = Window.partitionBy("block").orderBy("end", F.asc_nulls_first("doc_id"), "tie", "text")
    return every.select("block", "end", F.row_number().over(w).alias("rid"), "doc_id", "text", F.lead("text").over(w).alias("next"))


def edited_text():
    """The last floor(n / 2) code points replaced by the first as many of the next text."""
    half = F.floor(F.length("text") / 2).cast("int")
    return F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))


def row(cell, n, key, check):
    return F.struct(cell.cast("int").alias("cell"), n.cast("int").alias("n"), key.alias("key"), check.alias("chk"))


def check_of(key, cells: int):
    return F.xxhash64(key, F.lit(77), F.lit(cells))


def cell_of(key, table: int, cells: int):
    return F.pmod(F.xxhash64(key, F.lit(table), F.lit(cells)), F.lit(cells)).cast("int") + table * cells


def sketches(rows: DataFrame, cells: int) -> DataFrame:
    """block, rid, version (0: text, 1: edited), cell, n, key, chk of the cells that hold something."""
    both = F.array(F.struct(F.lit(0).alias("version"), F.col("own").alias("keys")), F.struct(F.lit(1).alias("version"), F.col("edited").alias("keys")))
    d = rows.select("block", "rid", F.explode(both).alias("v")).select("block", "rid", "v.version", F.explode("v.keys").alias("key"))
    d = d.withColumn("chk", check_of(F.col("key"), cells)).select("*", F.explode(F.array(*[cell_of(F.col("key"), t, cells) for t in range(TABLES)])).alias("cell"))
    return d.groupBy("block", "rid", "version", "cell").agg(F.count("*").cast("int").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("chk").alias("chk"))


PAIR_EDITED, PAIR_NEXT, PRINT = 0, 1, 2
PLACE = ["block", "rid", "pair"]


def subtracted(cells: DataFrame, prints: bool) -> DataFrame:
    """block, rid, pair, cell, n, key, chk: the pairs' differing cells.

    Pair 0 is text minus edited, pair 1 text minus the next row's text. With prints, pairs
    2 and 3 hold digests of the two sketches themselves, in a cell -1.
    """
    own = F.col("version") == 0
    out = lambda rid, pair, sign: F.struct(rid.alias("rid"), F.lit(pair).alias("pair"), F.col("cell").alias("cell"), (F.col("n") * sign).alias("n"), F.col("key").alias("key"), F.col("chk").alias("chk"))
    mark = F.struct(
        F.col("rid").alias("rid"), (F.col("version") + PRINT).alias("pair"), F.lit(-1).alias("cell"), F.col("n").alias("n"),
        F.xxhash64("cell", "n", "key", "chk").alias("key"), F.xxhash64("chk", "key", "n", "cell").alias("chk"),
    )
    marks = [mark] if prints else []
    rows = F.when(own, F.array(out(F.col("rid"), 0, 1), out(F.col("rid"), 1, 1), out(F.col("rid") - 1, 1, -1), *marks)).otherwise(F.array(out(F.col("rid"), 0, -1), *marks))
    d = cells.select("block", F.explode(rows).alias("x")).select("block", "x.*")
    return summed(d)


def summed(d: DataFrame, by: list[str] = PLACE) -> DataFrame:
    d = d.groupBy(*by, "cell").agg(F.sum("n").cast("int").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("chk").alias("chk"))
    return d.where("cell < 0 or n <> 0 or key <> 0 or chk <> 0")


def peeled(d: DataFrame, cells: int, rounds: int = MORE_ROUNDS, by: list[str] = PLACE) -> DataFrame:
    """Rounds of peeling, a table at a time, so that no digest is found twice in a round.

    Cell -1 of a pair counts the digests that were recovered.
    """
    for k in range(rounds):
        t = k % TABLES
        key, pure = F.col("key"), F.floor(F.col("cell") / cells) == t
        pure = (F.col("pair") < PRINT) & (F.col("cell") >= 0) & pure & (F.abs("n") == 1) & (F.col("chk") == check_of(key, cells)) & (F.col("cell") == cell_of(key, t, cells))
        taken = [row(cell_of(key, o, cells), -F.col("n"), key, F.col("chk")) for o in range(TABLES) if o != t]
        found = row(F.lit(-1), F.lit(1), F.lit(0).cast("long"), F.lit(0).cast("long"))
        same = row(F.col("cell"), F.col("n"), key, F.col("chk"))
        d = summed(d.select(*by, F.explode(F.when(pure, F.array(*taken, found)).otherwise(F.array(same))).alias("x")).select(*by, "x.*"), by)
    return d


def outcome(d: DataFrame, by: list[str] = PLACE) -> DataFrame:
    """block, rid, pair, found, left (cells that still hold something), key, chk."""
    last = F.col("cell") < 0
    return d.groupBy(*by).agg(
        F.sum(F.when(last, F.col("n")).otherwise(0)).alias("found"), F.sum(F.when(last, 0).otherwise(1)).alias("left"),
        F.bit_xor(F.when(last, F.col("key"))).alias("key"), F.bit_xor(F.when(last, F.col("chk"))).alias("chk"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    rows = with_next(docs).withColumn("new", edited_text())
    rows = rows.select(
        "block", "rid", "end", "doc_id", F.length("text").cast("long").alias("n_chars"), F.when(F.col("end") == 0, F.sha2("new", 256)).alias("edited_sha256"),
        digests(F.col("text")).alias("own"), F.when(F.col("end") == 0, digests(F.col("new"))).otherwise(F.array().cast("array<long>")).alias("edited"),
    )
    rows = stored(rows, "print-rows")
    total = rows.agg(F.sum(F.size("own") + F.size("edited"))).first()[0] or 0
    parts = max(shuffle_partitions(spark), int(total // DIGESTS))
    placed = rows.select("block", "rid", "own", "edited").repartition(parts, "block")
    level = stored(outcome(peeled(subtracted(sketches(placed, CELLS), prints=True), CELLS, ROUNDS)), "print-pairs")
    prints = level.where(F.col("pair") >= PRINT)
    pairs = level.where(F.col("pair") < PRINT).select("block", "rid", "pair", "found", "left")
    done, failed = [pairs.where("left = 0").select("block", "rid", "pair", "found")], pairs.where("left > 0").select("block", "rid", "pair")
    cells = CELLS
    while not failed.isEmpty():
        cells *= GROW
        # both texts of a failed pair: its row, and for the next text the row after
        wanted = failed.select("block", "rid").union(failed.where(F.col("pair") == PAIR_NEXT).select("block", F.col("rid") + 1)).distinct()
        some = rows.select("block", "rid", "own", "edited").join(wanted, ["block", "rid"], "left_semi")
        some = some.repartition(parts, "block")
        again = outcome(peeled(subtracted(sketches(some, cells), prints=False), cells)).select("block", "rid", "pair", "found", "left")
        level = stored(failed.join(again, ["block", "rid", "pair"], "left").fillna(0, ["found", "left"]), "print-pairs")
        done.append(level.where("left = 0").select("block", "rid", "pair", "found"))
        failed = level.where("left > 0").select("block", "rid", "pair")
    results = done[0]
    for x in done[1:]:
        results = results.union(x)
    return described(rows, results, prints)


def sketch_table(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """doc_id, n_digests, cells: each document's sketch itself, to be stored and subtracted later.

    Rows of one id are one document, whose paragraphs are those of all its rows; a null id is
    an id like any other."""
    rows = pick(docs, "doc_id", "text").select("doc_id", F.explode_outer(digests(F.coalesce("text", F.lit("")))).alias("key")).distinct()
    d = rows.withColumn("chk", check_of(F.col("key"), cells)).select("*", F.explode(F.array(*[cell_of(F.col("key"), t, cells) for t in range(TABLES)])).alias("cell"))
    held = d.groupBy("doc_id", "cell").agg(F.count("key").cast("int").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("chk").alias("chk"))
    one = F.sort_array(F.collect_list(F.when(F.col("n") > 0, F.struct("cell", "n", "key", "chk"))))
    return held.groupBy("doc_id").agg((F.sum("n") / TABLES).cast("long").alias("n_digests"), one.alias("cells"))


def differences(before: DataFrame, after: DataFrame, cells: int = CELLS) -> DataFrame:
    """doc_id, found, left of two sketch tables: how many digests differ, and the cells that are
    left where the sketches are too small for them (make larger ones then). An id that only one
    table has is held against an empty text."""
    side = lambda df, sign: df.select("doc_id", F.explode("cells").alias("c")).select("doc_id", "c.cell", (F.col("c.n") * sign).alias("n"), "c.key", "c.chk")
    every = side(before, -1).union(side(after, 1))
    every = every.withColumn("pair", F.lit(0))
    by = ["doc_id", "pair"]
    out = outcome(peeled(summed(every, by), cells, by=by), by).select(F.col("doc_id").alias("_id"), "found", "left")
    ids = before.select("doc_id").union(after.select("doc_id")).distinct()
    named = ids.join(out, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return named.select("doc_id", F.coalesce("found", F.lit(0)).cast("long").alias("found"), F.coalesce("left", F.lit(0)).cast("long").alias("left"))


def described(rows: DataFrame, results: DataFrame, prints: DataFrame) -> DataFrame:
    """One row a document from its pairs' differences and its sketches' digests."""
    tall = results.select(
        "block", "rid", "pair", "found", F.lit(None).cast("long").alias("key"), F.lit(None).cast("long").alias("chk"),
    ).union(prints.select("block", "rid", "pair", "found", "key", "chk"))
    of = lambda p, c: F.max(F.when(F.col("pair") == p, F.col(c)))
    hexed = lambda c: F.lpad(F.lower(F.hex(F.coalesce(c, F.lit(0).cast("long")))), 16, "0")
    wide = tall.groupBy("block", "rid").agg(
        of(0, "found").alias("d0"), of(1, "found").alias("d1"), of(2, "key").alias("k2"), of(2, "chk").alias("c2"), of(3, "key").alias("k3"),
        of(3, "chk").alias("c3"),
    )
    sizes = rows.select("block", "rid", "end", "doc_id", "n_chars", "edited_sha256", F.size("own").alias("a"), F.size("edited").alias("b"))
    after = rows.select("block", (F.col("rid") - 1).alias("rid"), F.size("own").alias("c"))
    j = sizes.where("end = 0").join(after, ["block", "rid"]).join(wide, ["block", "rid"], "left")

    def alike(x, y, d):
        both, d = (F.col(x) + F.col(y)).cast("double"), F.coalesce(F.col(d), F.lit(0)).cast("double")
        return F.when(both + d > 0, (both - d) / (both + d)).otherwise(F.lit(1.0))

    return j.select(
        "doc_id", "n_chars", "edited_sha256", F.concat(hexed(F.col("k2")), hexed(F.col("c2"))).alias("fingerprint"),
        F.concat(hexed(F.col("k3")), hexed(F.col("c3"))).alias("edited_fingerprint"), alike("a", "b", "d0").alias("near_edited"),
        alike("a", "c", "d1").alias("near_next"),
    )


LIKENESS_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS rn, count(*) OVER () AS n FROM documents
), e AS (
  SELECT a.doc_id, a.t, b.t AS nt, substr(a.t, 1, length(a.t) - length(a.t) // 2) || substr(b.t, 1, length(a.t) // 2) AS et FROM d a JOIN d b ON b.rn = a.rn % a.n + 1
), p AS (
  SELECT *, list_distinct(list_filter(string_split(regexp_replace(t, '([.!?])[ \t\r]+', '\1' || chr(10), 'g'), chr(10)), lambda x: x <> '')) AS a,
    list_distinct(list_filter(string_split(regexp_replace(et, '([.!?])[ \t\r]+', '\1' || chr(10), 'g'), chr(10)), lambda x: x <> '')) AS b,
    list_distinct(list_filter(string_split(regexp_replace(nt, '([.!?])[ \t\r]+', '\1' || chr(10), 'g'), chr(10)), lambda x: x <> '')) AS c FROM e
), s AS (
  SELECT *, len(list_intersect(a, b)) AS ab, len(list_intersect(a, c)) AS ac FROM p
)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(et) AS edited_sha256,
  CASE WHEN len(a) + len(b) = 0 THEN 1.0::DOUBLE ELSE ab / (len(a) + len(b) - ab)::DOUBLE END AS near_edited,
  CASE WHEN len(a) + len(c) = 0 THEN 1.0::DOUBLE ELSE ac / (len(a) + len(c) - ac)::DOUBLE END AS near_next
FROM s
"""
