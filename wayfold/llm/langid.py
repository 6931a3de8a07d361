"""Language identification by prediction with partial matching over bytes.

Each language has a tree of byte contexts of up to ORDER bytes. In a context seen N times with
D different next bytes, a byte seen n times costs -log2(n / (N + D)) bits; any other costs the
escape, D / (N + D), and its price in the context one byte shorter, where the bytes that the
longer context knows are excluded and the rest shares their probability. So every context holds
a whole distribution, and a text's code length under a language is a sum over all its bytes. A
context is a node of the tree from its second occurrence on: depth follows the statistics. The
shortest code wins.

Statistics are counted by Spark over a bounded sample and frozen: at most SAMPLE_DOCS documents,
as many from each language, of a longer one SAMPLE_CHARS characters in a row from a place that a
hash of its text chooses. That bounds the broadcast trees; classification has no bound. They
hold, for each gram that any language knows, the finished prices of all languages, so a byte
takes one look into a hash table and shorter contexts only where no language knows the longer.
Prices are whole numbers of 1/65536 bit: sums don't depend on batches.

Defined results: a text that is null or has no letter is `und` with score 0, as are all where
nothing could be learned; of equally short codes the language that sorts first wins. Rows with a
null doc_id are never learned from and are not held out. Rows that share an id and a language
are learned from once, and all are classified. The score is the language's share if all were as
likely beforehand: 2^-length over the sum of these.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, ship, text_chunks
from .quality import held_out
from .shingles import PIECE

#: Bound of the sample that trees are grown from, and the longest context in bytes.
SAMPLE_DOCS, SAMPLE_CHARS, ORDER = 2000, 2000, 4
#: Occurrences from which a context is a node.
LEAST = 2
#: Prices are in units of 1 / UNIT bit; a byte takes BITS bits of a key, 0 stands for none; bytes priced at once.
UNIT, BITS, AT_ONCE = 1 << 16, 9, 1 << 16
UNKNOWN = "und"


def codes(data: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """Of each byte: itself in the low bits of a key, the byte before it above, and so on; bytes
    before a text's start are 0."""
    code = data.astype(np.uint64) + np.uint64(1)
    key = code.copy()
    for j in range(1, order + 1):
        if j >= len(code):
            break
        before = code[:-j] << np.uint64(BITS * j)
        for t in range(j):
            at = starts + t - j
            before[at[(at >= 0) & (at < len(before))]] = 0
        key[j:] |= before
    return key


def masked(key: np.ndarray, n: int) -> np.ndarray:
    return key & np.uint64((1 << (BITS * n)) - 1)


def grams(order: int):
    """Rows (lang, part) to counts of grams: lang, depth (bytes of context), gram, n."""
    schema = pa.schema([("lang", pa.string()), ("depth", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for b in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(part.encode())
            for lang, parts in by_lang.items():
                size = np.array([len(p) for p in parts])
                starts = np.cumsum(size) - size
                key = codes(np.frombuffer(b"".join(parts), np.uint8), starts, order)
                for depth in range(order + 1):
                    whole = key if not depth else key[key >> np.uint64(BITS * depth) > 0]  # with a context that long
                    gram, n = np.unique(masked(whole, depth + 1), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(np.full(len(gram), depth), pa.int32()), pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))], schema=schema)

    return run


class Slots:
    """Rows of keys by open addressing; keys are never 0."""

    SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.key, self.row = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        at, left = self.place(keys), np.arange(len(keys))
        while len(left):
            free = left[self.key[at[left]] == 0]
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.key[at[won]], self.row[at[won]] = keys[won], won
            left = left[self.key[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & self.last

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.SPREAD) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, or -1; key 0 has none."""
        at = self.place(keys)
        got = self.key[at]
        row = np.where((got == keys) & (keys != 0), self.row[at], -1)
        left = np.nonzero((got != keys) & (got != 0))[0]
        while len(left):
            at[left] = (at[left] + 1) & self.last
            got = self.key[at[left]]
            same = (got == keys[left]) & (got != 0)
            row[left[same]] = self.row[at[left[same]]]
            left = left[~same & (got != 0)]
        return row


class Trees:
    """The frozen context trees of all languages: prices of grams and of escapes by depth."""

    def __init__(self, langs: list[str], lang: np.ndarray, depth: np.ndarray, gram: np.ndarray, n: np.ndarray, order: int = ORDER):
        self.langs, self.order = langs, order
        self.grams, self.price, self.contexts, self.escape = [], [], [], []
        keys: list[np.ndarray] = []
        bits: list[np.ndarray] = []
        for d in range(order + 1):
            at = depth == d
            key, row = np.unique(gram[at].astype(np.uint64), return_inverse=True)
            count = np.zeros((len(key), len(langs)))
            count[row, lang[at]] = n[at]
            shorter = np.full(count.shape, 8.0) if not d else bits[-1][np.searchsorted(keys[-1], masked(key, d))]
            context, of = np.unique(key >> np.uint64(BITS), return_inverse=True)
            total, kinds, known = (np.zeros((len(context), len(langs))) for _ in range(3))
            np.add.at(total, of, count)
            np.add.at(kinds, of, count > 0)
            np.add.at(known, of, np.where(count > 0, 2.0**-shorter, 0))
            kinds[kinds == 256] = 0  # nothing is left to escape to
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where((total > 0) & (kinds > 0), -np.log2(kinds / (total + kinds) / np.maximum(1 - known, 1e-12)), 0.0)
                here = -np.log2(count / (total + kinds)[of])
            keys.append(key)
            bits.append(np.where(count > 0, here, escape[of] + shorter))
            whole = lambda x: np.rint(x * UNIT).astype(np.int32)
            self.grams.append(Slots(key))
            self.price.append(whole(bits[-1]))
            self.contexts.append(Slots(context) if d else None)
            self.escape.append(whole(escape))
        self.rows = sum(map(len, keys))

    def prices(self, key: np.ndarray) -> np.ndarray:
        """Prices of bytes, given with what is before them, under each language."""
        out = np.zeros((len(key), len(self.langs)), np.int64)
        left = np.arange(len(key))
        for d in range(self.order, -1, -1):
            part = masked(key[left], d + 1)
            row = self.grams[d].find(part)
            hit = row >= 0
            out[left[hit]] += self.price[d][row[hit]]
            left, part = left[~hit], part[~hit]
            if not len(left):
                return out
            if d:
                row = self.contexts[d].find(part >> np.uint64(BITS))
                out[left[row >= 0]] += self.escape[d][row[row >= 0]]
            else:
                out[left] += self.escape[0][0] + 8 * UNIT
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths of texts, a column a language."""
        size = np.array([len(t) for t in texts], np.int64)
        ends, data = np.cumsum(size), np.frombuffer(b"".join(texts), np.uint8)
        starts, total = ends - size, np.zeros((len(texts), len(self.langs)), np.int64)
        for a in range(0, len(data), AT_ONCE):  # with the bytes before it, for their contexts
            back = min(a, self.order)
            key = codes(data[a - back : a + AT_ONCE], starts[(starts >= a - back) & (starts < a + AT_ONCE)] - (a - back), self.order)[back:]
            price = self.prices(key)
            run = np.concatenate([np.zeros((1, len(self.langs)), np.int64), np.cumsum(price, axis=0)])
            total += run[np.clip(ends - a, 0, len(key))] - run[np.clip(starts - a, 0, len(key))]
        return total

    def told(self, texts: list[str], letters: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        length = self.lengths([(t if ok else "").encode() for t, ok in zip(texts, letters, strict=True)])
        best = length.argmin(axis=1)
        more = (length - length[np.arange(len(texts)), best][:, None]) / UNIT
        share = 1 / np.exp2(-np.minimum(more, 1000)).sum(axis=1)
        return [self.langs[i] if ok else UNKNOWN for i, ok in zip(best.tolist(), letters, strict=True)], np.where(letters, share, 0)


def sample_of(docs: DataFrame, most: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """lang, part: the texts that are learned from, at most `most` in all, and chars of each."""
    rows = pick(docs, "doc_id", "text", "lang").where("doc_id is not null and lang is not null").where(~held_out(F.col("doc_id")))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    each = max(1, most // max(1, len(counts)))
    shares = rows.sparkSession.createDataFrame([(k, min(1.0, 2.0 * each / n)) for k, n in counts.items()], "of string, share double")
    draw = F.xxhash64(F.lit("language"), "doc_id")
    # about twice as many as are wanted, before they meet in one group a language
    drawn = rows.join(F.broadcast(shares), F.col("lang") == F.col("of")).where(F.pmod(draw, F.lit(1 << 30)) < F.col("share") * (1 << 30)).select("lang", "doc_id").distinct()
    first = Window.partitionBy("lang").orderBy(draw, "doc_id")
    chosen = drawn.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= each).select("lang", "doc_id").collect()
    ids = rows.sparkSession.createDataFrame(chosen, "a_lang string, an_id long")
    texts = rows.where("text is not null").join(F.broadcast(ids), (F.col("lang") == F.col("a_lang")) & (F.col("doc_id") == F.col("an_id")))
    start = F.pmod(F.xxhash64("text"), F.greatest(F.lit(1), F.length("text") - chars + 1)).cast("int") + 1
    return texts.groupBy("lang", "doc_id").agg(F.min(F.substring("text", start, F.lit(chars))).alias("part")).select("lang", "part")


def grow(docs: DataFrame, most: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS, order: int = ORDER) -> Trees:
    """Trees from the sample: grams are counted by Spark, rare contexts left out there."""
    ship(docs.sparkSession)
    counted = sample_of(docs, most, chars).mapInArrow(grams(order), "lang string, depth int, gram long, n long").groupBy("lang", "depth", "gram").agg(F.sum("n").alias("n"))
    context = Window.partitionBy("lang", "depth", F.shiftright("gram", BITS))  # at most 256 rows
    kept = counted.withColumn("seen", F.sum("n").over(context)).where((F.col("seen") >= LEAST) | (F.col("depth") == 0))
    t = kept.select("lang", F.col("depth").cast("long").alias("depth"), "gram", "n").toArrow()
    langs = sorted(set(t["lang"].to_pylist()))
    number = np.asarray(pc.index_in(t["lang"], pa.array(langs, pa.string())).combine_chunks(), dtype=np.int64) if len(t) else np.empty(0, np.int64)
    return Trees(langs, number, *[np.asarray(t[c].combine_chunks(), dtype=np.int64) if len(t) else np.empty(0, np.int64) for c in ("depth", "gram", "n")], order)


def classify(trees):
    """Rows (doc_id, text, letter) to doc_id, lang_pred, score; trees: a broadcast Trees."""

    def run(batches):
        for b in text_chunks(batches, PIECE):
            texts = [t or "" for t in b.column(1).to_pylist()]
            lang, score = trees.value.told(texts, np.asarray(b.column(2), dtype=bool))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return run


def languages(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(trees or grow(docs))
    rows = pick(docs, "doc_id", "text").withColumn("letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    told = rows.mapInArrow(classify(sent), "doc_id long, lang_pred string, score double")
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
