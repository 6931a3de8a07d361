"""Token counts by source, language and tokenizer version, kept up to date by signed deltas.

A store is a folder in shared storage. A batch of changes (insert, revise, delete) becomes
signed ledger rows: what a changed document counted before with -1, what it counts now
with +1. Their sums by group are the batch's delta, and totals are the sum of the deltas
of all committed batches.

A batch is written under a name of its own and counts once an entry of the log has it. The
entry's number is the length of the log that the batch was computed from, and it is created
only if it is absent; so of two writers one wins, and the other computes its rows anew from
the longer log, or finds its batch there and stops. A batch that failed half-way is in no
entry and can run again; one that was committed is ignored when it comes again.

The ledger is written in buckets by a hash of its key, and a batch reads only the buckets
that its documents fall into. A bucket has about ROWS rows: their number is chosen when the
ledger begins and anew whenever it is rewritten. After COMPACT batches it is rewritten to what
is current, and their deltas to their sum. A pointer then names the entry that replaces all
before it, so a batch reads the entries from there on; whether it is in already is looked up
where the entries are.

Defined results: a document has one count per tokenizer version, an insert of a known one
revises it, a deletion of an unknown one does nothing; of several changes of a document in
a batch one counts (a count before a deletion, the largest first); null ids, sources and
languages are values like any other; a null text has no tokens; no changes give no groups.
"""

from __future__ import annotations

import base64
import json
import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, hadoop_fs, new_folder, pick, ship, shuffle_partitions, stored, text_chunks

KEY = ["doc_id", "tokenizer_version"]
GROUP = ["source", "lang", "tokenizer_version"]
COUNT = ["doc_id", "tokenizer_version", "source", "lang", "n_tokens"]
LEDGER = "doc_id long, tokenizer_version string, source string, lang string, n_tokens long, sign int, bucket int"
DELTA = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"
#: Buckets at least (of older entries: exactly) and at most, rows of one, and batches until a rewrite.
BUCKETS, MOST, ROWS, COMPACT = 64, 1 << 15, 1_000_000, 24


class TokenRollup:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def log(self) -> list[dict]:
        """The entries in their order: batch, folder, and whether it replaces all before it."""
        fs, path = hadoop_fs(self.spark, f"{self.folder}/log")
        if not fs.exists(path) or not fs.listStatus(path):
            return []
        rows = self.spark.read.text(f"{self.folder}/log", wholetext=True).collect()
        return sorted((json.loads(r.value) for r in rows), key=lambda e: e["version"])

    def tail(self) -> list[dict]:
        """The entries from the last one that is known to replace all before it."""
        fs, path = hadoop_fs(self.spark, f"{self.folder}/log")
        if not fs.exists(path):
            return []
        at, marks = hadoop_fs(self.spark, f"{self.folder}/replaced")
        start = max([int(x.getPath().getName()) for x in at.listStatus(marks)], default=0) if at.exists(marks) else 0
        names = sorted(n for x in fs.listStatus(path) if (n := x.getPath().getName())[0] != "_" and n.endswith(".json") and int(n[:12]) >= start)
        if not names:
            return []
        rows = self.spark.read.text([f"{self.folder}/log/{n}" for n in names], wholetext=True).collect()
        return sorted((json.loads(r.value) for r in rows), key=lambda e: e["version"])

    def known(self, batch: str) -> bool:
        """Whether a batch is in; its name is looked for by Spark, however many there are."""
        fs, path = hadoop_fs(self.spark, f"{self.folder}/log")
        if not fs.exists(path) or not fs.listStatus(path):
            return False
        entries = self.spark.read.text(f"{self.folder}/log", wholetext=True)
        return not entries.where(F.get_json_object("value", "$.batch") == batch).isEmpty()

    def buckets(self, log: list[dict]) -> int:
        """How many buckets the live folders have."""
        first = max([k for k, e in enumerate(log) if e["replaces"]], default=0)
        return log[first].get("buckets", BUCKETS) if log else BUCKETS

    def live(self, log: list[dict]) -> list[str]:
        """Names of what counts: from the last entry that replaces the others."""
        first = max([k for k, e in enumerate(log) if e["replaces"]], default=0)
        return [e["folder"] for e in log[first:]]

    def _append(self, entry: dict) -> bool:
        """Creates the entry's file if it is absent, whole or not at all. False if another writer was first."""
        text = json.dumps(entry).encode()
        fs, mark = hadoop_fs(self.spark, f"{self.folder}/log/{entry['version']:012d}.json")
        fs.mkdirs(mark.getParent())
        uri = fs.makeQualified(mark).toUri()
        if uri.getScheme() == "file":
            own = os.path.join(os.path.dirname(uri.getPath()), f"_{uuid.uuid4().hex}")
            with open(own, "wb") as f:
                f.write(text)
            try:
                os.link(own, uri.getPath())
            except FileExistsError:
                return False
            finally:
                os.unlink(own)
            return True
        try:
            out = fs.create(mark, False)
        except Exception:
            if fs.exists(mark):
                return False
            raise
        out.write(text)
        out.close()
        return True

    def _ledger(self, log: list[dict]) -> DataFrame:
        """The live ledger rows; the folders of buckets that a filter leaves out are not read."""
        root = f"{self.folder}/ledger"
        roots = [f"{root}/batch={f}" for f in self.live(log)]
        if not roots:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(f"{LEDGER}, batch string").option("basePath", root).parquet(*roots).drop("batch")

    def _deltas(self, log: list[dict]) -> DataFrame:
        roots = [f"{self.folder}/delta/{f}" for f in self.live(log)]
        rows = self.spark.read.schema(DELTA).parquet(*roots) if roots else self.spark.createDataFrame([], DELTA)
        return rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")

    def current(self) -> DataFrame:
        """The count of every document that is in."""
        return standing(self._ledger(self.tail())).select(*COUNT)

    def totals(self) -> DataFrame:
        return self._deltas(self.tail())

    def _write(self, ledger: DataFrame, n: int, delta: DataFrame | None = None) -> str:
        """Writes ledger rows in n buckets, and their delta, under a new name."""
        name = uuid.uuid4().hex
        dealt = ledger.repartition("bucket") if n <= shuffle_partitions(self.spark) else ledger.repartition(n, "bucket")
        dealt.write.partitionBy("bucket").parquet(f"{self.folder}/ledger/batch={name}")
        if delta is None:
            rows = self.spark.read.schema(LEDGER).parquet(f"{self.folder}/ledger/batch={name}")
            delta = rows.groupBy(*GROUP).agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("n_tokens"))
        delta.write.parquet(f"{self.folder}/delta/{name}")
        return name

    def _drop(self, name: str) -> None:
        for path in (f"ledger/batch={name}", f"delta/{name}"):
            fs, at = hadoop_fs(self.spark, f"{self.folder}/{path}")
            fs.delete(at, True)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """changes: doc_id, source, lang, tokenizer_version, n_tokens, change. False if it was in."""
        if self.known(batch):
            return False
        state = F.struct((F.col("change") != "delete").alias("stays"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), "source", "lang")
        new = pick(changes, "doc_id", "source", "lang", "tokenizer_version", "n_tokens", "change").withColumn("doc_id", F.col("doc_id").cast("long"))
        new = new.groupBy(*KEY).agg(F.max(state).alias("s")).select(*KEY, "s.*")
        written = stored(new, "rollup-batch")
        while True:
            log = self.tail()
            if self.known(batch):
                return False
            n = self.buckets(log) if log else buckets_for(written.count())
            new = written.withColumn("bucket", bucket_of(n))
            rows = new.where("stays").select(*COUNT, F.lit(1).alias("sign"), "bucket")
            plus = rows
            if log:
                touched = [r.bucket for r in new.select("bucket").distinct().collect()]
                old, keys = standing(self._ledger(log).where(F.col("bucket").isin(touched))).alias("o"), new.select(*KEY).alias("k")
                same = F.col("o.doc_id").eqNullSafe(F.col("k.doc_id")) & F.col("o.tokenizer_version").eqNullSafe(F.col("k.tokenizer_version"))
                rows = plus.union(old.join(keys, same, "left_semi").select(*COUNT, F.lit(-1).alias("sign"), "bucket"))
            name = self._write(rows, n)
            entry = {"version": log[-1]["version"] + 1 if log else 0, "batch": batch, "folder": name, "replaces": False, "buckets": n}
            if self._append(entry):
                if len(self.live([*log, entry])) > COMPACT:
                    self.compact()
                return True
            self._drop(name)

    def compact(self) -> bool:
        """Replaces the live folders by what they add up to. False if another writer came between."""
        log = self.tail()
        rows = standing(self._ledger(log)).select(*COUNT, F.lit(1).alias("sign"))
        n = buckets_for(rows.count())
        name = self._write(rows.withColumn("bucket", bucket_of(n)), n, self._deltas(log))
        version = log[-1]["version"] + 1 if log else 0
        done = self._append({"version": version, "batch": None, "folder": name, "replaces": True, "buckets": n})
        if done:
            fs, at = hadoop_fs(self.spark, f"{self.folder}/replaced/{version:012d}")
            fs.mkdirs(at)  # an older one does as well
        else:
            self._drop(name)
        return done


def bucket_of(n: int):
    return F.pmod(F.xxhash64(*KEY), F.lit(n)).cast("int")


def buckets_for(rows: int) -> int:
    """A power of two, so that a bucket has ROWS rows at most, about."""
    return min(MOST, max(BUCKETS, 1 << max(0, (rows // ROWS)).bit_length()))


def standing(ledger: DataFrame) -> DataFrame:
    """The ledger's rows that weren't taken back."""
    return ledger.groupBy(*COUNT, "bucket").agg(F.sum("sign").alias("_n")).where("_n > 0").drop("_n")


_CODERS: dict = {}


def coder(path: str, pattern: str):
    if path not in _CODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _CODERS[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _CODERS[path]


def counter(path: str, pattern: str):
    def run(batches):
        enc = coder(path, pattern)
        for b in text_chunks(batches):
            cols = [c for c, n in zip(b.columns, b.schema.names, strict=True) if n != "text"]
            names = [n for n in b.schema.names if n != "text"]
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            yield pa.RecordBatch.from_arrays([*cols, pa.array([len(enc.encode_ordinary(t)) if t else 0 for t in texts], pa.int64())], names=[*names, "n_tokens"])

    return run


def token_counts(docs: DataFrame, version: str, path: str | None = None, pattern: str = "") -> DataFrame:
    """doc_id, source, lang, tokenizer_version, n_tokens; without a rank file, of plain words."""
    rows = pick(docs, "doc_id", "source", "lang", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    if path is None:
        counted = rows.select("doc_id", "source", "lang", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"))
    else:
        ship(docs.sparkSession)
        counted = rows.mapInArrow(counter(path, pattern), "doc_id long, source string, lang string, n_tokens long")
    return counted.withColumn("tokenizer_version", F.lit(version))


def without_repeated_lines(text):
    return F.array_join(F.array_distinct(F.split(text, "\n", -1)), "\n")


def maintained(docs: DataFrame, version: str, path: str | None = None, pattern: str = "", folder: str | None = None) -> DataFrame:
    """The totals after a feed of batches over all documents: every document goes in; those
    with repeated lines are counted anew without the repeats; of exact copies all but the
    one with the smallest id go out; then the second batch comes once more, and is ignored."""
    spark = docs.sparkSession
    store = TokenRollup(spark, folder or new_folder(spark, "token-rollup"))
    count = lambda d, change: token_counts(d, version, path, pattern).withColumn("change", F.lit(change))
    store.commit("1-load", count(docs, "insert"))
    plain = pick(docs, "doc_id", "source", "lang", "text")
    lines = F.split("text", "\n", -1)
    repeats = plain.where(F.size(F.array_distinct(lines)) < F.size(lines)).withColumn("text", without_repeated_lines(F.col("text")))
    revised = count(repeats, "revise")
    store.commit("2-lines", revised)
    keyed = stored(plain.select("doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("key")), "rollup-keys")
    first = keyed.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first")
    first = stored(first, "rollup-first")  # written, so that a text with very many copies can be split in the join
    copies = keyed.join(first, "key").where("doc_id > first").select("doc_id", "source", "lang")
    store.commit("3-copies", copies.select("*", F.lit(version).alias("tokenizer_version"), F.lit(0).cast("long").alias("n_tokens"), F.lit("delete").alias("change")))
    store.commit("2-lines", revised)
    return store.totals().select(*GROUP, "n_docs", "n_tokens")


ROLLUP_SQL = r"""
WITH d AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents
)
SELECT source, lang, 'words-1' AS tokenizer_version, CAST(count(*) AS BIGINT) AS n_docs,
  CAST(sum(list_sum(list_transform(list_distinct(string_split(text, chr(10))), lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))))) AS BIGINT) AS n_tokens
FROM d WHERE doc_id = first GROUP BY source, lang
"""
