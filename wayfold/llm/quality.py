"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's features describe it and its neighbouring lines; the
chain adds weights for two lines in a row. The field is fitted to a bounded sample of
labelled documents, whose lines carry their document's label: at most SAMPLE_DOCS documents,
of a longer one SAMPLE_LINES lines in a row from a place that a hash of its text chooses.
It minimises one objective, the negative conditional log-likelihood of the labelled chains,
in which both classes weigh alike, a line's mean of it, with a quadratic penalty.
Forward-backward marginals of the lines, weighted by length, give a document's share of good
text, and a logistic curve fitted to the same sample turns that into the score.

Defined results: a null or empty text is one empty line and has a score too; labels with
null ids or qualities are ignored, of repeated ones the least counts; without usable
labels every score is 0.5; a null doc_id is not held out; of rows that share a labelled id
one is fitted to, and all are scored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, ship, slices, text_chunks
from .shingles import PIECE, words_of

#: Bound of the fitting sample: documents, and lines of one of them. Scoring has no bound.
SAMPLE_DOCS, SAMPLE_LINES = 4000, 100
STEPS, RATE, PENALTY = 200, 0.1, 1e-4
THRESHOLD = 0.3
#: Classes of bytes whose share in a line is a feature.
CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\f\v", ".,;:", "!?", "|", "#$%&*+=<>^~@\\/_{}[]", "'\"()-"]
CLASS_OF = np.full(256, len(CLASSES), np.int64)  # all else: beyond ASCII, controls
for _i, _c in enumerate(CLASSES):
    CLASS_OF[list(_c.encode())] = _i
OWN = len(CLASSES) + 1 + 8
FEATURES = 3 * OWN + 3


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of features a line, the lines' lengths, and how many lines each text has."""
    split = [(t or "").split("\n") for t in texts]
    per = np.fromiter(map(len, split), np.int64, len(split))
    lines = [x for s in split for x in s]
    n = len(lines)
    raw = [x.encode() for x in lines]
    size = np.fromiter(map(len, raw), np.int64, n)
    buf = np.frombuffer(b"".join(raw), np.uint8)
    k = len(CLASSES) + 1
    ends, share = np.cumsum(size), np.empty((n, k))
    for a, b in slices(size, PIECE):  # lines of about PIECE bytes at a time
        part = buf[ends[a] - size[a] : ends[b - 1]]
        share[a:b] = np.bincount(np.repeat(np.arange(b - a) * k, size[a:b]) + CLASS_OF[part], minlength=(b - a) * k).reshape(b - a, k)
    share /= np.maximum(size, 1)[:, None]
    word, count = words_of(lines)
    owner = np.repeat(np.arange(n), count)
    again = np.zeros((n, 2))
    for i in (1, 2):
        same = (word[i:] == word[:-i]) & (owner[i:] == owner[:-i])
        again[:, i - 1] = np.bincount(owner[i:][same], minlength=n) / np.maximum(count, 1)
    first = np.zeros(n, bool)
    first[(np.cumsum(per) - per)] = True
    marks = np.zeros(n)
    last = ends - 1
    full = size > 0
    marks[full] = np.isin(buf[last[full]], list(b".!?"))
    cap = np.zeros(n)
    cap[full] = CLASS_OF[buf[(last - size + 1)[full]]] == 1
    copied = np.zeros(n)
    copied[1:] = [a == b for a, b in zip(lines[1:], lines[:-1], strict=True)]
    copied[first] = 0
    own = np.column_stack([share, again, marks, cap, copied, np.log1p(size) / 8, np.log1p(count) / 6, np.minimum(size / np.maximum(count, 1), 30) / 30])
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    end = np.zeros(n, bool)
    end[np.cumsum(per) - 1] = True
    before[first], after[end] = 0, 0
    return np.column_stack([own, before, after, first, end, np.ones(n)]), size, per


def marginals(emission: np.ndarray, per: np.ndarray, move: np.ndarray, weight: np.ndarray | None = None):
    """P(good) of every line (and, with a weight a document, the weighted sums of the expected
    moves and of the logs of the partitions).

    emission: log potential of good against bad a line; move: log potentials [from, to].
    All documents advance a line at a time, the longer ones for longer.
    """
    order = np.argsort(-per, kind="stable")
    first = (np.cumsum(per) - per)[order]
    sizes = per[order]
    a = np.exp(move)
    pot = np.ones((len(emission), 2))
    pot[:, 1] = np.exp(np.clip(emission, -30, 30))
    alpha, beta, scale = np.zeros_like(pot), np.ones_like(pot), np.zeros(len(pot))
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    for t in range(longest):
        at = first[: active[t]] + t
        x = pot[at] if t == 0 else (alpha[at - 1] @ a) * pot[at]
        scale[at] = x.sum(axis=1)
        alpha[at] = x / scale[at][:, None]
    expected = np.zeros((2, 2))
    for t in range(longest - 1, 0, -1):
        at = first[: active[t]] + t
        back = pot[at] * beta[at]
        if weight is not None:
            both = alpha[at - 1][:, :, None] * a[None] * back[:, None, :]
            expected += (both * (weight[order[: len(at)]] / both.sum(axis=(1, 2)))[:, None, None]).sum(axis=0)
        b = back @ a.T
        beta[at - 1] = b / b.sum(axis=1)[:, None]
    g = alpha * beta
    good = g[:, 1] / np.maximum(g.sum(axis=1), 1e-300)
    return good if weight is None else (good, expected, (np.log(scale) * np.repeat(weight, per)).sum())


def weighted(good: np.ndarray, size: np.ndarray, per: np.ndarray) -> np.ndarray:
    w = size + 1.0
    ends = np.cumsum(per)
    total = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[np.concatenate([[0], ends])])
    return np.clip(total(good * w) / total(w), 0, 1)


class Model:
    """weights of the features, move potentials, and the curve from good share to score."""

    def __init__(self):
        self.weights, self.move, self.curve = np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2)

    def objective(self, x: np.ndarray, per: np.ndarray, label: np.ndarray) -> tuple[float, np.ndarray]:
        """The weighted negative log-likelihood of a line, and its gradient in weights and moves."""
        share = np.array([max((label == c).sum(), 1) for c in (0, 1)]) / max(len(label), 1)
        weight, y, total = 0.5 / share[label], np.repeat(label, per), max(per.sum(), 1)
        emission = x @ self.weights
        good, expected, log_z = marginals(emission, per, self.move, weight)
        each, seen = np.repeat(weight, per), np.zeros((2, 2))
        for c in (0, 1):
            seen[c, c] = (weight * (per - 1))[label == c].sum()
        held = (each * y * np.clip(emission, -30, 30)).sum() + (seen * self.move).sum()
        loss = (log_z - held) / total + PENALTY / 2 * ((self.weights**2).sum() + (self.move**2).sum())
        by_weight = x.T @ (each * (good - y) * (np.abs(emission) <= 30)) / total + PENALTY * self.weights
        return loss, np.concatenate([by_weight, ((expected - seen) / total + PENALTY * self.move).ravel()])

    def fit(self, x: np.ndarray, size: np.ndarray, per: np.ndarray, label: np.ndarray) -> Model:
        """The objective's minimum by Adam, then the curve by Newton's steps."""
        moments = [np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)]
        for step in range(1, STEPS + 1):
            _, g = self.objective(x, per, label)
            moments[0] = 0.9 * moments[0] + 0.1 * g
            moments[1] = 0.999 * moments[1] + 0.001 * g * g
            d = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
            self.weights -= d[:FEATURES]
            self.move -= d[FEATURES:].reshape(2, 2)
        s = weighted(marginals(x @ self.weights, per, self.move), size, per)
        z = np.column_stack([s, np.ones(len(s))])
        for _ in range(30):  # with a small penalty
            p = 1 / (1 + np.exp(-z @ self.curve))
            h = z.T @ (z * (p * (1 - p))[:, None]) + 0.1 * np.eye(2)
            self.curve -= np.linalg.solve(h, z.T @ (p - label) + 0.1 * self.curve)
        return self

    def score(self, texts: list[str | None]) -> np.ndarray:
        x, size, per = line_features(texts)
        s = weighted(marginals(x @ self.weights, per, self.move), size, per)
        return 1 / (1 + np.exp(-(self.curve[0] * s + self.curve[1])))


def sample_features(batches):
    """doc_id, a hash, and features and lengths of a document's stretch of at most SAMPLE_LINES lines."""
    schema = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("x", pa.binary()), ("size", pa.binary())])
    for b in text_chunks(batches, PIECE):
        texts = b.column(1).to_pylist()
        x, size, per = line_features(texts)
        hashes = [zlib.crc32((t or "").encode()) for t in texts]
        first = np.cumsum(per) - per + np.array(hashes, np.int64) % np.maximum(per - SAMPLE_LINES + 1, 1)
        spans = list(zip(first.tolist(), (first + np.minimum(per, SAMPLE_LINES)).tolist(), strict=True))
        rows = [[x[a:e].astype(np.float32).tobytes() for a, e in spans], [size[a:e].tobytes() for a, e in spans]]
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(hashes, pa.int64()), *[pa.array(r, pa.binary()) for r in rows]], schema=schema)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> Model:
    """A model of at most `sample` labelled documents that aren't held out.

    Their ids are chosen by a hash, half of them from each label if there are enough; only
    these few ids are broadcast, and only features of these documents reach the driver.
    """
    labels = pick(labels, "doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
    labels = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    by_hash = [F.xxhash64(F.lit("quality"), "doc_id"), F.col("doc_id")]
    chosen = [r for q in (0, 1) for r in labels.where(F.col("quality") == q).orderBy(*by_hash).limit(sample // 2).collect()]
    if not chosen:
        return Model()
    label_of = {r.doc_id: r.quality for r in chosen}
    ids = docs.sparkSession.createDataFrame([(i,) for i in label_of], "id long")
    texts = pick(docs, "doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select("doc_id", "text")
    features = texts.mapInArrow(sample_features, "doc_id long, hash long, x binary, size binary")
    one = features.groupBy("doc_id").agg(F.min(F.struct("hash", "x", "size")).alias("f")).select("doc_id", "f.x", "f.size")
    rows = sorted(one.collect())
    if not rows:
        return Model()
    x = np.concatenate([np.frombuffer(r.x, np.float32).reshape(-1, FEATURES) for r in rows]).astype(np.float64)
    size = [np.frombuffer(r.size, np.int64) for r in rows]
    return Model().fit(x, np.concatenate(size), np.array([len(s) for s in size]), np.array([label_of[r.doc_id] for r in rows]))


def scorer(model: Model):
    def run(batches):
        for b in text_chunks(batches, PIECE):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(b.column(b.schema.get_field_index("text")).to_pylist()), pa.float64())], names=[*b.schema.names, "_score"])

    return run


def ids_scorer(model: Model):
    def run(batches):
        for b in text_chunks(batches, PIECE):
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(model.score(b.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    return run


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""
    ship(docs.sparkSession)
    model = fit(docs, labels)
    scored = pick(docs, "doc_id", "text").mapInArrow(ids_scorer(model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose score reaches the threshold."""
    ship(docs.sparkSession)
    model = fit(docs, labels)
    names = docs.columns
    plain = docs.toDF(*[n if n == "text" else f"_p{i}" for i, n in enumerate(names)])
    scored = plain.mapInArrow(scorer(model), plain.withColumn("_score", F.lit(0.0)).schema)
    return scored.where(F.col("_score") >= threshold).drop("_score").toDF(*names)
