"""Language trees against a plain model of the same kind, and what they tell of held-out texts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from wayfold.llm import langid

SF = "/root/testdata/sf0.01"


def plain_model(texts, order, least):
    """context -> Counter of next bytes, of contexts with enough occurrences."""
    seen = defaultdict(Counter)
    for t in texts:
        for i, b in enumerate(t):
            for d in range(min(i, order) + 1):
                seen[t[i - d : i]][b] += 1
    return {c: n for c, n in seen.items() if sum(n.values()) >= least or not c}


def price(model, context, b):
    """Bits of b after context, by the definition."""
    if context not in model:
        return 8.0 if not context else price(model, context[1:], b)
    n = model[context]
    total, kinds = sum(n.values()), len(n)
    if kinds == 256:
        return -math.log2(n[b] / total)
    shorter = (lambda x: 8.0) if not context else (lambda x: price(model, context[1:], x))
    if b in n:
        return -math.log2(n[b] / (total + kinds))
    return -math.log2(kinds / (total + kinds) / max(1 - sum(2 ** -shorter(x) for x in n), 1e-12)) + shorter(b)


def trees(samples, order):
    import pyarrow as pa

    langs = sorted(samples)
    rows = pa.RecordBatch.from_pydict({"lang": [k for k in langs for _ in samples[k]], "part": [t for k in langs for t in samples[k]]})
    counts = Counter()
    for b in langid.grams(order)([rows]):
        for lang, d, g, n in zip(*[c.to_pylist() for c in b.columns], strict=True):
            counts[lang, d, g] += n
    seen = Counter()
    for (lang, d, g), n in counts.items():
        seen[lang, d, g >> langid.BITS] += n
    kept = [(langs.index(k), d, g, n) for (k, d, g), n in sorted(counts.items()) if d == 0 or seen[k, d, g >> langid.BITS] >= langid.LEAST]
    return langid.Trees(langs, *[np.array(c, np.int64) for c in zip(*kept, strict=True)], order)


@pytest.fixture(scope="module")
def small():
    r = random.Random(2)
    words = {"aa": ["the", "thin", "over", "and", "é"], "bb": ["das", "dann", "und", "über", "thin"], "cc": ["x"]}
    samples = {k: [" ".join(r.choice(v) for _ in range(60)) for _ in range(3)] for k, v in words.items()}
    return samples, trees(samples, 3), {k: plain_model([t.encode() for t in v], 3, langid.LEAST) for k, v in samples.items()}


def test_lengths_equal_the_definition(small, monkeypatch):
    samples, t, models = small
    texts = ["the über", "", "x", "dann and 日本\x00 zz", "é", samples["aa"][0], "over" * 30]
    want = [[sum(price(models[k], b[max(0, i - 3) : i], b[i]) for i in range(len(b))) for k in t.langs] for b in (x.encode() for x in texts)]
    for at_once in (1 << 16, 7):
        monkeypatch.setattr(langid, "AT_ONCE", at_once)
        got = t.lengths([x.encode() for x in texts]) / langid.UNIT
        assert np.allclose(got, want, atol=1e-3)
    exact = t.lengths([x.encode() for x in texts])
    assert (t.lengths([texts[5].encode()])[0] == exact[5]).all()  # whole numbers, whatever the batch


def test_each_context_holds_a_distribution(small):
    _, t, models = small
    for context in (b"", b"t", b"th", b"the", b"qq", b"un"):
        data = np.frombuffer(b"".join(context + bytes([b]) for b in range(256)), np.uint8)
        n = len(context) + 1
        key = langid.codes(data, np.arange(256) * n, 3)[n - 1 :: n]
        total = (2.0 ** -(t.prices(key) / langid.UNIT)).sum(axis=0)
        assert np.allclose(total, 1, atol=1e-3), context


def test_slots():
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(1, 1 << 45, 5000).astype(np.uint64))
    s = langid.Slots(keys)
    assert (s.find(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(r.integers(1, 1 << 45, 5000).astype(np.uint64), keys)
    assert (s.find(others) == -1).all()
    assert (langid.Slots(np.empty(0, np.uint64)).find(keys) == -1).all()


def test_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: (r.lang, r.n_chars) for r in docs.collect()}
    rows = langid.languages(docs).collect()
    assert len(rows) == len(lang) and {r.lang_pred for r in rows} <= {"de", "en", "es", "fr"}
    out = [r for r in rows if r.held_out and lang[r.doc_id][1] >= 20]
    assert len(out) > 100 and sum(r.lang_pred == lang[r.doc_id][0] for r in out) >= 0.99 * len(out)
    assert rows == langid.languages(docs).collect()


def test_inputs_of_a_prediction(spark):
    """Held-out rows teach nothing; lang, source and id of a row don't matter."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    t = langid.grow(docs, most=40, chars=300)
    from pyspark.sql import functions as F

    without = docs.where(~langid.held_out(F.col("doc_id")))
    u = langid.grow(without, most=40, chars=300)
    assert t.langs == u.langs and all((a == b).all() for a, b in zip(t.price, u.price, strict=True))
    moved = docs.select((F.col("doc_id") + 1000003).alias("doc_id"), "text", F.lit("zz").alias("lang"), F.lit("q").alias("source"))
    key = lambda df, off: sorted((r.doc_id - off, r.lang_pred, r.score) for r in langid.languages(df, t).collect())
    assert key(docs, 0) == key(moved, 1000003)


def test_sample_is_bounded(spark):
    rows = [(i if i % 3 else 7, f"text {i} " * 40, "en" if i % 2 else "fr") for i in range(1, 600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.sample_of(docs, most=20, chars=50).collect()
    assert 0 < len(got) <= 20 and all(len(r.part) <= 50 for r in got) and {r.lang for r in got} == {"en", "fr"}


def test_language_awkward(spark, awkward, empty):
    rows = langid.languages(awkward).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (r.doc_id in (1, 2, 3) or (r.doc_id is None and r.score == 0))
    assert langid.languages(empty).count() == 0
    nothing = spark.createDataFrame([(1, "words", None), (2, "12 ٣ ½ !", "en"), (None, "x", "fr")], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in langid.languages(nothing).collect()} <= {("und", 0.0), ("en", 1.0)}
