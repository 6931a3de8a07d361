import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfold.llm import fingerprint, mixing, topk

# ---- mixing -------------------------------------------------------------------------------


def shares(sizes, cap=3):
    """Targets by sharing again and again until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / max(sum(weight[s] for s in rest), 1)
        over = [s for s in rest if level * weight[s] > cap * sizes[s]]
        if not over:
            return {s: fixed.get(s, level * weight[s]) for s in names}
        fixed |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_mix_meets_its_targets(spark, seed):
    r = random.Random(seed)
    sources = [f"s{i}" for i in range(7)] + [None, "ü", "a"]
    rows = [(i, " ".join(["w"] * r.randint(0, 40)), s) for i, s in enumerate(r.choices(sources, weights=[200, 40, 9, 5, 3, 60, 10, 8, 2, 1], k=900))]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = shares(sizes)
    assert len(got) == len(rows)
    for s in sizes:
        mine = [g for g in got if g.source == s]
        assert mine[0].target == pytest.approx(want[s]) and mine[0].source_size == sizes[s]
        taken = sum(g.size * g.copies for g in mine)
        assert all(0 <= g.copies <= 3 for g in mine) and abs(taken - want[s]) <= 3 * 40
        e = want[s] / sizes[s] if sizes[s] else 0
        assert {g.copies for g in mine} <= {math.floor(e), math.ceil(e)}  # systematic: none is off by more than one
    again = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(2)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_both_ways_to_the_mixed_rows_agree(spark, monkeypatch):
    r = random.Random(4)
    rows = [(i, " ".join(["w"] * r.randint(0, 9)), r.choice("aab"), i) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    whole = sorted(map(tuple, mixing.emit(mixing.mix(df, keep=tuple(df.columns)), df.columns).collect()))
    assert sorted(map(tuple, mixing.mixed_rows(df).collect())) == whole
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 1)
    assert sorted(map(tuple, mixing.mixed_rows(df).collect())) == whole and mixing.mixed_rows(df).columns == df.columns
    twice = df.union(df.limit(3))
    assert sorted(map(tuple, mixing.mixed_rows(twice).collect())) == sorted(map(tuple, mixing.emit(mixing.mix(twice, keep=tuple(df.columns)), df.columns).collect()))


def test_mix_awkward(spark, awkward, empty):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count() and {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    kept = mixing.emit(mixing.mix(awkward, keep=tuple(awkward.columns)), awkward.columns)
    assert kept.columns == awkward.columns and kept.count() == sum(r.copies for r in rows)
    assert mixing.mix(empty).count() == 0 and mixing.emit(mixing.mix(empty, keep=tuple(empty.columns)), empty.columns).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r.target, r.copies) for r in mixing.mix(blank).collect()} == {(0.0, 0)}


# ---- fingerprints -------------------------------------------------------------------------


def paragraphs(t):
    return {x for x in re.split(r"\n|(?<=[.!?])[ \t\r]+", t) if x}


def alike(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def held_against(spark, rows, got):
    hashes = {r.t: r.h for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1] or ""]))
    texts = [t or "" for _, t in order]
    want = []
    for k, t in enumerate(texts):
        after = texts[(k + 1) % len(texts)]
        e = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        want.append((order[k][0], len(t), hashlib.sha256(e.encode()).hexdigest(), round(alike(t, e), 9), round(alike(t, after), 9)))
    have = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(map(repr, have)) == sorted(map(repr, want))


@pytest.mark.parametrize("cells", [4, 64])
def test_fingerprints_equal_sets(spark, monkeypatch, cells):
    monkeypatch.setattr(fingerprint, "CELLS", cells)  # small sketches fail and are made larger
    r = random.Random(6)
    pool = [" ".join(f"é{r.randint(0, 99)}" for _ in range(r.randint(1, 6))) + r.choice(".!?") for _ in range(200)]
    rows = [(i * 3, r.choice(["\n", " "]).join(r.choices(pool, k=r.randint(0, 60)))) for i in range(80)] + [(1000, pool[0] + "\n" + "\n".join(pool))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held_against(spark, rows, fingerprint.fingerprints(df).collect())


def test_no_task_gets_a_text_of_every_block(spark, awkward, monkeypatch):
    monkeypatch.setattr(fingerprint, "BLOCK_CHARS", 200)
    for most in (500_000, 0):
        monkeypatch.setattr(fingerprint, "BROADCAST_BLOCKS", most)
        rows = fingerprint.with_next(awkward)
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        whole = [line for line in plan.split("\n") if "Window [" in line and "text" in line]
        assert whole and all("block#" in line for line in whole)  # windows over texts are within a block
        assert "SinglePartition" not in "".join(line for line in rows._jdf.queryExecution().executedPlan().toString().split("\n") if "text" in line)
        assert rows.where("end = 0").count() == awkward.count()


def test_equal_texts_have_equal_fingerprints(spark, awkward, empty):
    rows = [(r.doc_id, r[1]) for r in awkward.collect()]
    got = fingerprint.fingerprints(awkward).collect()
    held_against(spark, rows, got)
    text = dict(rows)
    by = {}
    for r in got:
        if r.doc_id is not None:
            by.setdefault(text[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by.values()) and len({next(iter(v)) for v in by.values()}) >= len(by) - 1
    assert fingerprint.fingerprints(empty).count() == 0
    alone = fingerprint.fingerprints(spark.createDataFrame([(4, "a.\nb.")], "doc_id long, text string")).first()
    assert alone.near_next == 1.0 and len(alone.fingerprint) == 32


def test_peeling_recovers_the_difference(spark):
    rows = spark.createDataFrame([(0, 1, list(range(30)), list(range(10, 45)))], "block long, rid int, own array<long>, edited array<long>").repartition(1, "block")
    d = fingerprint.subtracted(fingerprint.sketches(rows, 64), prints=False)
    out = {r.pair: r for r in fingerprint.outcome(fingerprint.peeled(d, 64)).collect()}
    assert (out[0].found, out[0].left) == (25, 0)
    small = fingerprint.outcome(fingerprint.peeled(fingerprint.subtracted(fingerprint.sketches(rows, 2), prints=False), 2)).where("pair = 0 and rid = 1").first()
    assert small.left > 0  # too small: it says so


def test_blocks_ascend(spark):
    ids = [(i * i, i) for i in range(500)] + [(None, k * 10**16) for k in range(-300, 300)] + [(7, k * 10**16) for k in range(-400, 400)]
    rows = fingerprint.blocks(spark.createDataFrame(ids, "doc_id long, tie long"), 300).collect()
    known = sorted((r.doc_id, r.tie, r.block) for r in rows if r.doc_id is not None)
    assert [b for *_, b in known] == sorted(b for *_, b in known)
    null = sorted((r.tie, r.block) for r in rows if r.doc_id is None)
    assert [b for _, b in null] == sorted(b for _, b in null) and max(b for _, b in null) < known[0][2]
    # null ids and a repeated id are spread
    assert len({b for _, b in null}) > 20 and len({b for d, _, b in known if d == 7}) > 20


@pytest.mark.parametrize("doc_id", [None, 7])
def test_many_rows_of_one_id(spark, monkeypatch, doc_id):
    """They lie in several blocks, in one order."""
    r = random.Random(2)
    rows = [(doc_id, f"line {r.randint(0, 40)}.\nline {r.randint(0, 40)}. {i}") for i in range(150)] + [(i, f"text {i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(fingerprint, "BLOCK_CHARS", 50)
    held_against(spark, rows, fingerprint.fingerprints(df).collect())
    tied = fingerprint.with_next(df).where("end = 0").groupBy("block").count().collect()
    assert len(tied) > 10


def test_stored_sketches_are_subtracted_later(spark, tmp_path):
    r = random.Random(5)
    pool = [f"paragraph {i} has words." for i in range(300)]
    old = {i: r.sample(pool, r.randint(0, 30)) for i in range(40)} | {None: pool[:3]}
    new = {i: [p for p in t if r.random() > 0.1] + r.sample(pool, 2) for i, t in old.items() if i != 3} | {99: pool[:5]}
    df = lambda of: spark.createDataFrame([(i, "\n".join(t)) for i, t in of.items()], "doc_id long, text string")
    for name, of in (("old", old), ("new", new)):
        fingerprint.sketch_table(df(of)).write.parquet(f"file://{tmp_path}/{name}")
    a, b = (spark.read.parquet(f"file://{tmp_path}/{n}") for n in ("old", "new"))
    assert {x.doc_id: x.n_digests for x in a.collect()} == {i: len(set(t)) for i, t in old.items()}
    got = {x.doc_id: (x.found, x.left) for x in fingerprint.differences(a, b).collect()}
    assert got == {i: (len(set(old.get(i, [])) ^ set(new.get(i, []))), 0) for i in old.keys() | new.keys()}
    small = fingerprint.differences(fingerprint.sketch_table(df(old), 2), fingerprint.sketch_table(df(new), 2), 2)
    assert small.where("left > 0").count() > 0


def test_no_python_in_the_plan(spark, awkward):
    df = fingerprint.fingerprints(awkward)
    plan = df._jdf.queryExecution().executedPlan().toString()
    rows = spark.createDataFrame([], "block long, rid int, own array<long>, edited array<long>")
    plan += fingerprint.peeled(fingerprint.subtracted(fingerprint.sketches(rows, 8), True), 8)._jdf.queryExecution().executedPlan().toString()
    plan += fingerprint.differences(fingerprint.sketch_table(awkward), fingerprint.sketch_table(awkward))._jdf.queryExecution().executedPlan().toString()
    plan += fingerprint.with_next(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- top k --------------------------------------------------------------------------------


def exact_rows(rows, queries, k, scale):
    """Every query row against every other row."""
    keep = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(keep):
        if q in queries:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for other, (i, w) in enumerate(keep) if other != at)[:k]
            out += [(q, n, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,first", [(4096, 32), (7, 2)])
def test_top_k_equals_all_scores(spark, monkeypatch, block, first):
    r = np.random.default_rng(8)
    v = r.normal(size=(300, 8)).astype(np.float32).round(2)
    rows = [(i, [float(x) for x in v[i % 200]]) for i in range(300)]  # a third are copies: ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    monkeypatch.setattr(topk, "QUERY_BYTES", 500)
    monkeypatch.setattr(topk, "GROUP_BYTES", 6000)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k=10, scale=1024.0)
    assert sorted(map(tuple, got.collect())) == exact_rows(rows, set(range(0, 300, 10)), 10, 1024.0)
    # the same a block at a time, in this process
    monkeypatch.setattr(topk, "STEP", first)
    ints = np.floor(1024 * v[np.arange(300) % 200].astype(np.float64))
    best, read = topk.Best(30, 10), 0
    for a in range(0, 300, block):
        uid = np.arange(a, min(a + block, 300))
        read += topk.scan_block(best, np.arange(0, 300, 10), ints[::10], uid, uid, ints[uid])
    assert read < 30 * 300 or first == 32
    assert sorted((q * 10, n + 1, int(best.id[q, n]), int(best.score[q, n])) for q in range(30) for n in range(10)) == exact_rows(rows, set(range(0, 300, 10)), 10, 1024.0)


def test_bounds_hold():
    r = np.random.default_rng(3)
    for scale in (1, 1e3, 1e9, 1e30):
        v, q = np.floor(r.normal(size=(500, 16)) * scale), np.floor(r.normal(size=(40, 16)) * scale)
        upper = topk.upper_bounds(q, *topk.cells_of(v))
        assert (upper >= q @ v.T).all() and (upper - q @ v.T).max() < 0.2 * (np.abs(q) @ np.abs(v).T).max() + 100


def test_top_k_of_rows_that_share_an_id(spark):
    rows = [(0, [1.0]), (0, [5.0]), (1, [2.0]), (0, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 100 == 0, 10).collect()))
    assert got == exact_rows(rows, {0}, 10, 1024.0) and len(got) == 9


def test_top_k_awkward(spark):
    schema = "vec_id long, embedding array<float>, EMBEDDING string, score int"
    raw = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]), (5, [1.0]), (6, []), (7, [3e9, -3e9]), (8, [1.0, 2.0]), (100, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, "x", 1) for r in raw], schema)
    asks = F.col("vec_id") % 100 == 0
    got = sorted(map(tuple, topk.top_k(df, asks, k=4, scale=1024.0).collect()))
    assert got == exact_rows([(i, None if v is None else v) for i, v in raw], {0, 100}, 4, 1024.0)
    big = spark.createDataFrame([(0, [1e18, 1e18]), (1, [1e18, 1e18]), (2, [-1e18, -1e18])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in topk.top_k(big, F.col("vec_id") == 0, 2).orderBy("rank").collect()] == [(1, 2**63 - 1), (2, -(2**63))]
    none = spark.createDataFrame([], schema)
    assert topk.top_k(none, asks).count() == 0 and topk.top_k(df, F.lit(False)).count() == 0
