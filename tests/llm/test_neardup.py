import collections
import random
import re

import numpy as np
import pytest

from wayfold.llm import neardup

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(rows, width):
    out = {}
    for i, t in rows:
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        out.setdefault(i, set()).add(frozenset(s))
    return out


def brute(rows, width, percent):
    """doc_id -> component by comparing all pairs."""
    sets = sets_of(rows, width)
    up = {i: i for i in sets}

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = top(a), top(b)
                up[max(p, q)] = min(p, q)
    return {i: top(i) for i in sets}


def copies(seed=5, n=60, words=80):
    """A base with near copies, chains of copies of copies, exact copies, and strangers."""
    r = random.Random(seed)
    rows, last = [], []
    for k in range(4):
        base = [f"w{r.randint(0, 4000)}" for _ in range(words)]
        rows.append(base)
        for _ in range(n // 4):
            x = list(r.choice(rows) if r.random() < 0.4 else base)
            for _ in range(r.randint(0, 4)):
                x[r.randrange(len(x))] = f"n{r.randint(0, 10**6)}"
            if r.random() < 0.2:
                x = x[: -r.randint(1, 12)]
            rows.append(x)
        last.append(base)
    texts = [" ".join(x) for x in rows]
    texts += [t.upper() for t in texts[:5]] + texts[:6]
    r.shuffle(texts)
    return list(enumerate(texts))


def components(df, width, percent):
    return {r.doc_id: r.component_id for r in neardup.near_duplicates(df, width, percent).collect()}


@pytest.mark.parametrize("width,percent,seed", [(3, 85, 5), (5, 80, 6), (3, 85, 7)])
def test_equal_to_all_pairs(spark, width, percent, seed):
    rows = copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert components(df, width, percent) == brute(rows, width, percent)


def test_small_slices_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SLICE", 300)
    monkeypatch.setattr(neardup, "PART", 400)
    monkeypatch.setattr(neardup, "BROADCAST_ROWS", 1)
    rows = copies(8, n=100)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert components(df, 3, 85) == brute(rows, 3, 85)


def test_links_between_members_alone():
    """Two members whose centre is too far from both still find each other."""
    c = np.arange(100, dtype=np.int64)
    far = lambda extra: (np.arange(0, 20, dtype=np.int64), np.array(extra, np.int64))
    members = [(7, 100, *far(range(200, 220))), (8, 99, *far(range(200, 219))), (9, 100, np.arange(50, 70, dtype=np.int64), np.arange(900, 920, dtype=np.int64))]
    between = lambda q, t: list(neardup.links_between(q, t, len(c), 85, neardup.Forest()))
    assert between(members, members) == [(7, 8)] and between(members[1:], members[:1]) == [(8, 7)]
    assert between(members[2:], members) == [] and between([], members) == [] and between(members, []) == []


def thue_morse(n, swap=False):
    return ["ab"[(bin(i).count("1") + swap) % 2] for i in range(n)]


def test_sequences_that_polynomial_hashes_confuse(spark):
    """Thue-Morse letters between unique words, and long words of them: no shingle in common."""
    rows = [(k, " ".join(f"u{i} {w}" for i, w in enumerate(thue_morse(1024, k)))) for k in (0, 1)]
    rows += [(k + 2, "".join(thue_morse(2048, k)) + " is one word") for k in (0, 1)] + [(k + 4, "".join(thue_morse(256, k)) + " is one word") for k in (0, 1)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert all(r.kept and r.component_id == r.doc_id for r in got) and len(got) == 6


def test_links_stand_on_words_not_hashes(spark, monkeypatch):
    """Even where hashes tell only the lengths of words apart."""
    from wayfold.llm.shingles import shingle_sets as real

    monkeypatch.setattr(neardup, "shingle_sets", lambda texts, width: real([" ".join("x" * len(w) for w in t.split()) for t in texts], width))
    rows = [(1, "the red fox ran far away home"), (2, "the old dog sat far away here"), (3, "the red fox ran far away home now"), (4, "the red fox ran far away home")]
    for slices in (1, 2):
        found = list(neardup.star(1, slices, rows, 3, 80))
        assert {r[:3] for r in found if r[2] is not None} == {(1, 3, 1), (1, 4, 1)}
        assert {r[1]: r[5] for r in found if r[2] is None} == ({2: False, 3: True, 4: True} if slices > 1 else {})
    # what hashes propose is looked at again
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs, sizes = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "center long, node long"), spark.createDataFrame([(i, 6) for i, _ in rows], "node long, n long")
    assert {tuple(sorted(r)) for r in neardup.confirmed(docs, pairs, sizes, 3, 80).collect()} == {(1, 3)}


def test_exact_sets_are_sets_of_words():
    from wayfold.llm.shingles import exact_sets, shingle_sets

    r = random.Random(3)
    texts = [" ".join(r.choice(["A", "a", "b", "é", "cc", "d\te"]) for _ in range(r.randint(0, 12))) for _ in range(200)]
    many = texts + [" ".join(f"w{r.randint(0, 9000)}" for _ in range(9000))] * 2
    for t, width in ((texts, 1), (texts, 3), (many, 5), (texts, 5)):
        codes, counts = exact_sets(t, width)
        want = [next(iter(sets_of([(0, x)], width)[0])) for x in t]
        assert counts.tolist() == [len(s) for s in want] == shingle_sets(t, width)[1].tolist()
        split = np.split(codes, np.cumsum(counts)[:-1])
        for _ in range(200):
            i, j = r.randrange(len(t)), r.randrange(len(t))
            assert len(np.intersect1d(split[i], split[j])) == len(want[i] & want[j])


def test_recall_on_the_shared_documents(spark):
    """Every link between whole texts of sf0.01 is found: recall against all pairs, at both production settings."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for width, percent in ((3, 85), (5, 80)):
        want = brute(rows, width, percent)
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, width, percent).collect()}
        groups = lambda of: {(i, j) for i, j in of.items() if i != j}
        recall = len(groups(got) & groups(want)) / max(len(groups(want)), 1)
        print(f"width {width}, {percent} %: recall {recall:.4f} of {len(groups(want))} linked documents")
        assert recall >= 0.9 and not groups(got) - groups(want)


def test_awkward_rows(spark, awkward, empty):
    got = collections.defaultdict(list)
    for r in neardup.near_duplicates(awkward, 3, 85).collect():
        got[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert sorted(got[None]) == [(0, None, True), (4, None, True)]
    assert got[1] == got[2][:0] + [(0, 1, True)] and got[2] == [(0, 2, True)] and got[3] == [(0, 3, True)]
    assert got[4] == [(5, 4, True)] and got[5] == [(5, 4, False)] * 2
    assert got[9] == [(1, 9, True)] and got[10] == [(1, 9, False)]
    assert got[6][0][0] == 997 and got[7] == [(1, 7, True)]
    assert neardup.near_duplicates(empty).count() == 0


def test_rows_of_one_id_are_one_document(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(5, a), (5, b), (2, a), (9, b)], "doc_id long, text string")
    assert components(df, 3, 85) == {5: 2, 2: 2, 9: 2}


def test_chains_reach_their_smallest_node(spark):
    n = 70
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (101, 100), (200, 200)], "a long, b long")
    got = {r.node: r.component for r in neardup.components(spark, edges).collect()}
    assert got == {**dict.fromkeys(range(n + 1), 0), 100: 100, 101: 100}


def test_signatures_estimate_similarity():
    r = np.random.default_rng(1)
    common, a, b = (np.unique(r.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) for k in (900, 100, 100))
    x, y = np.sort(np.concatenate([common, a])), np.sort(np.concatenate([common, b]))
    sig = neardup.signatures(np.concatenate([x, y]), np.array([len(x), len(y)]))
    assert abs((sig[0] == sig[1]).mean() - 900 / 1100) < 0.15
    one = neardup.signatures(np.array([5], np.uint64), np.array([1]))
    assert (one == 5).all()
    assert neardup.rows_per_band(85) == 5 and neardup.rows_per_band(80) == 4
