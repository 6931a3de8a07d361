import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from wayfold.llm import bpe, grammar, rollup
from wayfold.llm.shingles import words_of

JSON, RANKS, MULTI = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def multi():
    return rollup.coder(MULTI, P.PATTERN)


def texts(awkward):
    return [(r.doc_id, r[1] or "") for r in awkward.collect()]


def test_bpe_equals_the_library(multi):
    table, split = bpe.Ranks(MULTI), bpe.splitter(P.PATTERN)
    r = random.Random(1)
    some = ["".join(r.choice("abehtn éß\n.,'s1") for _ in range(r.randint(0, 400))) for _ in range(200)] + ["x" * 5000, "\x1c \x85 a　b", "", "日本語 123"]
    some += ["".join(r.choice("abetn") for _ in range(n)) for n in (63, 64, 65, 66, 300)]
    for t, ids in zip(some, table.memo.encode([split.findall(t) for t in some]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == multi.encode_ordinary(t)
        assert table.decode(ids) == t.encode()


def test_wide_and_single_trees_agree():
    table = bpe.Ranks(MULTI)
    words = [bytes(random.Random(k).choices(b"aeinrst", k=k % 60 + 1)) for k in range(300)]
    wide = table.merge_many(words, 64)
    assert [np.frombuffer(w, "<u4").tolist() for w in wide] == [table.merge_one(w) for w in words]


def test_bpe_query_on_awkward_rows(spark, awkward, empty, multi):
    got = bpe.encode_documents(awkward, MULTI, P.PATTERN, with_ids=True).collect()
    want = []
    for i, t in texts(awkward):
        ids = np.array(multi.encode_ordinary(t), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), bytes(ids)))
    assert sorted(repr((*r[:4], bytes(r[4]))) for r in got) == sorted(map(repr, want))
    assert bpe.encode_documents(empty, MULTI, P.PATTERN).count() == 0


def test_grammar_round_trip_and_random_access():
    r = np.random.default_rng(4)
    for ids in ([], [5], [3, 3], [3, 3, 3, 3, 3], [1] * 100 + [2] * 7 + [1, 2] * 50, r.integers(0, 9, 3000).tolist(), (r.integers(0, 4, 500).tolist() + [7, 8, 9, 7, 8]) * 6):
        g = grammar.compress(np.array(ids, np.uint16), 10)
        back = grammar.Grammar.of_row(g.row())
        assert back.ids().tolist() == ids
        for a, b in ((0, 0), (0, len(ids)), (len(ids) // 3, len(ids) // 2), (max(0, len(ids) - 1), len(ids))):
            assert back.range(a, b).tolist() == ids[a:b]
    text = r.integers(0, 9, 3000).tolist()
    g = grammar.compress(np.array(text * 3, np.uint32), 10)
    assert len(g.symbols) < 6000


def test_grammar_ends_when_nothing_shrinks(monkeypatch):
    """No pair is left whose replacement would shorten the written block."""
    r = np.random.default_rng(7)
    ids = np.concatenate([r.integers(0, 300, 20_000), np.tile(r.integers(0, 300, 500), 20)])
    g = grammar.compress(ids, 300)
    pairs, n = np.unique(np.stack([g.symbols[:-1], g.symbols[1:]]), axis=1, return_counts=True)
    assert grammar.written(300, len(g.rules), len(g.symbols)) < 0.85 * 2 * len(ids)
    assert (n >= 5).sum() == 0 and g.ids().tolist() == ids.tolist()
    monkeypatch.setattr(grammar, "SHORT", 320)  # two bytes hold 20 rules: the most frequent pairs
    h = grammar.compress(ids, 300)
    assert len(h.rules) == 20 or len(h.rules) > 300
    assert h.ids().tolist() == ids.tolist()


def test_runs_pair_up_from_the_left():
    at, rank = grammar.leftmost(np.array([0, 1, 2, 5, 6, 9]), np.array([0, 0, 0, 1, 0, 2]))
    assert at.tolist() == [0, 2, 6, 9] and rank.tolist() == [0, 0, 0, 2]


@pytest.mark.parametrize("block", [5, 1 << 20])
def test_token_files(spark, awkward, empty, tmp_path, block):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    from pyspark.sql import functions as F

    hashed = {(r.doc_id, r.t or ""): r.h for r in awkward.toDF(*"abcdefgh").select(F.col("a").alias("doc_id"), F.col("b").alias("t"), F.xxhash64("b").alias("h")).collect()}
    rows = sorted(texts(awkward), key=lambda r: (r[0] is not None, r[0] or 0, hashed[r]))
    want, windows, start = [], [], 0
    for i, x in rows:
        ids = [*t.encode(x, add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        windows.append((i, len(ids) // 2, ids[len(ids) // 2 :][:16]))
        start += len(ids)
    got = grammar.token_files(awkward, JSON, block=block, folder=f"file://{tmp_path}/a").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    seen = grammar.token_windows(spark, f"file://{tmp_path}/a").collect()
    assert sorted(map(repr, map(tuple, seen))) == sorted(map(repr, windows))
    assert grammar.token_files(empty, JSON, folder=f"file://{tmp_path}/b").count() == 0
    assert grammar.token_windows(spark, f"file://{tmp_path}/b").count() == 0


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [64, 128, 1024, 2048])
def test_words_that_polynomial_hashes_confuse(n):
    """In both orders, twice in one session, alone and together."""
    a = thue_morse(n)
    b = a.translate(str.maketrans("ab", "ba"))
    e = grammar.LibraryEncoder(JSON)
    for x in ([a], [b], [b], [a], [a, b], [f"x {a} y", f"x {b} y"], [f"x {b} y", f"x {a} y"]):
        assert [i.tolist() for i in e.encode(x)] == [i.ids for i in e.tokenizer.encode_batch(x, add_special_tokens=False)]


def test_bytes_decide_and_not_their_hash(monkeypatch):
    """Even with a hash that tells only lengths apart."""
    monkeypatch.setattr(grammar, "span_hashes", lambda buf, start, stop: (stop - start).astype(np.uint64) << np.uint64(40))
    e = grammar.LibraryEncoder(JSON)
    r = random.Random(3)
    for _ in range(30):
        x = [" ".join(r.choice("ab cd ef alpha gamma delta beta. zeta theta-12345 omega-12345".split()) for _ in range(r.randint(1, 9))) for _ in range(4)]
        assert [i.tolist() for i in e.encode(x)] == [i.ids for i in e.tokenizer.encode_batch(x, add_special_tokens=False)]


def test_every_text_as_the_library_has_it():
    import pyarrow.parquet as pq

    e = grammar.LibraryEncoder(JSON)
    x = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()]
    for a in range(0, len(x), 100):
        want = e.tokenizer.encode_batch(x[a : a + 100], add_special_tokens=False)
        assert [i.tolist() for i in e.encode(x[a : a + 100])] == [i.ids for i in want]


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(grammar, "TEXT", 300)
    e = grammar.LibraryEncoder(JSON)
    r = random.Random(5)
    x = ["  ".join(" ".join(r.choice(["alpha", "b.", "it's", "9"]) for _ in range(30)) for _ in range(6)), "x" * 5000, "a b", "", "z " * 700]
    assert [i.tolist() for i in e.encode(x)] == [i.ids for i in e.tokenizer.encode_batch(x, add_special_tokens=False)]


def test_other_tokenizers_go_whole(awkward):
    e = grammar.LibraryEncoder(P.path("word_bpe_49k.json"))
    x = [t for _, t in texts(awkward)]
    want = [i.ids for i in e.tokenizer.encode_batch(x, add_special_tokens=False)]
    assert not e.by_word and [i.tolist() for i in e.encode(x)] == want


def test_the_memo_forgets_without_harm():
    e = grammar.LibraryEncoder(JSON)
    e.words = grammar.WordTable(e.kind, bits=6)
    r = random.Random(2)
    for _ in range(20):
        x = [" ".join(r.choice("alpha beta gamma delta. zeta, eta! theta-9".split()) for _ in range(9)) + "\nend" for _ in range(5)]
        want = [i.ids for i in e.tokenizer.encode_batch(x, add_special_tokens=False)]
        assert [i.tolist() for i in e.encode(x)] == want


def test_word_sums_equal_whole_texts():
    e = grammar.LibraryEncoder(JSON)
    r = random.Random(12)
    parts = ["the", "The", "of,", "it's", "'s", "!!", "...", "é", "naïve.", "日本", "a\u3000b", "x\x1cy", "<|endoftext|>", "w<|endoftext|>", "12", "3.14", "_a_", "--", "e\u0301", "\u200b", "don't!"]
    x = ["", " ", "\n", "a", "a ", " a", "a\n", "\na", "a\n\nb", "a  b", "a\tb", "a \nb", "a\n b", "\r\n"]
    x += ["".join(r.choice(parts) + r.choice([" ", " ", " ", "\n", "", "  "]) for _ in range(r.randint(0, 30))) for _ in range(400)]
    want = [i.ids for i in e.tokenizer.encode_batch(x, add_special_tokens=False)]
    assert [i.tolist() for i in e.encode(x)] == want
    assert [i.tolist() for i in e.encode(x[5:6])] == want[5:6] and e.encode([]) == []


def test_rollup_follows_changes(spark, tmp_path):
    store = rollup.TokenRollup(spark, f"file://{tmp_path}/r")
    c = lambda *rows: spark.createDataFrame(rows, "doc_id long, source string, lang string, tokenizer_version string, n_tokens long, change string, DOC_ID string")
    total = lambda: sorted(((r.source, r.lang, r.n_docs, r.n_tokens) for r in store.totals().collect()), key=repr)
    assert total() == []
    assert store.commit("a", c((1, "s", "en", "v", 10, "insert", ""), (2, "s", "en", "v", 5, "insert", ""), (None, None, None, "v", 3, "insert", "")))
    assert total() == sorted([("s", "en", 2, 15), (None, None, 1, 3)], key=repr)
    assert store.commit("b", c((1, "t", "en", "v", 7, "revise", ""), (9, "s", "en", "v", 0, "delete", ""), (None, None, None, "v", 0, "delete", "")))
    assert total() == [("s", "en", 1, 5), ("t", "en", 1, 7)]
    assert not store.commit("a", c((1, "s", "en", "v", 10, "insert", "")))
    assert not store.commit("b", c((1, "t", "en", "v", 7, "revise", "")))
    assert total() == [("s", "en", 1, 5), ("t", "en", 1, 7)]
    # a batch that failed before its entry left files; it runs again and counts once
    store._write(spark.createDataFrame([(2, "v", "s", "en", 99, 1, 3)], rollup.LEDGER), 64)
    assert total() == [("s", "en", 1, 5), ("t", "en", 1, 7)]
    assert store.commit("c", c((2, "s", "en", "v", 1, "delete", ""), (2, "s", "en", "v", 4, "revise", ""), (2, "s", "en", "v", 6, "revise", "")))
    assert total() == [("s", "en", 1, 6), ("t", "en", 1, 7)]
    assert sorted((r.doc_id, r.n_tokens) for r in store.current().collect()) == [(1, 7), (2, 6)]
    assert store.commit("d", c()) and total() == [("s", "en", 1, 6), ("t", "en", 1, 7)]
    assert store.compact() and total() == [("s", "en", 1, 6), ("t", "en", 1, 7)] and len(store.live(store.log())) == 1
    assert not store.commit("a", c((1, "s", "en", "v", 10, "insert", "")))
    assert store.commit("e", c((1, "t", "en", "v", 8, "revise", ""))) and total() == [("s", "en", 1, 6), ("t", "en", 1, 8)]


@pytest.mark.parametrize("other", ["same", "different"])
def test_two_writers(spark, tmp_path, other):
    """One that comes between a writer's reading and its commit: each batch counts once, on top of the other."""
    c = lambda *rows: spark.createDataFrame(rows, "doc_id long, source string, lang string, tokenizer_version string, n_tokens long, change string")
    folder = f"file://{tmp_path}/{other}"
    assert rollup.TokenRollup(spark, folder).commit("load", c((1, "s", "en", "v", 10, "insert"), (2, "s", "en", "v", 5, "insert")))

    class Slow(rollup.TokenRollup):
        tries = 0

        def _append(self, entry):
            self.tries += 1
            if self.tries == 1:
                change = (1, "s", "en", "v", 7, "revise") if other == "same" else (1, "t", "en", "v", 20, "revise")
                assert rollup.TokenRollup(spark, folder).commit("x" if other == "same" else "y", c(change))
            return super()._append(entry)

    slow = Slow(spark, folder)
    assert slow.commit("x", c((1, "s", "en", "v", 7, "revise"))) == (other == "different")
    assert {(r.source, r.n_docs, r.n_tokens) for r in slow.totals().collect()} == {("s", 2, 12)}
    assert sorted((r.doc_id, r.n_tokens) for r in slow.current().collect()) == [(1, 7), (2, 5)]
    assert len([e for e in slow.log() if e["batch"] == "x"]) == 1
    import os

    assert len(os.listdir(f"{tmp_path}/{other}/ledger")) == len(slow.log())


def test_the_ledger_is_rewritten_after_some_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rollup, "COMPACT", 3)
    store = rollup.TokenRollup(spark, f"file://{tmp_path}/r")
    c = lambda *rows: spark.createDataFrame(rows, "doc_id long, source string, lang string, tokenizer_version string, n_tokens long, change string")
    for k in range(7):
        assert store.commit(f"b{k}", c((k % 3, "s", "en", "v", k, "revise")))
        assert len(store.live(store.log())) <= 4
    assert sorted((r.doc_id, r.n_tokens) for r in store.current().collect()) == [(0, 6), (1, 4), (2, 5)]
    assert [(r.n_docs, r.n_tokens) for r in store.totals().collect()] == [(3, 15)]


def test_buckets_follow_the_ledger_and_the_log_is_read_from_its_pointer(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rollup, "COMPACT", 3)
    monkeypatch.setattr(rollup, "BUCKETS", 2)
    monkeypatch.setattr(rollup, "ROWS", 10)
    store = rollup.TokenRollup(spark, f"file://{tmp_path}/r")
    c = lambda a, e, n, change="insert": spark.range(a, e).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit("v").alias("tokenizer_version"), F.lit(n).cast("long").alias("n_tokens"), F.lit(change).alias("change"))
    assert store.commit("b0", c(0, 15, 1))
    few = store.buckets(store.tail())
    for k in range(1, 5):
        assert store.commit(f"b{k}", c(15 * k, 15 * k + 100, 1))
    assert few == 2 and store.buckets(store.tail()) >= 8  # rewritten with more
    assert len(store.tail()) < len(store.log()) and not store.commit("b0", c(0, 15, 9)) and store.known("b2") and not store.known("b9")
    assert store.commit("less", c(0, 160, 0, "delete")) and store.compact() and len(store.tail()) == 1
    assert store.buckets(store.tail()) == 2 and [(r.n_docs, r.n_tokens) for r in store.totals().collect()] == []
    assert store.commit("again", c(3, 5, 7)) and [(r.n_docs, r.n_tokens) for r in store.totals().collect()] == [(2, 14)]
    used = spark.read.parquet(f"file://{tmp_path}/r/ledger").select("bucket").distinct().count()
    assert used >= 8


def test_maintained_equals_counting_again(spark, awkward, empty, tmp_path):
    enc = rollup.coder(RANKS, P.PATTERN)
    got = rollup.maintained(awkward, "v", RANKS, P.PATTERN, f"file://{tmp_path}/a")
    first, seen = {}, {}
    for r in awkward.collect():
        first.setdefault(r[1] or "", []).append(r.doc_id)
    for r in awkward.collect():
        ids = [i for i in first[r[1] or ""] if i is not None]
        if r.doc_id is None or r.doc_id == min(ids):
            t = "\n".join(dict.fromkeys((r[1] or "").split("\n")))
            key = (r.doc_id, r.source, r.lang)
            seen[key] = max(seen.get(key, 0), len(enc.encode_ordinary(t)))
    # rows with a null id are one document: the largest count stays
    kept = max((k for k in seen if k[0] is None), key=lambda k: seen[k])
    want = {}
    for k, n in seen.items():
        if k[0] is not None or k == kept:
            d, t = want.get(k[1:], (0, 0))
            want[k[1:]] = (d + 1, t + n)
    assert {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in got.collect()} == want
    assert rollup.maintained(empty, "v", RANKS, P.PATTERN, f"file://{tmp_path}/b").count() == 0


def test_words_in_pieces(monkeypatch):
    from wayfold.llm import shingles

    t = ["a bb  ccc\tdd", "", None, "x" * 100 + " y\nz", " lead", "trail "] * 3
    whole = words_of(t)
    monkeypatch.setattr(shingles, "PIECE", 16)
    cut = words_of(t)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist() == [4, 0, 0, 3, 1, 1] * 3


def test_hot_ids_are_spread_over_shards(spark, tmp_path):
    """Null ids and one repeated id, also with one text, lie in several shards, in one order."""
    from pyspark.sql import functions as F

    rows = [(None, f"text {i}") for i in range(300)] + [(7, "the same text")] * 300 + [(i, f"doc {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = grammar.token_files(df, JSON, folder=f"file://{tmp_path}/t").orderBy("start").collect()
    assert len(got) == len(rows) and [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    shards = spark.read.parquet(f"file://{tmp_path}/t").select("shard", F.explode("doc_id").alias("d")).groupBy("d").agg(F.countDistinct("shard").alias("n"))
    many = {r.d: r.n for r in shards.collect()}
    assert many[None] > 1 and many[7] > 1


def test_copies_of_one_text(spark, tmp_path):
    rows = [(i, "one two three\none two three", "en", "s") for i in range(400)] + [(i, f"own words {i}", None, "s") for i in range(400, 420)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    got = {r.lang: (r.n_docs, r.n_tokens) for r in rollup.maintained(df, "v", folder=f"file://{tmp_path}/c").collect()}
    assert got == {"en": (1, 3), None: (20, 60)}
