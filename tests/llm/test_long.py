"""Very long words, lines and numbers of lines go through every operator whole."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from wayfold.llm import bpe, fingerprint, grammar, licenses, mixing, neardup, pii, quality, rollup

WORD, LINE = "".join(chr(97 + i * i % 26) for i in range(150_000)), " ".join(f"w{i % 5000}" for i in range(60_000))
TEXTS = {1: WORD, 2: LINE, 3: "\n" * 60_000, 4: WORD + " " + LINE, 5: LINE + " x", 6: "é" * 70_000, 7: "a.b " * 40_000, 8: "1 " * 50_000}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s") for i, t in TEXTS.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)


def test_near_duplicates(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, 3, 85).collect()}
    assert got == {1: (1, 1), 2: (5000, 2), 3: (0, 3), 4: (5001, 2), 5: (5001, 2), 6: (1, 6), 7: (1, 7), 8: (1, 8)}


def test_token_files(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in grammar.token_files(docs, P.path("byte_bpe_50k.json"), folder=f"file://{tmp_path}/t").collect()}
    for i, text in TEXTS.items():
        ids = [*t.encode(text, add_special_tokens=False).ids, 2]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_byte_bpe(docs):
    enc = rollup.coder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    for r in bpe.encode_documents(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect():
        ids = np.array(enc.encode_ordinary(TEXTS[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(TEXTS[r.doc_id].encode()).hexdigest()


def test_the_rest(spark, docs, tmp_path):
    labels = spark.createDataFrame([(i, i % 2) for i in TEXTS], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.quality(docs, labels).collect())
    assert [r.license for r in licenses.license_scan(docs).collect()] == [None] * 8
    assert {r.doc_id: r.size for r in mixing.mix(docs).collect()} == {i: len(t.split()) for i, t in TEXTS.items()}
    assert {r.doc_id: r.n_card for r in pii.personal_data(docs).collect()} == dict.fromkeys(TEXTS, 0)
    assert pii.redact(docs).count() == 8
    prints = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    assert {i: r.n_chars for i, r in prints.items()} == {i: len(t) for i, t in TEXTS.items()}
    half = len(WORD) - len(WORD) // 2
    assert prints[1].edited_sha256 == hashlib.sha256((WORD[:half] + LINE[: len(WORD) // 2]).encode()).hexdigest()
    assert rollup.maintained(docs, "v", folder=f"file://{tmp_path}/r").first().n_docs == 8
