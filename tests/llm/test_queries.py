"""The registered queries on the smallest tables, and the pipeline stage by stage."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm.test_neardup import brute
from wayfold.llm import pii, quality, registry

SF = "/root/testdata/sf0.001"


def plain(rows, cols):
    order = sorted(range(len(cols)), key=cols.__getitem__)
    return sorted((tuple(float(f"{r[i]:.10g}") if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql_gives_the_same_rows(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = registry.queries()[name](spark, SF), c.sql(registry.oracle_sql()[name])
    assert plain(got.collect(), got.columns) == plain(want.fetchall(), want.columns)


def test_all_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", [n for n in registry.queries() if n.startswith(("op4", "op5", "op8", "op11"))])
def test_one_row_a_document(spark, name):
    assert registry.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, start = docs.columns, docs.collect()
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = [r for r, s in zip(start, model.score([r.text for r in start]), strict=True) if s >= quality.THRESHOLD]
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert name == "byte_bpe" or out.columns == names
        out.write.parquet(f"file://{tmp_path}/{name}")
        docs = spark.read.parquet(f"file://{tmp_path}/{name}")
        steps.append(docs.collect())
    good, once, clean, mixed, coded = steps
    key = lambda rows: sorted(map(repr, map(tuple, rows)))
    assert key(good) == key(want) and 0 < len(good) < len(start)
    top = brute([(r.doc_id, r.text) for r in good], 5, 80)
    assert key(once) == key([r for r in good if top[r.doc_id] == r.doc_id])
    w = pii.fitted()
    assert sorted((r.doc_id, r.text, r.n_chars) for r in clean) == sorted((r.doc_id, t := pii.redacted(w, r.text), len(t)) for r in once)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in clean} and len(coded) == len(mixed)
    text = {r.doc_id: r.text for r in clean}
    assert all(text[r.doc_id] == r.text for r in mixed)
    assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() for r in coded)


def test_run_equals_its_stages(spark):
    a = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted(map(tuple, a.drop("ids").collect())) == sorted(map(tuple, docs.drop("ids").collect()))


def test_pipeline_on_awkward_and_empty_rows(spark, tmp_path):
    os.makedirs(tmp_path / "sf", exist_ok=True)
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra int"
    rows = [(None, None, None, None, None, 1), (1, "same text of some five words or more", "en", "a", 36, 1), (1, "same text of some five words or more", "en", "a", 36, 1), (2, "same text of some five words or more", "en", "a", 36, 2), (3, "", "en", "b", 0, 3), (4, "mail me at a@b.co now", "en", None, 21, 4)]
    for k, (data, n) in enumerate(((rows, 4), ([], 0))):
        sf = f"file://{tmp_path}/sf{k}"
        spark.createDataFrame(data, schema).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:3]:
            docs = stage(spark, docs, sf)
        kept = docs.collect()
        assert len(kept) == n and (not n or {r.doc_id: r.text for r in kept}[4] == "mail me at [EMAIL] now")
        corpus_pipeline.run(spark, sf).collect()


def test_repeated_ids_with_columns_that_have_no_order(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, tags map<string,int>, parts array<int>, more struct<a:int,b:map<string,string>>"
    text = "one text of more than five words here"
    rows = [(1, text, "en", "a", 37, {"x": 1}, [1], (1, {"k": "v"})), (1, text, "en", "b", 37, {"x": 2}, [2], (2, None)), (1, "a smaller text of some six words", "en", "c", 32, None, None, None), (2, text, "en", "a", 37, {}, [], None), (3, None, None, None, None, {"y": 1}, None, None)]
    docs = spark.createDataFrame(rows, schema)
    once = lambda: sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()), key=repr)
    got = once()
    assert [r[:2] for r in got] == [(1, "a smaller text of some six words"), (3, None)] and once() == got
    for stage in (corpus_pipeline.redact_personal_data, corpus_pipeline.mix_sources):
        assert stage(spark, docs, SF).columns == docs.columns
