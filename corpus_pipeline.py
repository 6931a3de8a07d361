"""The corpus pipeline: stages over documents, each writing what the next one reads.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. The driver, or run(), writes each result as Parquet and rereads it.
"""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import functions as F

from wayfold.llm import bpe, mixing, neardup, pii, quality
from wayfold.llm.common import stored, text_batches


def keep_quality(spark, docs, sf_dir):
    """Documents that the line model rejects go; rows with equal texts go or stay together, a
    null or empty text is one empty line and is scored like any other."""
    text_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark, docs, sf_dir):
    """The document with the smallest id of each group of near duplicates stays (five words, 0.8).

    Rows that share an id are one document, of which the row with the smallest text stays (then
    the smallest hash of its other columns; maps and variants don't count); rows with a null id stay unless their text's group has a document with an id; texts without words
    are in no group.
    """
    text_batches(spark)
    marked = stored(neardup.near_duplicates(docs, width=5, percent=80).select("doc_id", "kept"), "pipeline-marked")
    names, at, text = docs.columns, docs.columns.index("doc_id"), docs.columns.index("text")
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    small = lambda df: F.broadcast(df) if df.count() <= neardup.BROADCAST_ROWS else df
    gone = marked.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    left = plain.join(small(gone), F.col(f"_c{at}") == F.col("_gone"), "left_anti")
    again = marked.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias("_again")).count().where("count > 1").select("_again")
    if again.isEmpty():
        return left.toDF(*names)
    again, same = small(again), F.col(f"_c{at}") == F.col("_again")
    # the least row of an id, combined before it is shuffled: no task holds all rows of an id
    hashed = [f.name for f in plain.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    order = F.struct(F.col(f"_c{text}").alias("t"), F.xxhash64(*hashed).alias("h"))
    row = F.struct(*[F.col(c) for c in plain.columns])
    one = left.join(again, same, "left_semi").groupBy(f"_c{at}").agg(F.min_by(row, order).alias("m")).select("m.*")
    return left.join(again, same, "left_anti").union(one).toDF(*names)


def redact_personal_data(spark, docs, sf_dir):
    """Spans of personal data become their kind in brackets; a null text stays null, and all rows
    and columns stay, n_chars following the new text."""
    text_batches(spark)
    return pii.redact(docs)


def mix_sources(spark, docs, sf_dir):
    """Each row as often as the mix takes it: a null text has size 0, a null source is a source
    of its own, equal rows may be taken differently, reruns agree."""
    text_batches(spark)
    return mixing.mixed_rows(docs)


def encode(spark, docs, sf_dir):
    """doc_id, n_tokens and digests of the ids and of the decoded text, for each row of the mix;
    a null text is empty and has no ids."""
    text_batches(spark)
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]
#: Fitted models, shingle sets and byte-pair merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
