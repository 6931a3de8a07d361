"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import importlib

from pyspark.sql import functions as F

from . import bpe, fingerprint, grammar, langid, licenses, mixing, neardup, negatives, pii, quality, rollup, topk, trie
from .common import documents, text_batches

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.rid <> q.rid
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def op10(spark, sf_dir):
    text_batches(spark)
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(rows, F.col("vec_id") % 100 == 0, k=10, scale=1024.0)


def op1(spark, sf_dir):
    import public_tokenizers

    return rollup.maintained(documents(spark, sf_dir), "byte_bpe_50k", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_words(spark, sf_dir):
    return rollup.maintained(documents(spark, sf_dir), "words-1")


def op5(spark, sf_dir):
    return licenses.license_scan(documents(spark, sf_dir))


def op2(spark, sf_dir):
    import public_tokenizers

    return grammar.token_files(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def token_windows(spark, sf_dir):
    import public_tokenizers

    from .common import new_folder

    folder = new_folder(spark, "token-ids")
    grammar.write_ids(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return grammar.token_windows(spark, folder)


def op3(spark, sf_dir):
    return neardup.near_duplicates(documents(spark, sf_dir), width=3, percent=85)


def op4(spark, sf_dir):
    return quality.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6(spark, sf_dir):
    import public_tokenizers

    return bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op8(spark, sf_dir):
    return pii.personal_data(documents(spark, sf_dir))


def op9(spark, sf_dir):
    return fingerprint.fingerprints(documents(spark, sf_dir))


def op11(spark, sf_dir):
    return langid.languages(documents(spark, sf_dir))


def likeness(spark, sf_dir):
    """What SQL can say about op9: all but the sketches' own digests."""
    return fingerprint.fingerprints(documents(spark, sf_dir)).drop("fingerprint", "edited_fingerprint")


def queries() -> dict:
    return {
        "op1_token_rollup": op1,
        "token_rollup_words": op1_words,
        "op2_token_files": op2,
        "token_windows": token_windows,
        "op3_near_duplicates": op3,
        "op4_line_quality": op4,
        "op5_license_scan": op5,
        "op6_byte_bpe": op6,
        "op7_mix_sources": mixing.op7,
        "op8_personal_data": op8,
        "op9_paragraph_sketch": op9,
        "edited_likeness": likeness,
        "op10_exact_top_k": op10,
        "op11_language_trees": op11,
        "op12_prefix_trie": trie.op12,
        "op13_hard_negatives": negatives.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {"token_rollup_words": rollup.ROLLUP_SQL, "op3_near_duplicates": neardup.SQL, "edited_likeness": fingerprint.LIKENESS_SQL, "op7_mix_sources": mixing.MIX_SQL, "op10_exact_top_k": TOPK_SQL, "op12_prefix_trie": trie.TRIE_SQL, "op13_hard_negatives": negatives.NEGATIVES_SQL}
