"""The registered queries of this subpackage: thin digests of its operators' outputs."""

from __future__ import annotations

import public_tokenizers

from . import bpe, exact_dedup, fingerprint, lm, ngram_jaccard, packing, pii, substring, toxicity, wavelet
from ._common import documents

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


@_query
def op3_pii(spark, sf_dir):
    return pii.report(documents(spark, sf_dir))


@_query
def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(documents(spark, sf_dir))


SQL["op10_exact_dedup"] = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t,
             max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
             count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size
      FROM documents)
"""


@_query
def op2_wavelet_ids(spark, sf_dir):
    return wavelet.encoded_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op5_substring_dedup(spark, sf_dir):
    return substring.duplicate_words(documents(spark, sf_dir))


@_query
def op7_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op8_fingerprints(spark, sf_dir):
    return fingerprint.edited_report(documents(spark, sf_dir))


@_query
def op9_byte_bpe(spark, sf_dir):
    return bpe.encode_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@_query
def op1_ngram_jaccard(spark, sf_dir):
    return ngram_jaccard.similar_groups(documents(spark, sf_dir))


@_query
def op4_lm_scores(spark, sf_dir):
    return lm.score_texts(documents(spark, sf_dir))


@_query
def op6_toxicity(spark, sf_dir):
    return toxicity.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
