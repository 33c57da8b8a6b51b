"""Each operator of this package applied to its whole table, with production parameters.

None of them is expressed in SQL: they are tested against brute force, exact round trips
and held-out labels in ``tests/llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    fingerprint,
    jaccard_join,
    language_id,
    mixing,
    pii,
    quality_rules,
    rtree_negatives,
    secret_scan,
    site_style,
    topk_blocks,
    toxicity,
    whitening,
)
from .common import fold, table

#: Shares of all tokens for the domains of the ``labels`` table.
TARGETS = {
    "quality1-toxic0": 0.92,
    "quality0-toxic0": 0.06,
    "quality1-toxic1": 0.015,
    "quality0-toxic1": 0.005,
}


def targets_for(domains) -> dict[str, float]:
    """The targets of the domains that the labels have, as shares of 1."""
    own = {d: TARGETS[d] for d in domains if d in TARGETS}
    return {d: share / sum(own.values()) for d, share in own.items()}


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_site_style_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.extract(table(spark, sf_dir, "pages"))


def op2_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_blocks.integer_vectors(table(spark, sf_dir, "embeddings"))
    queries = vectors.where(F.col("vec_id") % 100 == 0)
    found = topk_blocks.search(vectors, queries, k=10)
    return found.withColumn("rank", F.col("rank").cast("int"))


def op3_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labelled = mixing.domain_of(table(spark, sf_dir, "labels"))
    domains = [r.domain for r in labelled.select("domain").distinct().take(mixing.MAX_DOMAINS)]
    return mixing.report(docs, mixing.train_and_fit(docs, labelled, targets_for(domains)))


def op4_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.report(docs, pii.train(docs))


def op5_secret_lexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary())
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"), 3, jaccard_join.Ratio(9, 10))


def op8_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.learnable())
    return toxicity.score(docs, model)


def op9_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.profiles(docs.where(language_id.learned_from()))
    named = language_id.identify(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare(table(spark, sf_dir, "documents"))


def op11_rtree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    vec_id, label = F.col("vec_id"), F.col("label")
    relabelled = rows.select(
        "vec_id",
        "embedding",
        F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
    )
    return rtree_negatives.mine(rtree_negatives.labelled_vectors(relabelled, vec_id % 50 == 0))


def op12_refined_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return whitening.report(rows, whitening.fit(rows))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


ALL = {
    f.__name__: f
    for f in (
        op1_site_style_text,
        op2_block_topk,
        op3_soft_mixing,
        op4_pii_boosting,
        op5_secret_lexing,
        op6_forced_boundary_bpe,
        op7_jaccard_join,
        op8_compression_toxicity,
        op9_rank_order_language,
        op10_multiset_fingerprint,
        op11_rtree_negatives,
        op12_refined_whitening,
        op13_quality_rules,
    )
}
#: No operator's result is expressible in SQL.
ORACLE_SQL: dict[str, str] = {}
