"""A training corpus from ``documents``: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.llm import bpe, jaccard_join, language_id, mixing, pii
from stratalake.llm.common import stored, table
from stratalake.llm.queries import targets_for, vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in no language of the labelled ones, go."""
    return language_id.accepted(docs, language_id.profiles(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that is linked by a similarity of 0.8 on five words, one stays."""
    return jaccard_join.keep_one(docs, 5, jaccard_join.Ratio(4, 5))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kinds; ``n_chars`` follows the text."""
    redacted = pii.redact(docs, pii.train(docs))
    return pii.with_length(redacted)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows occur as often as their rates say, so that domains have their target tokens."""
    labelled = mixing.domain_of(table(spark, sf_dir, "labels"))
    domains = [r.domain for r in labelled.select("domain").distinct().take(mixing.MAX_DOMAINS)]
    return mixing.resampled(docs, mixing.train_and_fit(docs, labelled, targets_for(domains)))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text: ``doc_id``, ``ids``, ``n_tokens``."""
    return bpe.encode(docs, vocabulary()).select("doc_id", "ids", "n_tokens")


STAGES = [
    ("language_id", identify_language),
    ("near_copies", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("mixing", mix_domains),
    ("tokens", encode_tokens),
]

#: No stage is expressible in SQL; each is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
