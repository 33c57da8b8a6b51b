"""Mixing sources to target weights by soft memberships.

A classifier trained on a labelled table gives every document a probability for each
domain. Rates, the expected numbers of copies of the documents, are then fitted so that
the expected tokens of each domain meet its target: with tokens t, posteriors p and
rates r >= 0, the sum over documents of r t p[d] shall be the target of d. Projected
gradient descent minimises the squared differences, each divided by its target, starting
from rate 1. It runs in variables scaled by sqrt(t), so that a rate changes by its
posteriors and not by its length, with the step that the scaled Gram matrix allows.

A step needs one sum per domain over all documents, which Spark gathers; a document's
rate after any number of steps is a fold of its posteriors over the differences of those
steps, so no rates are stored or moved. Domains come from the labels and are few.

The classifier is naive Bayes over hashed words, trained on at most ``MAX_LABELLED``
documents, the ones with the smallest hashes of their ids: a bounded sample, which may be
broadcast. Posteriors are tempered (``TEMPERATURE`` per token), because word counts are
far from independent.

Defined results: a null or empty text has no tokens, the prior as posterior, and takes
part in no sum; null labels teach nothing; of several labels of one document the
smallest counts; the share of a target domain that no labelled document has goes to the
other targets in proportion; a domain without target keeps its share; without labels or
documents, or targets of learned domains, every rate is 1.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

MAX_LABELLED = 20_000
#: Domains that labels may have; more is an error.
MAX_DOMAINS = 64
BUCKETS = 1 << 14
#: A text's evidence counts as that of about so many words.
TEMPERATURE = 30.0
STEPS = 40
#: Steps end when no difference is above this share of its target.
TOLERANCE = 0.002


@dataclass(frozen=True)
class Classifier:
    domains: tuple[str, ...]
    prior: tuple[float, ...]
    #: Log probability of a word's bucket in a domain: bytes of a buckets x domains matrix.
    words: bytes

    def posteriors(self, texts: list[str]) -> tuple[list[int], np.ndarray]:
        """Each text's tokens and its probabilities of the domains."""
        table = np.frombuffer(self.words).reshape(BUCKETS, len(self.domains))
        prior = np.array(self.prior)
        tokens, found = [], np.empty((len(texts), len(self.domains)))
        for i, text in enumerate(texts):
            own = buckets(text)
            tokens.append(len(own))
            evidence = table[own].sum(axis=0) if own else np.zeros(len(prior))
            logs = prior + evidence * min(1.0, TEMPERATURE / max(1, len(own)))
            odds = np.exp(logs - logs.max())
            found[i] = odds / odds.sum()
        return tokens, found


def buckets(text: str) -> list[int]:
    """The hash buckets of a text's words, one a token."""
    return [zlib.crc32(word) % BUCKETS for word in text.lower().encode("utf-8", "replace").split()]


def domain_of(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``domain`` of the labels: quality and toxicity together."""
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    domain = F.format_string("quality%d-toxic%d", "quality", "toxic")
    return known.select(F.col("doc_id").cast("long").alias("doc_id"), domain.alias("domain"))


def train(docs: DataFrame, labelled: DataFrame) -> Classifier | None:
    """A classifier of the domains in ``labelled`` (doc_id, domain); None without any."""
    sample = (
        labelled.groupBy("doc_id")
        .agg(F.min("domain").alias("domain"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MAX_LABELLED)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.where("text is not null").join(F.broadcast(sample), "doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            columns = (batch.column(c).to_pylist() for c in ("domain", "text"))
            for domain, text in zip(*columns):
                own = held.setdefault(domain, np.zeros(BUCKETS + 1, np.int64))
                own += np.bincount([*buckets(text), BUCKETS], minlength=BUCKETS + 1)
        for domain, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([domain] * len(at)), pa.array(at), pa.array(counts[at])],
                names=["domain", "bucket", "n"],
            )

    counts = rows.select("domain", "text").mapInArrow(count, "domain string, bucket long, n long")
    most = MAX_DOMAINS * (BUCKETS + 1)
    found = counts.groupBy("domain", "bucket").agg(F.sum("n").alias("n")).take(most + 1)
    domains = sorted({r.domain for r in found})
    if len(domains) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains in the labels")
    if not domains:
        return None
    table = np.zeros((BUCKETS + 1, len(domains)))
    for row in found:
        table[row.bucket, domains.index(row.domain)] = row.n
    documents, words = table[BUCKETS], table[:BUCKETS] + 0.5
    logs = np.log(words / words.sum(axis=0))
    prior = np.log((documents + 1) / (documents + 1).sum())
    return Classifier(tuple(domains), tuple(map(float, prior)), logs.astype(np.float64).tobytes())


def classify(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``docs`` with ``mix_tokens`` and ``mix_posteriors``, in the order of the domains."""
    at = docs.columns.index("text")
    names = [*docs.columns, "mix_tokens", "mix_posteriors"]

    def classified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [text or "" for text in batch.column(at).to_pylist()]
            tokens, found = classifier.posteriors(texts)
            posteriors = pa.array(list(found), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tokens, pa.int64()), posteriors], names=names
            )

    empty = F.array().cast("array<double>")
    schema = docs.withColumns({"mix_tokens": F.lit(0).cast("long"), "mix_posteriors": empty}).schema
    return docs.mapInArrow(classified, schema)


def rate(posteriors: Column, tokens: Column, steps: list[list[float]]) -> Column:
    """A document's rate after steps along the given differences, never below 0."""
    if not steps:
        return F.lit(1.0)
    table = F.array(*(F.array(*map(F.lit, step)) for step in steps))

    def moved(value: Column, step: Column) -> Column:
        slope = F.aggregate(
            F.zip_with(posteriors, step, lambda p, d: p * d), F.lit(0.0), lambda a, x: a + x
        )
        return F.greatest(value - slope, F.lit(0.0))

    return F.when(tokens == 0, 1.0).otherwise(F.aggregate(table, F.lit(1.0), moved))


def fit(
    classified: DataFrame, domains: tuple[str, ...], targets: dict[str, float]
) -> list[list[float]]:
    """The steps of projected gradient descent; ``targets`` are shares of all tokens."""
    known_share = sum(share for d, share in targets.items() if d in domains)
    larger = sum(targets.values()) / known_share if known_share else 1.0
    targets = {d: share * larger for d, share in targets.items() if d in domains}
    known = classified.where("mix_tokens > 0").select(
        F.col("mix_tokens").cast("double").alias("t"), F.col("mix_posteriors").alias("p")
    )
    places = range(len(domains))
    grams = [(i, j) for i in places for j in places if i <= j]
    sums = known.agg(
        F.sum("t").alias("t"), *(F.sum(F.col("t") * F.col("p")[i] * F.col("p")[j]) for i, j in grams)
    ).first()
    total = sums["t"]
    if not total:
        return []
    gram = np.zeros((len(domains), len(domains)))
    for (i, j), value in zip(grams, sums[1:]):
        gram[i, j] = gram[j, i] = value
    wanted = np.array([targets.get(d, np.nan) for d in domains]) * total
    # What a domain has at rate 1 is the sum of its row of the Gram matrix.
    wanted = np.where(np.isnan(wanted), gram.sum(axis=1), wanted)
    scale = np.maximum(wanted, TOLERANCE * total)
    step = 1 / np.linalg.eigvalsh(gram / np.sqrt(np.outer(scale, scale)))[-1]
    steps: list[list[float]] = []
    for _ in range(STEPS):
        now = known.agg(
            *(F.sum(rate(F.col("p"), F.col("t"), steps) * F.col("t") * F.col("p")[i]) for i in places)
        ).first()
        difference = (np.array(now, np.float64) - wanted) / scale
        if np.abs(difference).max() <= TOLERANCE:
            break
        steps.append([float(step * d) for d in difference])
    return steps


@dataclass(frozen=True)
class Mixture:
    """A fitted mixture: the classifier and the steps to each document's rate."""

    classifier: Classifier | None
    steps: list[list[float]]


def train_and_fit(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float]
) -> Mixture:
    """``targets``: the share of all tokens each domain shall have."""
    classifier = train(docs, labelled)
    if classifier is None:
        return Mixture(None, [])
    measured = classify(docs.select("text"), classifier).select("mix_tokens", "mix_posteriors")
    return Mixture(
        classifier, fit(stored(measured, "mixing-posteriors"), classifier.domains, targets)
    )


def rated(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """``docs`` with ``mix_tokens``, ``mix_posteriors`` and ``mix_rate``."""
    if mixture.classifier is None:
        empty = F.array().cast("array<double>")
        tokens = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != ""))
        return docs.withColumns(
            {
                "mix_tokens": tokens.cast("long"),
                "mix_posteriors": empty,
                "mix_rate": F.lit(1.0),
            }
        )
    known = classify(docs, mixture.classifier)
    value = rate(F.col("mix_posteriors"), F.col("mix_tokens"), mixture.steps)
    return known.withColumn("mix_rate", value)


def report(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """Per document: tokens, the likeliest domain, its posterior and the rate."""
    domains = mixture.classifier.domains if mixture.classifier else ()
    found = rated(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), mixture)
    best = F.array_max("mix_posteriors")
    names = F.array(*map(F.lit, domains)).cast("array<string>")
    place = F.array_position("mix_posteriors", best)
    posteriors = [F.get("mix_posteriors", i).alias(f"p_{d}") for i, d in enumerate(domains)]
    return found.select(
        "doc_id",
        F.col("mix_tokens").alias("n_tokens"),
        F.get(names, (place - 1).cast("int")).alias("domain"),
        best.alias("posterior"),
        F.col("mix_rate").alias("rate"),
        *posteriors,
    )


def resampled(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """``docs`` with each row as often as its rate says.

    The fraction of a rate is rounded up for the share of ids whose hash falls below it,
    the same ones every time. Rows without id are rounded by the hash of their text.
    """
    row = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"))
    key = F.when(F.col("row.doc_id").isNotNull(), F.col("row.doc_id").cast("string")).otherwise(
        F.coalesce("text", F.lit(""))
    )
    chance = F.crc32(key) / F.lit(float(1 << 32))
    found = rated(row, mixture)
    copies = F.floor(F.col("mix_rate") + chance).cast("int")
    none = F.array().cast("array<int>")
    times = F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(none)
    repeated = found.select("row", F.explode_outer(times).alias("mix_copy"))
    return repeated.where("mix_copy is not null").select("row.*")
