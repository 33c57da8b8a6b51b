"""Learned operators: held-out accuracy, odd rows, targets that are met."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import language_id, mixing, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op9_rank_order_language(spark, SF).collect()
    assert {r.doc_id for r in rows} == docs.keys()
    out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in out)
    assert right / len(out) > 0.97


def test_places_are_compared_as_defined():
    a, b = (language_id.ranked(t, 5) for t in ("aaab", "bbba"))
    ranks = language_id.Ranks({"a": a.tolist(), "b": b.tolist()}, 5)
    assert ranks.best("aaab") == ("a", 1.0)
    own = a.tolist()
    apart = sum(abs(i - b.tolist().index(g)) if g in b else 5 for i, g in enumerate(own))
    only_b = language_id.Ranks({"b": b.tolist()}, 5)
    assert only_b.best("aaab")[1] == pytest.approx(1 - apart / (5 * len(own)))


def test_grams_are_of_words():
    chars = lambda key: "".join(
        chr(c) for c in (key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF) if c
    ).replace("\x01", "_")
    found = sorted(chars(int(k)) for k in language_id.grams("Ab, c"))
    assert found == sorted(["a", "b", "c", "_a", "ab", "b_", "_c", "c_", "_ab", "ab_", "_c_"])


def test_odd_languages(odd, none):
    model = language_id.profiles(odd.where(language_id.learned_from()))
    rows = language_id.identify(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(r.lang_pred == "und" for r in rows if not any(map(str.isalpha, r.text or "")))
    kept = language_id.accepted(odd, model)
    assert kept.columns == odd.columns
    assert language_id.profiles(none) == {}
    assert {r.lang_pred for r in language_id.identify(odd, {}).collect()} == {"und"}


def area(scores, labels) -> float:
    ones = [s for s, y in zip(scores, labels) if y]
    zeros = np.sort([s for s, y in zip(scores, labels) if not y])
    below = np.searchsorted(zeros, ones) + np.searchsorted(zeros, ones, side="right")
    return below.sum() / 2 / len(ones) / len(zeros)


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op8_compression_toxicity(spark, sf).collect()
    out = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert area([r.score for r in out], [labels[r.doc_id] for r in out]) > 0.93
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    right = sum(r.predicted == labels[r.doc_id] for r in out)
    assert right / len(out) > 0.93


def test_odd_toxicity(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1, 1), (2, 1, 0), (6, 0, 0), (7, None, None), (None, 1, 1), (9, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    for some in (labels, labels.where("toxic = 0"), labels.limit(0)):
        model = toxicity.train(odd, some, F.lit(True))
        rows = toxicity.score(odd, model).collect()
        assert len(rows) == odd.count()
        assert all(0 <= r.score <= 1 for r in rows)
        assert toxicity.score(none, model).collect() == []
    assert toxicity.score(none, toxicity.train(none, labels, F.lit(True))).collect() == []


def test_rates_meet_the_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labelled = mixing.domain_of(spark.read.parquet(f"{SF}/labels.parquet"))
    targets = {
        "quality1-toxic0": 0.7, "quality0-toxic0": 0.15,
        "quality1-toxic1": 0.1, "quality0-toxic1": 0.05,
    }
    mixture = mixing.train_and_fit(docs, labelled, targets)
    rows = mixing.report(docs, mixture).collect()
    total = sum(r.n_tokens for r in rows)
    for domain, share in targets.items():
        got = sum(r.rate * r.n_tokens * r[f"p_{domain}"] for r in rows)
        assert got == pytest.approx(share * total, rel=0.02)
    assert all(r.rate >= 0 for r in rows)
    labels = {r.doc_id: r.domain for r in labelled.collect()}
    known = [r for r in rows if r.doc_id in labels]
    assert sum(r.domain == labels[r.doc_id] for r in known) / len(known) > 0.8


def test_rows_are_repeated_by_their_rates(spark):
    docs = spark.createDataFrame([(i, "a b") for i in range(2000)], "doc_id long, text string")
    classifier = mixing.Classifier(("x",), (0.0,), np.zeros(mixing.BUCKETS).tobytes())
    for steps, mean in (([[-0.25]], 1.25), ([[0.25]], 0.75), ([[5.0]], 0.0)):
        rows = mixing.resampled(docs, mixing.Mixture(classifier, steps)).collect()
        assert len(rows) == pytest.approx(mean * 2000, abs=60)
        assert len({r.doc_id for r in rows}) == min(len(rows), 2000)


def test_odd_mixing(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1, 1), (2, 1, 0), (6, 0, 0), (7, None, None), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    labelled = mixing.domain_of(labels)
    mixture = mixing.train_and_fit(odd, labelled, {"quality1-toxic0": 0.5, "quality0-toxic0": 0.5})
    assert mixing.report(odd, mixture).count() == odd.count()
    assert mixing.resampled(odd, mixture).columns == odd.columns
    assert mixing.report(none, mixture).collect() == []
    assert mixing.resampled(odd, mixing.train_and_fit(odd, labelled.limit(0), {})).count() == odd.count()
    assert mixing.train_and_fit(odd, labelled, {"other": 1.0}).steps == []
    shared = {"other": 0.5, "quality1-toxic0": 0.25, "quality0-toxic0": 0.25}
    assert mixing.train_and_fit(odd, labelled, shared) == mixture
