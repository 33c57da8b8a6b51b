"""Quality rules against plain counting, trees against their constraints and labels."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratalake.llm import monotone_trees, quality_rules, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text: str) -> tuple[int, int, int, int, int]:
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    inside = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(inside)


def test_query_counts_what_plain_loops_count(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    df = queries.op13_quality_rules(spark, SF)
    kinds = dict(df.dtypes)
    assert all(kinds[c] == "bigint" for c in ("doc_id", *quality_rules.BASE))
    assert kinds["base_failed"] == kinds["kept"] == "boolean"
    rows = df.collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        expected = brute(docs[r.doc_id])
        assert tuple(r[c] for c in quality_rules.BASE) == expected
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (r.base_failed and r.kept)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab# \n\t\vé中\U0001f600| \x85\x1c"), max_size=80))
def test_statistics_of_any_text(text):
    assert quality_rules.statistics(text.encode())[:5] == brute(text)


def test_windows_of_very_many_words():
    """Numbers of windows beyond 64 bits go by the pairs that occur."""
    ids = np.array([5, 6, 7, 1, 5, 6, 7, 2, 8, 9])
    assert quality_rules._repeated(ids, 10) == quality_rules._repeated(ids, 1 << 22) == 6


def test_learned_verdict_on_documents_not_learned_from(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_rules.train(docs, labels.where("crc32(string(doc_id)) % 5 <> 0"))
    held_out = {r.doc_id: r.quality for r in labels.where("crc32(string(doc_id)) % 5 = 0").collect()}
    rows = [r for r in quality_rules.judge(docs, model).collect() if r.doc_id in held_out]
    judged = [r for r in rows if not r.base_failed]
    good = [r.kept for r in judged if held_out[r.doc_id] == 1]
    bad = [r.kept for r in rows if held_out[r.doc_id] == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.03
    assert len(good) > 300 and len(bad) > 50


def test_trees_keep_their_directions():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    # The first feature helps up to a half and harms beyond; the second is noise.
    y = (x[:, 0] * (x[:, 0] < 0.5) + x[:, 2] + rng.normal(0, 0.1, 4000) > 0.6).astype(float)
    free = monotone_trees.fit(x, y, [0, 0, 0])
    bound = monotone_trees.fit(x, y, [1, -1, 1])
    grid = np.linspace(0, 1, 200)
    falls = {}
    for name, forest in (("free", free), ("bound", bound)):
        drop = rise = 0.0
        for other in rng.random((30, 3)):
            line = np.tile(other, (200, 1))
            line[:, 0] = grid
            drop = max(drop, -np.diff(forest.margins(line)).min())
            line = np.tile(other, (200, 1))
            line[:, 1] = grid
            rise = max(rise, np.diff(forest.margins(line)).max())
        falls[name] = drop, rise
    assert falls["bound"][0] <= 1e-12 and falls["bound"][1] <= 1e-12
    assert falls["free"][0] > 0.1
    right = ((bound.margins(x) > 0) == (y > 0)).mean()
    assert right > 0.85


def test_flat_arrays_score_as_a_walk_does():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, (500, 4)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 4)).astype(float)
    forest = monotone_trees.fit(x, y, [0, 0, 0, 0], rounds=10)

    def walk(row):
        total = forest.start
        for node in forest.roots:
            while forest.left[node] != node:
                below = row[forest.feature[node]] <= forest.cut[node]
                node = forest.left[node] if below else forest.right[node]
            total += forest.value[node]
        return total

    assert forest.margins(x) == pytest.approx([walk(row) for row in x])
    assert ((forest.margins(x) > 0) == (y > 0)).mean() > 0.95
    assert len(forest.margins(x[:0])) == 0
    assert set(monotone_trees.fit(x, np.ones(500), [0] * 4).margins(x).round(9)) == {round(float(np.log(501)), 9)}


def test_odd_documents(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1, 1), (1, 0, 0), (6, 0, 0), (7, None, None), (None, 1, 1), (9, 0, 1)],
        "doc_id long, quality int, score int",
    )
    for some in (labels, labels.where("quality = 1"), labels.limit(0)):
        model = quality_rules.train(odd, some)
        rows = quality_rules.judge(odd, model).collect()
        assert len(rows) == odd.count()
        by_id = {r.doc_id: r for r in rows}
        assert by_id[3].n_words == by_id[4].n_words == 0 and by_id[3].base_failed
        assert by_id[6].n_words == 60_000 and by_id[6].n_repeat_words == 0
        assert by_id[8].n_repeat_words == 30_000 and not by_id[8].kept
        kept = quality_rules.accepted(odd, model)
        assert kept.columns == odd.columns
        assert kept.count() == sum(r.kept for r in rows)
        assert quality_rules.judge(none, model).collect() == []
    # Nothing speaks against a long text where all labels are good, or none is given.
    assert by_id[6].kept
    assert quality_rules.judge(none, quality_rules.train(none, labels)).collect() == []
    bad = quality_rules.train(odd, labels.where("doc_id = 6"))
    assert not any(r.kept for r in quality_rules.judge(odd, bad).collect())
