"""Quality rules: base rules on a document's statistics, then boosted trees over them.

Words are runs of anything but the six ASCII white-space bytes. Statistics are counted
over the whole text as UTF-8 bytes, without decoding it. Base rules drop a document of
fewer than ``LEAST_WORDS`` words, or one more than half of whose words lie in 3-word
windows that the text has twice. The rest is judged by gradient-boosted trees
(``monotone_trees``) over shares that do not depend on a text's length; more symbols,
repeated lines or repeated windows never make a score higher. Trees are fitted on at
most ``MAX_LABELLED`` labelled documents, the ones with the smallest hashes of their ids,
and are flattened into arrays, which score a batch of documents at once.

A document is kept if its probability reaches a cut of at most 0.5, chosen on halves of
the sample that are scored by trees of the other half: the highest at which at least
``KEEP_GOOD`` of the good ones stay.

Defined results: a null or empty text has no words and fails the base rules; without
labels of both kinds there are no trees, and what passes the base rules is kept unless
all labels are 0; null labels teach nothing; of several labels of one document the
largest counts, and of several texts the one with the smallest statistics; rows without
id are judged, but not learned from; repeated rows are judged once each; an empty table
gives an empty result. Columns besides ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import monotone_trees
from .common import id_and_text, slices
from .monotone_trees import Forest, probabilities

LEAST_WORDS = 50
#: Share of repeated words, in percent, beyond which a document fails.
MOST_REPEATED = 50
MAX_LABELLED = 20_000
KEEP_GOOD = 0.99

_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\v\f\r"
_CONTINUATION = bytes(range(0x80, 0xC0))
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = b"0123456789"
_ENDS = b".!?"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_distinct", "n_frequent", "n_capitals", "n_digits", "n_ends")
#: Features of the trees, each with its direction.
DIRECTIONS = {
    "symbols a word": -1,
    "share of repeated lines": -1,
    "share of repeated words": -1,
    "letters a word": 0,
    "words": 0,
    "words a line": 0,
    "share of distinct words": 0,
    "share of the ten most frequent words": 0,
    "capitals a word": 0,
    "digits a word": 0,
    "sentence ends a word": 0,
}


def statistics(data: bytes) -> tuple[int, ...]:
    """The numbers named in ``BASE`` and ``MORE`` of one text."""

    def count(characters: bytes) -> int:
        return len(data) - len(data.translate(None, characters))

    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    places: dict[bytes, int] = {}
    ids = np.array([places.setdefault(w, len(places)) for w in words], np.int64)
    frequent = np.sort(np.bincount(ids, minlength=1))[-10:].sum()
    return (
        len(words),
        len(data) - count(_CONTINUATION + _SPACES),
        count(_SYMBOLS),
        len(lines) - len(set(lines)),
        _repeated(ids, len(places)),
        len(lines),
        len(places),
        int(frequent),
        count(_CAPITALS),
        count(_DIGITS),
        count(_ENDS),
    )


def _repeated(ids: np.ndarray, distinct: int) -> int:
    """Words that lie in a window of three that occurs twice or more."""
    if len(ids) < 4:
        return 0
    first = ids[:-2]
    if distinct**3 >= 1 << 63:
        # Numbers of the pairs that occur, for the numbers of the words in them.
        pairs = np.unique(first * distinct + ids[1:-1], return_inverse=True)[1]
    else:
        pairs = first * distinct + ids[1:-1]
    windows = pairs * distinct + ids[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = twice[np.minimum(np.searchsorted(twice, windows), len(twice) - 1)] == windows
    inside = np.zeros(len(ids), bool)
    for shift in range(3):
        inside[shift : len(ids) - 2 + shift] |= at
    return int(inside.sum())


def features(rows: np.ndarray) -> np.ndarray:
    """The trees' features, in the order of ``DIRECTIONS``, of rows of statistics."""
    words, chars, symbols, dup, repeated, lines, distinct, frequent, capitals, digits, ends = (
        rows.T.astype(np.float64)
    )
    each_word, each_line = np.maximum(words, 1), np.maximum(lines, 1)
    columns = (
        symbols / each_word,
        dup / each_line,
        repeated / each_word,
        chars / each_word,
        np.log1p(words),
        words / each_line,
        distinct / each_word,
        frequent / each_word,
        capitals / each_word,
        digits / each_word,
        ends / each_word,
    )
    return np.column_stack(columns)


def fails_base(rows: np.ndarray) -> np.ndarray:
    return (rows[:, 0] < LEAST_WORDS) | (100 * rows[:, 4] > MOST_REPEATED * rows[:, 0])


@dataclass(frozen=True)
class Model:
    forest: Forest
    #: Lowest probability of a document that is kept.
    cut: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return probabilities(self.forest.margins(features(rows)))


def _counted(batch: pa.RecordBatch) -> np.ndarray:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    found = [statistics(text) for text in texts]
    return np.array(found, np.int64).reshape(-1, len(BASE) + len(MORE))


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every document."""
    names = [*BASE, *MORE]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns = [pa.array(c) for c in _counted(batch).T]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", *names]
            )

    schema = ", ".join(["doc_id long", *(f"{name} long" for name in names)])
    return id_and_text(docs).mapInArrow(count, schema)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The trees learned from ``labels`` (``doc_id``, ``quality`` 0 or 1) and their cut."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MAX_LABELLED)
    )
    labelled = id_and_text(docs).join(F.broadcast(known), "doc_id", "left_semi")
    one_each = measured(labelled).groupBy("doc_id").agg(F.min(F.struct(*BASE, *MORE)).alias("s"))
    # At most MAX_LABELLED rows of a few numbers.
    found = one_each.join(F.broadcast(known), "doc_id").select("doc_id", "s.*", "quality")
    rows = np.array(sorted(map(tuple, found.collect())), np.int64)
    return fit(rows[:, 1:-1], rows[:, -1]) if len(rows) else fit_nothing()


def fit_nothing() -> Model:
    return fit(np.zeros((0, len(BASE) + len(MORE)), np.int64), np.zeros(0, np.int64))


def fit(rows: np.ndarray, quality: np.ndarray) -> Model:
    """The model of labelled rows of statistics."""
    x, y = features(rows), (quality > 0).astype(np.float64)
    directions = list(DIRECTIONS.values())
    forest = monotone_trees.fit(x, y, directions)
    halves = np.arange(len(y)) % 2
    scores = np.zeros(len(y))
    for half in (0, 1):
        other = monotone_trees.fit(x[halves != half], y[halves != half], directions)
        scores[halves == half] = probabilities(other.margins(x[halves == half]))
    good = np.sort(scores[(y > 0) & ~fails_base(rows)])
    lost = int((1 - KEEP_GOOD) * len(good))
    return Model(forest, min(0.5, float(good[lost])) if len(good) else 0.5)


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``score``, ``kept`` of every document."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = _counted(batch)
            failed, scores = fails_base(rows), model.scores(rows)
            columns = [*rows.T[: len(BASE)], failed, scores, ~failed & (scores >= model.cut)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, columns)],
                names=["doc_id", *BASE, "base_failed", "score", "kept"],
            )

    numbers = ", ".join(f"{name} long" for name in BASE)
    return id_and_text(docs).mapInArrow(
        judged, f"doc_id long, {numbers}, base_failed boolean, score double, kept boolean"
    )


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = pa.RecordBatch.from_arrays([batch.column("text").fill_null("")], ["text"])
            rows = _counted(texts)
            kept = ~fails_base(rows) & (model.scores(rows) >= model.cut)
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(chosen, docs.schema)
