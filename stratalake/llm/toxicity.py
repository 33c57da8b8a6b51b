"""Toxicity by compression distance.

Two raw zstandard dictionaries are made of lists of words that are counted in labelled
documents, one of ordinary words and one of the same and toxic ones; zstandard does not
train them (measured in the README). A document is cut into windows of words; a window is the more toxic, the
shorter it gets with the toxic dictionary than with the ordinary one. The windows' mean
and largest gain are turned into a probability by a logistic curve calibrated on
labelled documents whose words the dictionaries have not seen.

Words are compressed as codes of 16 bytes, half of them for the word's first letters.
A code that is in the dictionary saves its length, an accidental match of a few letters
saves nothing; as plain letters the gains of real words drown in such matches.

Training reads at most ``MAX_LABELLED`` labelled documents, the ones with the smallest
hashes of their ids: a bounded sample, so it may be broadcast. A dictionary holds the
words (and beginnings) whose document frequencies differ most between the classes, and
the most frequent ordinary words, up to ``TOXIC_UNITS`` and ``ORDINARY_WORDS``; toxic words
beyond that, or below ``MIN_CONTRAST``, give no gain. Frequencies are counted by Spark. Calibration is
cross-fitted: each half of the sample is scored by dictionaries trained on the other.
Documents are scored whole in Arrow batches, without a shuffle.

Defined results: a null, empty or wordless text has gains of 0 and gets the curve's
value there; without labels of both classes every score is the share of toxic labels
(0 without any); null labels teach nothing; of several labels of one document the
largest counts; repeated rows are scored once each; rows without id are not learned from.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, id_and_text, slices, stored

MAX_LABELLED = 20_000
WINDOW_WORDS = 32
#: Most toxic units and ordinary words in a dictionary.
TOXIC_UNITS = 512
ORDINARY_WORDS = 3000
#: Least difference of a unit's document frequencies, in standard errors.
MIN_CONTRAST = 3.0
BEGINNING = 5
LEVEL = 3
_CODE = 8
_REMEMBERED = 200_000
_WORDS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def _code(unit: str) -> bytes:
    return hashlib.blake2b(unit.encode("utf-8", "replace"), digest_size=_CODE).digest()


def beginning(word: str) -> str:
    """A name for a word's first letters that no word has."""
    return f"{word[:BEGINNING]}-"


@dataclass(frozen=True)
class Model:
    """Units for the dictionaries, the strongest last, and the calibrated curve."""

    toxic: tuple[str, ...]
    ordinary: tuple[str, ...]
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)

    def score(self, gains: tuple[float, float]) -> float:
        x = self.weights[0] + sum(w * g for w, g in zip(self.weights[1:], gains))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))


class Gains:
    """Measures texts with a model's two dictionaries; one per task."""

    def __init__(self, model: Model):
        ordinary = b"".join(_code(beginning(w)) + _code(w) for w in model.ordinary)
        toxic = b"".join(
            _code(u) if u.endswith("-") else _code(beginning(u)) + _code(u) for u in model.toxic
        )
        self.same = not toxic
        # A dictionary needs some bytes; both begin alike.
        start = _code("-") + ordinary
        self.plain, self.toxic = self._compressor(start), self._compressor(start + toxic)
        self.codes: dict[str, bytes] = {}

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        dictionary = zstandard.ZstdCompressionDict(
            content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False
        )

    def of(self, text: str) -> tuple[float, float]:
        """Mean and largest gain of a text's windows, in bytes a word."""
        found = words(text)
        if not found or self.same:
            return 0.0, 0.0
        if len(self.codes) > _REMEMBERED:
            self.codes.clear()
        codes = self.codes
        parts = []
        for word in found:
            code = codes.get(word)
            if code is None:
                code = codes[word] = _code(beginning(word)) + _code(word)
            parts.append(code)
        total, largest = 0, 0.0
        for i in range(0, len(parts), WINDOW_WORDS):
            window = b"".join(parts[i : i + WINDOW_WORDS])
            gain = len(self.plain.compress(window)) - len(self.toxic.compress(window))
            total += gain
            largest = max(largest, float(gain))
        return total / len(parts), math.log1p(largest)


def _sample(docs: DataFrame, labels: DataFrame, learnable: Column) -> DataFrame:
    """``text``, ``toxic`` and ``half`` of at most ``MAX_LABELLED`` labelled documents."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .where(F.col("toxic").isNotNull() & learnable)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MAX_LABELLED)
    )
    half = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("half")), F.lit(2)).cast("int")
    return id_and_text(docs).join(F.broadcast(known), "doc_id").select(
        "doc_id", "text", "toxic", half.alias("half")
    )


def _frequencies(sample: DataFrame) -> DataFrame:
    """In how many toxic (t) and ordinary (o) documents of each half a unit occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in slices(batches, "text"):
            columns = (batch.column(c).to_pylist() for c in ("text", "half", "toxic"))
            for text, half, toxic in zip(*columns):
                own = set(words(text))
                own |= {beginning(w) for w in own}
                held.update((unit, half, toxic) for unit in own)
                if len(held) > _REMEMBERED:
                    yield _counted(held)
                    held.clear()
        yield _counted(held)

    found = sample.mapInArrow(count, "unit string, half int, toxic int, n long")

    def documents(toxic: int, half: int) -> Column:
        own = F.when((F.col("toxic") == toxic) & (F.col("half") == half), F.col("n"))
        return F.coalesce(F.sum(own), F.lit(0)).alias(f"{'t' if toxic else 'o'}{half}")

    kinds = [documents(toxic, half) for toxic in (0, 1) for half in (0, 1)]
    return found.groupBy("unit").agg(*kinds)


def _counted(held: Counter) -> pa.RecordBatch:
    columns = list(zip(*held)) or [(), (), ()]
    kinds = (pa.string(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array(held.values(), pa.int64())],
        names=["unit", "half", "toxic", "n"],
    )


def _dictionaries(
    counts: DataFrame, halves: tuple[int, ...], n_toxic: int, n_ordinary: int
) -> Model:
    """The units of the dictionaries trained on the given halves of the sample."""
    toxic = sum((F.col(f"t{h}") for h in halves), F.lit(0))
    ordinary = sum((F.col(f"o{h}") for h in halves), F.lit(0))
    in_toxic = (toxic + 0.5) / (n_toxic + 1)
    in_ordinary = (ordinary + 0.5) / (n_ordinary + 1)
    share = (toxic + ordinary + 1) / (n_toxic + n_ordinary + 2)
    error = F.sqrt(share * (1 / (n_toxic + 1) + 1 / (n_ordinary + 1)))
    contrast = (in_toxic - in_ordinary) / error
    units = counts.select("unit", contrast.alias("contrast"), ordinary.alias("ordinary"))
    strong = (
        units.where(F.col("contrast") >= MIN_CONTRAST)
        .orderBy(F.desc("contrast"), "unit")
        .limit(TOXIC_UNITS)
    )
    frequent = (
        units.where(~F.col("unit").endswith("-") & (F.col("contrast") < MIN_CONTRAST))
        .where(F.col("ordinary") > 0)
        .orderBy(F.desc("ordinary"), "unit")
        .limit(ORDINARY_WORDS)
    )
    return Model(
        tuple(r.unit for r in reversed(strong.collect())),
        tuple(r.unit for r in reversed(frequent.collect())),
    )


def _measured(sample: DataFrame, models: dict[int, Model]) -> list[tuple[int, float, float]]:
    """(toxic, mean gain, largest gain) of the sample, each half by the other's dictionaries."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = {half: Gains(model) for half, model in models.items()}
        for batch in slices(batches, "text"):
            columns = (batch.column(c).to_pylist() for c in ("text", "half"))
            found = [gains[1 - half].of(text) for text, half in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), *(pa.array(c) for c in zip(*found))],
                names=["toxic", "mean", "largest"],
            )

    rows = sample.mapInArrow(measure, "toxic int, mean double, largest double")
    return [tuple(r) for r in rows.collect()]


def fit_curve(rows: list[tuple[int, float, float]]) -> tuple[float, ...]:
    """Logistic regression of the label on the gains, by Newton's method with a small ridge."""
    data = np.array(sorted(rows), np.float64)
    y, x = data[:, 0], np.column_stack([np.ones(len(data)), data[:, 1:]])
    weights = np.zeros(3)
    ridge = np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - ridge @ weights
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, weights))


def train(docs: DataFrame, labels: DataFrame, learnable: Column) -> Model:
    """The model learned from the labels for which ``learnable`` holds."""
    sample = stored(_sample(docs, labels, learnable), "toxicity-sample")
    n = Counter()
    for row in sample.groupBy("half", "toxic").count().collect():
        n[row.half, row.toxic] = row["count"]
    n_toxic, n_ordinary = n[0, 1] + n[1, 1], n[0, 0] + n[1, 0]
    if not n_toxic or not n_ordinary:
        share = min(1 - 1e-9, max(1e-9, n_toxic / max(1, n_toxic + n_ordinary)))
        return Model((), (), (math.log(share / (1 - share)), 0.0, 0.0))
    counts = stored(_frequencies(sample), "toxicity-words")
    halves = {h: _dictionaries(counts, (h,), n[h, 1], n[h, 0]) for h in (0, 1)}
    curve = fit_curve(_measured(sample, halves))
    whole = _dictionaries(counts, (0, 1), n_toxic, n_ordinary)
    return Model(whole.toxic, whole.ordinary, curve)


def learnable(folds: int = 5) -> Column:
    return fold(F.col("doc_id"), folds) != 0


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(model)
        for batch in slices(batches, "text"):
            found = [model.score(gains.of(text)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"]
            )

    rows = id_and_text(docs).mapInArrow(scored, "doc_id long, score double")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return rows.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))
