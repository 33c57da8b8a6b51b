"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent character n-grams (one to
three letters, words padded by a blank) in the order of their counts. A document's
own list is compared with each profile: every n-gram adds the distance between its
two places, or the profile's length if the language does not have it; the language
with the smallest sum wins (ties: the smaller name).

Counting is a partial count per task and a Spark sum per language and n-gram; the
profiles that reach the driver hold ``profile_size`` rows per language. Documents
are compared in Arrow batches, without a shuffle.

Defined results: a null text or one without any letter gives ``und`` with score 0,
as does every text when nothing could be learned; a null language teaches nothing;
a row without id is neither learned from nor held out. Repeated rows count, and are
answered, once each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, slices

UNDETERMINED = "und"
PROFILE_SIZE = 400
#: Languages a model may have; more is an error, not a cut.
MAX_LANGUAGES = 2000
#: Below this share of the best possible agreement no learned profile fits.
MIN_SCORE = 0.1
_BLANK = 1
_CODE_BITS = 21
#: N-grams a task holds before it merges equal ones.
_HELD_GRAMS = 1_000_000
#: N-grams a task reads before it counts them.
_NEW_GRAMS = 500_000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray:
    """The n-grams of a text as numbers: up to three code points of 21 bits."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64)
    spaced = np.full(len(codes) + 2, _BLANK, np.int64)
    spaced[1:-1][letter] = codes[letter]
    word = spaced != _BLANK
    keep = word.copy()
    keep[0] = True
    keep[1:] |= word[:-1]
    run = spaced[keep]
    pairs = (run[:-1] << _CODE_BITS) | run[1:]
    triples = (pairs[:-1] << _CODE_BITS) | run[2:]
    return np.concatenate([run[run != _BLANK], pairs, triples[run[1:-1] != _BLANK]])


def ranked(text: str | None, size: int) -> np.ndarray:
    """A text's ``size`` most frequent n-grams, ties by their number."""
    keys, counts = np.unique(grams(text), return_counts=True)
    return keys[np.lexsort((keys, -counts))[:size]]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) for what a task has read, merged as it goes."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    new: dict[str, list[np.ndarray]] = {}
    size = n_new = 0

    def merged(parts):
        keys = np.concatenate([k for k, _ in parts])
        counts = np.concatenate([n for _, n in parts])
        unique, place = np.unique(keys, return_inverse=True)
        return unique, np.bincount(place, counts, len(unique)).astype(np.int64)

    def rows():
        for lang, parts in held.items():
            keys, counts = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)],
                names=["lang", "gram", "n"],
            )

    def count_new() -> int:
        added = 0
        for lang, parts in new.items():
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            held.setdefault(lang, []).append((keys, counts))
            added += len(keys)
        new.clear()
        return added

    for batch in slices(batches, "text"):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            found = grams(text)
            new.setdefault(lang, []).append(found)
            n_new += len(found)
            if n_new > _NEW_GRAMS:
                size, n_new = size + count_new(), 0
        if size > _HELD_GRAMS:
            held = {lang: [merged(parts)] for lang, parts in held.items()}
            size = sum(len(keys) for parts in held.values() for keys, _ in parts)
            if size > _HELD_GRAMS // 2:
                yield from rows()
                held, size = {}, 0
    count_new()
    yield from rows()


def profiles(labelled: DataFrame, profile_size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """Each language's most frequent n-grams, from every row of ``text``, ``lang``."""
    rows = labelled.select("lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = (
        rows.mapInArrow(_count_grams, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= profile_size)
    found = top.select("lang", "gram", "place").take(MAX_LANGUAGES * profile_size + 1)
    if len(found) > MAX_LANGUAGES * profile_size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    model: dict[str, list[int]] = {}
    for row in sorted(found, key=lambda r: (r.lang, r.place)):
        model.setdefault(row.lang, []).append(row.gram)
    return model


class Ranks:
    """The profiles as one sorted list of n-grams and their places by language."""

    def __init__(self, model: dict[str, list[int]], size: int):
        self.langs = sorted(model)
        self.size = size
        self.grams = np.unique(np.array([g for p in model.values() for g in p], np.int64))
        self.places = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        for i, lang in enumerate(self.langs):
            own = np.array(model[lang], np.int64)
            self.places[i, np.searchsorted(self.grams, own)] = np.arange(len(own))

    def best(self, text: str | None) -> tuple[str, float]:
        own = ranked(text, self.size)
        if not len(own) or not self.langs:
            return UNDETERMINED, 0.0
        at = np.searchsorted(self.grams, own)
        known = np.append(self.grams, -1)[at] == own
        places = self.places[:, np.where(known, at, len(self.grams))]
        apart = np.where(places < 0, self.size, np.abs(places - np.arange(len(own))))
        sums = apart.sum(axis=1)
        first = int(sums.argmin())
        return self.langs[first], float(1 - sums[first] / (self.size * len(own)))


def identify(
    docs: DataFrame, model: dict[str, list[int]], profile_size: int = PROFILE_SIZE
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of those names are replaced."""
    ranks = Ranks(model, profile_size)
    others = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*others)
    at = others.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [ranks.best(text) for text in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=[*others, "lang_pred", "score"],
            )

    schema = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return rows.mapInArrow(predict, schema)


def accepted(docs: DataFrame, model: dict[str, list[int]]) -> DataFrame:
    """The rows of ``docs`` in some learned language: no ``und`` and no misfit."""
    row = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"))
    named = identify(row, model)
    fits = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_SCORE)
    return named.where(fits).select("row.*")


def held_out(folds: int = 3, out: int = 1):
    """Whether a row's fold is the one kept from learning."""
    return F.coalesce(fold(F.col("doc_id"), folds) == out, F.lit(False))


def learned_from(folds: int = 3, out: int = 1):
    return fold(F.col("doc_id"), folds) != out
