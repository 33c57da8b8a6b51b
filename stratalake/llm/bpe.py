"""Byte-level BPE by forced-boundary splitting, and its inverse.

A pair of neighbouring bytes that stands inside no token of the vocabulary is a cut
that every encoding must have. The cuts before white space, where the pre-tokenizer's
pattern also starts anew, split a whole text into fragments without running that
pattern over it. Each fragment is merged alone and the ids are concatenated; equal
fragments are looked up, in a table of bounded size, instead of merged again.

The vocabulary file is read on the driver and its tables are shipped to the tasks
once: they are as large as the vocabulary, whatever the data. Texts are encoded in
Arrow batches, without a shuffle.

Defined results: null and empty texts have no ids and decode to the empty string;
strings of added tokens in a text become those tokens; repeated rows are encoded
once each; a null id stays null.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from .common import id_and_text, slices

#: Fixed value: the pattern by which byte-level vocabularies split a text before merging.
PRETOKENS = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
#: Fragments a task remembers.
REMEMBERED = 100_000
#: Longer fragments are not worth remembering.
_LONG = 64


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    hidden = (b for b in range(0x100) if b not in letters)
    return letters | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


def little_endian(ids: list[int]) -> bytes:
    """The ids as little-endian unsigned 32-bit numbers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class Vocabulary:
    """What merging and decoding need, from a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or splitter["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without a normalizer is needed")
        if splitter["add_prefix_space"] or not splitter.get("use_regex", True):
            raise ValueError("prefix spaces and files without the pattern are not supported")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or match single words are not supported")
        bytes_of = {letter: b for b, letter in byte_letters().items()}
        as_bytes = lambda token: bytes(bytes_of[c] for c in token)
        self.ids = {
            as_bytes(t): i for t, i in model["vocab"].items() if t not in self.added
        }
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        made = [self.ids[as_bytes(a) + as_bytes(b)] for a, b in merges]
        if any(a >= b for a, b in itertools.pairwise(made)):
            raise ValueError("ids must be in the order of the merges that make them")
        self.tokens = {i: t for t, i in self.ids.items()}
        self.tokens |= {i: content.encode() for content, i in self.added.items()}
        self.inside = np.zeros((256, 256), bool)
        for token in self.ids:
            for left, right in itertools.pairwise(token):
                self.inside[left, right] = True


class Encoder:
    """Encodes and decodes whole texts; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.merge = tiktoken.Encoding(
            "fragments", pat_str=PRETOKENS, mergeable_ranks=vocabulary.ids, special_tokens={}
        ).encode_ordinary
        self.fragments = re.compile(self._fragment_pattern(vocabulary))
        names = sorted(vocabulary.added, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names)) or r"(?!)")
        self.known: dict[bytes, bytes] = {}
        size = max(vocabulary.tokens) + 1
        self.by_id = [vocabulary.tokens.get(i, b"") for i in range(size)]

    @staticmethod
    def _fragment_pattern(vocabulary: Vocabulary) -> bytes:
        """Cut before an ASCII white-space byte that no token has after the byte before it.

        Such a byte begins a pre-token or goes on a run of white space, so the text on
        either side is split alike alone; within a run nothing merges across the cut.
        """
        white = b" \t\n\x0b\x0c\r"
        byte = lambda b: b"\\x%02x" % b
        crossed = [
            b"(?<=[" + b"".join(map(byte, np.flatnonzero(vocabulary.inside[:, w]))) + b"])" + byte(w)
            for w in white
            if vocabulary.inside[:, w].any()
        ]
        other = b"[^" + b"".join(map(byte, white)) + b"]*+"
        return b"(?s:.)" + other + b"(?:(?:" + (b"|".join(crossed) or b"(?!)") + b")" + other + b")*+"

    def fragment(self, text: bytes) -> bytes:
        """The ids of a fragment as little-endian unsigned 32-bit numbers."""
        found = little_endian(self.merge(text.decode()))
        if len(text) <= _LONG:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[text] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit numbers."""
        found, start = [], 0
        for special in self.special.finditer(text):
            found.append(self._plain(text[start : special.start()]))
            found.append(little_endian([self.vocabulary.added[special[0]]]))
            start = special.end()
        found.append(self._plain(text[start:]))
        return b"".join(found)

    def _plain(self, text: str) -> bytes:
        known, fragment = self.known, self.fragment
        fragments = self.fragments.findall(text.encode())
        return b"".join([known.get(f) or fragment(f) for f in fragments])

    def decode(self, ids: bytes) -> str:
        by_id = self.by_id
        parts = [by_id[i] for i in np.frombuffer(ids, "<u4").tolist()]
        return b"".join(parts).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def _read(path: str) -> Vocabulary:
    return Vocabulary(path)


def _encoder(shipped) -> Encoder:
    """One per worker process, so that later tasks find the fragments remembered."""
    if getattr(_encoder, "key", None) != shipped.id:
        _encoder.key, _encoder.held = shipped.id, Encoder(shipped.value)
    return _encoder.held


class _Shipped:
    """A broadcast vocabulary and a name that is the same in every task."""

    def __init__(self, spark: SparkSession, path: str):
        self.id = path
        self._broadcast = spark.sparkContext.broadcast(_read(path))

    @property
    def value(self) -> Vocabulary:
        return self._broadcast.value


def encode(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned 32-bit numbers), ``n_tokens``, ``decoded``."""
    shipped = _Shipped(docs.sparkSession, vocabulary_path)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shipped)
        for batch in slices(batches, "text"):
            ids = [encoder.encode(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(ids, pa.binary()),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([encoder.decode(i) for i in ids], pa.string()),
                ],
                names=["doc_id", "ids", "n_tokens", "decoded"],
            )

    return id_and_text(docs).mapInArrow(
        encoded, "doc_id long, ids binary, n_tokens long, decoded string"
    )


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
