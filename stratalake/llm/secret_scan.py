"""Secret scanning by assignment-aware lexing.

Base patterns give the plain cases. Beside them the text is read as source or
configuration: name-literal pairs of the forms ``name = "x"``, ``name: x``,
``"name": "x"``, ``name := x``, ``export NAME=x``, ``--name x`` and ``<name>x</name>``
are lexed; a backslash keeps a quote from ending a literal. Values of several lines
(triple quotes, heredocs, YAML blocks, elements) give a literal for each line. A
literal's value is carried through later assignments of plain names (``a = "x"``, then
``password = a``), and a literal is scored by how sensitive its target names are and how
random it looks. Literals above a threshold
are added as spans of kind ``lexed``. Base spans are always kept.

Every text is read whole, in Arrow batches, without a shuffle. Offsets are code
points, ends exclusive. Defined results: a null or empty text has no spans; repeated
rows are scanned once each; a null id stays null.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, slices

#: The base patterns, their least lengths, and the order of kinds.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16
KINDS = ("assign", "access", "hex", "lexed")
_ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")

#: How much a word in a target name says that its value is secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.8,
    "secret": 1.0, "token": 0.9, "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.7, "authorization": 0.8,
    "bearer": 0.9, "signature": 0.6, "salt": 0.6, "session": 0.5, "cookie": 0.5,
    "key": 0.5, "private": 0.4, "access": 0.4, "client": 0.2,
}
#: Values that stand for a secret without being one.
PLACEHOLDERS = re.compile(
    r"(?i)^(?:none|null|nil|true|false|changeme|example|your\W?.*|x+|\*+|\.+|<.*>|\$\{.*\}|%\(.*\))$"
)
MIN_LITERAL = 8
#: Sum of name and literal evidence from which a literal is reported.
MIN_SCORE = 1.2

# Names are read whole from where a run of their characters begins, so that a long run is
# read once. What is repeated is repeated possessively.
_NAME = r"[A-Za-z_][\w.\-]*+"
_NAMED = rf"""(?:(?P<q>["'])(?P<qn>{_NAME})(?P=q)|(?<![\w.\-])[\d.\-]*+(?P<n>{_NAME}))"""
_SIGN = r"[\x20\t]*+(?::=|=>|[:=])[\x20\t]*+"
_PAIR = re.compile(
    rf"""{_NAMED}(?:{_SIGN}|(?<=\w)\x20(?=["']))
    (?:\"{{3}}(?P<tdq>(?:[^"\\]|\\.|"(?!""))*+)\"{{3}}|'{{3}}(?P<tsq>(?:[^'\\]|\\.|'(?!''))*+)'{{3}}
    |"(?P<dq>(?:[^"\\\n]|\\.)*+)"|'(?P<sq>(?:[^'\\\n]|\\.)*+)'
    |"(?P<cdq>[^"\n]*)"|'(?P<csq>[^'\n]*)'|(?P<bare>[^\s"',;|<>()\[\]{{}}]+))""",
    re.VERBOSE | re.ASCII | re.DOTALL,
)
_LITERALS = ("tdq", "tsq", "dq", "sq", "cdq", "csq", "bare")
_ELEMENT = re.compile(rf"<(?P<n>{_NAME})>(?P<bare>[^<>]+)</(?P=n)>", re.ASCII)
_FLAG = re.compile(
    r"--(?P<n>[A-Za-z_](?:[\w.]|-(?!-))*+)\x20(?P<bare>[^\s\"'-][^\s\"']*)", re.ASCII
)
_HEREDOC = re.compile(
    rf"""{_NAMED}{_SIGN}["']?(?:\$\([\x20\t]*+cat[\x20\t]++)?<<[-~]?[\x20\t]*+
    (?P<t>["']?)(?P<tag>[A-Za-z_]\w*+)(?P=t)[^\n]*+\n""",
    re.VERBOSE | re.ASCII,
)
_YAML = re.compile(
    rf"""^(?P<indent>[\x20\t]*+)(?P<dash>(?:-[\x20\t]++)*+){_NAMED}[\x20\t]*+:[\x20\t]++
    [|>][-+0-9]{{0,2}}[\x20\t]*+(?:\#[^\n]*+)?\r?\n""",
    re.VERBOSE | re.ASCII | re.MULTILINE,
)
_LINE = re.compile(r"[^\n]*+\n?")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


class Span(NamedTuple):
    start: int
    end: int
    kind: str

    def text(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


class Pair(NamedTuple):
    name: str
    start: int
    end: int
    quoted: bool
    #: Whether it goes on with the value of the literal before of that name.
    more: bool = False


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def base_spans(text: str) -> list[Span]:
    found = []
    low = text.lower()
    if any(word in low for word in _ASSIGN_WORDS):
        found += [
            Span(m.start(), m.end(), "assign")
            for m in ASSIGN.finditer(text)
            if len(m.group(1)) >= ASSIGN_LENGTH
        ]
    if "AKIA" in text:
        found += [
            Span(m.start(), m.end(), "access")
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LENGTH
        ]
    found += [Span(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return _ordered(found)


def pairs(text: str) -> list[Pair]:
    """Name-literal pairs in the order of their literals."""
    found = []
    if "=" in text or ":" in text or '"' in text or "'" in text:
        for m in _PAIR.finditer(text):
            group = next(g for g in _LITERALS if m.group(g) is not None)
            name = m.group("qn") or m.group("n")
            if "\n" in m[group]:
                found += _lines(name, text, m.start(group), m.end(group))
            else:
                found.append(Pair(name, m.start(group), m.end(group), group != "bare"))
    if "<<" in text:
        found += _heredocs(text)
    if "|" in text or ">" in text:
        found += _yaml_blocks(text)
    if "</" in text:
        for m in _ELEMENT.finditer(text):
            if "\n" in m["bare"]:
                found += _lines(m["n"], text, m.start("bare"), m.end("bare"))
            else:
                found.append(Pair(m["n"], m.start("bare"), m.end("bare"), True))
    if "--" in text:
        found += [Pair(m["n"], m.start("bare"), m.end("bare"), True) for m in _FLAG.finditer(text)]
    return sorted(found, key=lambda p: (p.start, p.end))


def _lines(name: str, text: str, start: int, end: int) -> list[Pair]:
    """The lines of a value, without the white space around each."""
    found: list[Pair] = []
    for line in _LINE.finditer(text, start, end):
        value = line[0].strip()
        if value:
            at = line.start() + line[0].index(value)
            found.append(Pair(name, at, at + len(value), True, bool(found)))
    return found


def _heredocs(text: str) -> list[Pair]:
    found, at, unclosed = [], 0, set()
    while m := _HEREDOC.search(text, at):
        at, tag = m.end(), m["tag"]
        if tag in unclosed:
            continue
        end = re.compile(rf"^[\x20\t]*+{tag}\b", re.M | re.ASCII).search(text, at)
        if end is None:
            unclosed.add(tag)
            continue
        found += _lines(m["qn"] or m["n"], text, at, end.start())
        at = end.end()
    return found


def _yaml_blocks(text: str) -> list[Pair]:
    """The lines below ``name: |`` that are further in than the name."""
    found, at = [], 0
    while m := _YAML.search(text, at):
        least = len(m["indent"]) + len(m["dash"])
        at = end = m.end()
        while end < len(text):
            line = _LINE.match(text, end)
            if line[0].strip() and len(line[0]) - len(line[0].lstrip(" \t")) <= least:
                break
            end = line.end()
        found += _lines(m["qn"] or m["n"], text, at, end)
        at = end
    return found


def targets(text: str, found: list[Pair]) -> dict[tuple[int, int], set[str]]:
    """Each literal's place and every name its value reaches, in the order of the text.

    A bare value that is the name of an earlier constant passes that literal on.
    """
    constants: dict[str, list[tuple[int, int]]] = {}
    reached: dict[tuple[int, int], set[str]] = {}
    for pair in found:
        value = text[pair.start : pair.end]
        places = constants.get(value) if not pair.quoted else None
        places = places or [(pair.start, pair.end)]
        for place in places:
            reached.setdefault(place, set()).add(pair.name)
        if pair.more and pair.name in constants:
            constants[pair.name].extend(places)
        else:
            constants[pair.name] = list(places)
    return reached


def name_score(name: str) -> float:
    words = [w.lower() for w in _WORDS.findall(name)]
    joined = ["".join(words[i : i + 2]) for i in range(len(words) - 1)]
    return max((SENSITIVE.get(w, 0.0) for w in words + joined), default=0.0)


def literal_score(value: str) -> float:
    """0 to 1: entropy a character against 4 bits, and the mixture of character kinds."""
    if len(value) < MIN_LITERAL or PLACEHOLDERS.match(value) or any(c.isspace() for c in value):
        return 0.0
    counts = {c: value.count(c) for c in set(value)}
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = sum(
        (any(map(str.isdigit, value)), any(map(str.islower, value)), any(map(str.isupper, value)))
    )
    return min(1.0, 0.75 * entropy / 4 + 0.125 * (kinds - 1))


def lexed_spans(text: str, min_score: float = MIN_SCORE) -> list[Span]:
    found = []
    for (start, end), names in targets(text, pairs(text)).items():
        sensitive = max(map(name_score, names))
        if sensitive:
            random = literal_score(text[start:end])
            if random and sensitive + random >= min_score:
                found.append(Span(start, end, "lexed"))
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(span.text() for span in spans)


def scan(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Per document: base counts, the hash of the base spans, and all spans."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts: dict[str, list[int]] = {kind: [] for kind in KINDS}
            hashes, spans = [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                lexed = lexed_spans(text, min_score)
                for kind, found in counts.items():
                    found.append(sum(s.kind == kind for s in (lexed if kind == "lexed" else base)))
                hashes.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(_ordered(base + lexed)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(counts[kind], pa.int64()) for kind in KINDS),
                    pa.array(hashes, pa.string()),
                    pa.array(spans, pa.string()),
                ],
                names=["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"],
            )

    numbers = ", ".join(f"n_{kind} long" for kind in KINDS)
    return id_and_text(docs).mapInArrow(
        scanned, f"doc_id long, {numbers}, base_sha256 string, spans string"
    )
