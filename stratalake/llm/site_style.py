"""Main text of web pages by site style trees.

The trees of all pages of a host are merged into one site style tree: an element
node is a path of labels (name, class, id words), its style nodes are the sequences
of child labels seen under it, and its content features are the words directly in it.
Spark counts, per host, how many pages have each path, each style and each feature.

* presentation importance of a node: the entropy, to the base of its pages, of its
  styles; 1 if one page has it;
* content importance of a node: 1 less the mean entropy of its features over the
  pages, so that words that all pages repeat weigh nothing; 1 if one page has it;
* importance of a node: the larger of its own and its children's, where the
  presentation counts the more the deeper the tree below it is (``DECAY``).

A branch that ``UNIMPORTANT`` or less of importance is left out. An element that says
that it is content (``article``, ``main``) stays, but the branches in it go like others,
unless it has nothing else: then the pages repeat each other whole. So do the pages of
which counts would take most of the text and leave hardly any content: nothing goes by
counts from those. Branches whose element or class says
that they are navigation, adverts, notices, forms or comments have importance 0 from
the start: a host of one page, or one whose menus differ, has no statistics to tell.
A class or id says so as a whole, not by a word in it (``has-sidebar`` names no sidebar),
but for comments, which are named beside anything (``reader-comments``),
and never of content, nor of the branch that has most of a page's words and its content.
If a main element or articles have at least half of the words that are left of a page,
text outside them goes; otherwise they are teasers, and the whole page counts.

Hosts, paths, styles and words are counted as hashes of 64 bits, summed per task first; a
path's hash is made of its parent's, so that deep pages cost no more than flat ones. Only
the paths a host leaves out travel back to its pages: broadcast once they have been
measured, or else by a join on the host, so that pages are not moved for them.

Defined results: null or empty html, or a page without text, gives the empty string;
a null url is a host of its own; repeated rows are extracted once each; an empty table
gives an empty result. Columns besides ``page_id``, ``url`` and ``html`` are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stored
from .html_tree import INLINE, Node, parse

#: Weight of the presentation of a node against the content below it.
DECAY = 0.9
#: Branches of this importance or less are left out.
UNIMPORTANT = 0.2
#: Pages a host needs before its counts say anything.
MIN_PAGES = 2
#: Most paths to leave out that are broadcast, 8 bytes each.
BROADCAST_PATHS = 2_000_000
#: Counts a task holds before it hands them on.
_HELD_COUNTS = 1_000_000

#: Elements, roles and class words that say what a branch is.
NOISE_ELEMENTS = frozenset(
    "head script style noscript template nav footer aside form button input select textarea "
    "option iframe object embed svg canvas audio video menu dialog fieldset map".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog "
    "menu menubar toolbar".split()
)
NOISE_WORDS = frozenset(
    "ad ads adv advert advertisement adverts advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer masthead sidebar "
    "aside widget comment comments disqus reply replies cookie cookies consent gdpr notice "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended pagination pager toolbar topbar skip outbrain taboola".split()
)
#: Words that beside one of those say only where or what shape a branch is.
PLAIN_WORDS = frozenset(
    "site page main global primary secondary left right top bottom upper lower inner outer "
    "list items item links link box boxes container content wrapper wrap area section block "
    "column col bar row group panel button buttons icons icon header head title text body "
    "inline sticky fixed float slot unit form".split()
)
#: Words that name comments, and those that beside them name a state of the page.
COMMENT_WORDS = frozenset("comment comments disqus reply replies".split())
STATE_WORDS = frozenset(
    "no not has have with without open opened closed enabled disabled on off allow allowed "
    "count can is".split()
)
#: Elements whose content is never shown: no part of the tree.
UNSEEN = frozenset("head script style noscript template textarea iframe".split())
CONTENT_ELEMENTS = frozenset("article main".split())
_LETTERS = re.compile(r"[^\W\d_]+")


def is_noise(node: Node, in_content: bool = False) -> bool:
    """Whether the element itself, its role or its style says that it is no text to read.

    A ``header`` within an article or main element is part of it.
    """
    if node.name in NOISE_ELEMENTS or "hidden" in node.attributes:
        return True
    if node.attributes.get("role", "").lower() in NOISE_ROLES:
        return True
    if node.name == "header" and not in_content:
        return True
    if "display:none" in node.attributes.get("style", "").replace(" ", "").lower():
        return True
    return False


def _is_named_noise(node: Node) -> bool:
    """Whether a class or id of the element says that it is noise."""
    if node.name in ("html", "body", *CONTENT_ELEMENTS):
        return False
    attributes = node.attributes
    if attributes.get("aria-hidden", "").lower() == "true":
        return True
    if NOISE_WORDS.isdisjoint(node.names):
        return False
    tokens = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()
    return any(_names_noise(set(_LETTERS.findall(token))) for token in tokens)


def _names_noise(words: set[str]) -> bool:
    if words & COMMENT_WORDS:
        return not words & STATE_WORDS
    return bool(words & NOISE_WORDS) and words <= NOISE_WORDS | PLAIN_WORDS


def noise(root: Node) -> set[int]:
    """The ``id`` of every branch to drop for its element, role, style or names.

    A name is no reason to drop the branch that has most of the words not in other
    noise, unless content elements stand outside of it.
    """
    # Nodes that are left in page order, each with the place of its parent.
    nodes: list[tuple[Node, int]] = []
    dropped: set[int] = set()
    waiting = [(root, -1, False)]
    while waiting:
        node, parent, in_content = waiting.pop()
        if node.text is None and node.name and is_noise(node, in_content):
            dropped.add(id(node))
            continue
        nodes.append((node, parent))
        at, inside = len(nodes) - 1, in_content or node.name in CONTENT_ELEMENTS
        waiting.extend((child, at, inside) for child in reversed(node.children))
    named = [i for i, (node, _) in enumerate(nodes) if node.text is None and _is_named_noise(node)]
    if not named:
        return dropped
    words, content = [0] * len(nodes), [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        node, parent = nodes[i]
        if node.text is not None:
            words[i] = len(node.text.split()) if node.name == "#text" else 0
        content[i] += node.name in CONTENT_ELEMENTS
        if parent >= 0:
            words[parent] += words[i]
            content[parent] += content[i]
    for i in named:
        if 2 * words[i] <= words[0] or content[i] < content[0]:
            dropped.add(id(nodes[i][0]))
    return dropped


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\w+://([^/?#]*)", 1)), F.lit(""))


#: The path of the page itself, above its first element.
ROOT = 0


def _hash(text: str, seed: int = 0) -> int:
    """A signed 64-bit hash."""
    found = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), seed & 0xFFFFFFFFFFFFFFFF)
    return found - (1 << 64) if found >> 63 else found


def _below(path: int, child: Node) -> int:
    """The path of an element under that of its parent; inline ones are part of their block."""
    return path if child.name in INLINE else _hash(child.label(), path)


def path_of(*labels: str) -> int:
    """The path of an element, given the labels on the way to it."""
    path = ROOT
    for label in labels:
        path = _hash(label, path)
    return path


class _Seen:
    """What a page shows of one path."""

    __slots__ = ("parent", "depth", "content", "styles", "words")

    def __init__(self, parent: int, depth: int, content: bool):
        self.parent, self.depth, self.content = parent, depth, content
        self.styles: set[str] = set()
        self.words: set[str] = set()


def _observations(root: Node) -> dict[int, _Seen]:
    """The styles of each path of a page and the words directly in its blocks."""
    seen = {ROOT: _Seen(ROOT, -1, False)}
    waiting = [(root, ROOT)]
    while waiting:
        block, path = waiting.pop()
        own = seen[path]
        labels = []
        inner = block.children[::-1]
        while inner:
            child = inner.pop()
            if child.text is not None:
                if child.name == "#text":
                    own.words.update(child.text.split())
            elif child.name in INLINE:
                inner.extend(reversed(child.children))
            elif child.name not in UNSEEN:
                label = child.label()
                if not labels or labels[-1] != label:
                    labels.append(label)
                below = _hash(label, path)
                if below not in seen:
                    seen[below] = _Seen(path, own.depth + 1, child.name in CONTENT_ELEMENTS)
                waiting.append((child, below))
        own.styles.add(" ".join(labels))
    del seen[ROOT]
    return seen


COUNT_SCHEMA = (
    "host long, path long, is_style boolean, value long, n long, "
    "parent long, depth int, is_content boolean"
)


class _Numbers(dict):
    """Numbers of words, in the order in which they are asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class _Counts:
    """How many pages have each style and word of each path, until they are handed on.

    Words are counted by sorting numbers that hold a path's place and a word's.
    """

    def __init__(self):
        self.numbers = _Numbers()
        self.hashes: list[int] = []
        self._clear()

    def _clear(self) -> None:
        self.places: dict[tuple[int, int], int] = {}
        self.nodes: list[_Seen] = []
        self.styles: Counter = Counter()
        self.words: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.size = 0

    def add(self, host: int, root: Node) -> None:
        for path, own in _observations(root).items():
            place = self.places.setdefault((host, path), len(self.places))
            if place == len(self.nodes):
                self.nodes.append(own)
            self.styles[place, _hash("|".join(sorted(own.styles)))] += 1
            numbers = map(self.numbers.__getitem__, own.words)
            own_words = np.fromiter(numbers, np.int64, len(own.words))
            self.words.append(own_words + (place << 32))
            self.size += len(own_words) + 1

    def rows(self) -> pa.RecordBatch:
        """The counts so far, which begin anew."""
        self.hashes += [_hash(w) for w in list(self.numbers)[len(self.hashes) :]]
        both, n = np.unique(np.concatenate(self.words), return_counts=True)
        hosts, paths = np.array(list(self.places), np.int64).reshape(-1, 2).T
        hashes = np.array(self.hashes, np.int64)
        of_style = np.array([place for place, _ in self.styles], np.int64)
        at = np.concatenate([of_style, both >> 32])
        style_hashes = np.array([value for _, value in self.styles], np.int64)
        is_style = np.arange(len(at)) < len(of_style)
        # Where a path is in the tree goes with its styles alone.
        nodes = [self.nodes[place] for place in of_style.tolist()]
        none = [None] * len(both)
        columns = [
            pa.array(hosts[at]),
            pa.array(paths[at]),
            pa.array(is_style),
            pa.array(np.concatenate([style_hashes, hashes[both & 0xFFFFFFFF]])),
            pa.array(np.concatenate([np.array(list(self.styles.values()), np.int64), n])),
            pa.array([node.parent for node in nodes] + none, pa.int64()),
            pa.array([node.depth for node in nodes] + none, pa.int32()),
            pa.array([node.content for node in nodes] + none, pa.bool_()),
        ]
        self._clear()
        if len(self.numbers) > _HELD_COUNTS:
            self.numbers.clear()
            self.hashes.clear()
        return pa.RecordBatch.from_arrays(
            columns, names=[c.split()[0] for c in COUNT_SCHEMA.split(", ")]
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts()
    for batch in slices(batches, "html"):
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            counts.add(host, parse(html))
            if counts.size > _HELD_COUNTS:
                yield counts.rows()
    if counts.size:
        yield counts.rows()


def style_tree(pages: DataFrame) -> DataFrame:
    """Every merged node of a host: its place, its pages, and its own importance by
    presentation (``look``) and by ``content``; ``single``: a child that one page has.

    Nodes that one page has are as important as can be. They are not listed, since a host
    may have them with every page; their parents know of them.
    """
    counts = (
        pages.select("host", "html")
        .mapInArrow(_count, COUNT_SCHEMA)
        .groupBy("host", "path", "is_style", "value")
        .agg(F.sum("n").alias("n"), *[F.max(c).alias(c) for c in ("parent", "depth", "is_content")])
    )
    # A page adds one style to each of its paths, so a path's styles add up to its pages.
    # With m pages, a style that n of them have adds -n/m log(n/m), and a word that n have,
    # evenly, has the entropy log(n) / log(m).
    log = F.log(F.col("n").cast("double"))
    sums = counts.groupBy("host", "path").agg(
        F.sum(F.when(F.col("is_style"), F.col("n"))).alias("pages"),
        F.sum(F.when(F.col("is_style"), F.col("n") * log)).alias("styles"),
        F.count(F.when(~F.col("is_style"), 1)).alias("words"),
        F.sum(F.when(~F.col("is_style"), log)).alias("word_logs"),
        *[F.max(c).alias(c) for c in ("parent", "depth", "is_content")],
    )
    base = F.log(F.col("pages").cast("double"))
    alone = F.col("pages") < MIN_PAGES
    look = 1 - F.col("styles") / F.col("pages") / base
    words = F.when(F.col("words") == 0, 0.0).otherwise(
        1 - F.col("word_logs") / F.col("words") / base
    )
    sums = sums.withColumns(
        {
            "look": F.when(alone, 1.0).otherwise(look),
            "content": F.when(alone, 1.0).otherwise(words),
        }
    )
    node = F.struct("path", "parent", "depth", "is_content", "look", "content")
    # Both come from one row a path, so that the pages are counted once.
    told = sums.select(
        "host",
        F.when(F.col("pages") >= MIN_PAGES, node).alias("node"),
        F.explode(
            F.array(
                F.struct("path", F.lit(False).alias("single"), F.lit(True).alias("own")),
                F.struct(
                    F.col("parent").alias("path"),
                    (F.col("pages") < MIN_PAGES).alias("single"),
                    F.lit(False).alias("own"),
                ),
            )
        ).alias("told"),
    )
    return (
        told.select(
            "host",
            "told.path",
            "told.single",
            F.when(F.col("told.own"), F.col("node")).alias("node"),
        )
        .groupBy("host", "path")
        .agg(F.first("node", ignorenulls=True).alias("node"), F.max("single").alias("single"))
        .where(F.col("node").isNotNull())
        .select("host", "node.*", "single")
    )


def unimportant_paths(nodes: list[dict], limit: float = UNIMPORTANT) -> list[int]:
    """The topmost paths of a host's tree whose importance is at most ``limit``.

    ``nodes`` are rows of ``style_tree`` of one host.
    """
    inner: dict[int, list[tuple[float, int]]] = {}
    low: dict[int, bool] = {}
    whole: set[int] = set()  # Content whose every branch is unimportant.
    for node in sorted(nodes, key=lambda n: -n["depth"]):
        children = inner.get(node["path"], [])
        if node["single"]:
            children = [*children, (1.0, 1)]
        depth = 1 + max((d for _, d in children), default=0)
        kept = DECAY ** (depth - 1)
        best = max([node["content"], *(i for i, _ in children)])
        importance = (1 - kept) * node["look"] + kept * best if children else node["content"]
        if node["is_content"]:
            if best <= limit:
                whole.add(node["path"])
            importance = 1.0
        low[node["path"]] = importance <= limit and node["depth"] >= 2
        inner.setdefault(node["parent"], []).append((importance, depth))
    out: list[int] = []
    settled: set[int] = set()  # What goes, or stays, with a branch above.
    for node in sorted(nodes, key=lambda n: n["depth"]):
        path = node["path"]
        if node["parent"] in settled or path in whole:
            settled.add(path)
        elif low[path]:
            out.append(path)
            settled.add(path)
    return out


def _left_out(nodes: DataFrame) -> DataFrame:
    """(host, out): the paths each host leaves out.

    A host's tree has as many nodes as its templates have, however many pages it has.
    """
    row = F.struct("path", "parent", "depth", "is_content", "look", "content", "single")
    grouped = nodes.groupBy("host").agg(F.collect_list(row).alias("nodes"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [unimportant_paths(tree) for tree in batch.column("nodes").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array(out, pa.list_(pa.int64()))], names=["host", "out"]
            )

    return grouped.mapInArrow(decide, "host long, out array<long>").where(F.size("out") > 0)


def main_text(root: Node, out: frozenset[int]) -> str:
    """The blocks of what is left of a page, one a line."""
    blocks: list[str] = []
    parts: list[str] = []

    def end_block() -> None:
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(text)
        parts.clear()

    # (node, path, whether it closes) in page order, without recursion: pages nest deeply.
    dropped = noise(root)
    if out and _repeats_others(root, out, dropped):
        out = frozenset()
    for start, start_path in _content_roots(root, out, dropped):
        waiting = [(start, start_path, False)]
        while waiting:
            node, path, closes = waiting.pop()
            if closes:
                end_block()
            elif node.text is not None:
                parts.append(node.text if node.name == "#text" else "")
            elif not (id(node) in dropped or (node.name and path in out)):
                if node.name == "br":
                    parts.append(" ")
                if node.name not in INLINE:
                    end_block()
                    waiting.append((node, path, True))
                for child in reversed(node.children):
                    inner = path if child.text is not None else _below(path, child)
                    waiting.append((child, inner, False))
        end_block()
    return "\n".join(blocks)


def _repeats_others(root: Node, out: frozenset[int], dropped: set[int]) -> bool:
    """Whether counts would take more than half of a page's words and leave hardly any content:
    then other pages repeat this one, and the counts tell nothing of what it is about."""
    total = removed = content = 0
    waiting = [(root, ROOT, False, False)]
    while waiting:
        node, path, gone, in_content = waiting.pop()
        if node.text is not None:
            words = len(node.text.split()) if node.name == "#text" else 0
            total += words
            removed += words if gone else 0
            content += words if in_content and not gone else 0
            continue
        if id(node) in dropped:
            continue
        gone = gone or bool(node.name) and path in out
        in_content = in_content or node.name in CONTENT_ELEMENTS
        for child in node.children:
            inner = path if child.text is not None or gone else _below(path, child)
            waiting.append((child, inner, gone, in_content))
    return 2 * removed > total and 4 * content < removed


def _content_roots(
    root: Node, out: frozenset[int], dropped: set[int]
) -> list[tuple[Node, int]]:
    """The main elements, or outermost articles, with their paths, if they have at least
    half of the words that are left of the page; otherwise the page."""
    roots: dict[str, list[tuple[Node, int]]] = {"main": [], "article": []}
    words: Counter = Counter()
    waiting = [(root, ROOT, "")]
    while waiting:
        node, path, inside = waiting.pop()
        if node.text is not None:
            if node.name == "#text":
                words[inside] += len(node.text.split())
            continue
        if id(node) in dropped or (node.name and path in out):
            continue
        if not inside and node.name in CONTENT_ELEMENTS:
            inside = node.name
            roots[inside].append((node, path))
        for child in reversed(node.children):
            inner = path if child.text is not None else _below(path, child)
            waiting.append((child, inner, inside))
    for name, found in roots.items():
        if found and 2 * words[name] >= sum(words.values()):
            return found
    return [(root, ROOT)]


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url"),
        F.xxhash64(host_of(F.col("url"))).alias("host"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    )
    removed = stored(_left_out(style_tree(rows)), "site-style-out")
    paths = removed.agg(F.coalesce(F.sum(F.size("out") + 1), F.lit(0)).alias("n")).first().n
    if paths <= BROADCAST_PATHS:
        removed = F.broadcast(removed)
    known = rows.join(removed, "host", "left").select("page_id", "url", "html", "out")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [
                main_text(parse(html), frozenset(out or ()))
                for html, out in zip(batch.column("html").to_pylist(), batch.column("out").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return known.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
