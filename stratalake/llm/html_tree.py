"""A small reader of HTML into the nodes a site style tree is made of.

It follows the rules of the HTML standard that matter for finding text: raw-text
elements, comments, void elements, end tags that may be left out, end tags without a
start. Every node knows its parent, so subtrees can be dropped; nothing is dropped here.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

#: Element names by their role in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: A start tag of the first kind ends an open element of the second.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
#: Elements beyond which an omitted end tag does not reach.
SCOPE = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"},
    "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"},
    "p": {"td", "th", "button", "table", "body", "html"},
}

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<attributes>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
#: One attribute after the other, so that nothing is looked for in a value.
_ATTRIBUTE = re.compile(
    r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'>]+)))?|"[^"]*"|'[^']*'"""
)
_KEPT = frozenset("class id role hidden style aria-hidden".split())
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}


@dataclass(slots=True)
class Node:
    """An element, or a piece of text if ``text`` is given."""

    name: str
    parent: Node | None
    names: tuple[str, ...] = ()
    attributes: dict[str, str] = field(default_factory=dict)
    text: str | None = None
    children: list[Node] = field(default_factory=list)

    def label(self) -> str:
        """The element's name with its class and id: what it looks like."""
        return ".".join((self.name, *self.names))


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if raw.strip(" /"):
        for m in _ATTRIBUTE.finditer(raw):
            if m[1] and (name := m[1].lower()) in _KEPT:
                found.setdefault(name, html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _names(attributes: dict[str, str]) -> tuple[str, ...]:
    """The words of class and id."""
    if not attributes:
        return ()
    both = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    return tuple(sorted(set(re.findall(r"[^\W\d_]+", both))))


class _Open:
    """The open elements, and where each name is among them, so that none are looked through."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks = [0]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.name, []).append(len(self.nodes))
        if node.name not in INLINE:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def last(self, names) -> int:
        """The place of the innermost open element of one of the names; 0 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def cut(self, place: int) -> None:
        """End the element at that place and all that it contains."""
        for node in self.nodes[place:]:
            self.places[node.name].pop()
            if node.name not in INLINE:
                self.blocks.pop()
        del self.nodes[place:]

    def end(self, name: str) -> None:
        """An end tag; one of an inline element does not reach beyond its block."""
        place = self.last((name,))
        if place and (name not in INLINE or place > self.blocks[-1]):
            self.cut(place)

    def close_omitted(self, name: str) -> None:
        """End the elements whose end tags may be left out before ``name``."""
        if name not in INLINE:
            self._close({"p"}, SCOPE["p"])
        if name in ENDS:
            self._close(ENDS[name], SCOPE.get(name, frozenset()))

    def _close(self, names: set[str], scope: set[str] | frozenset[str]) -> None:
        limit = self.last(scope)
        while (place := self.last(names)) > limit:
            self.cut(place)
            if len(names) == 1:
                return


def parse(source: str) -> Node:
    """The tree of a page under a root without a name."""
    root = Node("", None)
    open_ = _Open(root)

    def add_text(text: str) -> None:
        if text:
            node = open_.nodes[-1]
            node.children.append(Node("#text", node, text=html.unescape(text)))

    at, size = 0, len(source)
    while at < size:
        start = source.find("<", at)
        while start >= 0 and not (tag := _TAG.match(source, start)):
            start = source.find("<", start + 1)
        if start < 0:
            add_text(source[at:])
            break
        add_text(source[at:start])
        at = tag.end()
        if tag["name"] is None:
            continue
        name = tag["name"].lower()
        if tag["end"]:
            open_.end(name)
            continue
        open_.close_omitted(name)
        attributes = _attributes(tag["attributes"])
        parent = open_.nodes[-1]
        node = Node(name, parent, _names(attributes), attributes)
        parent.children.append(node)
        if name in RAW:
            close = _CLOSE[name].search(source, at)
            end = close.start() if close else size
            node.children.append(Node("#raw", node, text=source[at:end]))
            at = close.end() if close else size
        elif name not in VOID:
            open_.push(node)
    return root
