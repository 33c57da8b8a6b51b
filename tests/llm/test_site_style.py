"""Style trees against plain counting, pages that repeat each other, comments, odd nesting."""

from __future__ import annotations

import math
import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stratalake.llm import site_style
from stratalake.llm.html_tree import INLINE, parse

WORDS = [f"w{i}" for i in range(400)]


def texts(spark, *pages, host="h.example.com"):
    """Main texts of pages of one host."""
    data = [(i, f"http://{host}/{i}", page) for i, page in enumerate(pages)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(2)
    return [r.text for r in sorted(site_style.extract(df).collect(), key=lambda r: r.page_id)]


def prose(seed: int, n: int = 40) -> str:
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def test_pages_that_repeat_each_other_keep_their_texts(spark):
    page = f"<html><body><div class='content'><p>{prose(1)}</p><p>{prose(2)}</p></div></body></html>"
    expected = f"{prose(1)}\n{prose(2)}"
    assert texts(spark, page, page) == [expected] * 2
    changed = page.replace("w1", "z1", 1)
    assert texts(spark, page, changed, page) == [expected, expected.replace("w1", "z1", 1), expected]


def test_what_all_pages_repeat_goes(spark):
    frame = "<html><body><div class='top-line'>{0}</div><div class='text'><p>{1}</p></div><div class='end'>{2}</div></body></html>"
    pages = [frame.format("our site of things", prose(i), "all rights kept") for i in range(9)]
    assert texts(spark, *pages) == [prose(i) for i in range(9)]


def test_copies_among_other_pages_keep_their_texts(spark):
    frame = "<html><body><div class='top-line'>our site of things</div><div class='text'><p>{0}</p></div></body></html>"
    pages = [frame.format(prose(i % 4)) for i in range(12)]
    assert texts(spark, *pages) == [prose(i % 4) for i in range(12)]


def test_branches_of_a_page_of_their_own_stay(spark):
    """Every page has an element named like no other: what holds them is not unimportant."""
    names = "abcdefgh"
    pages = [
        f"<html><body><div class='all'><div id='post{c * 4}'><p>{prose(i)}</p></div></div></body></html>"
        for i, c in enumerate(names)
    ]
    assert texts(spark, *pages) == [prose(i) for i in range(len(names))]


@pytest.mark.parametrize(
    "name", ["post-comments", "reader-comments", "comments", "article-replies", "CommentList comment"]
)
@pytest.mark.parametrize("n", [1, 3])
def test_reader_comments_go(spark, name, n):
    pages = [
        f"<html><body><article><h1>t{i}</h1><p>{prose(i)}</p><section class='{name}'>"
        f"<p>{prose(50 + i, 10)}</p></section></article></body></html>"
        for i in range(n)
    ]
    assert texts(spark, *pages) == [f"t{i}\n{prose(i)}" for i in range(n)]


def test_states_of_comments_name_no_comments(spark):
    for name in ("page no-comments", "post comments-open", "has-comments", "comment-count-3"):
        page = f"<html><body><div class='{name}'><p>{prose(3)}</p></div></body></html>"
        assert texts(spark, page) == [prose(3)]


def test_hidden_and_labelled_text(spark):
    page = (
        f"<html><body><article><p>{prose(1)} <label>kept</label> on</p>"
        f"<div aria-hidden='true'>not seen</div><p aria-hidden='false'>seen</p></article></body></html>"
    )
    assert texts(spark, page) == [f"{prose(1)} kept on\nseen"]
    form = f"<html><body><p>{prose(1)}</p><form><label>Name</label><input></form></body></html>"
    assert texts(spark, form) == [prose(1)]


@pytest.mark.parametrize(
    "source",
    [
        "<div>" * 100_000 + "text",
        "<div><p>" * 50_000 + "text",
        "<b>" * 50_000 + "text" + "</i>" * 50_000,
        "<i><div>" + "<b>" * 50_000 + "text" + "</i>" * 50_000,
        "<table>" + "<div>" * 50_000 + "<td>" * 50_000 + "text",
        "<ul><li>" * 30_000 + "text" + "<li>" * 30_000,
        "<header>" * 50_000 + "</p>" * 50_000 + "<article><header>text",
        "<div class='a b'>" * 50_000 + "text" + "</div>" * 20_000,
    ],
)
def test_odd_nesting_takes_time_in_proportion(source):
    start = time.perf_counter()
    tree = parse(source)
    site_style.main_text(tree, frozenset({1}))
    site_style._observations(tree)
    assert time.perf_counter() - start < 8


def plain_tree(pages: list[str]) -> dict[tuple[str, ...], tuple[int, float, float]]:
    """(pages, look, content) by labels, counted the plain way on one host."""
    styles, words, n = defaultdict(Counter), defaultdict(Counter), Counter()

    def walk(node, path, seen):
        labels, own = [], []

        def gather(of):
            for child in of.children:
                if child.text is not None:
                    own.extend(child.text.split() if child.name == "#text" else [])
                elif child.name in INLINE:
                    gather(child)
                elif child.name not in site_style.UNSEEN:
                    if not labels or labels[-1] != child.label():
                        labels.append(child.label())
                    walk(child, (*path, child.label()), seen)

        gather(node)
        entry = seen.setdefault(path, (set(), set()))
        entry[0].add(" ".join(labels))
        entry[1].update(own)

    for page in pages:
        seen: dict = {}
        walk(parse(page), (), seen)
        for path, (looks, own) in seen.items():
            n[path] += 1
            styles[path]["|".join(sorted(looks))] += 1
            words[path].update(own)
    found = {}
    for path, m in n.items():
        if path and m > 1:
            look = -sum(c / m * math.log(c / m) for c in styles[path].values()) / math.log(m)
            entropies = [math.log(c) / math.log(m) for c in words[path].values()]
            content = 1 - sum(entropies) / len(entropies) if entropies else 0.0
            found[path] = (m, look, content)
    return found


def random_page(rng: random.Random, depth: int = 0) -> str:
    parts = []
    for _ in range(rng.randint(1, 3)):
        kind = rng.choice(["div", "p", "section", "ul", "text", "b"])
        if kind == "text" or depth > 3:
            parts.append(" ".join(rng.choices(WORDS[:30], k=rng.randint(0, 4))))
        else:
            name = rng.choice(["", " class='x'", " id='y2'"])
            parts.append(f"<{kind}{name}>{random_page(rng, depth + 1)}</{kind}>")
    return "".join(parts)


@pytest.mark.parametrize("seed", range(3))
def test_style_tree_is_that_of_plain_counting(spark, seed):
    rng = random.Random(seed)
    pages = [f"<html><body>{random_page(rng)}</body></html>" for _ in range(25)]
    df = spark.createDataFrame([(7, p) for p in pages], "host long, html string").repartition(4)
    rows = {r.path: r for r in site_style.style_tree(df).collect()}
    expected = plain_tree(pages)
    assert rows.keys() == {site_style.path_of(*labels) for labels in expected}
    single = set()
    every = Counter()
    for page in pages:
        seen = site_style._observations(parse(page))
        every.update(seen.keys())
        parents = {path: own.parent for path, own in seen.items()}
        single |= {(path, parent) for path, parent in parents.items()}
    alone = {parent for path, parent in single if every[path] == 1}
    for labels, (_, look, content) in expected.items():
        row = rows[site_style.path_of(*labels)]
        assert row.look == pytest.approx(look, abs=1e-9)
        assert row.content == pytest.approx(content, abs=1e-9)
        assert row.depth == len(labels) - 1
        assert row.parent == site_style.path_of(*labels[:-1])
        assert row.single == (row.path in alone)


def test_removal_is_broadcast_or_joined_alike(spark, monkeypatch):
    frame = "<html><body><div class='line'>our site</div><div class='text'><p>{0}</p></div></body></html>"
    pages = [frame.format(prose(i)) for i in range(6)]
    whole = texts(spark, *pages)
    monkeypatch.setattr(site_style, "BROADCAST_PATHS", -1)
    assert texts(spark, *pages) == whole == [prose(i) for i in range(6)]


def test_odd_pages(spark):
    schema = "page_id long, url string, html string, host string, out string, path string"
    data = [
        (1, None, None), (None, None, None), (2, "u", ""), (3, "http://h/", "no tags"),
        (3, "http://h/", "no tags"), (4, "", "<<<>"), (5, "http://h/", "<p>" + "a " * 100_000),
    ]
    df = spark.createDataFrame([(*row, "x", "y", "z") for row in data], schema)
    rows = site_style.extract(df.select("*", F.lit(1).alias("text")))
    found = sorted(((r.page_id, r.n_chars) for r in rows.collect()), key=repr)
    assert found == sorted([(1, 0), (2, 0), (3, 7), (3, 7), (4, 4), (5, 199_999), (None, 0)], key=repr)
