"""Joins, search, fingerprints and page texts against brute force."""

from __future__ import annotations

import hashlib
import html
import random
import re

import numpy as np
import pytest

from stratalake.llm import components, fingerprint, jaccard_join, queries, site_style, topk_blocks
from stratalake.llm.html_tree import parse


def shingle_set(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_components(texts, n, ratio):
    sets = [shingle_set(t, n) for _, t in texts]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and both * ratio.den >= len(a | sets[j]) * ratio.num:
                parent[root(i)] = root(j)
    named = {}
    for i, (doc_id, _) in enumerate(texts):
        if doc_id is not None:
            named[root(i)] = min(doc_id, named.get(root(i), doc_id))
    return [
        (d, len(s), named.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(texts, sets))
    ]


def near_copies(seed, groups=12, copies=9):
    chance = random.Random(seed)
    texts = []
    for _ in range(groups):
        size = chance.choice([4, 9, 12, 16, 21, 30, 45, 80, 150])
        base = [f"w{chance.randrange(60)}" for _ in range(size)]
        for _ in range(copies):
            words = list(base)
            for _ in range(chance.choice([0, 0, 1, 1, 2, 4])):
                words[chance.randrange(len(words))] = f"x{chance.randrange(1000)}"
            texts.append(" ".join(words))
    return list(enumerate(texts))


@pytest.mark.parametrize(
    "n, ratio, cheap_pairs, long_list",
    [(3, jaccard_join.Ratio(9, 10), 0, 64), (5, jaccard_join.Ratio(4, 5), 10**9, 2)],
)
def test_components_are_those_of_all_pairs(spark, n, ratio, cheap_pairs, long_list, monkeypatch):
    texts = near_copies(n) + [(1000, None), (1001, ""), (1002, "A b"), (1003, "a B"), (None, "a b")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    # Hubs are tried or not, and shingles put last, on far smaller data than otherwise.
    monkeypatch.setattr(jaccard_join, "CHEAP_PAIRS", cheap_pairs)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 4)
    monkeypatch.setattr(jaccard_join, "LONG_LIST", long_list)
    rows = [tuple(r) for r in jaccard_join.join(docs, n, ratio).collect()]
    assert sorted(rows, key=repr) == sorted(brute_components(texts, n, ratio), key=repr)


def borderline_pairs(groups=10):
    """Pairs just similar enough, with a smaller third member in one of their two lists.

    Of a pair's 60 words each has 3 of its own, and 57 are in both: one that nothing else
    has, one that a text before them has, and 55 that many have.
    """
    texts = []

    def add(*words):
        texts.append((len(texts), " ".join(words)))

    everywhere = [f"e{i}" for i in range(59)]
    for g in range(groups):
        add(f"third{g}", *everywhere)
    for g in range(groups):
        common = [f"c{g}x{i}" for i in range(55)]
        for copy in "ab":
            add(f"pair{g}", f"third{g}", *common, *(f"o{g}{copy}{i}" for i in range(3)))
        for copy in "pqr":
            add(*common, *(f"o{g}{copy}{i}" for i in range(30)))
    return texts


@pytest.mark.parametrize("long_list", [2, 64])
def test_pairs_meet_the_same_way_round_in_every_list(spark, long_list, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LONG_LIST", long_list)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 4)
    texts = borderline_pairs()
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    ratio = jaccard_join.Ratio(9, 10)
    rows = [tuple(r) for r in jaccard_join.join(docs, 1, ratio).collect()]
    assert sorted(rows) == sorted(brute_components(texts, 1, ratio))


def test_boundary_follows_the_cost():
    ratio = jaccard_join.Ratio(9, 10)
    few = jaccard_join.choose_boundary(ratio, {8: 100, 25: 100}, 0.0)
    many = jaccard_join.choose_boundary(ratio, {8: 100, 25: 100}, 1e6)
    assert few <= 25 < many <= jaccard_join.largest_light(ratio) + 1


def test_every_link_has_a_common_subset_key():
    ratio = jaccard_join.Ratio(9, 10)
    for s in range(1, 60):
        for t in range(s, 70):
            least = min(o for o in range(s + t + 1) if ratio.den * o >= ratio.num * (s + t - o))
            assert ratio.overlap(s, t) == least


def test_odd_joins(odd, none):
    rows = jaccard_join.join(odd, 3, jaccard_join.Ratio(9, 10)).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert {r.component_id for r in rows if r.n_shingles == 0} == {3, 4, 5, None}
    assert jaccard_join.join(none, 3, jaccard_join.Ratio(9, 10)).collect() == []
    kept = jaccard_join.keep_one(odd, 3, jaccard_join.Ratio(9, 10))
    assert kept.columns == odd.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 3, 4, 5, 6, 7, 8, 9, 10, 11]


def test_parities_never_exceed_the_difference():
    chance = np.random.default_rng(7)
    pool = chance.integers(-(2**63), 2**63 - 1, 5000)
    for size, other, shared in [(1, 1, 0), (1, 1, 1), (64, 65, 60), (300, 330, 290), (900, 1100, 100)]:
        left, right = pool[:size], pool[size - shared : size - shared + other]
        both = np.concatenate([left, pool[:0], right])
        a, _, b = jaccard_join.parities(both, np.array([size, 0, other]))
        least = jaccard_join.least_difference(a, b)
        assert least == jaccard_join.least_difference(b, a)
        assert least <= size + other - 2 * shared
        assert least > 0 or size == 1
    far = jaccard_join.parities(pool[:2000], np.array([1000, 1000]))
    # 2,000 shingles in 1,024 places leave an odd number in about half of them.
    assert jaccard_join.least_difference(*far) > 450


def test_parities_drop_no_linked_pair(spark):
    ratio = jaccard_join.Ratio(9, 10)
    chance = np.random.default_rng(8)
    base = [f"w{i}" for i in chance.integers(0, 400, 2600)]
    rows = []
    for i in range(60):
        words = list(base[: [130, 256, 1030, 2600][i % 4]])
        for at in chance.integers(0, len(words), int(len(words) * (i % 7) / 150)):
            words[at] = f"x{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = jaccard_join._with_parities(jaccard_join._signed(jaccard_join.shingles(docs, 3)))
    sets = signed.withColumnRenamed("doc_id", "row")
    # Candidates have sizes that fit each other.
    fitting = [(a, b) for b in range(60) for a in range(b) if a % 4 == b % 4]
    pairs = spark.createDataFrame(fitting, "a long, b long")
    left = {tuple(r) for r in jaccard_join._near(pairs, sets, ratio).collect()}
    whole = {r.row: set(r.shingles) for r in sets.collect()}
    apart = {(a, b): len(whole[a] ^ whole[b]) for a, b in fitting}
    most = {
        (a, b): len(whole[a]) + len(whole[b]) - 2 * ratio.overlap(len(whole[a]), len(whole[b]))
        for a, b in fitting
    }
    linked = {p for p in fitting if apart[p] <= most[p]}
    assert linked and linked <= left
    far = {p for p in fitting if apart[p] > 3 * most[p]}
    assert far and not far & left


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 102), (102, 101), (7, 7)]
    edges = spark.createDataFrame(chain, "a long, b long")
    labels = dict(components.components(edges).collect())
    assert labels == {i: 0 for i in range(51)} | {i: 100 for i in (100, 101, 102)}
    assert components.components(edges.limit(0)).collect() == []


def test_topk_is_exact(spark):
    sf = "/root/testdata/sf0.001"
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in vectors])
    whole = np.array([np.floor(1024 * np.array(r.embedding, np.float64)) for r in vectors])
    scores = (whole @ whole.T).astype(np.int64)
    expected = []
    for q, query in enumerate(ids):
        if query % 100 == 0:
            best = sorted((-scores[q][c], ids[c]) for c in range(len(ids)) if c != q)[:10]
            expected += [(query, i + 1, v, -s) for i, (s, v) in enumerate(best)]
    rows = [tuple(r) for r in queries.op2_block_topk(spark, sf).collect()]
    assert sorted(rows) == sorted(expected)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [0.5, 0.5]), (100, [1.0, 1.0, 1.0]), (1, [3.0, -4.0]),
        (2, [3.0, -4.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
        (None, [1.0, 1.0]), (200, [-1.0, 0.25]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = topk_blocks.integer_vectors(frame)
    found = topk_blocks.search(vectors, vectors.where("vec_id % 100 = 0"), k=10).collect()
    hits = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        hits.setdefault(r.query_id, []).append(r.vec_id)
    # The smaller of the two vectors of id 0 is the query; ties go to the smaller id.
    assert hits == {0: [200, 1, 2], 200: [0, 0, 1, 2]}
    none = vectors.limit(0)
    assert topk_blocks.search(none, none).collect() == []
    assert topk_blocks.search(vectors, none).collect() == []


def test_scores_near_the_ends_of_64_bits(spark):
    frame = spark.createDataFrame(
        [(0, [float(1 << 21)]), (1, [-float(1 << 21)]), (2, [-1.2 * (1 << 21)]), (3, [1.9 * (1 << 21)])],
        "vec_id long, embedding array<double>",
    )
    vectors = topk_blocks.integer_vectors(frame)
    found = topk_blocks.search(vectors, vectors.where("vec_id = 0"), k=10).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"])] == [3, 1, 2]
    assert min(r.score for r in found) < -(1 << 62)


def _clustered(clusters: int, each: int, dims: int) -> list[tuple[int, list[float]]]:
    chance = np.random.default_rng(5)
    centres = chance.normal(size=(clusters, dims)) * 4
    near = chance.normal(size=(clusters * each, dims)) * 0.1
    return [(i, (centres[i // each] + near[i]).tolist()) for i in range(clusters * each)]


def test_blocks_are_excluded_before_queries_are_sent(spark, monkeypatch):
    rows = _clustered(60, 50, 16)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = topk_blocks.integer_vectors(frame)
    asked = vectors.where("vec_id % 100 = 0")
    index, sent, _ = topk_blocks.admitted(vectors, asked, 10, 50)
    left = sum(r.blocks for r in sent.collect())
    assert index.count() >= 60
    assert left < 0.5 * 30 * index.count()
    whole = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64)
    # Queries in parts, several lists in a task, and parts of few queries change nothing.
    monkeypatch.setattr(topk_blocks, "QUERY_PART", 7)
    monkeypatch.setattr(topk_blocks, "QUERY_GROUP", 3)
    monkeypatch.setattr(topk_blocks, "LIST_BYTES", 20_000)
    found = topk_blocks.search(vectors, asked, 10, 50).collect()
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)
    expected = []
    for q in range(0, 3000, 100):
        scores = (whole @ whole[q]).tolist()
        best = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:10]
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == expected


def test_floors_come_from_the_best_blocks_of_all(spark):
    """However many lists there are, a query is scored in a few blocks before its floor."""
    frame = spark.createDataFrame(_clustered(40, 20, 8), "vec_id long, embedding array<double>")
    vectors = topk_blocks.integer_vectors(frame)
    index, n = topk_blocks._index(vectors, 20)
    packed = topk_blocks._packed(vectors.where("vec_id % 100 = 0"), 1)
    maxima = index.selectExpr(
        "dims", "0L place", "0 part", "key", "list", "largest", "smallest"
    )
    floored = topk_blocks.floors(index, maxima, packed, 1, 5).collect()
    whole = {r.vec_id: np.array(r.weights) for r in vectors.collect()}
    for r in floored:
        scores = sorted((int(whole[r.vec_id] @ w) for i, w in whole.items() if i != r.vec_id))
        assert topk_blocks._LEAST < r.floor <= scores[-5]
    assert n >= 40 and len(floored) == 8


def test_vectors_with_other_columns(spark):
    rows = [(i, [float(i), 1.0], i, "x", 7) for i in range(30)]
    names = "vec_id long, embedding array<float>, place int, part string, floor int"
    vectors = topk_blocks.integer_vectors(spark.createDataFrame(rows, names))
    found = topk_blocks.search(vectors, vectors.where("vec_id = 0"), k=3).collect()
    assert sorted((r["rank"], r.vec_id) for r in found) == [(1, 1), (2, 2), (3, 3)]


def test_blocks_prune_without_loss(spark):
    chance = np.random.default_rng(3)
    centres = chance.normal(size=(8, 6)) * 4
    points = [centres[i // 40] + chance.normal(size=6) * 0.1 for i in range(320)]
    best = topk_blocks.Best(np.array([-1]), 5, np.array([-(1 << 62)]))
    weights = np.floor(np.array(points) * 1024).astype(np.int64)
    made = []
    for start in range(0, 320, 40):
        part = weights[start : start + 40]
        made.append(
            topk_blocks._block(6, list(range(start, start + 40)), part.tolist()).to_pylist()[0]
        )
    query = weights[:1]
    topk_blocks._visit(best, query, made, None)
    scores = (weights @ query[0]).tolist()
    assert best.hits[0] == sorted((-s, i) for i, s in enumerate(scores))[:5]
    bound = topk_blocks.bounds(
        query, np.array([weights[i : i + 40].max(axis=0) for i in range(0, 320, 40)]),
        np.array([weights[i : i + 40].min(axis=0) for i in range(0, 320, 40)]),
    )[0]
    assert (bound < best.floor[0]).sum() >= 4
    huge = np.array([[1 << 40, -(1 << 40)]])
    with pytest.raises(OverflowError):
        topk_blocks.products(huge, huge)


def test_fingerprints_of_edited_texts(spark, small):
    texts = sorted((r.doc_id, r.text) for r in small.collect())
    rows = {r.doc_id: r for r in fingerprint.compare(small.repartition(5)).collect()}
    assert rows.keys() == {i for i, _ in texts}
    for at, (doc_id, text) in enumerate(texts):
        following = texts[(at + 1) % len(texts)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        assert rows[doc_id].n_chars == len(text)
        assert rows[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    near = [r.near_edited for r in rows.values()]
    far = [r.near_next for r in rows.values()]
    assert np.median(near) > 0.6 and np.median(far) < 0.2


def test_fingerprints_are_homomorphic(spark):
    rows = [(1, "b c d e\na a a a a"), (2, "a a a a a\nb c d e"), (3, "a a a a a"), (4, "b c d e"),
            (5, "a a a a a\na a a a a"), (6, "")]
    docs = spark.createDataFrame(rows, "key long, text string")
    lanes = {r.key: r for r in fingerprint._lanes(docs.repartition(2, "key"), ["key"]).collect()}
    add = lambda a, b, m: [(x + y) % m for x, y in zip(a, b)]
    for part, modulus in (("identity", 1 << 32), ("likeness", 1 << 32)):
        assert lanes[1][part] == lanes[2][part]
        assert lanes[1][part] == add(lanes[3][part], lanes[4][part], modulus)
        assert lanes[5][part] == add(lanes[3][part], lanes[3][part], modulus)
    found = {r.key: r.fingerprint for r in fingerprint.fingerprints(docs, "key").collect()}
    assert found[1] == found[2] and len(set(found.values())) == 5
    joined = spark.createDataFrame(
        [(lanes[3].identity, lanes[4].identity, lanes[1].identity)],
        "a array<long>, b array<long>, c array<long>",
    )
    both = fingerprint.combined(joined.a, joined.b, 32)
    back = fingerprint.combined(joined.c, joined.b, 32, -1)
    assert joined.select(both == joined.c, back == joined.a).first() == (True, True)


def test_likeness_of_windows_that_occur_very_often(spark):
    text = "a " * 100_000
    docs = spark.createDataFrame(
        [(1, text), (2, text + "b c d"), (3, "x y z " * 50_000)], "doc_id long, text string"
    )
    rows = {r.doc_id: r for r in fingerprint.compare(docs).collect()}
    assert rows[1].near_next > 0.999 and rows[1].near_edited > 0.999
    assert rows[2].near_next < 0.5


def test_odd_fingerprints(spark, odd, none):
    rows = fingerprint.compare(odd).collect()
    assert len(rows) == odd.count()
    assert len({r.fingerprint for r in rows if r.doc_id == 1}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprint.compare(none).collect() == []
    alone = fingerprint.compare(odd.where("doc_id = 7")).collect()
    text = odd.where("doc_id = 7").first().text
    quarter = len(text) // 4
    assert alone[0].edited_sha256 == hashlib.sha256(
        (text[: len(text) - quarter] + text[:quarter]).encode()
    ).hexdigest()
    assert alone[0].near_next == 1


def test_page_texts(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op1_site_style_text(spark, sf).collect()
    assert {r.page_id for r in rows} == pages.keys()
    for row in rows:
        article = re.search(r"(?s)<article>(.*?)</article>", pages[row.page_id].html)[1]
        blocks = (
            " ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split())
            for b in re.split(r"</?(?:p|h1)>", article)
        )
        assert row.text == "\n".join(b for b in blocks if b)
        assert (row.n_chars, row.url) == (len(row.text), pages[row.page_id].url)


PAGE = """<html><head><title>t</title><style>p{{}}</style></head><body>
<div class="top"><p>Welcome to our site</p></div>
<div class="text"><p>{0} one &amp; {0}<p>{0} <b>two</b><br>{0}</div>
<div class="end"><p>All rights reserved</p></div></body></html>"""


def test_repeated_branches_go_without_a_name(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(f"w{i}")) for i in range(30)]
    rows += [(100, "http://alone.example/", PAGE.format("z"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in site_style.extract(pages).collect()}
    assert all(found[i] == f"w{i} one & w{i}\nw{i} two w{i}" for i in range(30))
    assert found[100].startswith("Welcome")  # One page tells nothing of its site.


@pytest.mark.parametrize(
    "source, text",
    [
        ("<div class='page has-sidebar'><p>a b</div>", "a b"),
        ("<div class=no-comments><p>a</div><p>b c", "a\nb c"),
        ("<article class='post comments-open'>a</article>", "a"),
        ("<article class=comments>a</article>", "a"),
        ("<main class=with-widget><p>a</main>", "a"),
        ("<div class=sidebar><p>a b c</div><p>d", "a b c\nd"),
        ("<article>a</article><div class=comment-list>b c d e</div>", "a"),
        ("<p>a b</p><div class=main-nav>c</div><div id=nav2>d</div>", "a b"),
        ("<p title='the hidden truth'>a", "a"),
        ("<p data-x=\" class='ad' hidden \">a</p><p hidden>b", "a"),
        ("<p hidden-x data-hidden='1'>a</p><p HIDDEN=''>b</p><p title='x'hidden>c", "a"),
    ],
)
def test_names_and_attributes_are_read_whole(source, text):
    assert site_style.main_text(parse(source), frozenset()) == text


SHARED = """<html><body><div class="shell"><article><p>{0} one {0} two</p>
<div class="box"><p>Pass this on to all your friends</p></div></article></div></body></html>"""


@pytest.mark.parametrize("copies", [2, 30])
def test_repeated_branches_of_articles_go(spark, copies):
    rows = [(i, f"http://h.example/{i}", SHARED.format(f"w{i}")) for i in range(copies)]
    # Pages that repeat each other whole keep their text.
    rows += [(100 + i, f"http://same.example/{i}", SHARED.format("z")) for i in range(copies)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in site_style.extract(pages).collect()}
    for i in range(copies):
        assert found[i] == f"w{i} one w{i} two"
        assert found[100 + i].startswith("z one z two")


@pytest.mark.parametrize(
    "source, text",
    [
        ("<div><p>a b c d e f</div><article>teaser</article>", "a b c d e f\nteaser"),
        ("<main></main><div>a b</div>", "a b"),
        ("<div>a</div><article>b c</article>", "b c"),
    ],
)
def test_the_root_has_most_of_the_text(source, text):
    assert site_style.main_text(parse(source), frozenset()) == text


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""),
        ("plain <b>text</b>", "plain text"),
        ("<header>x</header><p>a<p>b <!-- c -->d", "a\nb d"),
        ("<article><header><h1>T</h1></header><p>a</article><aside>b</aside>", "T\na"),
        ("<ul><li>a<li>b</ul>c<table><tr><td>1<td>2<tr><td>3</table>", "a\nb\nc\n1\n2\n3"),
        ("<main><p>a</p><div id=comments><p>no</p></div></main>", "a"),
        ("<p>a</p><form><p>b</form><script>if (1<2) '</p>'</script><div class='ad x'>c</div>", "a"),
        ("<div class='cookie-notice'>n</div><p>1 &lt; 2&nbsp;&#233;</p>", "1 < 2 é"),
        ("a < b <i>c</i> <", "a < b c <"),
        ("<p title='>'>x</p><p>y", "x\ny"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ],
)
def test_main_text(source, text):
    assert site_style.main_text(parse(source), frozenset()) == text


def test_odd_pages(spark):
    rows = [(1, None, None), (1, None, None), (2, "u", ""), (None, "http://a.b/", "<p>x"),
            (3, "http://a.b/", "<p>" + "y " * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sorted(((r.page_id, r.n_chars) for r in site_style.extract(pages).collect()), key=repr)
    assert found == [(1, 0), (1, 0), (2, 0), (3, 199_999), (None, 1)]
    assert site_style.extract(pages.limit(0)).collect() == []
