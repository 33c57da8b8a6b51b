"""Similarity join of documents on word n-grams: an exact size-aware heavy-light join.

Two documents link if the Jaccard similarity of their sets of word n-grams (shingles) is
at least a given ratio. Equal sets are one class from the start, so copies cost nothing.
Classes are light or heavy by the size of their set:

* **Light** sets enumerate subsets. Sets of sizes s <= t link exactly if they share a
  subset of c(s, t) shingles, so every subset of that size is a key, and everything under
  a key is linked to one set of size s under it: no pairs, no verification.
* **Heavy** sets scan inverted lists. Linked sets share at least ``SHARED`` shingles among
  the first few of each in any common order. The order puts shingles that many documents
  have last, so lists are short, except those of large groups of near copies. How far
  down the order a shared shingle may stand follows from both sizes, which leaves out
  most members of such a group that are too far from the others. Members are compared
  with one hub of the list first; once the group is one component, a list has nothing
  left to compare but members of different components. All such pairs are counted. Of
  those that share enough, the sets' parities (a bit for every place that shingles fall
  into) give a least difference, which rules most of the others out without their sets;
  what is left is verified on whole sets.

The boundary between the two is the size at which enumerating, by the sizes there are,
begins to cost more than the measured lists. Whatever the boundary and the order, the
links are the same; both only decide what is cheap. Shingles are 64-bit hashes; classes
are told apart by the size and two hashes of their sets.

Nothing is collected but the frequent shingles (at most ``MAX_FREQUENT``) and the counts
by size of the light sets. A side is broadcast only after its rows have been counted.

Defined results: a text without words, empty or null, has an empty set and links with
nothing; with fewer than n words, the whole sequence is one shingle; rows that repeat a
``doc_id`` are rows of their own, with the smallest id of all they link with; a row
without id takes part, and its component is named by the others' ids, if any.
"""

from __future__ import annotations

import functools
import itertools
import math
import operator
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, stored
from .components import components

#: Something of a word: any character but the white space that separates words.
_WORD = r"[^\x20\x09-\x0D]"
#: Shingles that linked heavy sets must share among their first ones.
SHARED = 2
#: A shingle of so many documents is put last in the order.
FREQUENT = 32
#: Members of longer lists are compared by an order of their own.
LONG_LIST = 64
#: Shingles that are put last, at most: what is sent to every task.
MAX_FREQUENT = 200_000
#: Shingles a task holds before it counts them.
COUNTED_AT_ONCE = 2_000_000
#: Sets whose parities are computed together.
SETS_AT_ONCE = 256
#: Subsets a light set may have.
MAX_SUBSETS = 1500
#: Rows up to which a side of a join is broadcast.
MAX_BROADCAST = 1_000_000
#: Pairs for each row of the lists, and pairs at all, from which comparing with hubs pays.
PAIRS_PER_ROW = 2.0
CHEAP_PAIRS = 1_000_000


@dataclass(frozen=True)
class Ratio:
    """A least Jaccard similarity of ``num / den``, exactly."""

    num: int
    den: int

    def overlap(self, s: int, t: int) -> int:
        """The least intersection of linked sets of sizes s and t."""
        return -(-self.num * (s + t) // (self.num + self.den))

    def least_partner(self, s: int) -> int:
        return -(-self.num * s // self.den)

    def prefix(self, s: int) -> int:
        """How many first shingles share ``SHARED`` of every linked set's first ones."""
        return s - self.least_partner(s) + SHARED

    def subsets(self, s: int) -> int:
        """How many subsets a light set of size s enumerates."""
        sizes = range(self.least_partner(s), s * self.den // self.num + 1)
        wanted = ((min(s, t), max(s, t)) for t in sizes)
        return sum(math.comb(s, c) for a, b in wanted if (c := self.overlap(a, b)) <= min(s, a))

    def columns_fit(self, s: Column, t: Column) -> Column:
        """Whether sets of these sizes can be linked."""
        return (F.least(s, t) * self.den) >= (F.greatest(s, t) * self.num)


def shingles(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id`` and ``shingles``: the sorted distinct hashes of each text's word n-grams.

    Texts without words are left out by a look at the text: a filter on the set itself
    would be pushed below it and build every set once more for each of its words.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    spaced = F.split(F.translate("text", upper, lower), r"[\x20\x09-\x0D]+")
    worded = docs.where(F.col("text").rlike(_WORD))
    words = worded.select("doc_id", F.filter(spaced, lambda w: w != "").alias("words"))
    size = F.size("words")
    grams = F.transform(
        F.sequence(F.lit(0), size - n),
        lambda i: F.xxhash64(*(F.get("words", i + j) for j in range(n))),
    )
    found = (
        F.when(size < n, F.array(F.xxhash64(size, F.concat_ws(" ", "words")))).otherwise(grams)
    )
    sets = words.select("doc_id", found.alias("grams"))
    return sets.select("doc_id", F.sort_array(F.array_distinct("grams")).alias("shingles"))


def _signed(sets: DataFrame) -> DataFrame:
    """Sets with their size and two hashes."""
    other = F.aggregate(
        "shingles", F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(F.xxhash64(x))
    )
    return sets.select(
        "doc_id",
        F.size("shingles").alias("size"),
        F.xxhash64("shingles").alias("hash"),
        other.alias("other_hash"),
        "shingles",
    )


SIGNATURE = ["size", "hash", "other_hash"]


def largest_light(ratio: Ratio) -> int:
    """The largest size up to which every size has at most ``MAX_SUBSETS`` subsets."""
    size = 0
    while size < 200 and ratio.subsets(size + 1) <= MAX_SUBSETS:
        size += 1
    return size


def _heads(docs: DataFrame, n: int, ratio: Ratio) -> DataFrame:
    """Every document's row number, id, signature and first shingles, stored.

    A light set's head is the whole set. A heavy one's has all shingles among the lowest
    hashes, of which twice a prefix is expected, and a prefix of the others: whichever
    of the former are put last, a whole prefix is left.
    """
    share = min(1.0, 2 * (1 - ratio.num / ratio.den))
    below = -(1 << 63) + int(share * (1 << 63)) * 2 if share < 1 else (1 << 63) - 1
    low = F.size(F.filter("shingles", lambda x: x < below))
    size = F.col("size")
    prefix = size - F.ceil(size * ratio.num / F.lit(ratio.den)).cast("int") + SHARED + 1
    head = F.when(size <= largest_light(ratio), size).otherwise(F.least(size, low + prefix))
    signed = _signed(shingles(id_and_text(docs), n))
    return stored(
        signed.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            *SIGNATURE,
            low.alias("low"),
            F.slice("shingles", F.lit(1), head).alias("head"),
        ),
        "jaccard-heads",
    )


def _checked(df: DataFrame, most: int = MAX_BROADCAST) -> DataFrame:
    """``df``, a stored table, to be broadcast if it has few enough rows."""
    return F.broadcast(df) if df.count() <= most else df


def _frequent(heads: DataFrame) -> np.ndarray:
    """The shingles to put last: the most frequent of the low ones, sorted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            more = n > 1  # A shingle that a task sees once is not frequent there.
            return pa.RecordBatch.from_arrays(
                [pa.array(values[more]), pa.array(n[more])], names=["shingle", "n"]
            )

        for batch in batches:
            lows, heads_ = batch.column("low").to_pylist(), batch.column("head")
            flat, ends = heads_.flatten().to_numpy(), np.cumsum(_list_sizes(heads_))
            for low, end, start in zip(lows, ends, [0, *ends[:-1]]):
                held.append(flat[start : min(end, start + low)])
                size += len(held[-1])
            if size > COUNTED_AT_ONCE:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    counts = heads.select("low", "head").mapInArrow(count, "shingle long, n long")
    top = (
        counts.groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= FREQUENT)
        .orderBy(F.desc("n"), "shingle")
        .limit(MAX_FREQUENT)
    )
    return np.sort(np.array([r.shingle for r in top.select("shingle").collect()], np.int64))


def _list_sizes(lists: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.list_value_length(lists).to_numpy()


def _first_shingles(
    heads: DataFrame, ratio: Ratio, frequent: np.ndarray, least: int
) -> DataFrame:
    """(shingle, row, size, place) of the first shingles of sets of at least ``least``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("head")
            flat, sizes = lists.flatten().to_numpy(), _list_sizes(lists)
            last = np.zeros(len(flat), bool)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, flat), len(frequent) - 1)
                last = frequent[at] == flat
            columns = (batch.column(c).to_pylist() for c in ("row", "size"))
            values, counts = [], []
            end = 0
            for (_, size), held in zip(zip(*columns), sizes):
                own = slice(end, end + held)
                end += held
                order = np.argsort(last[own], kind="stable")[: ratio.prefix(size)]
                values.append(flat[own][order])
                counts.append(len(order))
            if values:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(values)),
                        pa.array(np.repeat(batch.column("row").to_numpy(), counts)),
                        pa.array(np.repeat(batch.column("size").to_numpy(), counts)),
                        pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in counts])),
                    ],
                    names=["shingle", "row", "size", "place"],
                )

    chosen = heads.where(F.col("size") >= least).select("row", "size", "head")
    return chosen.mapInArrow(emit, "shingle long, row long, size int, place int")


def _light_links(heads: DataFrame, ratio: Ratio, most: int) -> DataFrame:
    """Edges (a, b) of row numbers between sets of at most ``most`` shingles."""

    def enumerate_subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, ...]] = []
            columns = (batch.column(c).to_pylist() for c in ("row", "head", "mixed"))
            for row, head, mixed in zip(*columns):
                t, whole, other_whole = len(head), _xor(head), _xor(mixed)
                partners = range(ratio.least_partner(t), min(most, t * ratio.den // ratio.num) + 1)
                for partner in partners:
                    s, u = min(t, partner), max(t, partner)
                    kept = ratio.overlap(s, u)
                    for out in itertools.combinations(range(t), t - kept):
                        key = whole ^ _xor(head[i] for i in out)
                        other = other_whole ^ _xor(mixed[i] for i in out)
                        found.append((row, t, s, u, key, other))
            arrays = [pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * 6
            yield pa.RecordBatch.from_arrays(
                arrays, names=["row", "size", "s", "t", "key", "other"]
            )

    mixed = F.transform("head", lambda x: F.xxhash64(x, F.lit("light")))
    light = heads.where(F.col("size") <= most).select("row", "size", "head", mixed.alias("mixed"))
    subsets = light.mapInArrow(
        enumerate_subsets, "row long, size long, s long, t long, key long, other long"
    )
    by = ["s", "t", "key", "other"]
    hub = F.min(F.when(F.col("size") == F.col("s"), F.col("row"))).alias("hub")
    hubs = subsets.groupBy(*by).agg(hub, F.count("*").alias("n"))
    hubs = hubs.where((F.col("n") > 1) & F.col("hub").isNotNull()).drop("n")
    linked = subsets.join(hubs, by).where("row <> hub")
    return linked.select(F.col("row").alias("a"), F.col("hub").alias("b")).distinct()


def _xor(values: Iterable[int]) -> int:
    return functools.reduce(operator.xor, values, 0)


def choose_boundary(
    ratio: Ratio, sizes: dict[int, int], list_rows: float
) -> int:
    """The size from which sets are heavy, by the least cost of all light sizes together.

    ``sizes`` counts sets by size up to ``largest_light``; ``list_rows`` is the mean number
    of rows a first shingle meets in its list.
    """
    # Below this the sets that lists must find may share fewer than SHARED shingles.
    first = next(b for b in itertools.count(1) if ratio.least_partner(b) > SHARED)
    candidates = range(first, max(first, largest_light(ratio) + 1) + 1)

    def cost(boundary: int) -> float:
        return sum(
            n * (ratio.subsets(s) if s < boundary else ratio.prefix(s) * (1 + list_rows))
            for s, n in sizes.items()
        )

    return min(candidates, key=lambda b: (cost(b), -b))


def _boundary(heads: DataFrame, ratio: Ratio) -> int:
    small = heads.where(F.col("size") <= largest_light(ratio))
    sizes = {r["size"]: r["count"] for r in small.groupBy("size").count().collect()}
    lists = (
        _first_shingles(small, ratio, np.empty(0, np.int64), 1).groupBy("shingle").count()
    )
    n = F.col("count").cast("double")
    row = lists.agg(F.sum(n * n).alias("met"), F.sum(n).alias("rows")).first()
    return choose_boundary(ratio, sizes, (row["met"] or 0.0) / (row["rows"] or 1.0))


def parities(sets: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """For each set, one bit a place: whether an odd number of its shingles fall there.

    ``sets`` holds the shingles of all sets, ``sizes`` how many each has. A set has the
    next power of two places to its size, 64 at least; a shingle falls into the place of
    its last bits.
    """
    places = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    ends = np.cumsum(places)
    at = np.repeat(ends - places, sizes) + (sets & np.repeat(places - 1, sizes))
    odd = np.bincount(at, minlength=int(places.sum())) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [packed[(end - size) // 8 : end // 8] for end, size in zip(ends, places)]


def least_difference(left: bytes, right: bytes) -> int:
    """How many shingles at least are in one of two sets only, by their parities."""
    a, b = (np.frombuffer(x, np.uint64) for x in sorted((left, right), key=len))
    while len(b) > len(a):
        # A place of the smaller one is two of the larger one.
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _with_parities(signed: DataFrame) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SETS_AT_ONCE):
                part = batch.slice(start, SETS_AT_ONCE)
                lists = part.column("shingles")
                bits = parities(lists.flatten().to_numpy(), _list_sizes(lists))
                yield part.append_column("bits", pa.array(bits, pa.binary()))

    fields = signed.schema.simpleString()[len("struct<") : -1]
    return signed.mapInArrow(add, f"{fields},bits:binary")


def _whole_sets(docs: DataFrame, n: int, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """(row, shingles, bits) of the given rows; only the sets of their documents are built.

    Rows may occur more than once, if their documents repeat an id and its text.
    """
    wanted = stored(classes.join(rows.distinct(), "row", "left_semi"), "jaccard-wanted")
    ids = _checked(stored(wanted.select(F.col("doc_id").alias("id")).distinct(), "jaccard-ids"))
    own = id_and_text(docs).join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    signed = stored(_with_parities(_signed(shingles(own, n))), "jaccard-sets")
    same = [signed[c] == wanted[c] for c in SIGNATURE]
    by_doc = signed["doc_id"].eqNullSafe(wanted["doc_id"])
    return signed.join(_checked(wanted), [by_doc, *same]).select(
        wanted["row"], signed["size"], signed["shingles"], signed["bits"]
    )


def _near(pairs: DataFrame, sets: DataFrame, ratio: Ratio) -> DataFrame:
    """The pairs (a, b) that the parities of their sets do not tell apart, stored.

    Linked sets differ by at most the sum of their sizes less twice the least overlap.
    """
    bits = sets.dropDuplicates(["row"])

    def side(name: str) -> DataFrame:
        return bits.select(
            F.col("row").alias(name),
            F.col("size").alias(f"{name}_size"),
            F.col("bits").alias(f"{name}_bits"),
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (
                batch.column(c).to_pylist() for c in ("a_size", "b_size", "a_bits", "b_bits")
            )
            near = [
                least_difference(left, right) <= s + t - 2 * ratio.overlap(s, t)
                for s, t, left, right in zip(*columns)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return stored(both.mapInArrow(compare, "a long, b long"), "jaccard-near")


def _verified(
    docs: DataFrame, n: int, ratio: Ratio, classes: DataFrame, pairs: DataFrame
) -> DataFrame:
    """The pairs (a, b) of row numbers whose whole sets are similar enough.

    Whole sets are moved for those pairs alone that their parities do not tell apart.
    """
    pairs = stored(pairs.select("a", "b"), "jaccard-pairs")
    found = _whole_sets(docs, n, classes, _ends(pairs))
    near = _near(pairs, found.select("row", "size", "bits"), ratio)
    ends = _checked(stored(_ends(near).distinct(), "jaccard-ends"))
    sets = found.select("row", "shingles").join(ends, "row", "left_semi").dropDuplicates(["row"])
    left = sets.select(F.col("row").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("row").alias("b"), F.col("shingles").alias("right"))
    both = near.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - common
    return both.where(common * ratio.den >= union * ratio.num).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row")))


def _labelled(lists: DataFrame, edges: DataFrame) -> DataFrame:
    """The lists with each row's component so far."""
    labels = components(edges)
    known = lists.join(labels, lists.row == labels.node, "left")
    label = F.coalesce("label", "row")
    return known.select("shingle", "row", "size", "place", "copies", label.alias("label"))


def _open_lists(lists: DataFrame) -> DataFrame:
    """The lists that have members of different components, with their hub and largest one."""
    members = lists.groupBy("shingle", "label").agg(
        F.count("*").alias("n"), F.max(F.struct("copies", -F.col("row"), "size", "place")).alias("hub")
    )
    open_ = members.groupBy("shingle").agg(
        F.count("*").alias("labels"),
        F.sum("n").alias("rows"),
        F.max(F.struct("n", -F.col("label"))).alias("largest"),
        F.max("hub").alias("hub"),
    )
    return open_.where("labels > 1").select(
        "shingle",
        "rows",
        (F.col("rows") * (F.col("rows") - F.col("largest.n"))).alias("pairs"),
        (-F.col("largest.col2")).alias("largest"),
        (-F.col("hub.col2")).alias("hub"),
        F.col("hub.size").alias("hub_size"),
        F.col("hub.place").alias("hub_place"),
    )


def _free(ratio: Ratio) -> tuple[Column, Column]:
    """How many shingles of a, and of b, a linked pair of their sizes can lack."""
    sizes = F.col("a_size") + F.col("b_size")
    least = F.ceil(sizes * ratio.num / F.lit(ratio.num + ratio.den)).cast("int")
    return F.col("a_size") - least, F.col("b_size") - least


def _fitting(pairs: DataFrame, ratio: Ratio) -> DataFrame:
    """The meetings that a linked pair can have by its sizes and places.

    With an intersection of at least c, sets of sizes s and t share k shingles among the
    first s - c + k and t - c + k of the order.
    """
    a_free, b_free = _free(ratio)
    return pairs.where(
        ratio.columns_fit(F.col("a_size"), F.col("b_size"))
        & (F.col("a_place") < a_free + SHARED)
        & (F.col("b_place") < b_free + SHARED)
    )


def _turned(pairs: DataFrame) -> DataFrame:
    """The meetings with a < b: which side a row is on differs from list to list."""
    swapped = F.col("a") > F.col("b")
    names = [name for c in ("", "_size", "_place") for name in (f"a{c}", f"b{c}")]
    other = {name: ("b" if name[0] == "a" else "a") + name[1:] for name in names}
    return pairs.select(
        *(F.when(swapped, F.col(other[c])).otherwise(F.col(c)).alias(c) for c in names)
    )


def _candidates(pairs: DataFrame, ratio: Ratio) -> DataFrame:
    """Pairs that share enough first shingles, the first of them early enough."""
    a_free, b_free = _free(ratio)
    early = F.max((F.col("a_place") <= a_free) & (F.col("b_place") <= b_free)).alias("early")
    meetings = _turned(_fitting(pairs, ratio))
    shared = meetings.groupBy("a", "b").agg(F.count("*").alias("shared"), early)
    return shared.where((F.col("shared") >= SHARED) & F.col("early")).select("a", "b")


def _met(members: DataFrame) -> DataFrame:
    """Members of lists with those of other components, unless both are in the largest."""

    def side(part: DataFrame, name: str) -> DataFrame:
        return part.select(
            "shingle",
            F.col("row").alias(name),
            *(F.col(c).alias(f"{name}_{c}") for c in ("size", "place", "label", "largest")),
        )

    others = side(members.where("label <> largest"), "a")
    return others.join(side(members, "b"), "shingle").where(
        "a_label <> b_label and (b_label = a_largest or a < b)"
    )


def _reordered(
    docs: DataFrame, n: int, ratio: Ratio, classes: DataFrame, crowded: DataFrame
) -> DataFrame:
    """The lists of the given rows in the order of their shingles' counts among them.

    The members of a group of near copies have most shingles in common; what tells them
    apart comes first here, so that only those meet that differ little from the others.
    """
    sets = _whole_sets(docs, n, classes, crowded.select("row")).select("row", "shingles")
    tokens = sets.dropDuplicates(["row"]).select(
        "row", F.explode_outer("shingles").alias("shingle")
    )
    counts = tokens.groupBy("shingle").agg(F.count("*").alias("n"))
    order = Window.partitionBy("row").orderBy("n", "shingle")
    placed = tokens.join(counts, "shingle").withColumn("place", F.row_number().over(order) - 1)
    least = F.ceil(F.col("size") * ratio.num / F.lit(ratio.den)).cast("int")
    known = placed.where("n > 1").join(crowded, "row")
    return known.where(F.col("place") < F.col("size") - least + SHARED).select(
        "shingle", "row", "size", "place", F.lit(1).cast("long").alias("copies"), "label"
    )


def _pairs_left(
    docs: DataFrame, n: int, ratio: Ratio, classes: DataFrame, labelled: DataFrame
) -> DataFrame:
    """All pairs of different components that may be linked.

    Two rows that share a shingle with a long list are both in that list, so all pairs
    among the members of long lists are found by the order made for them; the others
    share only shingles with short lists.
    """
    open_ = _open_lists(labelled).select("shingle", "largest", "rows")
    members = stored(labelled.join(open_, "shingle"), "jaccard-open-members")
    crowded = members.where(F.col("rows") > LONG_LIST).select("row", "size", "label").distinct()
    crowded = stored(crowded, "jaccard-crowded")
    again = stored(_reordered(docs, n, ratio, classes, crowded), "jaccard-reordered")
    ordered = again.join(_open_lists(again).select("shingle", "largest"), "shingle")
    short = _candidates(_met(members.where(F.col("rows") <= LONG_LIST)), ratio)
    return short.unionByName(_candidates(_met(ordered), ratio)).distinct()


def _heavy_links(
    docs: DataFrame,
    n: int,
    ratio: Ratio,
    heads: DataFrame,
    classes: DataFrame,
    least: int,
    light: DataFrame,
) -> DataFrame:
    """Edges among sets of at least ``least`` shingles, as far as others do not imply them."""
    first = _first_shingles(heads, ratio, _frequent(heads), least)
    several = first.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    lists = first.join(several, "shingle").join(
        classes.select("row", "copies"), "row"
    ).select("shingle", "row", "size", "place", "copies")
    lists = stored(lists, "jaccard-lists")
    labelled = stored(_labelled(lists, light), "jaccard-labelled")
    open_ = stored(_open_lists(labelled), "jaccard-open")
    edges = light
    if (open_.agg(F.sum("pairs")).first()[0] or 0) > max(CHEAP_PAIRS, PAIRS_PER_ROW * lists.count()):
        # Once: a list's hub is the same whatever has been linked.
        hub = labelled.select(F.col("row").alias("hub"), F.col("label").alias("hub_label"))
        named = open_.join(hub.distinct(), "hub")
        met = labelled.join(named, "shingle").where("row <> hub and label <> hub_label")
        pairs = met.select(
            F.col("row").alias("a"),
            F.col("hub").alias("b"),
            F.col("size").alias("a_size"),
            F.col("hub_size").alias("b_size"),
            F.col("place").alias("a_place"),
            F.col("hub_place").alias("b_place"),
        )
        found = _verified(docs, n, ratio, classes, _candidates(pairs, ratio))
        edges = stored(light.unionByName(found).distinct(), "jaccard-edges")
        labelled = stored(_labelled(lists, edges), "jaccard-labelled")
    pairs = _pairs_left(docs, n, ratio, classes, labelled)
    found = _verified(docs, n, ratio, classes, pairs)
    return edges.unionByName(found)


def join(docs: DataFrame, n: int, ratio: Ratio) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``."""
    heads = _heads(docs, n, ratio)
    classes = stored(
        heads.groupBy(*SIGNATURE).agg(F.min("row").alias("row"), F.count("*").alias("copies"))
        .join(heads.select("row", "doc_id"), "row"),
        "jaccard-classes",
    )
    one_each = heads.join(_checked(_repeats(heads, classes)), "row", "left_anti")
    boundary = _boundary(one_each, ratio)
    light = stored(_light_links(one_each, ratio, boundary - 1), "jaccard-light")
    least = max(1, ratio.least_partner(boundary))
    edges = _heavy_links(docs, n, ratio, one_each, classes, least, light)
    labels = components(edges)
    rows = heads.select("row", "doc_id", *SIGNATURE)
    of_class = classes.join(labels, classes.row == labels.node, "left").select(
        *SIGNATURE, F.coalesce("label", "row").alias("label")
    )
    members = stored(rows.join(of_class, SIGNATURE), "jaccard-members")
    names = members.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked = members.join(names, "label").select(
        "doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id"
    )
    texts = id_and_text(docs)
    blank = texts.where(~F.col("text").rlike(_WORD))
    alone = blank.select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return linked.unionByName(alone)


def _repeats(heads: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows that repeat the set of another row of a smaller number."""
    several = classes.where("copies > 1").select(*SIGNATURE, F.col("row").alias("kept"))
    repeated = heads.select("row", *SIGNATURE).join(several, SIGNATURE).where("row <> kept")
    return stored(repeated.select("row"), "jaccard-repeats")


def keep_one(docs: DataFrame, n: int, ratio: Ratio) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Rows that repeat an id stay or go together, except that of equal texts one stays.
    Rows without words or without id stay.
    """
    groups = join(docs, n, ratio).where(F.col("doc_id").isNotNull())
    by_id = stored(
        groups.groupBy("doc_id").agg(
            F.max(F.col("component_id") == F.col("doc_id")).alias("stays"),
            F.count("*").alias("rows"),
        ),
        "jaccard-kept",
    )
    # Names that no column of the documents is likely to have.
    named = F.col("doc_id").alias("__jaccard_id")
    gone = stored(by_id.where("not stays").select(named), "jaccard-gone")
    same = F.col("doc_id") == F.col("__jaccard_id")
    left = docs.join(_checked(gone), same, "left_anti")
    repeated = _checked(stored(by_id.where("stays and rows > 1").select(named), "jaccard-repeated"))
    once = left.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(repeated, same, "left_anti").unionByName(once)
