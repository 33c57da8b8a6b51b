"""Hard negatives by exact search in STR-packed R-trees.

Vectors are packed sort-tile-recursive. At the top, quantiles of the first component cut
the table into slabs, and each slab is cut along the second component into cells of a
bounded number of rows; ids decide between equal vectors, so a vector that a third of all
rows have fills as many cells as it needs. A cell is one row of the stored index. Within
a cell the rows of each frequent label are tiled apart (rarer labels together), along the
component of the widest spread at each level, into leaves of at most ``LEAF`` rows; nodes
hold ``FANOUT`` leaves. Every leaf and node has its minimum bounding box and the range of
its labels. For an anchor q a box bounds the inner products of its rows: component by
component the product lies between q times the one side and q times the other.

An anchor looks for rows of its own label, or of other ones, whose scores lie in windows.
In a cell it keeps a queue of boxes, the highest bound first. A box is pruned if its
interval of scores lies outside each of the anchor's windows, or strictly below the k-th
score found there so far; ties of bound and k-th score are looked at, since ids decide
them. Anchors that have taken the same leaf from their queues are scored together. Before
all cells are searched, each anchor is searched in its own cell, which gives every window
a k-th score to start with.

Cells are sent to slots, and groups of anchors to every slot, in one shuffle without a
join; a task holds the cells of one slot and one group of anchors at a time. A window
keeps the best k of each anchor, and k rows a task before its shuffle.

Components x become floor(scale * x). Scores are whole numbers, computed in doubles where
these are exact and in Python's integers beyond; a score that does not fit 64 bits is an
error. Defined results: rows with a null id or label, a null or empty vector, or any null
or non-finite component take no part; vectors of another length are not compared; rows
that repeat an id are candidates of their own, but no positive of their own id; of
several rows with an anchor's id the smallest (by length, label and components) is the
anchor; an anchor without positives, or with negative scores only, has no result, nor
has an empty table. Columns besides ``vec_id``, ``label`` and ``embedding`` are not
looked at.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vectors import floored, matrices

SCALE = 256
LEAF = 128
FANOUT = 16
#: Packed components of a cell.
CELL_BYTES = 8 << 20
#: Anchors that are searched together.
GROUP = 1024

PACKED = np.dtype("<i8")
LEAST, MOST = -(1 << 63), (1 << 63) - 1
_EXACT = 2.0**53

VECTOR_SCHEMA = (
    "vec_id long, label long, dims int, first long, second long, anchor boolean, weights binary"
)
CELL_SCHEMA = (
    "cell long, dims int, ids binary, labels binary, weights binary, leaves binary, anchors binary"
)
HIT_SCHEMA = "anchor_id long, place int, vec_id long, score long"


def labelled_vectors(rows: DataFrame, anchor: Column, scale: int = SCALE) -> DataFrame:
    """The rows that take part, with packed integer components; ``anchor`` marks anchors."""
    known = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        "embedding",
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, own in matrices(batch, "embedding"):
                weights, places = floored(own, scale), pa.array(at)
                dims = weights.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(places),
                        batch.column("label").take(places),
                        pa.array(np.full(len(at), dims, np.int32)),
                        pa.array(weights[:, 0]),
                        pa.array(weights[:, min(1, dims - 1)]),
                        batch.column("anchor").take(places),
                        pa.array([w.astype(PACKED).tobytes() for w in weights], pa.binary()),
                    ],
                    names=[c.split()[0] for c in VECTOR_SCHEMA.split(", ")],
                )

    return known.mapInArrow(pack, VECTOR_SCHEMA)


# Packing


def tiles(weights: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """``rows`` in leaves: sorted along the widest spread, cut into slabs, and so on within."""
    if len(rows) <= leaf:
        return [rows] if len(rows) else []
    own = weights[rows]
    widest = int((own.max(axis=0) - own.min(axis=0)).argmax())
    ordered = rows[np.argsort(own[:, widest], kind="stable")]
    n_leaves = -(-len(rows) // leaf)
    slab = leaf * -(-n_leaves // int(np.ceil(np.sqrt(n_leaves))))
    found = []
    for start in range(0, len(rows), slab):
        found += tiles(weights, ordered[start : start + slab], leaf)
    return found


def leaves_of(weights: np.ndarray, labels: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """The leaves of a cell; labels of less than half a leaf share theirs."""
    values, counts = np.unique(labels, return_counts=True)
    frequent = values[2 * counts >= leaf]
    found = []
    for label in frequent:
        found += tiles(weights, np.flatnonzero(labels == label), leaf)
    return found + tiles(weights, np.flatnonzero(~np.isin(labels, frequent)), leaf)


def cells(vectors: DataFrame) -> DataFrame:
    """The index: a row for every cell."""
    spark = vectors.sparkSession
    sizes = vectors.groupBy("dims").count().collect()
    parallel = spark.sparkContext.defaultParallelism
    most = {
        r.dims: min(max(1, CELL_BYTES // (8 * r.dims)), max(LEAF, -(-r["count"] // parallel)))
        for r in sizes
    }
    slabs = {
        r.dims: max(1, int(np.ceil(np.sqrt(-(-r["count"] // most[r.dims]))))) for r in sizes
    }
    slab = F.lit(0)
    for dims, n in slabs.items():
        if n > 1:
            cuts = (
                vectors.where(F.col("dims") == dims)
                .agg(F.percentile_approx("first", [i / n for i in range(1, n)]).alias("cuts"))
                .first()
                .cuts
            )
            below = F.filter(F.lit(cuts), lambda cut: cut < F.col("first"))
            slab = F.when(F.col("dims") == dims, F.size(below)).otherwise(slab)
    order = ["dims", "slab", "second", "vec_id"]
    packed = vectors.withColumn("slab", slab).repartitionByRange(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None
        for batch in batches:
            names = ("dims", "slab", "vec_id", "label", "anchor", "weights")
            for dims, of, *row in zip(*(batch.column(c).to_pylist() for c in names)):
                if held and ((dims, of) != at or len(held) == most[at[0]]):
                    yield _cell(at[0], held)
                    held = []
                at = (dims, of)
                held.append(tuple(row))
        if held:
            yield _cell(at[0], held)

    return packed.sortWithinPartitions(*order).mapInArrow(cut, CELL_SCHEMA)


def _cell(dims: int, rows: list[tuple]) -> pa.RecordBatch:
    ids, labels, anchors, weights = zip(*rows)
    ids, labels = np.array(ids, np.int64), np.array(labels, np.int64)
    matrix = np.frombuffer(b"".join(weights), PACKED).reshape(-1, dims)
    leaves = leaves_of(matrix, labels)
    order = np.concatenate(leaves)
    ends = np.cumsum([len(leaf) for leaf in leaves])
    packed = (ids[order], labels[order], matrix[order], ends, np.array(anchors, np.int64)[order])
    return pa.RecordBatch.from_arrays(
        [
            # The first row of a cell, in the order of the table, tells cells apart well enough.
            pa.array([int(ids[0])], pa.int64()),
            pa.array([dims], pa.int32()),
            *(pa.array([numbers.astype(PACKED).tobytes()], pa.binary()) for numbers in packed),
        ],
        names=[c.split()[0] for c in CELL_SCHEMA.split(", ")],
    )


# Searching a cell


def inner(left: np.ndarray, right: np.ndarray, exact: bool) -> np.ndarray:
    """left @ right.T in whole numbers: doubles if they are exact, else Python's integers."""
    if exact:
        return left.astype(np.float64) @ right.T.astype(np.float64)
    return left.astype(object) @ right.T.astype(object)


def intervals(
    queries: np.ndarray, low: np.ndarray, high: np.ndarray, exact: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest inner product of each query with any point of each box."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    smallest = inner(up, low, exact) + inner(down, high, exact)
    return smallest, inner(up, high, exact) + inner(down, low, exact)


class Tree:
    """A cell's leaves and nodes with their boxes."""

    def __init__(self, row: dict):
        self.dims = row["dims"]
        self.ids = np.frombuffer(row["ids"], PACKED)
        self.labels = np.frombuffer(row["labels"], PACKED)
        self.weights = np.frombuffer(row["weights"], PACKED).reshape(-1, self.dims)
        ends = np.frombuffer(row["leaves"], PACKED)
        starts = np.concatenate([[0], ends[:-1]])
        self.leaves = [slice(a, b) for a, b in zip(starts.tolist(), ends.tolist())]
        self.size = float(np.abs(self.weights).max())
        firsts = np.arange(0, len(ends), FANOUT)
        self.children = [range(f, min(f + FANOUT, len(ends))) for f in firsts.tolist()]
        self.low = self._boxes(np.minimum, self.weights, starts, firsts)
        self.high = self._boxes(np.maximum, self.weights, starts, firsts)
        self.first_label = self._boxes(np.minimum, self.labels, starts, firsts)
        self.last_label = self._boxes(np.maximum, self.labels, starts, firsts)

    @staticmethod
    def _boxes(side, values, starts, firsts) -> np.ndarray:
        """One side of all boxes: those of the leaves, then those of the nodes."""
        leaves = side.reduceat(values, starts, axis=0)
        return np.concatenate([leaves, side.reduceat(leaves, firsts, axis=0)])

    def labelled(self, labels: np.ndarray, same: bool) -> np.ndarray:
        """Whether a box (column) may hold rows of the label (row), or of another one."""
        if same:
            return (self.first_label <= labels[:, None]) & (labels[:, None] <= self.last_label)
        return (self.first_label != labels[:, None]) | (self.last_label != labels[:, None])


class Anchors:
    """A group of anchors of one length, their windows, and the best rows found so far."""

    def __init__(self, rows: list[dict], k: int, same: bool):
        self.k, self.same = k, same
        self.ids = np.array([r["anchor_id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        self.weights = np.array([np.frombuffer(r["weights"], PACKED) for r in rows])
        self.size = float(np.abs(self.weights).max())
        most = max(len(r["windows"]) for r in rows)
        # Windows that an anchor lacks let nothing in.
        self.places = np.full((len(rows), most), -1)
        self.high = np.full((len(rows), most), LEAST, np.int64)
        self.need = np.full((len(rows), most), MOST, np.int64)
        for i, row in enumerate(rows):
            for j, window in enumerate(row["windows"]):
                self.places[i, j] = window["place"]
                self.high[i, j] = window["high"]
                self.need[i, j] = max(window["low"], window["floor"])
        self.found: list[list[list]] = [[[] for _ in range(most)] for _ in rows]

    def admits(self, at, smallest, largest) -> np.ndarray:
        """Whether an interval of scores touches a window of its anchor."""
        need, high = self.need[at][..., None, :], self.high[at][..., None, :]
        return ((largest[..., None] >= need) & (smallest[..., None] <= high)).any(axis=-1)

    def search(self, tree: Tree) -> None:
        """All rows of the tree that are among the best k of a window, added to these."""
        exact = self.size * tree.size * tree.dims < _EXACT
        smallest, largest = intervals(self.weights, tree.low, tree.high, exact)
        labelled = tree.labelled(self.labels, self.same)
        if not exact:
            self._check(tree, labelled, smallest, largest)
        everyone = np.arange(len(self.ids))
        open_ = labelled & self.admits(everyone, smallest, largest)
        n_leaves = len(tree.leaves)
        queues: dict[int, list] = {}
        for a in everyone.tolist():
            nodes = n_leaves + np.flatnonzero(open_[a, n_leaves:])
            if len(nodes):
                queues[a] = list(zip((-largest[a, nodes]).tolist(), nodes.tolist()))
                heapq.heapify(queues[a])
        while queues:
            taken: dict[int, list[int]] = defaultdict(list)
            for a in list(queues):
                leaf = self._next_leaf(a, queues[a], tree, smallest, largest, open_)
                if leaf is None:
                    del queues[a]
                else:
                    taken[leaf].append(a)
            for leaf, anchors in taken.items():
                self._score(np.array(anchors), tree, tree.leaves[leaf], exact)

    def _check(self, tree: Tree, labelled, smallest, largest) -> None:
        """Scores beyond 64 bits, which no window holds, are an error."""
        beyond = labelled & ((smallest < LEAST) | (largest > MOST))
        for box, leaf in enumerate(tree.leaves):
            at = np.flatnonzero(beyond[:, box])
            scores = inner(self.weights[at], tree.weights[leaf], exact=False)
            if any(not LEAST <= s <= MOST for s in scores.ravel()):
                raise OverflowError("a score does not fit 64 bits")

    def _next_leaf(self, a: int, queue: list, tree: Tree, smallest, largest, open_) -> int | None:
        """The leaf of the highest bound that is not pruned; nodes on the way are opened."""
        n_leaves = len(tree.leaves)
        least = self.need[a].min()
        while queue:
            bound, box = heapq.heappop(queue)
            if -bound < least:
                # The rest of the queue lies lower still.
                return None
            if not self.admits(a, smallest[a, box : box + 1], largest[a, box : box + 1])[0]:
                continue
            if box < n_leaves:
                return box
            for leaf in tree.children[box - n_leaves]:
                if open_[a, leaf]:
                    heapq.heappush(queue, (-largest[a, leaf], leaf))
        return None

    def _score(self, at: np.ndarray, tree: Tree, leaf: slice, exact: bool) -> None:
        scores = inner(self.weights[at], tree.weights[leaf], exact).astype(np.int64)
        labels, ids = tree.labels[leaf], tree.ids[leaf]
        wanted = (labels == self.labels[at][:, None]) == self.same
        wanted &= ids != self.ids[at][:, None]
        for j in range(self.need.shape[1]):
            need, high = self.need[at, j][:, None], self.high[at, j][:, None]
            good = wanted & (scores >= need) & (scores <= high)
            for i in np.flatnonzero(good.any(axis=1)).tolist():
                row = np.flatnonzero(good[i])
                self._keep(int(at[i]), j, scores[i, row].tolist(), ids[row].tolist())

    def _keep(self, a: int, j: int, scores: list[int], ids: list[int]) -> None:
        best = sorted([*self.found[a][j], *((-s, i) for s, i in zip(scores, ids))])[: self.k]
        self.found[a][j] = best
        if len(best) == self.k:
            self.need[a, j] = max(self.need[a, j], -best[-1][0])

    def rows(self) -> pa.RecordBatch:
        flat = [
            (int(self.ids[a]), int(self.places[a, j]), i, -s)
            for a, windows in enumerate(self.found)
            for j, best in enumerate(windows)
            for s, i in best
        ]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        columns = list(zip(*flat)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)],
            names=[c.split()[0] for c in HIT_SCHEMA.split(", ")],
        )


# Searching the index


class Index:
    """The stored cells of a table and the anchors among its rows."""

    def __init__(self, vectors: DataFrame):
        index = stored(cells(vectors), "rtree-cells")
        self.slots = max(1, index.count())
        slot = F.pmod(F.xxhash64("cell", "dims"), F.lit(self.slots)).cast("int").alias("slot")
        self.cells = index.select(slot, "*")
        smallest = F.min(F.struct("dims", "label", "weights", "slot")).alias("row")
        anchors = _anchors(self.cells).groupBy("anchor_id").agg(smallest)
        self.anchors = stored(anchors.select("anchor_id", "row.*"), "rtree-anchors")
        self.groups = max(1, -(-self.anchors.count() // GROUP))

    def best(self, windows: DataFrame, k: int, same: bool) -> DataFrame:
        """The best ``k`` rows of every window of every anchor, with their ``rank``.

        ``windows``: ``anchor_id``, ``place``, ``low``, ``high``; ``same``: rows of the
        anchor's label, else of all others.
        """
        plain = windows.withColumn("floor", F.lit(LEAST))
        home = _ranked(self._hits(plain, k, same, home=True), k)
        kth = home.where(F.col("rank") == k).select(
            "anchor_id", "place", F.col("score").alias("kth")
        )
        begun = windows.join(kth, ["anchor_id", "place"], "left").select(
            *windows.columns, F.coalesce("kth", F.lit(LEAST)).alias("floor")
        )
        begun = stored(begun, "rtree-windows")
        return _ranked(self._hits(begun, k, same, home=False), k)

    def _hits(self, windows: DataFrame, k: int, same: bool, home: bool) -> DataFrame:
        """The best rows of every window in each cell: of the anchor's own slot, or of all."""
        window = F.struct("place", "low", "high", "floor")
        each = windows.groupBy("anchor_id").agg(F.collect_list(window).alias("windows"))
        query = F.struct("anchor_id", "dims", "label", "weights", "windows")
        group = F.pmod(F.xxhash64("anchor_id"), F.lit(self.groups)).alias("group")
        asked = self.anchors.join(each, "anchor_id").select("slot", group, query.alias("query"))
        queries = F.collect_list("query").alias("queries")
        if home:
            sent = asked.groupBy("slot", "group").agg(queries)
        else:
            every = F.explode(F.sequence(F.lit(0), F.lit(self.slots - 1))).alias("slot")
            sent = asked.groupBy("group").agg(queries).select(every, "group", "queries")
        met = self.cells.drop("anchors").withColumn("group", F.lit(-1).cast("long"))
        met = met.unionByName(sent, allowMissingColumns=True)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slot, trees = None, []
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    if row["slot"] != slot:
                        slot, trees = row["slot"], []
                    if row["queries"] is None:
                        trees.append(Tree(row))
                    else:
                        yield from _searched(trees, row["queries"], k, same)

        dealt = met.repartition("slot").sortWithinPartitions("slot", "group")
        return dealt.mapInArrow(search, HIT_SCHEMA)


def _searched(
    trees: list[Tree], queries: list[dict], k: int, same: bool
) -> Iterator[pa.RecordBatch]:
    for dims in sorted({q["dims"] for q in queries}):
        own = [t for t in trees if t.dims == dims]
        if own:
            anchors = Anchors([q for q in queries if q["dims"] == dims], k, same)
            for tree in own:
                anchors.search(tree)
            yield anchors.rows()


def _anchors(index: DataFrame) -> DataFrame:
    """The anchors in the cells, with the slots they lie in."""
    schema = "anchor_id long, label long, dims int, weights binary, slot int"

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = Tree(row)
                at = np.flatnonzero(np.frombuffer(row["anchors"], PACKED))
                columns = [
                    pa.array(tree.ids[at], pa.int64()),
                    pa.array(tree.labels[at], pa.int64()),
                    pa.array([tree.dims] * len(at), pa.int32()),
                    pa.array([w.tobytes() for w in tree.weights[at]], pa.binary()),
                    pa.array([row["slot"]] * len(at), pa.int32()),
                ]
                names = [c.split()[0] for c in schema.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return index.mapInArrow(taken, schema)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _percent(score: str, percent: int, up: bool) -> Column:
    """``percent`` of a score of 0 or more, rounded down or up, without leaving 64 bits."""
    rest = f"({score} % 100 * {percent} + {99 if up else 0}) div 100"
    return F.expr(f"{score} div 100 * {percent} + {rest}")


def mine(
    vectors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """For every anchor and each of its best ``positives``, the best ``negatives``: rows of
    other labels that score between ``low`` and ``high`` percent of the positive's score.

    ``vectors`` is a result of ``labelled_vectors``.
    """
    index = Index(stored(vectors, "rtree-vectors"))
    everything = index.anchors.select(
        "anchor_id",
        F.lit(0).alias("place"),
        F.lit(LEAST).alias("low"),
        F.lit(MOST).alias("high"),
    )
    liked = stored(
        index.best(everything, positives, same=True).select(
            "anchor_id",
            F.col("rank").alias("place"),
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "rtree-positives",
    )
    windows = (
        liked.where("positive_score >= 0")
        .select(
            "anchor_id",
            "place",
            _percent("positive_score", low, up=True).alias("low"),
            _percent("positive_score", high, up=False).alias("high"),
        )
        .where("low <= high")
    )
    found = index.best(stored(windows, "rtree-asked"), negatives, same=False)
    return found.join(liked, ["anchor_id", "place"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
