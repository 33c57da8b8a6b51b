"""Exact top-k search by block-at-a-time pruning.

Vectors are dealt into blocks of neighbouring ids. A block keeps its forward index
(the integer components of its vectors, row by row) and, for every term (component),
the largest and the smallest weight in it. A query's bound for a block is the sum,
over its terms, of weight times the largest weight if the query's weight is positive
and times the smallest if it is negative. A task orders its blocks by that bound for
each query and scores them through their forward indexes until the next bound falls
below the query's k-th score; ties of bound and k-th score are still scored, because
a tie is decided by the smaller id.

Two rounds share the work. The maxima and minima of all blocks, a small part of the
index, are met by every query first, and each is scored in the ``FIRST_BLOCKS`` blocks
of the highest bounds there are; the k-th score found is its floor. Queries then meet
the bounds once more, and only those that a list of blocks cannot exclude are sent to
it, to visit the list's blocks by falling bound until their floor, which rises, excludes
the rest.

Where queries meet blocks, rows of both are shuffled by the place where they meet and
sorted, blocks first: a task holds the blocks of one list (``LIST_BYTES``) and reads the
queries past them, ``QUERY_GROUP`` at a time. Queries are in parts of ``QUERY_PART``, and
a place that all of them come to is one of its own for every part, so that no task has to
read them all. A query's best k of each list meet in a window that keeps k rows per task
before its shuffle.

Components x become floor(1024 * x) by default. Scores are sums of products in
doubles where these are exact and in Python's integers beyond; a score that does not
fit 64 bits is an error. Defined results: null vectors, empty ones and those with null
or non-finite components take no part; neither do rows without id; vectors of another
length are compared only with their like. Rows that repeat an id are candidates of
their own; as a query the smallest of them counts, and it meets no row of its id. Fewer
than k candidates are all returned. Components too large for 64 bits are an error.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SCALE = 1024
BLOCK_SIZE = 256
#: Queries that meet blocks at a time.
QUERY_GROUP = 1024
#: Queries that read past the same blocks in one task.
QUERY_PART = 65_536
#: Blocks in which the floor of a query's k-th score is found.
FIRST_BLOCKS = 4
_EXACT = 2.0**53
#: No score that fits 64 bits is below this.
_LEAST = -(1 << 63)

#: Bytes of one list of blocks, or of bounds: what a task holds at a time.
LIST_BYTES = 32 << 20

#: Numbers in a block are packed as little-endian 64-bit integers.
BLOCK_SCHEMA = (
    "dims int, block long, ids binary, weights binary, largest binary, smallest binary"
)
PACKED = np.dtype("<i8")
HIT_SCHEMA = "query_id long, vec_id long, score long"
#: Where queries meet blocks: vectors of a length, a list or a block of them, a part.
PLACE = ["dims", "place", "part"]
_QUERY = ["vec_id", "query", "floor"]


def integer_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``dims`` and integer ``weights`` of the rows that take part."""
    x = F.col("embedding")
    finite = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    return rows.where(F.col("vec_id").isNotNull() & (F.size(x) > 0) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.size(x).alias("dims"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("weights"),
    )


def blocks(vectors: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """The blocks of ``vectors``, each a row; ids that share a range share a block.

    Blocks are cut within the sorted partitions of a range shuffle, so no key gathers
    more than a block's rows.
    """
    ordered = vectors.repartitionByRange("dims", "vec_id").sortWithinPartitions("dims", "vec_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        rows: list[list[int]] = []
        dims = None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("vec_id", "dims", "weights"))
            for vec_id, size, weights in zip(*columns):
                if ids and (size != dims or len(ids) == block_size):
                    yield _block(dims, ids, rows)
                    ids, rows = [], []
                dims = size
                ids.append(vec_id)
                rows.append(weights)
        if ids:
            yield _block(dims, ids, rows)

    return ordered.mapInArrow(cut, BLOCK_SCHEMA)


def _block(dims: int, ids: list[int], rows: list[list[int]]) -> pa.RecordBatch:
    weights = np.array(rows, np.int64)
    packed = (np.array(ids), weights, weights.max(axis=0), weights.min(axis=0))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([dims], pa.int32()),
            pa.array([ids[0]], pa.int64()),
            *(pa.array([numbers.astype(PACKED).tobytes()], pa.binary()) for numbers in packed),
        ],
        names=["dims", "block", "ids", "weights", "largest", "smallest"],
    )


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T in exact integers."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    size = float(np.abs(left).max()) * float(np.abs(right).max()) * left.shape[1]
    if size < _EXACT:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    exact = left.astype(object) @ right.T.astype(object)
    if any(abs(v) >= 1 << 63 for v in exact.ravel()):
        raise OverflowError("a score does not fit 64 bits")
    return exact.astype(np.int64)


def bounds(queries: np.ndarray, largest: np.ndarray, smallest: np.ndarray) -> np.ndarray:
    """Each query's bound (rows) for each block (columns)."""
    up = products(np.maximum(queries, 0), largest)
    return up + products(np.minimum(queries, 0), smallest)


class Best:
    """The k best candidates of each query of a group so far."""

    def __init__(self, query_ids: np.ndarray, k: int, floor: np.ndarray):
        self.query_ids = query_ids
        self.k = k
        self.floor = floor.copy()
        self.hits: list[list[tuple[int, int]]] = [[] for _ in query_ids]

    def add(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores of a block's ids for the queries at the given places."""
        for row, q in zip(scores, at):
            good = np.flatnonzero((row >= self.floor[q]) & (ids != self.query_ids[q]))
            if not len(good):
                continue
            found = self.hits[q] + list(zip((-row[good]).tolist(), ids[good].tolist()))
            found.sort()
            self.hits[q] = found[: self.k]
            if len(found) >= self.k:
                self.floor[q] = max(self.floor[q], -found[self.k - 1][0])

    def rows(self) -> pa.RecordBatch:
        flat = [(int(q), i, -s) for q, hits in zip(self.query_ids, self.hits) for s, i in hits]
        columns = list(zip(*flat)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
        )


def _packed(queries: DataFrame, parts: int) -> DataFrame:
    """``dims``, ``part``, ``vec_id``, ``query``: the weights of each query as bytes."""
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part")
    row = F.min(F.struct("dims", "weights")).alias("row")
    single = queries.groupBy("vec_id").agg(row).select("row.dims", part, "vec_id", "row.weights")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(w, PACKED).tobytes() for w in batch.column("weights").to_pylist()]
            columns = [batch.column(c) for c in ("dims", "part", "vec_id")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(rows, pa.binary())], names=["dims", "part", "vec_id", "query"]
            )

    return single.mapInArrow(pack, "dims int, part int, vec_id long, query binary")


def _meet(
    held: DataFrame,
    asking: DataFrame,
    visit: Callable[[tuple, list[dict], pa.RecordBatch], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``visit`` of each place, the rows held there, and a group of the queries that ask there."""
    both = held.withColumn("asks", F.lit(0)).unionByName(
        asking.withColumn("asks", F.lit(1)), allowMissingColumns=True
    )
    kept = [c for c in held.columns if c not in PLACE]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in (*PLACE, "asks"))
            start = 0
            for key, run in itertools.groupby(zip(*columns)):
                own = batch.slice(start, sum(1 for _ in run))
                start += own.num_rows
                if key[:-1] != place:
                    place, rows = key[:-1], []
                if not key[-1]:
                    rows += own.select(kept).to_pylist()
                elif rows:
                    for at in range(0, own.num_rows, QUERY_GROUP):
                        yield from visit(place, rows, own.slice(at, QUERY_GROUP))

    shuffled = both.repartition(*PLACE).sortWithinPartitions(*PLACE, "asks")
    return shuffled.mapInArrow(stream, schema)


def _asked(place: tuple, group: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, weights and floors of a group of queries."""
    weights = np.frombuffer(b"".join(group.column("query").to_pylist()), PACKED)
    return (
        group.column("vec_id").to_numpy(),
        weights.reshape(group.num_rows, place[0]),
        group.column("floor").to_numpy(),
    )


def _bounds_of(weights: np.ndarray, rows: list[dict]) -> np.ndarray:
    return bounds(
        weights,
        np.array([np.frombuffer(r["largest"], PACKED) for r in rows]),
        np.array([np.frombuffer(r["smallest"], PACKED) for r in rows]),
    )


def _first(place: tuple, rows: list[dict], group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The blocks of each query's highest bounds."""
    ids, weights, _ = _asked(place, group)
    bound = _bounds_of(weights, rows)
    order = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST_BLOCKS]
    keys = np.array([r["key"] for r in rows])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(ids, order.shape[1])),
            pa.array(keys[order].ravel()),
            pa.array(np.take_along_axis(bound, order, axis=1).ravel()),
        ],
        names=["vec_id", "key", "bound"],
    )


def _admit(place: tuple, rows: list[dict], group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The queries of each list in which some block's bound is not below their floor."""
    _, weights, floors = _asked(place, group)
    alive = _bounds_of(weights, rows) >= floors[:, None]
    lists = np.array([r["list"] for r in rows])
    for one in np.unique(lists):
        blocks_left = alive[:, lists == one].sum(axis=1)
        at = pa.array(np.flatnonzero(blocks_left))
        n = len(at)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, place[0], np.int32)),
                pa.array(np.full(n, one, np.int64)),
                pa.array(np.full(n, place[2], np.int32)),
                *(group.column(c).take(at) for c in _QUERY),
                pa.array(blocks_left[blocks_left > 0].astype(np.int64)),
            ],
            names=[*PLACE, *_QUERY, "blocks"],
        )


def _scorer(k: int):
    """The best k hits of a group of queries in the blocks of a place."""

    def score(place: tuple, rows: list[dict], group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, weights, floors = _asked(place, group)
        best = Best(ids, k, floors)
        _visit(best, weights, rows, None)
        yield best.rows()

    return score


def _visit(best: Best, weights: np.ndarray, own: list[dict], most: int | None) -> None:
    bound = _bounds_of(weights, own)
    order = np.argsort(-bound, axis=1, kind="stable")
    matrices = [np.frombuffer(b["weights"], PACKED).reshape(-1, weights.shape[1]) for b in own]
    ids = [np.frombuffer(b["ids"], PACKED) for b in own]
    # Step by step: every query's next block; those whose bound is too low have ended.
    waiting = np.arange(len(weights))
    for step in range(min(len(own), most or len(own))):
        blocks_now = order[waiting, step]
        alive = bound[waiting, blocks_now] >= best.floor[waiting]
        waiting, blocks_now = waiting[alive], blocks_now[alive]
        if not len(waiting):
            return
        for block in np.unique(blocks_now):
            at = waiting[blocks_now == block]
            best.add(at, ids[block], products(weights[at], matrices[block]))


def _best(hits: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    )
    return hits.withColumn("rank", place).where(F.col("rank") <= k)


def _index(vectors: DataFrame, block_size: int) -> tuple[DataFrame, int]:
    """The stored blocks with a ``key`` and the ``list`` each is in; how many there are."""
    index = stored(
        blocks(vectors, block_size).withColumn("key", F.monotonically_increasing_id()),
        "topk-blocks",
    )
    size = index.agg(F.count("*").alias("n"), F.sum(F.length("largest")).alias("bytes")).first()
    n_lists = _lists(index, size["n"], (size["bytes"] or 0) * block_size)
    return index.withColumn("list", F.pmod(F.xxhash64("key"), F.lit(n_lists))), size["n"]


def _lists(df: DataFrame, rows: int, size: int) -> int:
    """How many lists of ``LIST_BYTES`` there are, or one for every task if rows allow."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // LIST_BYTES), min(tasks, rows))


def _every(n: int, kind: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast(kind), F.lit(n - 1).cast(kind)))


def floors(
    index: DataFrame, maxima: DataFrame, queries: DataFrame, n_maxima: int, k: int
) -> DataFrame:
    """Packed ``queries`` with the k-th score each has in its first blocks as ``floor``."""
    unbounded = queries.withColumn("floor", F.lit(_LEAST).cast("long"))
    asking = unbounded.withColumn("place", _every(n_maxima, "long"))
    found = _meet(maxima, asking, _first, "vec_id long, key long, bound long")
    place = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.desc("bound"), "key"))
    chosen = stored(
        found.withColumn("nth", place).where(F.col("nth") <= FIRST_BLOCKS).select("vec_id", "key"),
        "topk-first",
    )
    asking = unbounded.join(chosen, "vec_id").withColumnRenamed("key", "place")
    # A block goes only to the parts of the queries that chose it.
    parts = asking.select("place", "part").distinct()
    held = index.withColumnRenamed("key", "place").drop("list").join(parts, "place")
    hits = _meet(held, asking, _scorer(k), HIT_SCHEMA)
    kth = _best(hits, k).where(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").alias("kth")
    )
    return stored(
        unbounded.join(kth, "vec_id", "left").select(
            "dims", "part", "vec_id", "query", F.coalesce("kth", "floor").alias("floor")
        ),
        "topk-floors",
    )


def admitted(
    vectors: DataFrame, queries: DataFrame, k: int = 10, block_size: int = BLOCK_SIZE
) -> tuple[DataFrame, DataFrame, int]:
    """The index, the queries that each of its lists cannot exclude, and the parts of these.

    A query's row in a list has in ``blocks`` how many blocks there its floor leaves.
    """
    index, n_blocks = _index(vectors, block_size)
    n_parts = max(1, -(-queries.select("vec_id").distinct().count() // QUERY_PART))
    packed = stored(_packed(queries, n_parts), "topk-queries")
    size = index.agg(F.sum(F.length("largest") + F.length("smallest"))).first()[0] or 0
    n_maxima = _lists(index, -(-n_blocks // QUERY_GROUP), size)
    maxima = index.select(
        "dims",
        F.pmod(F.xxhash64("list"), F.lit(n_maxima)).alias("place"),
        _every(n_parts, "int").alias("part"),
        "key",
        "list",
        "largest",
        "smallest",
    )
    floored = floors(index, maxima, packed, n_maxima, k)
    asking = floored.withColumn("place", _every(n_maxima, "long"))
    schema = "dims int, place long, part int, vec_id long, query binary, floor long, blocks long"
    return index, _meet(maxima, asking, _admit, schema), n_parts


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, block_size: int = BLOCK_SIZE
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's k best candidates.

    ``vectors`` and ``queries`` are results of ``integer_vectors``.
    """
    index, asking, n_parts = admitted(vectors, queries, k, block_size)
    held = index.withColumnRenamed("list", "place").withColumn("part", _every(n_parts, "int"))
    hits = _meet(held, asking.drop("blocks"), _scorer(k), HIT_SCHEMA)
    return _best(hits, k).select("query_id", "rank", "vec_id", "score")
