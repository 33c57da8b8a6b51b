"""Whitening of embeddings, by mixed-precision eigenvectors of their covariance.

A component c becomes the integer x = floor(scale * c) + shift. One pass counts the
vectors and sums every dimension, exactly. A second one centres each vector at the
integers c next to the means and sums the products of its components; the rest of the
centring, d = mean - c, is at most a half a dimension and is taken off afterwards:
V = sum((x - c)(x - c)') / n - d d'. The products are whole numbers, so as long as their
sums stay below 2^53 the covariance is exact and does not depend on the order of the
rows; beyond that it has double precision.

Tasks send one row of d numbers for each dimension; these are added in two rounds, so that
no group grows with the number of tasks squared. The driver holds matrices of d by d
numbers, whatever the number of rows, and finds their eigenvectors (``eigen_refine``):
float32 first, then corrected by products in higher precision. A third pass measures the
whitened vectors' own covariance; a last one returns them. Vectors go through Arrow
batches, one matrix a batch; no pass shuffles them.

Defined results: null and empty vectors and those with null or non-finite components are
left out; rows that are repeated count and are returned once each; rows without id take
part and are returned without one; vectors of different lengths are whitened apart, each
length by its own statistics (the lengths are expected to be few); components without
variance (an eigenvalue within rounding of 0 against the largest) cannot be whitened and
are left out, so fewer than the wanted number are returned where the vectors span fewer
dimensions, and none for one vector or copies of one; an empty table gives an empty
result. A component, or a deviation, beyond 64 bits is an error. Columns besides
``vec_id`` and ``embedding`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .eigen_refine import eigen
from .vectors import floored, matrices

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Groups in which the matrices of the tasks are added first.
SALTS = 32
#: Rows of numbers in the files of the table are little-endian doubles.
PACKED = np.dtype("<f8")

#: From the integer vectors of one length to the rows whose products are summed.
Rows = Callable[[int, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """What turns the integer vectors of one length into whitened ones.

    ``centre`` are the integers next to the means, ``rest`` the sums less n times these.
    """

    n: int
    centre: np.ndarray
    rest: np.ndarray
    projection: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre).astype(np.float64) - self.rest.astype(np.float64) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.projection

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sums over the dimensions of (n * x - S)^2, exact."""
        moved = x - self.centre
        size = self.n * int(np.abs(moved).max(initial=0)) + int(np.abs(self.rest).max(initial=0))
        if size * size * x.shape[1] < 1 << 63:
            own = self.n * moved - self.rest
            return np.einsum("ij,ij->i", own, own)
        own = self.n * moved.astype(object) - self.rest.astype(object)
        sums = (own * own).sum(axis=1)
        if any(s >= 1 << 63 for s in sums):
            raise OverflowError("a deviation does not fit 64 bits")
        return sums.astype(np.int64)


def _vectors(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")


def integers(
    batches: Iterator[pa.RecordBatch], scale: int, shift: int
) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, integer vectors) of one length each."""
    for batch in batches:
        for at, own in matrices(batch, "embedding"):
            yield batch.column("vec_id").take(pa.array(at)), floored(own, scale) + shift


def sums(rows: DataFrame, scale: int, shift: int) -> dict[int, tuple[int, list[int]]]:
    """For each length the number of vectors and the exact sum of every dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for _, x in integers(batches, scale, shift):
            # Whole numbers of any size once they leave the batch.
            small = int(np.abs(x).max()) * len(x) < 1 << 63
            own = (x if small else x.astype(object)).sum(axis=0).astype(object)
            n, before = held.get(x.shape[1], (0, 0))
            held[x.shape[1]] = n + len(x), before + own
        for dims, (n, totals) in held.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([dims] * dims, pa.int32()),
                    pa.array(range(dims), pa.int32()),
                    pa.array([n] * dims, pa.int64()),
                    pa.array([int(t) for t in totals], pa.decimal128(38, 0)),
                ],
                names=["dims", "place", "n", "total"],
            )

    partial = _vectors(rows).mapInArrow(add, "dims int, place int, n long, total decimal(38,0)")
    added = partial.groupBy("dims", "place").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")
    )
    found: dict[int, tuple[int, list[int]]] = {}
    for row in sorted(added.collect(), key=lambda r: (r.dims, r.place)):
        found.setdefault(row.dims, (row.n, []))[1].append(int(row.total))
    return found


def products(rows: DataFrame, scale: int, shift: int, made: Rows) -> dict[int, np.ndarray]:
    """For each length, the sum over all vectors of y y', where y is ``made`` of the vector."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for _, x in integers(batches, scale, shift):
            y = made(x.shape[1], x)
            held[x.shape[1]] = held.get(x.shape[1], 0) + y.T @ y
        for dims, matrix in held.items():
            yield _packed(dims, np.arange(len(matrix)), matrix)

    def add(table: pa.Table) -> pa.Table:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in table.to_batches():
            columns = (batch.column(c).to_pylist() for c in ("dims", "place", "numbers"))
            for dims, place, numbers in zip(*columns):
                own = np.frombuffer(numbers, PACKED)
                held[dims, place] = held.get((dims, place), 0) + own
        parts = [_packed(d, np.array([p]), row[None, :]) for (d, p), row in held.items()]
        return pa.Table.from_batches(parts)

    schema = "dims int, place int, numbers binary"
    partial = _vectors(rows).mapInArrow(multiply, schema)
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt")
    some = partial.select("*", salt).groupBy("dims", "place", "salt").applyInArrow(add, schema)
    added = some.groupBy("dims", "place").applyInArrow(add, schema)
    found: dict[int, list[np.ndarray]] = {}
    for row in sorted(added.collect(), key=lambda r: (r.dims, r.place)):
        found.setdefault(row.dims, []).append(np.frombuffer(row.numbers, PACKED))
    return {dims: np.array(matrix) for dims, matrix in found.items()}


def _packed(dims: int, places: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([dims] * len(matrix), pa.int32()),
            pa.array(places, pa.int32()),
            pa.array([row.astype(PACKED).tobytes() for row in matrix], pa.binary()),
        ],
        names=["dims", "place", "numbers"],
    )


def fit(
    rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> dict[int, Whitening]:
    """The whitening of each length of ``rows``, fitted on all of them and measured."""
    start: dict[int, Whitening] = {}
    for dims, (n, totals) in sums(rows, scale, shift).items():
        centre = [(2 * t + n) // (2 * n) for t in totals]
        rest = [t - n * c for t, c in zip(totals, centre)]
        empty = np.zeros((dims, 0)), np.zeros(0)
        start[dims] = Whitening(n, np.array(centre), np.array(rest), *empty)
    if not start:
        return {}
    gram = products(rows, scale, shift, _near_centre(start))
    fitted = {d: _projected(w, gram[d], components) for d, w in start.items()}
    measured = products(rows, scale, shift, _with_ones(fitted))
    return {
        dims: replace(w, identity_error=_identity_error(measured[dims], w.n))
        for dims, w in fitted.items()
    }


def _near_centre(models: Mapping[int, Whitening]) -> Rows:
    return lambda dims, x: (x - models[dims].centre).astype(np.float64)


def _with_ones(models: Mapping[int, Whitening]) -> Rows:
    """Whitened vectors and a 1 each, whose products are the vectors' sums."""

    def made(dims: int, x: np.ndarray) -> np.ndarray:
        return np.column_stack([models[dims].whitened(x), np.ones(len(x))])

    return made


def _projected(start: Whitening, gram: np.ndarray, components: int) -> Whitening:
    rest = start.rest.astype(np.longdouble) / start.n
    covariance = gram.astype(np.longdouble) / start.n - np.outer(rest, rest)
    values, vectors = eigen(covariance)
    least = values.max(initial=0) * len(values) * np.finfo(np.float64).eps
    kept = min(components, int((values > least).sum()))
    values, vectors, trace = values[:kept], vectors[:, :kept], float(np.trace(covariance))
    return replace(start, projection=vectors / np.sqrt(values), explained=values / trace)


def _identity_error(sums_of_products: np.ndarray, n: int) -> float:
    means = sums_of_products[-1, :-1] / n
    covariance = sums_of_products[:-1, :-1] / n - np.outer(means, means)
    return float(np.abs(covariance - np.eye(len(means))).max(initial=0))


def whiten(
    rows: DataFrame, models: Mapping[int, Whitening], scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """``vec_id`` and the ``whitened`` vector of every row that takes part."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in integers(batches, scale, shift):
            found = list(models[x.shape[1]].whitened(x))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(found, pa.list_(pa.float64()))], names=["vec_id", "whitened"]
            )

    return _vectors(rows).mapInArrow(project, "vec_id long, whitened array<double>")


def report(
    rows: DataFrame, models: Mapping[int, Whitening], scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """A row for every vector and component, with what the components explain."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in integers(batches, scale, shift):
            model = models[x.shape[1]]
            found = model.whitened(x)
            n, kept = found.shape
            each = np.repeat(np.arange(n), kept)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * kept, model.n, np.int64)),
                    pa.array(model.deviations(x)[each]),
                    pa.array(found.ravel()),
                    pa.array(np.tile(model.explained, n)),
                    pa.array(np.full(n * kept, model.identity_error)),
                ],
                names=REPORT_COLUMNS,
            )

    return _vectors(rows).mapInArrow(listed, REPORT_SCHEMA)


REPORT_SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)
REPORT_COLUMNS = [column.split()[0] for column in REPORT_SCHEMA.split(", ")]
