"""Eigenvectors against known ones, whitening against numpy on whole tables."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from stratalake.llm import eigen_refine, queries, whitening

SF = "/root/testdata/sf0.01"


def rotated(values, seed=0):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    return (q * np.asarray(values)) @ q.T, q


def check_eigen(matrix):
    values, vectors = eigen_refine.eigen(matrix)
    size = max(np.abs(matrix).max(), 1e-300)
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-14 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(matrix))).max() <= 1e-14
    assert (np.diff(values) <= 0).all()
    return values, vectors


def test_separate_eigenvalues_are_found_to_double_precision():
    values = np.linspace(1, 5, 40)
    matrix, q = rotated(values)
    found, vectors = check_eigen(matrix)
    assert found == pytest.approx(values[::-1], rel=1e-14)
    agreement = np.abs((vectors * q[:, ::-1]).sum(axis=0))
    assert agreement == pytest.approx(1, abs=1e-13)


@pytest.mark.parametrize(
    "values",
    [
        [5.0] * 10 + [1.0] * 20 + list(1 + np.linspace(0, 1e-9, 20)) + [0.0] * 14,
        list(1 + np.arange(32) * 1e-8) + list(np.arange(32) * 1e-6),
        [1.0] * 7,
        [0.0] * 3,
        [1e30, 1.0, 1e-30],
        [3.0],
    ],
)
def test_clustered_eigenvalues(values):
    found, _ = check_eigen(rotated(values)[0] if len(set(values)) > 1 else np.diag(values))
    assert found == pytest.approx(sorted(values, reverse=True), abs=1e-14 * max(values))


def test_clusters_beyond_float32_are_told_apart():
    """Gaps of 1e-8 are lost in float32; the sub-solves bring the vectors back."""
    values = [2.0, 1 + 3e-8, 1 + 2e-8, 1 + 1e-8, 1.0, 0.5]
    matrix, q = rotated(values, 3)
    _, vectors = check_eigen(matrix)
    # The matrix itself is rounded at 1e-16, which moves vectors by that over the gap.
    assert np.abs((vectors * q).sum(axis=0)) == pytest.approx(1, abs=1e-12)


def vectors_of(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    return [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)


def test_query_whitens_the_table(spark):
    ids, c = vectors_of(spark, SF)
    x = np.floor(64 * c).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    df = queries.op12_refined_whitening(spark, SF)
    assert dict(df.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    rows = df.toPandas().sort_values(["vec_id", "component"])
    assert len(rows) == 32 * n and set(rows.n) == {n}
    assert (rows.component.to_numpy().reshape(n, 32) == np.arange(1, 33)).all()
    order = np.argsort(ids)
    deviation = ((n * x - sums) ** 2).sum(axis=1)[order]
    assert (rows.deviation.to_numpy().reshape(n, 32) == deviation[:, None]).all()
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, q = np.linalg.eigh(covariance)
    values, q = values[::-1], q[:, ::-1]
    expected = (centred @ q[:, :32] / np.sqrt(values[:32]))[order]
    found = rows.whitened.to_numpy().reshape(n, 32)
    signs = np.sign((found * expected).sum(axis=0))
    assert np.abs(found - expected * signs).max() < 1e-10
    explained = rows.explained.to_numpy().reshape(n, 32)
    assert explained == pytest.approx(np.tile(values[:32] / values.sum(), (n, 1)), rel=1e-10)
    own = found.T @ found / n - np.outer(found.mean(axis=0), found.mean(axis=0))
    assert set(rows.identity_error) and rows.identity_error.max() < 1e-10
    assert np.abs(own - np.eye(32)).max() < 1e-10


def table(spark, vectors):
    schema = "vec_id long, embedding array<double>, n string, component string, dims string"
    data = [(i, v, "n", "c", "d") for i, v in vectors]
    return spark.createDataFrame(data, schema).repartition(3)


def result(df, components=32):
    models = whitening.fit(df, components)
    return whitening.report(df, models).collect(), models


def test_odd_vectors(spark):
    rng = np.random.default_rng(0)
    good = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    nan, inf = float("nan"), float("inf")
    odd = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [nan, 1.0, 1.0]), (94, [inf, 0.0, 0.0])]
    extra = [(7, good[7][1]), (None, [1.0, 2.0, 3.0]), (95, [1.0, 0.0]), (96, [0.0, 2.0])]
    rows, models = result(table(spark, good + odd + extra))
    assert {d: m.n for d, m in models.items()} == {3: 42, 2: 2}
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, []).append(r)
    assert len(by_id[7]) == 6 and len(by_id[None]) == 3 and len(by_id[0]) == 3
    # Two vectors span one dimension.
    assert [r.component for r in by_id[95]] == [1]
    assert by_id[95][0].whitened == pytest.approx(-by_id[96][0].whitened)
    assert not set(by_id) & {90, 91, 92, 93, 94}


def test_nothing_to_whiten(spark):
    none = table(spark, [(1, [1.0, 2.0])]).limit(0)
    assert result(none) == ([], {})
    for same in ([(1, [1.0, 2.0])], [(i, [3.0, 4.0]) for i in range(5)]):
        rows, models = result(table(spark, same))
        assert rows == [] and models[2].n == len(same)


def test_fewer_components_and_a_constant_dimension(spark):
    rng = np.random.default_rng(1)
    data = [(i, [*rng.normal(size=2).tolist(), 5.0]) for i in range(30)]
    rows, models = result(table(spark, data))
    assert {r.component for r in rows} == {1, 2}
    assert models[3].explained.sum() == pytest.approx(1)
    assert {r.component for r in result(table(spark, data), 1)[0]} == {1}
    plain = whitening.whiten(table(spark, data), models).collect()
    assert {r.vec_id: r.whitened for r in plain} == {
        i: [r.whitened for r in sorted(rows, key=lambda r: r.component) if r.vec_id == i]
        for i in range(30)
    }


def test_large_numbers_are_exact_or_refused(spark):
    """Sums and deviations are whole numbers, whatever a double could hold."""
    data = [(i, [float(i * 2**21 + i % 7), 1.0]) for i in range(5)]
    rows, models = result(table(spark, data))
    x = [int(64 * v[0]) + 1_000_000 for _, v in data]
    expected = {i: (5 * v - sum(x)) ** 2 for (i, _), v in zip(data, x)}
    assert max(expected.values()) > 1 << 53
    assert {r.vec_id: r.deviation for r in rows} == expected
    assert models[2].deviations(np.array([[x[0], 1_000_064]]) * 1) == [expected[0]]
    with pytest.raises(Exception, match="64 bits"):
        result(table(spark, [(0, [1e20]), (1, [0.0])]))
    with pytest.raises(Exception, match="64 bits"):
        result(table(spark, [(0, [1e9]), (1, [0.0])]))


def test_covariance_is_exact(spark):
    """Against fractions: centring before the products loses nothing to the shift."""
    ids, c = vectors_of(spark, "/root/testdata/sf0.001")
    x = [[int(v) for v in row] for row in np.floor(64 * c[:, :6])]
    df = table(spark, [(i, [v / 64 for v in row]) for i, row in enumerate(x)])
    models = whitening.fit(df, 6)
    n = len(x)
    means = [Fraction(sum(row[j] for row in x), n) for j in range(6)]
    exact = [
        [float(sum((r[i] - means[i]) * (r[j] - means[j]) for r in x) / n) for j in range(6)]
        for i in range(6)
    ]
    values = np.sort(np.linalg.eigvalsh(exact))[::-1]
    assert models[6].explained == pytest.approx(values / values.sum(), rel=1e-13)
