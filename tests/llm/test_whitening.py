"""Whitening: incremental spectra against the dense eigendecomposition."""

import hypothesis.strategies as st
import numpy as np
import pytest
from hypothesis import given, settings
from pyspark.sql import functions as F

from basketry.llm import queries
from basketry.llm import whitening as W

SF = "/root/testdata/sf0.001"


def scatter(x):
    c = x - x.mean(axis=0)
    return c.T @ c


def check_spectrum(own, x):
    want = scatter(x)
    size = max(abs(want).max(), 1)
    assert own.n == len(x) and (own.sums == x.sum(axis=0) + len(x) * W.OFFSET).all()
    assert np.allclose(own.vectors.T @ own.vectors, np.eye(x.shape[1]), atol=1e-10)
    assert np.abs(own.vectors * own.values @ own.vectors.T - want).max() < 1e-10 * size


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 7), st.integers(1, 30), st.integers(0, 3), st.integers(0, 10 ** 6))
def test_spectra_are_those_of_the_scatter(d, n, kind, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-40, 40, (n, d)).astype(float)
    if kind == 1:
        x[:, d // 2] = 3                                    # a dimension without variance
    if kind == 2:
        x = np.repeat(x[:max(n // 3, 1)], 3, axis=0)        # copies
    if kind == 3:
        x = x[:, :1] * np.arange(1, d + 1)                  # rank one
    own, other, n = W.Spectrum(d), W.Spectrum(d), len(x)
    for row in x[:n // 2]:
        own.add(row)
    for row in x[n // 2:]:
        other.add(row)
    check_spectrum(other, x[n // 2:])
    own.combine(other)
    check_spectrum(own, x)


def test_copies_are_one_weighted_update():
    x = np.random.default_rng(3).integers(-9, 9, (5, 4)).astype(float)
    own = W.Spectrum(4)
    for row, times in zip(x, (1, 4, 2, 1, 3)):
        own.add(row, times)
    check_spectrum(own, np.repeat(x, (1, 4, 2, 1, 3), axis=0))


def test_roots_of_the_secular_equation():
    d, z2 = np.array([-1.0, 0.0, 1e-9, 2.0]), np.array([0.5, 1e-12, 3.0, 1e-3])
    pole, offset = W.secular_roots(d, z2)
    want = np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(z2), np.sqrt(z2)))
    assert np.allclose(d[pole] + offset, want, atol=1e-13)


def dense(vectors):
    """Component count, deviations, whitened rows up to sign, shares: from the definition."""
    x = [[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    c = np.array([[(n * r[j] - sums[j]) / n for j in range(d)] for r in x])
    values, basis = np.linalg.eigh(c.T @ c / n)
    values, basis = values[::-1], basis[:, ::-1]
    return (n, [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x],
            c @ basis / np.sqrt(values), values / values.sum())


def test_op11_matches_dense_eigenvectors(spark):
    table = queries.table(spark, SF, "embeddings")
    rows = {r.vec_id: r.embedding for r in table.collect()}
    got = queries.op11_whitening(spark, SF).collect()
    ids = list(rows)
    n, deviation, whitened, share = dense(list(rows.values()))
    assert len(got) == n * 32 and all(r.n == n for r in got)
    assert all(0 <= r.identity_error <= 1e-9 for r in got)
    at = {v: i for i, v in enumerate(ids)}
    cells = np.zeros((n, 32))
    for r in got:
        cells[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[at[r.vec_id]]
        assert abs(r.explained - share[r.component - 1]) < 1e-10 * share[r.component - 1] + 1e-14
    want = whitened[:, :32]
    sign = np.sign((cells * want).sum(axis=0))
    assert np.abs(cells - want * sign).max() < 1e-7


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25, -1.0]), (2, None), (3, [0.1, None, 0.2]), (4, [nan, 0.0, 0.0]),
            (5, [inf, 0.0, 0.0]), (6, []), (7, [0.5, 0.25]), (None, [1.5, -0.25, 0.75]),
            (8, [0.5, 0.25, -1.0]), (8, [0.5, 0.25, -1.0]), (9, [3.0, 2.0, 1.0])]
    df = (spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
          .withColumns({c: F.lit(c) for c in ("id", "v", "n", "component", "part")}))
    got = W.whiten(df).collect()
    kept = [v for i, v in rows if i in (1, 8, 9, None)]
    n, deviation, whitened, share = dense(kept)
    assert n == 5 and sorted((r.vec_id or 0, r.component) for r in got) == sorted(
        (i, c) for i in (0, 1, 8, 8, 9) for c in (1, 2, 3))
    assert {r.vec_id: r.deviation for r in got} == {1: deviation[0], 8: deviation[0],
                                                   None: deviation[1], 9: deviation[4]}
    # Three different vectors span two components; the third has no variance.
    assert all((r.whitened is None) == (r.component == 3) for r in got)
    assert all(r.identity_error < 1e-9 for r in got)
    alone = W.whiten(df.filter("vec_id = 9")).collect()
    assert [(r.n, r.deviation, r.whitened, r.identity_error) for r in alone] == [(1, 0, None, None)] * 3
    assert W.whiten(df.limit(0)).count() == 0
    assert W.whiten(df.filter("vec_id in (2, 6)")).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_a_long_is_null():
    x = np.array([[2.0 ** 40, -3.0], [0.0, 0.0]])
    sums = x.sum(axis=0).astype(np.int64) + 2 * W.OFFSET
    assert W._deviations(x, 2, sums) == [None, None]
    assert W._deviations(x[1:], 2, np.array([2 * W.OFFSET + 4, 2 * W.OFFSET - 3])) == [25]


@pytest.mark.parametrize("parts", [1, 3, 20])
def test_partitions_do_not_matter(spark, parts):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 4))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)],
                               "vec_id long, embedding array<double>").repartition(parts)
    rows, d = W.usable(df, "vec_id", "embedding")
    spectrum = W.fit_spectrum(rows, d)
    check_spectrum(spectrum, np.floor(64 * x))
