"""Spectrum slicing and whitening against plain linear algebra, with their edge cases."""

import math

import numpy as np
import pytest

from civicmart.llm import queries, whitening
from civicmart.llm.spectrum import inertia, leading


def matrices():
    rng = np.random.default_rng(0)
    for t in range(40):
        n = int(rng.integers(1, 30))
        if t % 4 == 0:    # indefinite
            a = rng.standard_normal((n, n))
            yield a + a.T
        elif t % 4 == 1:  # a covariance, tiny
            b = rng.standard_normal((n, n + 5)) * 1e-6
            yield b @ b.T
        elif t % 4 == 2:  # eigenvalues that occur several times
            q = np.linalg.qr(rng.standard_normal((n, n)))[0]
            yield q @ np.diag(rng.integers(0, 4, n).astype(float)) @ q.T
        else:             # of low rank
            b = rng.standard_normal((n, max(1, n // 3)))
            yield b @ b.T


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(1)
    for a in matrices():
        a = (a + a.T) / 2
        values = np.linalg.eigvalsh(a)
        shift = float(rng.standard_normal()) * np.abs(values).max()
        assert inertia(a, shift) == (int((values < shift).sum()), 0, int((values > shift).sum()))


def test_leading_pairs_equal_a_full_decomposition():
    for a in matrices():
        a = (a + a.T) / 2
        want = np.linalg.eigvalsh(a)[::-1]
        values, axes = leading(a, 8)
        size = np.abs(want).max()
        assert len(values) == min(8, len(a))
        assert np.allclose(values, want[:len(values)], atol=1e-11 * size, rtol=0)
        assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-9
        assert np.abs(a @ axes - axes * values).max() < 1e-9 * size


def test_nothing_to_decompose():
    assert len(leading(np.zeros((0, 0)), 3)[0]) == 0
    assert leading(np.zeros((2, 2)), 3)[0].tolist() == [0, 0]


SCHEMA = "vec_id long, embedding array<float>, label int, key string, x long, n int, whitened double"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, None, "k", 1, 2, 0.5) for i, v in vectors], SCHEMA).repartition(3)


def brute(vectors):
    """x, n, S, covariance of the vectors that take part."""
    kept = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(kept), x.sum(axis=0)
    off = (n * x - sums).astype(float) / n
    return [i for i, _ in kept], x, n, sums, off, off.T @ off / n


def random_vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((d, d)) * 0.3
    return [(i, [float(np.float32(c)) for c in rng.standard_normal(d) @ mix]) for i in range(n)]


def check(spark, vectors, components=32):
    rows, fitted, error = whitening.whiten(table(spark, vectors), components=components)
    got = rows.collect()
    ids, x, n, sums, off, cov = brute(vectors)
    assert fitted.n == n and fitted.sums == sums.tolist()
    values = np.linalg.eigvalsh(cov)[::-1][:components]
    assert np.allclose(fitted.values, values[:len(fitted.values)], rtol=1e-9)
    assert np.allclose(fitted.explained, fitted.values / np.trace(cov), rtol=1e-9)
    assert np.allclose(cov @ fitted.axes, fitted.axes * fitted.values, atol=1e-9 * values[0])
    place = {}
    for k, i in enumerate(ids):
        place.setdefault(i, []).append(k)
    assert sorted(str(r.key) for r in got) == sorted(map(str, ids))
    whitened = np.array([r.whitened for r in got])
    for r in got:
        k = place[r.key][0]
        if len(place[r.key]) == 1:
            assert r.deviation == sum(int(v) ** 2 for v in n * x[k] - sums)
            assert np.allclose(r.whitened, off[k] @ fitted.axes / np.sqrt(fitted.values), atol=1e-8)
    own = np.abs(whitened.T @ whitened / n - np.eye(len(fitted.values))).max()
    assert own < 1e-9 and error < 1e-9
    return fitted


def test_whitening_equals_brute_force(corpus):
    assert len(check(corpus, random_vectors(300, 12)).values) == 12
    assert len(check(corpus, random_vectors(200, 40, 1)).values) == 32
    assert len(check(corpus, random_vectors(50, 6, 2), components=3).values) == 3


def test_rows_that_take_no_part_and_repeated_rows(corpus):
    v = random_vectors(40, 5, 3)
    bad = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [math.nan] * 5),
           (104, [math.inf] + [0.0] * 4), (105, [-math.inf] + [0.0] * 4), (105, None)]
    fitted = check(corpus, v + bad + v[:7] + [(None, v[0][1])])
    assert fitted.n == 48
    other = whitening.whiten(table(corpus, [*v, (200, [1.0, 2.0]), (201, [1e30] * 5)]))
    assert other[1].n == 40  # another length, and no whole number of a long


def test_directions_without_variance_are_left_out(corpus):
    v = [(i, [float(c), float(c) * 2, 1.0]) for i, c in enumerate(range(20))]
    assert len(check(corpus, v).values) == 1
    rows, fitted, error = whitening.whiten(table(corpus, [(1, [0.5, 0.25])]))
    assert (fitted.n, len(fitted.values), error) == (1, 0, None)
    assert [(r.key, r.deviation, r.whitened) for r in rows.collect()] == [(1, 0, [])]
    same = whitening.whiten(table(corpus, [(k, [0.5, 0.25]) for k in range(5)]))
    assert len(same[1].values) == 0


def test_no_rows(corpus):
    rows, fitted, error = whitening.whiten(table(corpus, []))
    assert rows.collect() == [] and fitted.n == 0 and error is None


def test_long_sums_stay_exact(corpus):
    x = np.array([[1 << 40, 5], [-(1 << 40), 7], [3, 9]])
    sums = x.sum(axis=0).tolist()
    want = [int(v) if v < 1 << 63 else None for v in ((3 * x.astype(object) - sums) ** 2).sum(axis=1)]
    assert whitening._deviations(x, 3, sums) == want and want[0] is None and want[2] is not None


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_returns_32_components_a_row(corpus, sf):
    got = queries.op12_embedding_whitening(corpus, f"/root/testdata/{sf}")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = got.collect()
    n = rows[0].n
    assert len(rows) == 32 * n and {r.component for r in rows} == set(range(1, 33))
    assert max(r.identity_error for r in rows) < 1e-9
    by = {r.component: r.explained for r in rows}
    assert all(by[k] >= by[k + 1] for k in range(1, 32))
