"""Hard-negative mining against brute force, with its edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicmart.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, id string, uid int, score double, x string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "k", 1, 0.5, "y") for i, v, lab in rows], SCHEMA).repartition(3)


def brute(rows, every=5, positives=5, negatives=3, low=50, high=95):
    kept = []
    for i, v, lab in rows:
        if lab is not None and v and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, [math.floor(256 * float(np.float32(c))) for c in v], lab))
    out = []
    for n, (i, x, lab) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), math.inf if j is None else j, m, o)
                        for m, (j, y, o) in enumerate(kept) if m != n)
        for s, j, _, _ in [r for r in scored if r[3] == lab][:positives]:
            found = [r for r in scored if r[3] != lab and low * -s <= 100 * -r[0] <= high * -s][:negatives]
            out += [(i, None if j == math.inf else j, k + 1, None if r[1] == math.inf else r[1], -s, -r[0])
                    for k, r in enumerate(found)]
    return sorted(out, key=str)


def got(spark, rows, every=5, **more):
    out = H.hard_negatives(table(spark, rows), F.col("id") % every == 0, **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def vectors(n, d, labels, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, d)) * spread
    out = []
    for i in range(n):
        lab = int(rng.integers(labels))
        v = (centres[lab] + rng.standard_normal(d)) * float(rng.choice([0.05, 0.3, 1.0]))
        out.append((i, [float(np.float32(c)) for c in v], lab))
    return out


@pytest.mark.parametrize(("n", "d", "labels", "spread", "rows_per_task"), [
    (300, 8, 4, 0.3, 1000), (300, 3, 3, 0.0, 40), (250, 16, 5, 2.0, 60), (120, 1, 2, 0.0, 50), (60, 2, 1, 1.0, 9)])
def test_equals_brute_force(corpus, n, d, labels, spread, rows_per_task):
    rows = vectors(n, d, labels, n + d, spread)
    want = brute(rows)
    assert want or labels == 1
    assert got(corpus, rows, rows_per_task=rows_per_task) == want


def test_pruning_excludes_most_rows_and_loses_none():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((2000, 4))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1)[:, None] * rng.uniform(0.95, 1, 2000)[:, None])
    b = H.Bucket(0, np.arange(len(x)), np.arange(len(x)), x)
    a = np.floor(100 * rng.standard_normal((40, 4)))
    exact = a @ x.T
    for low, high in ((0.97, 1.0), (0.9, 0.93), (0.0, 0.03)):
        least, most, seen = np.quantile(exact, low, axis=1), np.quantile(exact, high, axis=1), 0
        for q, at, scores in b.candidates(a, least, most):
            at = np.arange(len(x)) if at is None else at
            assert np.array_equal(scores, exact[q, at])
            assert set(np.flatnonzero((exact[q] >= least[q]) & (exact[q] <= most[q]))) <= set(at.tolist())
            seen += len(at)
        assert seen < exact.size * (0.75 if low == 0.9 else 0.4)  # the others were never scored


def test_feasible_ranges_hold_every_vector_in_the_angle():
    rng = np.random.default_rng(2)
    for _ in range(300):
        q, p = rng.standard_normal((2, 3))
        q, p = q / np.linalg.norm(q), p / np.linalg.norm(p)
        cos = float(q @ p)
        lo, hi = H.feasible(q, np.full(3, cos - rng.random() * 0.2), np.full(3, cos + rng.random() * 0.2))
        assert ((lo <= p) & (p <= hi)).all()


def test_rows_without_part_ties_and_repeats(corpus):
    v = vectors(60, 3, 2, 4, 0.5)
    bad = [(1000, None, 1), (1005, [], 1), (1010, [1.0, None, 1.0], 1), (1015, [math.nan, 0.0, 0.0], 1),
           (1020, [math.inf, 0.0, 0.0], 0), (1025, v[0][1], None)]
    ties = [(2000 + k, v[5][1], k % 2) for k in range(20)] + [(5, v[5][1], 1), (5, v[5][1], 1), (None, v[5][1], 0)]
    zero = [(3000 + k, [0.0, 0.0, 0.0], k % 3) for k in range(12)]
    rows = v + bad + ties + zero
    assert got(corpus, rows, rows_per_task=20) == brute(rows)
    other = rows + [(4000, [1.0, 2.0], 0), (4005, [1e9, 0.0, 0.0], 0)]  # another length; too long to score
    assert got(corpus, other) == brute(rows)


def test_a_third_of_all_rows_alike(corpus):
    v = vectors(100, 4, 2, 7, 0.2)
    rows = v + [(500 + k, v[0][1], 1) for k in range(60)]
    assert got(corpus, rows, rows_per_task=16) == brute(rows)


def test_no_rows(corpus):
    assert got(corpus, []) == []
    assert got(corpus, [(5, [1.0, 2.0], 1)]) == []
