"""Bounded rounds of k-means against rounds that compare every point with every centroid."""

import numpy as np
import pytest

from foldwise.operators.distance_bounds import anchored, doubtful, improved_by_bounds, nearest
from foldwise.sources.scratch import stored


def every_point(x, centers, rounds, tol):
    before, done = None, 0
    for _ in range(rounds):
        squares = ((x[:, None, :] - centers[None]) ** 2).sum(-1)
        first, loss = squares.argmin(axis=1), squares.min(axis=1).sum()
        if before is not None and before - loss <= tol * before:
            break
        centers = np.stack([x[first == i].mean(axis=0) if (first == i).any() else c for i, c in enumerate(centers)])
        before, done = loss, done + 1
    return centers, done


def table(spark, x):
    return stored(spark.createDataFrame([(row.tolist(),) for row in x], "x array<double>").repartition(3), "points")


def groups(seed, n=600, k=4, width=5, spread=0.6):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(k, width))[rng.integers(0, k, n)] * 3 + rng.normal(size=(n, width)) * spread


@pytest.mark.parametrize("seed, spread, k", [(1, 0.4, 4), (2, 1.5, 4), (3, 3.0, 7)])
def test_same_centroids_and_rounds(spark, seed, spread, k):
    x = groups(seed, spread=spread)
    start = x[:k] + 0.01
    want, rounds = every_point(x, start, 12, 0.0008)
    got = improved_by_bounds(table(spark, x), start, 12, 0.0008)
    assert np.allclose(got.centers, want, atol=1e-9) and got.rounds == rounds
    assert got.points == 600 * (rounds + (rounds < 12))


def test_most_points_are_not_compared_again(spark):
    x = groups(5, spread=1.0)
    start = x[[0, 1, 2, 3]]
    got = improved_by_bounds(table(spark, x), start, 15, -1.0)
    assert np.allclose(got.centers, every_point(x, start, 15, -1.0)[0], atol=1e-9)
    assert got.rounds == 15 and got.anchors <= 4 and got.skipped > 0.5


def test_every_changed_point_is_doubtful(spark):
    x = groups(7, spread=2.0)
    centers = x[:5].copy()
    anchor = anchored(table(spark, x), centers, 1.0)
    for scale in (0.0, 0.01, 0.3, 2.0):
        moved = centers + np.random.default_rng(1).normal(size=centers.shape) * scale
        kept = {tuple(r["x"]) for r in doubtful(anchor, moved).collect()}
        changed = nearest(x, centers)[0] != nearest(x, moved)[0]
        assert {tuple(p) for p in x[changed]} <= kept
    assert doubtful(anchor, centers).count() == 0 or (nearest(x, centers)[1] <= 0).any()


def test_bound_reaches_the_scan(spark):
    x = groups(8)
    anchor = anchored(table(spark, x), x[:3], 1.0)
    plan = doubtful(anchor, x[:3] + 0.1)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(slack" in plan.split("PushedFilters")[1].split("]")[0]


def test_ties_copies_and_centroids_without_points(spark):
    # the first two centroids are equal: all their points are the first one's; the last has none
    x = np.array([[0.0, 0.0]] * 40 + [[4.0, 0.0]] * 20 + [[2.0, 0.0]] * 7)
    start = np.array([[0.0, 0.0], [0.0, 0.0], [4.0, 0.0], [99.0, 99.0]])
    got = improved_by_bounds(table(spark, x), start, 6, -1.0)
    assert np.allclose(got.centers, every_point(x, start, 6, -1.0)[0])
    assert got.centers[3].tolist() == [99.0, 99.0]


def test_one_centroid_large_values_and_no_points(spark):
    x = groups(9) * 1e6 + 1e8
    got = improved_by_bounds(table(spark, x), x[:1], 3, -1.0)
    assert np.allclose(got.centers[0], x.mean(axis=0), rtol=1e-12) and got.compared == 600
    nothing = spark.createDataFrame([], "x array<double>")
    assert improved_by_bounds(nothing, x[:2], 3, 0.0008).centers.tolist() == x[:2].tolist()
