"""op4 against brute force: exact at factor one, high recall at the query's factor, ties, and vectors that take no part."""

import numpy as np
import pytest

from foldwise.llm.neighbours import nearest
from foldwise.llm.neighbours_query import FACTOR

SF = "/root/testdata/sf0.001"


def expected(ids, vectors, every, k):
    out = {}
    for q, v in zip(ids, vectors):
        if q % every == 0:
            # added in order, as plain SQL does
            with np.errstate(all="ignore"):
                scores = np.cumsum(vectors * v, axis=1)[:, -1]
            scored = sorted((-s, i) for i, s in zip(ids, scores.tolist()) if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def recall(got, want):
    assert got.keys() == want.keys() and all(len(got[q]) == len(want[q]) for q in want)
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("factor", [1.0, FACTOR])
def test_given_vectors(spark, factor):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = frame.select("vec_id", "embedding").collect()
    want = expected([r[0] for r in rows], np.array([r[1] for r in rows], np.float64), 20, 20)
    got = found(nearest(frame, factor=factor, shard_rows=200))
    assert got.keys() == want.keys()
    share = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert share == 1.0 if factor == 1.0 else share >= 0.95
    if factor == 1.0:
        assert all([i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12) for q in want)


def test_a_frequent_vector_and_ties(spark):
    rng = np.random.default_rng(3)
    same = rng.normal(size=8).astype(np.float32)
    rows = [(i, (same if i % 3 else rng.normal(size=8).astype(np.float32) / 9).tolist()) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = expected([i for i, _ in rows], np.array([v for _, v in rows], np.float32).astype(np.float64), 20, 20)
    got = found(nearest(frame, factor=1.0, shard_rows=100))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [-1.0, 0.0]), (8, [1.0, 2.0, 3.0]), (20, [5.0]), (40, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rank", "2 AS score", "3 AS shard")
    assert found(nearest(frame)) == {0: [(1, 2.0), (7, -1.0)]}


def test_empty(spark):
    assert nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def searched(spark, vectors, **options):
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(3)
    return found(nearest(frame, **options)), expected(range(len(vectors)), vectors, 20, 20)


@pytest.mark.parametrize("spread", [0, 1, 3, 6, 12])
@pytest.mark.parametrize("kind", ["normal", "groups"])
def test_norms_of_all_sizes(spark, spread, kind):
    """Norms over so many powers of ten, queries included: exact at factor one, high recall at the query's."""
    rng = np.random.default_rng(spread)
    x = rng.normal(size=(1500, 24)) if kind == "normal" else rng.normal(size=(30, 24)).repeat(50, axis=0) + rng.normal(size=(1500, 24)) / 5
    x = x * 10.0 ** rng.uniform(0, spread, (1500, 1))
    got, want = searched(spark, x, factor=1.0, shard_rows=900)
    assert got == want
    got, want = searched(spark, x, factor=FACTOR, shard_rows=900)
    assert recall(got, want) >= 0.9


@pytest.mark.parametrize("large", [10.0, 100.0, 1e7, 1e200])
def test_a_few_large_vectors(spark, large):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(903, 16))
    x[-3:] *= large
    got, want = searched(spark, x, factor=1.0)
    assert got == want
    got, want = searched(spark, x, factor=FACTOR)
    assert recall(got, want) >= 0.9


@pytest.mark.parametrize("low, high", [(-1, 2), (0, 2), (-3, 4)])
def test_ties_of_different_vectors(spark, low, high):
    x = np.random.default_rng(2).integers(low, high, (900, 12)).astype(float)
    x[:, 0] += (x == 0).all(axis=1)
    got, want = searched(spark, x, factor=1.0, shard_rows=500)
    assert got == want


def test_products_that_overflow(spark):
    big = 1e308
    x = np.array([[big, big], [big, -big], [-big, big], [1.0, 1.0], [big, 0.0], [5e-324, 0.0]])
    got, _ = searched(spark, x, factor=1.0)
    assert [i for i, _ in got[0]] == [3, 4, 5, 1, 2] and got[0][0][1] == got[0][1][1] == np.inf
