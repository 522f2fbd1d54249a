"""op12 against SQL over all pairs: error bounds, whole groups, vectors at the bound, copies, ids that repeat or lack."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from foldwise.llm.similar import cosines, near_vectors, product, quantised, scaled
from foldwise.llm.similar_query import SQL

SF = "/root/testdata/sf0.001"


def expected(ids, vectors):
    db = duckdb.connect()
    db.register("embeddings", pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float64()))}))
    return sorted(db.execute(SQL).fetchall(), key=repr)


def found(spark, ids, vectors, kind="double", **options):
    frame = spark.createDataFrame([*zip(ids, vectors)], f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 AS tile", "2 AS size", "'x' AS kept", "3 AS point").repartition(3)
    out = near_vectors(frame, **options)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("size", [1, 3, 64, 1500])
def test_error_bounds(size):
    rng = np.random.default_rng(size)
    x = rng.normal(size=(200, size)) * 10.0 ** rng.integers(-9, 9, (200, 1))
    x[100:] = x[:100] * 3 + rng.normal(size=(100, size)) * np.abs(x[:100]).max(axis=1, keepdims=True) / 9
    codes, scale, error = quantised(x)
    assert np.abs(codes.astype(int)).max(axis=1).min() == 127
    dots = product(codes, codes)
    assert (dots == codes.astype(np.int64) @ codes.astype(np.int64).T).all()
    a, b = (i.ravel() for i in np.meshgrid(np.arange(200), np.arange(200)))
    true = cosines(scaled(x[a]), scaled(x[b]))
    bound = error[a] + error[b] + error[a] * error[b]
    assert (np.abs(dots[a, b] * scale[a] * scale[b] - true) <= bound + 1e-12).all()


@pytest.mark.parametrize("tile_rows", [8192, 40])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_near_copies(spark, tile_rows, kind):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 24))
    groups = np.repeat(centres, rng.integers(1, 60, 12), axis=0)
    # noise that puts many pairs close to the bound
    x = groups + rng.normal(size=groups.shape) * rng.uniform(0, 0.35, (len(groups), 1))
    x = np.concatenate([x, x[::7], -x[:5], x[:9] * 1e-6]).astype(np.float32).astype(np.float64)
    ids = rng.permutation(len(x)).tolist()
    want = expected(ids, x.tolist())
    assert len({r[2] for r in want}) > 20 and max(r[1] for r in want) > 20
    assert found(spark, ids, x.tolist(), kind, tile_rows=tile_rows) == want


def test_exactly_at_the_bound_and_a_chain(spark):
    bound = [[1.0, 0, 0, 0, 0], [19.0, 6, 1, 1, 1], [19.0 - 1e-9, 6, 1, 1, 1]]
    chain = [[0, 0, 0, np.cos(t), np.sin(t)] for t in 10 + np.arange(40) * 0.3]
    x = [[0.0, *map(float, v)] for v in bound] + [[1e-3, *map(float, v)] for v in chain]
    ids = list(range(len(x)))
    out = {r[0]: r for r in found(spark, ids, x, tile_rows=9)}
    assert out[0][1] == 1 and out[1][1] == 2 and out[2][1] == 1 and len({r[2] for r in out.values()}) == 2
    assert sorted(out.values(), key=repr) == expected(ids, x)


def test_a_third_are_copies(spark):
    rng = np.random.default_rng(1)
    same = rng.normal(size=8).tolist()
    x = [same if i % 3 == 0 else rng.normal(size=8).tolist() for i in range(900)]
    out = {r[0]: r for r in found(spark, range(900), x, tile_rows=100)}
    assert all(out[i][1] >= 299 and out[i][2] == 0 and out[i][3] == (i == 0) for i in range(0, 900, 3))
    assert sorted(out.values(), key=repr) == expected(range(900), x)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.1]), (1, [2.0, 0.1]), (1, [0.0, 5.0]), (2, None), (3, [0.0, -0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0])]
    rows += [(None, [1.0, 0.01]), (None, [-1.0, 0.3]), (None, [-1.0, 0.2]), (None, None), (7, []), (8, [1.0, 0.0, 0.0]), (9, [1e200, 1e199]), (10, [1e-300, 0.0]), (11, [1e308, 1e308]), (12, [5e-324, 5e-324]), (-3, [3.0, 3.0])]
    ids, vectors = zip(*rows)
    got = found(spark, ids, vectors)
    # SQL's own cosine overflows and underflows: the same vectors, scaled
    tame = {9: [1.0, 0.1], 10: [1.0, 0.0], 11: [1.0, 1.0], 12: [1.0, 1.0]}
    assert got == expected(ids, [tame.get(i, v) for i, v in rows])


def test_given_vectors_and_an_empty_table(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = frame.select("vec_id", "embedding").collect()
    assert found(spark, *zip(*rows), kind="float") == expected([r[0] for r in rows], [r[1] for r in rows])
    assert near_vectors(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        near_vectors(frame, least=0.0)
