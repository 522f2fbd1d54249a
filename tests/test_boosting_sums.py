"""Sums by subtraction, sparse blocks, merging in two levels; quantile summaries; scoring in blocks of trees."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foldwise.operators import boosting as bo
from foldwise.operators import classifiers as c
from foldwise.operators import quantiles as qs
from foldwise.schema import Problem

P = Problem(tuple(f"feat_{i}" for i in range(12)), n_classes=3, n_folds=3)


@pytest.fixture(scope="module")
def state(spark):
    rng = np.random.default_rng(3)
    x = rng.poisson(1.0, (3000, 12)).astype(float)
    target = 1 + (x[:, 0] > x[:, 1]).astype(int) + ((x[:, 2] > 1) & (rng.random(3000) < 0.8))
    rows = [(i, i % 3, int(t), *v) for i, (t, v) in enumerate(zip(target, x.tolist()))]
    frame = spark.createDataFrame(rows, "id long, n_fold long, target long, " + ", ".join(f"feat_{i} double" for i in range(12)))
    view = c.vectors(frame.repartition(6, "id"), P.features)
    cuts = bo.cut_points(view, 12, 64)
    return bo.packed(view, P, cuts), cuts


def trees_of(state, options):
    frame, cuts = state
    return bo.grown(frame, P, cuts, set(P.folds), 1, options)


def same(a, b):
    return all((t.feature == b[p].feature).all() and (t.cut == b[p].cut).all() and np.allclose(t.value, b[p].value, atol=1e-12) for p, t in a.items())


OPTIONS = bo.BoostedOptions(rate=0.5, depth=6, min_child=1.0)


def test_one_task_and_shuffled_merges_grow_the_same_trees(state, monkeypatch):
    whole, losses = trees_of(state, OPTIONS)
    assert any((t.feature[31:63] >= 0).any() for t in whole.values())
    monkeypatch.setattr(bo, "MERGED_BYTES", 1 << 20)  # too little to merge in one task
    shuffled, again = trees_of(state, OPTIONS)
    assert same(whole, shuffled) and losses == pytest.approx(again)
    monkeypatch.setattr(bo, "MERGED_TASKS", 2)  # the six tasks are merged in two levels
    assert same(whole, trees_of(state, OPTIONS)[0])
    monkeypatch.setattr(bo, "MERGED_BYTES", 100)  # handed on after every tree
    assert same(whole, trees_of(state, OPTIONS)[0])


def test_less_than_half_is_handed_on(state, monkeypatch):
    """Per level, against all bins of all columns of all nodes, which every task would otherwise send."""
    sizes = []
    plain = bo.level_sums

    def counted(frame, problem, width, columns, bins, growing, summed, level, *rest):
        out = plain(frame, problem, width, columns, bins, growing, summed, level, *rest)
        sent = out.filter("label >= 0").agg(F.sum(F.length("sums"))).first()[0]
        nodes = sum(map(len, summed.values())) * (2 if level else 1)
        sizes.append(sent / (frame.rdd.getNumPartitions() * nodes * width * bins * 16))
        return out

    monkeypatch.setattr(bo, "level_sums", counted)
    trees_of(state, OPTIONS)
    assert len(sizes) == 6 and max(sizes) <= 0.5


def test_sums_of_the_largest_level_fit_a_worker():
    """93 features, 9 classes, 5 folds, depth 8: the lighter children of the last level in a task, all bins filled."""
    held = 5 * 9 * 2**6 * round(0.8 * 93) * 64 * 2 * 8
    assert held < bo.MERGED_BYTES and bo.MERGED_BYTES + held < 1 << 29


@pytest.mark.parametrize("share", [0.0, 0.05, 0.9])
def test_encoding(share):
    rng = np.random.default_rng(8)
    sums = rng.normal(size=(5, 16, 2)) * (rng.random((5, 16, 1)) < share)
    total = np.ones((5, 16, 2))
    part = bo.encoded(sums)
    bo.added(total, part)
    assert np.array_equal(total, 1 + sums) and len(part) <= 5 * 16 * 16 + 1


def test_perfect_trees_score_as_the_walk():
    rng = np.random.default_rng(9)
    feature = np.where(rng.random((150, 31)) < 0.7, rng.integers(0, 6, (150, 31)), -1)
    feature[:, 15:] = -1
    for node in range(1, 31):
        feature[feature[:, (node - 1) // 2] < 0, node] = -1
    threshold, value, labels = rng.normal(size=(150, 31)).round(1), rng.normal(size=(150, 31)), np.arange(150) % 4
    x = rng.normal(size=(200, 6)).round(1)
    x[0, 0] = np.nan
    at = bo.descended((feature, threshold), x, 4)
    got = value[np.arange(150), at]
    margins = np.stack([got[:, labels == k].sum(axis=1) for k in range(4)], axis=1)
    assert bo.score_forest((feature, threshold, value, labels, 4, 4), x) == pytest.approx(bo._softmax(margins))


def test_an_ensemble_of_full_size_is_not_refused(spark, state):
    """1000 rounds of 9 classes at depth 8, the largest the default options can give."""
    trees, nodes = 9000, 511
    feature = np.tile(np.where(np.arange(nodes) < 255, np.arange(nodes) % 3, -1), (trees, 1))
    forest = bo.BoostedScorer(feature, np.zeros((trees, nodes)), np.full((trees, nodes), 1e-3), np.arange(trees) % 9, 9, 8, 3)
    frame = spark.createDataFrame([(1, [0.5, -1.0, 2.0])], "id long, x array<double>")
    from pyspark.ml.functions import array_to_vector

    (row,) = forest.probabilities(frame.select("id", array_to_vector("x").alias("features")), "p").collect()
    assert row["p"] == pytest.approx([1 / 9] * 9)


@pytest.mark.parametrize("kind", ["few", "normal", "sorted", "skewed"])
def test_rank_error_of_summaries(kind):
    rng = np.random.default_rng(4)
    n = 200_000
    values = {"few": rng.integers(0, 300, n).astype(float), "normal": rng.normal(size=n), "sorted": np.arange(n) / 7, "skewed": np.floor(rng.pareto(0.5, n))}[kind]
    growing = qs.Growing(256)
    for part in np.array_split(values, 70):
        growing.add(part)
    other = qs.Growing(256)
    other.add(values[:5000])
    found = qs.merged([growing.whole(), other.whole()], 256)
    every = np.sort(np.concatenate([values, values[:5000]]))
    assert found[1].sum() == pytest.approx(len(every)) and len(found[0]) <= 300
    shares = np.arange(1, 64) / 64
    got = qs.quantile(found, shares)
    # ranks that a value covers: from the first of its copies to the last
    low, high = np.searchsorted(every, got, "left") / len(every), np.searchsorted(every, got, "right") / len(every)
    off = np.maximum(np.maximum(low - shares, shares - high), 0)
    doublings = 7 + 2
    assert off.max() <= doublings / (2 * 256)


def test_exact_on_few_values_and_dealt_by_feature(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 50, (500, 4)).astype(float)
    frame = spark.createDataFrame([(v,) for v in x.tolist()], "x array<double>").repartition(9)
    shares = np.arange(1, 10) / 10
    want = [np.unique([np.sort(x[:, j])[int(np.ceil(s * 500 - 1e-9)) - 1] for s in shares]) for j in range(4)]
    for fan in (64, 3):
        monkeypatch.setattr(qs, "FAN", fan)
        got = qs.column_quantiles(frame, 4, shares)
        assert all(np.array_equal(a, b) for a, b in zip(got, want))
    assert [len(a) for a in qs.column_quantiles(frame.limit(0), 4, shares)] == [0] * 4


def test_a_task_may_begin_with_rows_a_fold_does_not_learn_from(spark, monkeypatch):
    """As in a view stored by fold: the first chunk is all of the fold that evaluates on it."""
    rng = np.random.default_rng(5)
    x, target = rng.random((300, 3)), rng.integers(1, 4, 300).tolist()
    rows = [(i, i // 100, target[i], *v) for i, v in enumerate(x.tolist())]
    frame = spark.createDataFrame(rows, "id long, n_fold long, target long, feat_0 double, feat_1 double, feat_2 double").coalesce(1).sortWithinPartitions("n_fold", "id")
    view = c.vectors(frame, ["feat_0", "feat_1", "feat_2"])
    cuts = bo.cut_points(view, 3, 8)
    options = bo.BoostedOptions(rate=0.5, depth=2, min_child=1.0, bins=8)
    whole, losses = trees_of((bo.packed(view, P, cuts), cuts), options)
    monkeypatch.setattr(bo, "CHUNK", 100)  # one fold in each
    by_fold, again = trees_of((bo.packed(view, P, cuts), cuts), options)
    assert same(whole, by_fold) and losses == pytest.approx(again)


def test_a_level_is_merged_by_several_tasks_and_equal_splits_go_to_the_first_column(state, monkeypatch):
    """Splits of a level were found one by one in a single task unless sums were large."""
    parts, plain = [], bo.split_nodes

    def counted(*args):
        out = plain(*args)
        parts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(bo, "split_nodes", counted)
    monkeypatch.setattr(bo, "NODES_PER_TASK", 8)
    several, _ = trees_of(state, OPTIONS)
    assert parts[0] == 2 and max(parts) == 6
    monkeypatch.setattr(bo, "NODES_PER_TASK", 1 << 20)
    assert same(several, trees_of(state, OPTIONS)[0]) and parts[-1] == 1
    rng = np.random.default_rng(2)
    sums = np.abs(rng.normal(size=(5, 1, 16, 2)))
    twice = np.concatenate([sums, sums * (1 + 1e-13)], axis=1)
    feature, cut, gain = bo.best_splits(twice, OPTIONS)
    for i in range(5):
        one = [v[0] for v in bo.best_splits(sums[i : i + 1], OPTIONS)]
        assert (feature[i], cut[i]) == (one[0], one[1]) and gain[i] == pytest.approx(one[2])


def test_rows_of_one_file_are_boosted_by_all_tasks_that_run(spark, monkeypatch):
    """A view stored by fold has few files; a task took whole ones."""
    rng = np.random.default_rng(6)
    x, target = rng.random((400, 2)), rng.integers(1, 4, 400).tolist()
    frame = spark.createDataFrame([(i, i % 3, target[i], *v) for i, v in enumerate(x.tolist())], "id long, n_fold long, target long, feat_0 double, feat_1 double")
    seen, plain = [], bo.grown

    def noted(state, *args):
        seen.append(state.rdd.getNumPartitions())
        return plain(state, *args)

    monkeypatch.setattr(bo, "grown", noted)
    monkeypatch.setattr(bo, "ROWS_PER_TASK", 100)
    bo.fit_forests(c.vectors(frame.coalesce(1), ["feat_0", "feat_1"]), P, bo.BoostedOptions(rounds=1, depth=2, bins=8))
    assert seen == [4]


def test_rows_are_packed_in_even_parts_across_batches():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array(range(a, b))], names=["n"]) for a, b in ((0, 3), (3, 3), (3, 10), (10, 11))]
    found = [b.column("n").to_pylist() for b in bo._of_size(iter(batches), 4)]
    assert found == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10]]


def test_walks_end_where_the_tree_does():
    rng = np.random.default_rng(9)
    feature = np.where(rng.random(31) < 0.7, rng.integers(0, 6, 31), -1)
    feature[15:] = -1
    for node in range(1, 31):
        feature[node] = -1 if feature[(node - 1) // 2] < 0 else feature[node]
    cut, value = rng.integers(0, 9, 31), rng.normal(size=31)
    x = rng.integers(0, 10, (200, 6)).astype(np.uint8)
    rows = np.arange(0, 200, 3)
    want = value[bo.descended((feature[None], cut[None]), x[rows], 4)[:, 0]]
    got = bo._lowered(bo.Tree(feature, cut, value), 4).take(bo.walked(feature, cut, x, rows, 4))
    assert got == pytest.approx(want, abs=1e-6)
