"""What each pass over the rows of a fit reads, sums and sends."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise import fixtures as fx
from foldwise.operators import logistic_fit as lf
from foldwise.operators import network_fit as nf
from foldwise.operators.classifiers import DNN, vectors
from foldwise.sources.scratch import spread, stored


def test_letters_are_those_of_the_lower_cased_text(spark):
    texts = ["", "abcxyz Zebra", None, "ÄÖß 東京 Kelvin İ", "a" * 70_000, "`{@[09\n"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    plain = [(F.octet_length("t") - F.octet_length(F.replace(F.col("t"), F.lit(c)))).cast("double").alias(c) for c in letters]
    want = [list(r) for r in frame.withColumn("t", F.lower("text")).orderBy("id").select(*plain).collect()]
    found = frame.select("id", fx.letter_counts(F.lower("text")).alias("n")).select("id", *[F.col("n")[i].alias(c) for i, c in enumerate(letters)])
    assert [list(r)[1:] for r in found.orderBy("id").collect()] == want
    assert want[2] == [None] * 26 and want[3][10] == 1


def test_rows_of_one_file_are_dealt_to_all_that_run(spark):
    one = spark.range(100).coalesce(1)
    dealt = spread(one, 10, "t")
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r["id"] for r in dealt.collect()) == list(range(100))
    assert spread(one, 1000, "t").rdd.getNumPartitions() == 1


def test_folds_that_share_products_have_their_own_losses_and_gradients(spark):
    """Against plain sums over standardised rows, with means far from zero and from each other."""
    rng = np.random.default_rng(4)
    own, labels = rng.integers(0, 3, 200), rng.integers(1, 4, 200)
    x = rng.normal(size=(200, 2)) * [1.0, 50.0] + np.array([1e6, -3.0]) + own[:, None]
    rows = [(i, int(k), int(t), *v) for i, (k, t, v) in enumerate(zip(own, labels, x.tolist()))]
    view = vectors(spark.createDataFrame(rows, "id long, n_fold long, target long, a double, b double").repartition(3), ["a", "b"])
    scalers = {k: (x[own != k].mean(axis=0), x[own != k].std(axis=0)) for k in range(3)}
    points = {k: rng.normal(size=9) for k in (0, 2)}
    found = lf._losses(lf.logistic_rows(view), points, scalers, 2, 3)
    assert sorted(found) == [0, 2]
    for k, point in points.items():
        w, z, y = point.reshape(3, 3), (x[own != k] - scalers[k][0]) / scalers[k][1], labels[own != k] - 1
        p = np.exp(z @ w[:-1] + w[-1])
        p /= p.sum(axis=1, keepdims=True)
        assert found[k][0] == pytest.approx(-np.log(p[np.arange(len(y)), y]).mean(), rel=1e-9)
        p[np.arange(len(y)), y] -= 1
        assert found[k][1] == pytest.approx(np.concatenate([(z.T @ p).ravel(), p.sum(axis=0)]) / len(y), abs=1e-8)


def test_a_network_is_the_mean_of_few_tasks_that_have_seen_many_rows(spark):
    """Three models of 80 rows each on three tasks: a task takes all steps of one of them."""
    rows = [(i, i % 3, 1 + i % 2, float(i % 5)) for i in range(120)]
    view = vectors(spark.createDataFrame(rows, "id long, n_fold long, target long, a double").repartition(3), ["a"])
    frame, options = stored(nf.training_rows(view, 1), "t"), nf.NetworkOptions(hidden=(4,), batch_rows=10)
    assert frame.rdd.getNumPartitions() == 3
    scalers = {k: ([2.0], [1.4]) for k in range(3)}
    begun = {k: nf.Fit.begun(nf.Weights.drawn((1, 4, 2), 0, k)) for k in range(3)}
    after, losses = nf.trained(frame, begun, scalers, options, 0, tasks=3)
    assert {k: f.steps for k, f in after.items()} == {0: 8, 1: 8, 2: 8}
    assert all(n == 40 for _, n in losses.values())
    dealt = nf.shares(frame, [0, 1, 2], 3).withColumn("task", F.spark_partition_id())
    assert [r["n"] for r in dealt.groupBy("task").agg(F.count_distinct("model").alias("n")).collect()] == [1, 1, 1]
    assert dealt.count() == 360
    # without a number of tasks, each part of the rows is one for every model
    spread_out, same = nf.trained(frame, begun, scalers, options, 0)
    assert all(f.steps < 4 for f in spread_out.values()) and same == {k: (pytest.approx(v), n) for k, (v, n) in losses.items()}


def test_what_tasks_may_send_unmerged_stays_far_below_the_drivers_limit():
    """Four networks of as many passes as they may take."""
    assert 4 * DNN.max_iter * nf.COLLECTED_BYTES < 500e6
