import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foldwise.functions.columns import doubles
from foldwise.operators import boosting as bo
from foldwise.operators import classifiers as c
from foldwise.operators import logistic_fit as lf
from foldwise.operators import network_fit as nf
from foldwise.operators.clusters import Clusters, add_distances, clusters_table, distance_features, fit_clusters, predict_clusters, read_clusters
from foldwise.operators.network import Dense, Network, fold_output, network_table, read_networks
from foldwise.operators.predict import oof_predictions, test_predictions as predict_test
from foldwise.operators.scaling import collect_scaler, fit_scaler, fit_scaler_all, standardise
from foldwise.schema import Problem

P = Problem(("feat_1", "feat_2", "feat_3"), n_classes=3, n_folds=3)


@pytest.fixture(scope="module")
def rows(spark):
    """Three separable classes; feat_3 is constant."""
    rng = np.random.default_rng(1)
    data = []
    for i in range(180):
        k = i % 3 if i % 7 else (i // 7) % 3
        x = rng.normal(loc=(3.0 * k, -2.0 * k), scale=1.0)
        data.append((i, (i // 2) % 3, k + 1, float(x[0]), float(x[1]), 0.1))
    ddl = "id long, n_fold long, target long, feat_1 double, feat_2 double, feat_3 double"
    return spark.createDataFrame(data, ddl).persist()


def test_scaler_uses_the_other_folds_and_keeps_constants(spark, rows):
    pdf = rows.toPandas()
    params = collect_scaler(fit_scaler(rows, P))
    assert sorted(params) == [0, 1, 2]
    for k, (mean, std) in params.items():
        other = pdf[pdf.n_fold != k][list(P.features)].to_numpy()
        assert mean == pytest.approx(other.mean(axis=0))
        assert std[:2] == pytest.approx(other.std(axis=0)[:2])
        assert std[2] == 1.0
    scaled = standardise(rows, fit_scaler(rows, P), P.features).toPandas()
    assert scaled.feat_3.abs().max() < 1e-9
    assert list(scaled.columns) == rows.columns


def test_scaler_with_far_mean_keeps_precision(spark):
    data = [(i, i % 5, 1e9 + (i % 7)) for i in range(500)]
    df = spark.createDataFrame(data, "id long, n_fold long, feat_1 double")
    params = collect_scaler(fit_scaler(df, Problem(("feat_1",))))
    for k, (_, std) in params.items():
        assert std[0] == pytest.approx(np.std([v for _, f, v in data if f != k]), rel=1e-6)


def test_network_scores_like_numpy_by_fold(spark, rows):
    rng = np.random.default_rng(0)
    networks = {
        k: Network((Dense(rng.normal(size=(3, 4)), rng.normal(size=4), "relu"), Dense(rng.normal(size=(4, 3)), rng.normal(size=3), "softmax")))
        for k in P.folds
    }
    score = fold_output(spark, networks)
    got = rows.select("id", "n_fold", doubles(P.features).alias("x"), score(doubles(P.features), F.col("n_fold")).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(networks[r.n_fold].forward(np.array([r.x]))[0])
        assert sum(r.p) == pytest.approx(1)
    again = read_networks(network_table(spark, networks))
    x = rng.normal(size=(5, 3))
    assert all(np.array_equal(again[k].forward(x), networks[k].forward(x)) for k in networks)


def test_scaler_moves_into_the_first_layer():
    rng = np.random.default_rng(0)
    network = Network((Dense(rng.normal(size=(3, 4)), rng.normal(size=4), "sigmoid"), Dense(rng.normal(size=(4, 2)), np.zeros(2), "softmax")))
    x, mean, std = rng.normal(size=(9, 3)), rng.normal(size=3), rng.uniform(0.5, 2, size=3)
    assert network.on_raw_inputs(mean, std).forward(x) == pytest.approx(network.forward((x - mean) / std))


def test_networks_are_checked(spark, rows, monkeypatch):
    with pytest.raises(ValueError, match="activation"):
        Dense(np.zeros((2, 2)), np.zeros(2), "selu")
    network = Network((Dense(np.zeros((3, 3)), np.zeros(3), "softmax"),))
    holes = rows.withColumn("feat_1", F.when(F.col("id") > 5, F.col("feat_1")))
    with pytest.raises(Exception, match="must not be NULL"):
        holes.select(fold_output(spark, {k: network for k in P.folds})(doubles(P.features), F.col("n_fold"))).collect()
    monkeypatch.setattr("foldwise.operators.network.MAX_BROADCAST_BYTES", 10)
    with pytest.raises(ValueError, match="too large"):
        fold_output(spark, {0: network})
    with pytest.raises(ValueError, match="too large"):
        read_networks(network_table(spark, {0: network}))


def test_distances(spark, rows):
    scaler = fit_scaler_all(rows, P.features).first()
    mean, std = np.array(scaler["mean"]), np.array(scaler["std"])
    centers = np.array([[0.0, 0.0, 0.0], [1.0, -1.0, 0.0], [-1.0, 1.0, 0.0]])
    clusters = Clusters(P.features, mean, std, centers)
    direct = add_distances(rows, clusters).orderBy("id").toPandas()
    looked_up = distance_features(predict_clusters(rows, clusters), 3).orderBy("id").toPandas()
    assert direct.equals(looked_up)
    z = (direct[list(P.features)].to_numpy() - mean) / std
    expected = np.sqrt(((z[:, None, :] - centers[None]) ** 2).sum(-1))
    assert direct[clusters.distance_columns].to_numpy() == pytest.approx(expected)
    nearest = predict_clusters(rows, clusters).orderBy("id").toPandas()["CENTROID_ID"]
    assert list(nearest) == list(expected.argmin(axis=1) + 1)
    assert np.array_equal(read_clusters(clusters_table(spark, clusters)).centers, centers)


def test_clusters_find_separated_groups(spark):
    data = [(float(10 * (i % 3) + (i % 5) * 0.1), float(-10 * (i % 3))) for i in range(90)]
    df = spark.createDataFrame(data, "feat_1 double, feat_2 double")
    found = fit_clusters(df.limit(60), df.limit(30), ("feat_1", "feat_2"), k=3)
    ids = predict_clusters(df, found).select("feat_2", "CENTROID_ID").distinct().count()
    assert ids == 3


def check_probabilities(long, n_ids):
    pdf = long.toPandas()
    assert len(pdf) == 3 * n_ids
    assert pdf.prob.between(0, 1).all()
    assert pdf.groupby("id").prob.sum().to_numpy() == pytest.approx(np.ones(n_ids))
    return pdf


@pytest.mark.parametrize(
    "model, options",
    [
        ("logistic", c.LogisticOptions(l1=0.001, l2=0.001, max_iter=20)),
        ("xgb", c.BoostedOptions(rounds=4, depth=3, rate=0.5)),
        ("dnn", c.NetworkOptions(hidden=(16, 8), rate=0.02, dropout=0.1, max_iter=40, patience=5)),
        ("nn", c.NetworkOptions(hidden=(16, 16, 16), rate=0.02, dropout=0.1, normalise=True, max_iter=40, patience=5)),
    ],
)
def test_fitted_models_predict_unseen_rows(rows, model, options):
    view = c.vectors(rows, P.features)
    scorers = c.fit_folds(model, view, P, options, parallelism=3)
    pdf = check_probabilities(oof_predictions(view, scorers, 3), 180)
    best = pdf.loc[pdf.groupby("id").prob.idxmax()]
    assert (best.label == best.target).mean() > 0.8
    tests = c.vectors(rows.select("id", *P.features), P.features)
    mean = check_probabilities(predict_test(tests, scorers, 3), 180)
    parts = [s.probabilities(tests, "p").select("id", F.col("p")[0].alias("p")).toPandas().set_index("id").p for s in scorers.values()]
    first = mean[mean.label == 1].set_index("id").prob
    assert first.sort_index().to_numpy() == pytest.approx((sum(parts) / 3).sort_index().to_numpy())


def _data(n=40, width=3, classes=4):
    rng = np.random.default_rng(5)
    return rng.normal(size=(n, width)), rng.integers(0, classes, n)


@pytest.mark.parametrize("normalise", [False, True])
def test_network_gradient(normalise):
    """Against differences of the loss, with the same units dropped."""
    x, labels = _data()
    options = nf.NetworkOptions(hidden=(6, 5, 4), dropout=0.4, normalise=normalise)
    sizes = (3, 6, 5, 4, 4)
    w = nf.Weights.drawn(sizes, 2 if normalise else 0, 1)
    w.flat += np.random.default_rng(4).normal(0, 0.1, len(w.flat))  # no unit exactly at its bend
    dropped = nf.masks(np.random.default_rng(2), len(x), sizes, options)
    g, _ = nf.gradient(w, x, labels, dropped)
    loss = lambda: -np.log(nf.passed(w, x, [None] * 5, dropped)[np.arange(len(x)), labels]).sum()
    for i in np.random.default_rng(3).choice(len(g), 40, replace=False):
        old, both = w.flat[i], []
        for step in (1e-6, -1e-6):
            w.flat[i] = old + step
            both.append(loss())
        w.flat[i] = old
        assert (both[0] - both[1]) / 2e-6 == pytest.approx(g[i], rel=1e-3, abs=1e-4)


def test_last_hidden_layer_of_a_normalised_network_is_whole():
    options = nf.NetworkOptions(hidden=(50, 50), dropout=0.5, normalise=True)
    one, two = nf.masks(np.random.default_rng(0), 20, (3, 50, 50, 2), options)
    assert set(np.unique(one)) == {0.0, 2.0} and set(np.unique(two)) == {1.0}


def test_plain_network_scores_as_the_normalised_one():
    x, _ = _data()
    w = nf.Weights.drawn((3, 6, 5, 4), 1, 4)
    rng = np.random.default_rng(6)
    for layer in w.layers:
        for part in layer:
            part[:] += rng.normal(0, 0.2, part.shape)
    running = [(rng.normal(size=6), rng.uniform(0.5, 2, 6))]
    mean, std = np.array([1.0, -2.0, 0.5]), np.array([2.0, 0.3, 1.0])
    network = nf.plain_network(w, running, mean, std)
    assert network.forward(x) == pytest.approx(nf.passed(w, (x - mean) / std, list(running), None), abs=1e-9)


@pytest.mark.parametrize("normalise", [False, True])
def test_a_pass_is_the_mean_of_what_tasks_learn(rows, monkeypatch, normalise):
    """One mini-batch a task: Adam's step on its mean gradient, averaged by rows; merged by segments or added on the driver."""
    scalers = {k: ([0.1, 0.2, 0.3], [2.0, 1.0, 0.5]) for k in P.folds}
    options = nf.NetworkOptions(hidden=(4, 4), dropout=0.0, normalise=normalise, rate=0.01, batch_rows=10_000, task_rows=1)
    frame = nf.training_rows(c.vectors(rows, P.features).repartition(3, "id"), 1)
    parts = [g for _, g in frame.withColumn("task", F.spark_partition_id()).toPandas().groupby("task")]
    assert len(parts) == 3
    begun = {k: nf.Fit.begun(nf.Weights.drawn((3, 4, 4, 3), int(normalise), k)) for k in P.folds}
    for most in (nf.COLLECTED_BYTES, 0):
        monkeypatch.setattr(nf, "COLLECTED_BYTES", most)
        monkeypatch.setattr(nf, "SEGMENT", 7)
        after, losses = nf.trained(frame, begun, scalers, options, 0)
        for k in P.folds:
            ends, seen, loss, judged = [], [], 0.0, 0
            for part in parts:
                x, labels = (np.stack(part.x) - scalers[0][0]) / scalers[0][1], part.label.to_numpy()
                mine = (part.n_fold != k).to_numpy()
                fit = begun[k].of(begun[k].numbers())
                g, found = nf.gradient(fit.weights, x[mine].astype(np.float32), labels[mine], [np.ones((mine.sum(), 4), np.float32)] * 2)
                g = g / mine.sum()
                ends.append(np.concatenate([fit.weights.flat - 0.01 * g / (np.abs(g) + 1e-7), 0.1 * g, 0.001 * g * g, *[0.9 * o + 0.1 * f for o, f in zip((np.zeros(4), np.ones(4)), found[0] or ())], [1]]))
                seen.append(mine.sum())
                p = nf.passed(begun[k].weights, x[~mine], list(begun[k].running), None)
                loss, judged = loss - np.log(p[np.arange(len(p)), labels[~mine]]).sum(), judged + len(p)
            assert after[k].numbers() == pytest.approx(np.average(ends, axis=0, weights=seen), abs=2e-4)
            assert losses[k] == (pytest.approx(loss, rel=1e-4), judged)


def test_mini_batches_do_not_grow_with_the_rows(rows):
    """Steps of a pass follow from the rows of a task and the size of a batch."""
    frame = nf.training_rows(c.vectors(rows, P.features).repartition(1), 10_000)
    n = {k: frame.filter(F.col("n_fold") != k).count() for k in P.folds}
    scalers = {k: ([0.0] * 3, [1.0] * 3) for k in P.folds}
    for size in (10, 40):
        options = nf.NetworkOptions(hidden=(4,), batch_rows=size)
        after, _ = nf.trained(frame, {k: nf.Fit.begun(nf.Weights.drawn((3, 4, 3), 0, 1)) for k in P.folds}, scalers, options, 0)
        assert {k: f.steps for k, f in after.items()} == {k: round(v / size) for k, v in n.items()}


def test_a_task_with_one_fold_only_has_no_say_in_its_model(rows):
    frame = nf.training_rows(c.vectors(rows, P.features).filter("n_fold = 0").repartition(2), 1)
    scalers = {k: ([0.0] * 3, [1.0] * 3) for k in P.folds}
    begun = {k: nf.Fit.begun(nf.Weights.drawn((3, 4, 3), 0, 1)) for k in P.folds}
    after, losses = nf.trained(frame, begun, scalers, nf.NetworkOptions(hidden=(4,)), 0)
    assert after[0] is begun[0] and after[1].steps > 0 and losses[1] == (0.0, 0) and losses[0][1] > 0


def _boosting_rows(rows):
    view = c.vectors(rows, P.features)
    cuts = bo.cut_points(view, 3, 16)
    pdf = view.select("id", "n_fold", "target", vector_to_array("features").alias("x")).toPandas()
    return view, cuts, pdf, bo.binned(np.stack(pdf.x), cuts)


@pytest.mark.parametrize("parts", [1, 4])
def test_trees_of_a_round_against_plain_loops(rows, parts):
    view, cuts, pdf, x = _boosting_rows(rows)
    options = bo.BoostedOptions(rate=0.3, depth=3, row_sample=1.0, column_sample=1.0, bins=16, min_child=1.0)
    state = bo.packed(view.repartition(parts, "id"), P, cuts)
    trees, losses = bo.grown(state, P, cuts, set(P.folds), 0, options)
    target = pdf.target.to_numpy() - 1
    for (k, label), tree in trees.items():
        train = (pdf.n_fold != k).to_numpy()
        g, h = 1 / 3 - (target == label), np.full(len(x), 2 / 9)
        assert losses[k] == pytest.approx(np.log(3))

        def grow(node, inside, depth):
            gs, hs = g[inside].sum(), h[inside].sum()
            assert tree.value[node] == pytest.approx(bo.leaf_value(gs, hs, options))
            found = (0.0, -1, 0)
            for f in range(3):
                for cut in range(16):
                    left = inside & (x[:, f] <= cut)
                    a, b = h[left].sum(), hs - h[left].sum()
                    if a >= 1 and b >= 1:
                        score = lambda q, w: max(abs(q) - 0.1, 0) ** 2 / (w + 0.1)
                        gain = score(g[left].sum(), a) + score(gs - g[left].sum(), b) - score(gs, hs)
                        if gain > found[0] + 1e-9:
                            found = (gain, f, cut)
            if depth == 0 or found[1] < 0:
                assert tree.feature[node] == -1
                return
            assert (tree.feature[node], tree.cut[node]) == found[1:]
            left = x[:, found[1]] <= found[2]
            grow(2 * node + 1, inside & left, depth - 1)
            grow(2 * node + 2, inside & ~left, depth - 1)

        grow(0, train, 3)


def test_sums_handed_on_early_are_merged(rows, monkeypatch):
    view, cuts, _, _ = _boosting_rows(rows)
    options = bo.BoostedOptions(depth=2, bins=16, min_child=0.5)
    whole, _ = bo.grown(bo.packed(view, P, cuts), P, cuts, {0, 1}, 3, options)
    monkeypatch.setattr(bo, "MERGED_BYTES", 100)
    monkeypatch.setattr(bo, "CHUNK", 16)
    parts, _ = bo.grown(bo.packed(view, P, cuts), P, cuts, {0, 1}, 3, options)
    for pair, t in whole.items():
        assert (t.feature == parts[pair].feature).all() and t.value == pytest.approx(parts[pair].value)


def test_boosting_stops_by_its_rule_and_survives_a_round_trip(spark, rows, monkeypatch):
    monkeypatch.setattr(bo, "WRITTEN_EVERY", 3)
    view = c.vectors(rows, P.features)
    fitted = bo.fit_forests(view, P, bo.BoostedOptions(rate=0.5, depth=3, min_progress=0.05, min_child=0.5))
    assert all(2 < f.n_rounds < 60 for f in fitted.values())
    again = bo.read_forest(bo.forest_table(spark, fitted[1]))
    one, two = (f.probabilities(view, "p").orderBy("id").select("p").collect() for f in (fitted[1], again))
    assert one == two
    none = bo.fit_forests(view, P, bo.BoostedOptions(rounds=0))[0]
    assert none.probabilities(view, "p").first()["p"] == pytest.approx([1 / 3] * 3)
    assert bo.read_forest(bo.forest_table(spark, none)).n_rounds == 0


def test_margins_are_those_of_the_forest(rows):
    view, cuts, pdf, x = _boosting_rows(rows)
    options = bo.BoostedOptions(depth=3, bins=16, min_child=0.5)
    state = bo.packed(view.repartition(1), P, cuts)
    trees, _ = bo.grown(state, P, cuts, {0}, 0, options)
    row = bo.advanced(state, P, 3, trees, 3).first().asDict()
    _, _, keys, seen, margins = bo._unpacked(row, P, 3)
    forest = bo._scorer([(c_, t) for (_, c_), t in sorted(trees.items())], [np.append(c_, np.full(256 - len(c_), np.inf)) for c_ in cuts], 3, 3, 3)
    values = view.repartition(1).select(vector_to_array("features").alias("x")).toPandas().x
    assert np.exp(margins[:, 0]) / np.exp(margins[:, 0]).sum(axis=1, keepdims=True) == pytest.approx(
        bo.score_forest((forest.feature, forest.threshold, forest.value, forest.labels, 3, 3), np.stack(values)), abs=1e-6
    )


def test_rows_drawn_for_a_round():
    keys = np.arange(20_000) * 7919
    one, two = bo.drawn(keys, 7, 0, 0.8), bo.drawn(keys, 7, 1, 0.8)
    assert abs(one.mean() - 0.8) < 0.02 and abs((one & two).mean() - 0.64) < 0.02 and bo.drawn(keys, 7, 0, 1.0).all()


def test_a_fold_stops_when_its_loss_does(rows):
    view = c.vectors(rows, P.features)
    scalers = {k: ([0.0] * 3, [1.0] * 3) for k in P.folds}
    still = nf.NetworkOptions(hidden=(4,), rate=0.0, patience=2, max_iter=9)
    assert set(nf.fit_networks(view, P, scalers, still)[1].values()) == {2}
    moving = nf.NetworkOptions(hidden=(4,), rate=0.01, dropout=0.0, min_progress=-1.0, max_iter=3)
    assert set(nf.fit_networks(view, P, scalers, moving)[1].values()) == {3}


def test_logistic_solution_is_stationary(rows):
    """Without the absolute-value penalty the gradient of the penalised mean loss vanishes at the fit."""
    options = c.LogisticOptions(l1=0.0, l2=0.05, max_iter=200, tol=1e-12)
    view = c.vectors(rows, ("feat_1", "feat_2"))
    model = c.fit_logistic(view, P, options).model
    pdf = rows.toPandas()
    x = pdf[["feat_1", "feat_2"]].to_numpy()
    spread = x.std(axis=0, ddof=1)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    z = x @ w.T + b
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    residual = p - np.eye(3)[pdf.target.to_numpy() - 1]
    gradient = residual.T @ (x / spread) / len(x) + options.l2 * w * spread
    assert np.abs(gradient).max() < 1e-4
    assert np.abs(residual.mean(axis=0)).max() < 1e-4


def test_logistic_models_of_all_folds_are_those_of_spark(rows, monkeypatch):
    """Same penalised loss as an estimator fitted to the rows of the other folds, in one pass a point; merged by fold or on the driver."""
    options = c.LogisticOptions(l1=0.02, l2=0.03, max_iter=300, tol=1e-13)
    view = c.vectors(rows, P.features).repartition(3, "id")
    found = c.fit_folds("logistic", view, P, options)
    assert all(0 < s.steps < 300 for s in found.values())
    for k, scorer in found.items():
        theirs = c.fit_logistic(view.filter(view.n_fold != k), P, options)
        one, two = (np.stack(s.probabilities(view, "p").orderBy("id").toPandas().p) for s in (scorer, theirs))
        assert np.abs(one - two).max() < 0.01  # theirs are scaled by the sample's deviation
    monkeypatch.setattr(lf, "COLLECTED_BYTES", 0)
    again = c.fit_folds("logistic", view, P, options)
    for k in found:
        assert again[k].network.layers[0].weights == pytest.approx(found[k].network.layers[0].weights, abs=1e-5)


def test_orthant_steps_find_the_minimum():
    """Least squares with absolute penalties, against plain coordinate descent."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(60, 12)), rng.normal(size=60)
    l1 = np.where(np.arange(12) < 10, 4.0, 0.0)
    run = lf.minimised(np.zeros(12), l1, lf.LogisticOptions(max_iter=500, tol=1e-15))
    point = next(run)
    try:
        while True:
            r = a @ point - b
            point = run.send((0.5 * r @ r, a.T @ r))
    except StopIteration as end:
        x, _ = end.value
    want = np.zeros(12)
    for _ in range(3000):
        for j in range(12):
            rho = a[:, j] @ (b - a @ want + a[:, j] * want[j])
            want[j] = np.sign(rho) * max(abs(rho) - l1[j], 0) / (a[:, j] @ a[:, j])
    assert x == pytest.approx(want, abs=1e-5) and (want == 0).any() and ((x == 0) == (want == 0)).all()


def test_a_class_missing_from_the_training_rows(rows):
    view = c.vectors(rows, P.features)
    only_two = view.filter("target <> 3")
    logistic = c.fit_logistic(only_two, P, c.LogisticOptions(max_iter=5))
    boosted = c.fit_folds("xgb", only_two, P, c.BoostedOptions(rounds=1, depth=1, early_stop=False))[0]
    for scorer in (logistic, boosted):
        pdf = scorer.probabilities(view, "p").select("p").toPandas()
        p = np.stack(pdf.p)
        assert p.shape == (180, 3) and p.sum(axis=1) == pytest.approx(np.ones(180))


def test_a_missing_feature_raises(rows):
    holes = rows.withColumn("feat_2", F.when(F.col("id") != 4, F.col("feat_2")))
    with pytest.raises(Exception, match="feature feat_2 is NULL"):
        c.vectors(holes, P.features).collect()


def test_models_too_large_to_send_are_refused(spark, rows, monkeypatch):
    from foldwise.operators import network as module

    view = c.vectors(rows, P.features)
    boosted = c.fit_folds("xgb", view, P, c.BoostedOptions(rounds=1, depth=1, early_stop=False))[0]
    monkeypatch.setattr(bo, "MAX_BROADCAST_BYTES", 10)
    with pytest.raises(ValueError, match="too large"):
        boosted.probabilities(view, "p")
    monkeypatch.setattr(module, "MAX_BROADCAST_BYTES", 10)
    with pytest.raises(ValueError, match="too large"):
        c.NetworkScorer(Network((Dense(np.eye(3), np.zeros(3), "softmax"),))).probabilities(view, "p")


def test_errors_of_one_fold_are_raised(rows):
    with pytest.raises(ValueError, match="not one of"):
        c.fit_folds("forest", c.vectors(rows, P.features), P, None, 2)

    def fail(k):
        raise RuntimeError(f"fold {k}")

    with pytest.raises(RuntimeError, match="fold 0"):
        c.concurrently(rows.sparkSession, fail, range(3), 3)
