"""Scoring with given parameters: linear softmax, dense networks, distances to given centroids."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from foldwise import fixtures as fx
from foldwise.functions.columns import array_mean, doubles
from foldwise.functions.features import labelled, log_view
from foldwise.operators.clusters import Clusters, add_distances, distance_features, predict_clusters
from foldwise.operators.metrics import log_loss
from foldwise.operators.network import fold_output, network_table, prob_structs, read_networks
from foldwise.operators.predict import (
    mean_over_folds,
    network_oof,
    network_test,
    predict,
    union_all,
    unnest,
    unnest_positions,
)
from foldwise.operators.classifiers import NetworkScorer, vectors
from foldwise.operators.scaling import collect_scaler, fit_scaler, fit_scaler_all, standardised_array
from foldwise.queries.base import _LOGS, _RAWS, BASE, LONG, oof_sql, query, r6, rounded, softmax, test_sql
from foldwise.queries.features import lab
from foldwise.sources.scratch import stored

P = fx.LETTERS


def log_train(spark, sf):
    return log_view(lab(spark, sf), P.features)


def log_test(spark, sf):
    return log_view(fx.letters_test(spark, sf), P.features)


def linear_oof(spark, sf, model: int = 0):
    """Stored long out-of-fold table of a rule-weighted model."""
    build = lambda: stored(network_oof(log_train(spark, sf), fx.linear_networks(P, model), P.features), f"oof-{model}")
    return fx.once(spark, sf, f"oof-{model}", build)


def linear_test(spark, sf, model: int = 0):
    build = lambda: stored(network_test(log_test(spark, sf), fx.linear_networks(P, model), P.features), f"test-{model}")
    return fx.once(spark, sf, f"test-{model}", build)


def flagship(spark, sf):
    """Log features, linear softmax of the row's own fold, long out-of-fold table, log loss per fold."""
    return rounded(log_loss(network_oof(log_train(spark, sf), fx.linear_networks(P), P.features), "n_fold"))


_LOSS = "SELECT n_fold, round(avg(-ln(greatest(prob, 1e-15))), 6) + 0.0 AS log_loss FROM oof WHERE label = target GROUP BY n_fold"

query("oof_log_loss", f"{BASE}, oof AS {oof_sql()} {_LOSS}")(flagship)


@query("linear_oof", f"{BASE} SELECT id, n_fold, target, label, {r6('prob')} FROM {oof_sql()}")
def linear_oof_query(spark, sf):
    return rounded(network_oof(log_train(spark, sf), fx.linear_networks(P), P.features))


@query("linear_test_mean", f"{BASE} SELECT id, label, {r6('prob')} FROM {test_sql()}")
def linear_test_query(spark, sf):
    return rounded(network_test(log_test(spark, sf), fx.linear_networks(P), P.features))


@query("linear_test_union_mean", f"{BASE} SELECT id, label, {r6('prob')} FROM {test_sql()}")
def linear_test_union_mean(spark, sf):
    """The same table by the other road: five long tables, stacked and averaged per (id, label)."""
    view = vectors(log_test(spark, sf), P.features)
    parts = [
        unnest(predict(view, NetworkScorer(network), P.n_classes), "id") for network in fx.linear_networks(P).values()
    ]
    return rounded(mean_over_folds(union_all(parts)))


@query("linear_test_wide_mean", f"{BASE} SELECT id, label, {r6('prob')} FROM {test_sql()}")
def linear_test_wide_mean(spark, sf):
    """Row-wise mean over one array per fold, then one row per position."""
    networks = fx.linear_networks(P)
    score = fold_output(spark, networks)
    x = log_test(spark, sf).select("id", doubles(P.features).alias("x"))
    scored = x.select("id", *[score(F.col("x"), F.lit(k).cast("bigint")).alias(f"p{k}") for k in P.folds])
    mean = scored.select("id", array_mean([F.col(f"p{k}") for k in P.folds], P.n_classes).alias("output"))
    return rounded(unnest_positions(mean, "id"))


@query(
    "predict_passes_input_through",
    f"""{BASE} SELECT id, target, feat_1, label, {r6('prob')} FROM {softmax('lab', _RAWS, 26, 4, 0, '3', 'id, target, feat_1')}""",
)
def predict_passes_input_through(spark, sf):
    """Every row through the model of fold 3; other input columns come back beside the probabilities."""
    rows = lab(spark, sf)
    keyed = rows.select("id", "target", "feat_1", doubles(P.features).alias("features"))

    class Raw:
        def probabilities(self, df, out):
            score = fold_output(spark, fx.linear_networks(P))
            return df.withColumn(out, score(F.col("features"), F.lit(3).cast("bigint")))

    return rounded(unnest(predict(keyed, Raw(), P.n_classes), "id", "target", "feat_1"))


def _hidden_sql(source: str, x: str, n_in: int, n_classes: int, fold: str, keys: str, by: str) -> str:
    weight = f"((13 * h + 29 * j + 5 * {fold}) % 11 - 5) / 50::DOUBLE"
    unit = f"greatest(list_inner_product({x}, list_transform(range(1, {n_in + 1}), lambda j: {weight})) + ((7 * h) % 5 - 2) / 10::DOUBLE, 0)"
    hidden = f"(SELECT *, list_transform(range(1, 9), lambda h: {unit}) AS hidden FROM {source})"
    return softmax(hidden, "hidden", 8, n_classes, 0, fold, keys, by)


_STD_TRAIN = f"""{LONG}, x AS (
  SELECT id, n_fold, target, list((x - mean) / std ORDER BY j) AS xs FROM long JOIN scaler USING (n_fold, j) GROUP BY id, n_fold, target)"""
_STD_TEST = f"""{LONG}, tlong AS (SELECT id, unnest(range(1, 27)) AS j, unnest({_RAWS}) AS x FROM test
), x AS (SELECT id, n_fold AS fold, list((x - mean) / std ORDER BY j) AS xs FROM tlong JOIN scaler USING (j) GROUP BY id, n_fold)"""


def standardising_networks(spark, sf):
    """Given networks on standardised inputs, with each fold's scaler moved into the first layer.

    They take the road of an imported model: written as a table of weights, read back, checked.
    """
    def build():
        scalers = collect_scaler(fit_scaler(lab(spark, sf), P))
        raw = {k: n.on_raw_inputs(*scalers[k]) for k, n in fx.hidden_networks(P).items()}
        return read_networks(stored(network_table(spark, raw), "networks"))

    return fx.once(spark, sf, "networks", build)


@query("network_oof", f"{_STD_TRAIN} SELECT id, n_fold, target, label, {r6('prob')} FROM {_hidden_sql('x', 'xs', 26, 4, 'n_fold', 'id, n_fold, target', 'id')}")
def network_oof_query(spark, sf):
    return rounded(network_oof(lab(spark, sf), standardising_networks(spark, sf), P.features))


@query(
    "network_test_mean",
    f"""{_STD_TEST} SELECT id, label, round(avg(prob), 6) + 0.0 AS prob
    FROM {_hidden_sql('x', 'xs', 26, 4, 'fold', 'id, fold', 'id, fold')} GROUP BY id, label""",
)
def network_test_query(spark, sf):
    return rounded(network_test(fx.letters_test(spark, sf), standardising_networks(spark, sf), P.features))


@query(
    "network_oof_vectors",
    "WITH x AS (SELECT vec_id AS id, vec_id % 5 AS n_fold, label::BIGINT + 1 AS target, embedding::DOUBLE[] AS xs FROM embeddings) "
    f"SELECT id, n_fold, target, label, {r6('prob')} FROM {_hidden_sql('(SELECT id, n_fold, target, xs FROM x)', 'xs', 64, 10, 'n_fold', 'id, n_fold, target', 'id')}",
)
def network_oof_vectors(spark, sf):
    rows = labelled(fx.vectors_train(spark, sf), fx.VECTORS)
    return rounded(network_oof(rows, fx.hidden_networks(fx.VECTORS), fx.VECTORS.features))


# centroids: mean of the standardised features of each class

def class_centroids(spark, sf, log: bool) -> Clusters:
    """Statistics over train and test, centroids from the labelled rows; four rows reach the driver."""
    def build():
        train = log_train(spark, sf) if log else lab(spark, sf)
        test = log_test(spark, sf) if log else fx.letters_test(spark, sf)
        both = train.select(*P.features).unionByName(test.select(*P.features))
        scaler = fit_scaler_all(both, P.features).first()
        z = train.select("target", standardised_array(P.features, scaler["mean"], scaler["std"]).alias("z"))
        means = z.groupBy("target").agg(*[F.avg(F.col("z")[i]).alias(f"m{i}") for i in range(26)]).orderBy("target").collect()
        centers = np.array([[r[f"m{i}"] for i in range(26)] for r in means])
        return Clusters(P.features, np.array(scaler["mean"]), np.array(scaler["std"]), centers)

    return fx.once(spark, sf, f"centroids-{log}", build)


def _centroid_sql(log: bool) -> str:
    x = _LOGS if log else _RAWS
    return f"""{BASE}, both_rows AS (
      SELECT id, target, unnest(range(1, 27)) AS j, unnest({x}) AS x FROM lab
      UNION ALL SELECT id, NULL, unnest(range(1, 27)), unnest({x}) FROM test
    ), st AS (SELECT j, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1 ELSE stddev_pop(x) END AS std FROM both_rows GROUP BY j
    ), z AS (SELECT id, target, j, (x - mean) / std AS z FROM both_rows JOIN st USING (j)
    ), c AS (SELECT target AS centroid, j, avg(z) AS c FROM z WHERE target IS NOT NULL GROUP BY target, j
    ), dist AS (SELECT id, any_value(target) AS target, centroid, sqrt(sum((z - c) * (z - c))) AS d FROM z JOIN c USING (j) GROUP BY id, centroid)"""


_WIDE_D = ", ".join(f"round(max(d) FILTER (centroid = {k}), 6) + 0.0 AS distance_{k}" for k in range(1, 5))

for _log in (False, True):
    _suffix = "_log" if _log else ""

    def _train_distances(spark, sf, log=_log):
        rows = log_train(spark, sf) if log else lab(spark, sf)
        clusters = class_centroids(spark, sf, log)
        found = distance_features(predict_clusters(rows, clusters), clusters.k)
        return rounded(found.select("id", "target", *clusters.distance_columns))

    def _test_distances(spark, sf, log=_log):
        rows = log_test(spark, sf) if log else fx.letters_test(spark, sf)
        clusters = class_centroids(spark, sf, log)
        return rounded(add_distances(rows, clusters).select("id", *clusters.distance_columns))

    query(f"distances_train{_suffix}", f"{_centroid_sql(_log)} SELECT id, target, {_WIDE_D} FROM dist WHERE target IS NOT NULL GROUP BY id, target")(_train_distances)
    query(f"distances_test{_suffix}", f"{_centroid_sql(_log)} SELECT id, {_WIDE_D} FROM dist WHERE target IS NULL GROUP BY id")(_test_distances)


@query(
    "nearest_centroid",
    f"""{_centroid_sql(False)} SELECT id, arg_min(centroid, d) AS centroid_id, round(min(d), 6) + 0.0 AS nearest, round(max(d), 6) + 0.0 AS farthest
    FROM dist GROUP BY id""",
)
def nearest_centroid(spark, sf):
    clusters = class_centroids(spark, sf, False)
    both = lab(spark, sf).select("id", *P.features).unionByName(fx.letters_test(spark, sf))
    pairs = F.col("NEAREST_CENTROIDS_DISTANCE")
    found = predict_clusters(both, clusters).select(
        "id",
        F.col("CENTROID_ID").alias("centroid_id"),
        pairs[0]["DISTANCE"].alias("nearest"),
        pairs[clusters.k - 1]["DISTANCE"].alias("farthest"),
    )
    return rounded(found)


@query(
    "unnest_pairs",
    f"{BASE} SELECT id, label, {r6('prob')} FROM {oof_sql()}",
)
def unnest_pairs(spark, sf):
    """Array of (label, prob) pairs into rows."""
    score = fold_output(spark, fx.linear_networks(P))
    rows = log_train(spark, sf)
    pairs = rows.select("id", prob_structs(score(doubles(P.features), F.col("n_fold")), P.n_classes).alias("pairs"))
    return rounded(unnest(pairs, "id", pairs="pairs"))
