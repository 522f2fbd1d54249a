"""Single steps of fits from given parameters, with a full oracle."""

from __future__ import annotations

import numpy as np

from foldwise import fixtures as fx
from foldwise.functions.features import all_features
from foldwise.operators.classifiers import fit_folds, vectors
from foldwise.operators.distance_bounds import improved_by_bounds
from foldwise.operators.logistic_fit import LogisticOptions, _losses, fit_logistics, logistic_rows, penalties, pseudo_gradient
from foldwise.operators.network_fit import Fit, NetworkOptions, Weights, trained, training_rows
from foldwise.operators.predict import oof_predictions
from foldwise.operators.scaling import collect_scaler, fit_scaler, fit_scaler_all, standardised_array
from foldwise.queries.base import _LOGS, BASE, LONG, query, rounded
from foldwise.queries.features import lab
from foldwise.sources.scratch import stored

P = fx.LETTERS
OFF = 3.14159e-6  # shares of few rows lie exactly between two values of four digits; not so when moved by this


@query(
    "network_first_step",
    f"""{LONG}, points AS (
      SELECT n_fold, target, j, x FROM long UNION ALL SELECT n_fold, target, 0, NULL FROM lab
    )
    SELECT k AS n_fold, label, p.j AS input,
           round(avg((0.25 - (target = label)::INT) * CASE WHEN p.j = 0 THEN 1 ELSE (x - mean) / std END) + {OFF}, 4) + 0.0 AS gradient
    FROM points p, (SELECT unnest(range(0, 5)) AS k), (SELECT unnest(range(1, 5)) AS label) LEFT JOIN scaler s ON s.n_fold = k AND s.j = p.j
    WHERE p.n_fold <> k GROUP BY k, label, p.j""",
)
def network_first_step(spark, sf):
    """The gradient of a softmax layer with weights of zero, all folds in one pass with one mini-batch. Input 0 is the bias."""
    view = stored(vectors(lab(spark, sf), P.features), "view")
    scalers = collect_scaler(fit_scaler(lab(spark, sf), P))
    options = NetworkOptions(hidden=(), batch_rows=1 << 30, task_rows=1 << 30, double=True)
    begun = {k: Fit.begun(Weights((len(P.features), P.n_classes), 0)) for k in P.folds}
    after, _ = trained(training_rows(view, options.task_rows), begun, scalers, options, 0)
    rows = []
    for k, fit in after.items():
        # the first moment after one step is a tenth of the gradient
        matrix, bias = Weights(fit.weights.sizes, 0, np.round(fit.first * 10 + OFF, 4) + 0.0).layers[0]
        for c in range(P.n_classes):
            rows += [(k, c + 1, j, float(g)) for j, g in enumerate([bias[c], *matrix[:, c]])]
    return spark.createDataFrame(rows, "n_fold long, label long, input long, gradient double")


@query(
    "logistic_without_features",
    f"""{BASE}, shares AS (
      SELECT k, label, avg((target = label)::INT) AS share FROM lab, (SELECT unnest(range(0, 5)) AS k), (SELECT unnest(range(1, 5)) AS label)
      WHERE n_fold <> k GROUP BY k, label
    )
    SELECT id, n_fold, target, label, round(share + {OFF}, 4) AS prob FROM lab JOIN shares ON k = n_fold""",
)
def logistic_without_features(spark, sf):
    """A penalty that no weight outweighs: the minimum is the intercepts of the class shares of the other folds."""
    view = stored(vectors(lab(spark, sf), P.features), "view")
    scorers = fit_folds("logistic", view, P, LogisticOptions(l1=10.0, tol=1e-15, max_iter=500))
    long = oof_predictions(view, scorers, P.n_classes)
    return rounded(long.withColumn("prob", long["prob"] + OFF), 4)


@query("logistic_optimum", f"{BASE} SELECT DISTINCT n_fold, true AS stationary, true AS sparse FROM lab")
def logistic_optimum(spark, sf):
    """At each fold's solution no direction leads down, and the absolute penalty has set weights to zero."""
    view = stored(vectors(lab(spark, sf), P.features), "view")
    scalers = collect_scaler(fit_scaler(lab(spark, sf), P))
    options = LogisticOptions(l1=0.01, l2=0.01, tol=1e-14, max_iter=500)
    found, _ = fit_logistics(view, P, scalers, options)
    width, classes = len(P.features), P.n_classes
    points = {}
    for k, network in found.items():
        # back to weights of standardised inputs
        layer, (mean, std) = network.layers[0], scalers[k]
        points[k] = np.concatenate([(layer.weights * np.asarray(std)[:, None]).ravel(), layer.bias + np.asarray(mean) @ layer.weights])
    l1, l2 = penalties(width, classes, options.l1), penalties(width, classes, options.l2)
    rows = []
    for k, (_, g) in _losses(logistic_rows(view), points, scalers, width, classes).items():
        steepest = pseudo_gradient(points[k], g + l2 * points[k], l1)
        rows.append((k, bool(np.abs(steepest).max() < 1e-5), bool((points[k] == 0).any())))
    return spark.createDataFrame(rows, "n_fold long, stationary boolean, sparse boolean")


ROUNDS, CENTROIDS = 4, 4


def _rounds_sql() -> str:
    """Rounds of k-means over the logarithms of all documents, every point compared with every centroid."""
    parts = [
        f"""{BASE}, counted AS (SELECT id, unnest(range(1, 27)) AS j, unnest({_LOGS}) AS x FROM letters
        ), moments AS (
          SELECT j, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1 ELSE stddev_pop(x) END AS std FROM counted GROUP BY j
        ), points AS (SELECT id, j, (x - mean) / std AS z FROM counted JOIN moments USING (j)
        ), c0 AS (
          SELECT i, j, ((31 * i + 17 * j) % 13 - 6) / 10::DOUBLE AS c
          FROM (SELECT unnest(range(1, {CENTROIDS + 1})) AS i), (SELECT unnest(range(1, 27)) AS j)
        )"""
    ]
    for r in range(ROUNDS):
        parts.append(f"""a{r} AS (
          SELECT id, arg_min(i, (d, i)) AS i FROM (SELECT id, i, sum((z - c) * (z - c)) AS d FROM points JOIN c{r} USING (j) GROUP BY id, i) GROUP BY id
        ), m{r} AS (SELECT i, j, avg(z) AS c FROM a{r} JOIN points USING (id) GROUP BY i, j
        ), c{r + 1} AS (SELECT i, j, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (i, j))""")
    return ", ".join(parts) + f" SELECT i AS centroid, j AS input, round(c, 8) + 0.0 AS center FROM c{ROUNDS}"


@query("kmeans_rounds", _rounds_sql())
def kmeans_rounds(spark, sf):
    """Centroids after some rounds from given ones, later rounds by the bounds of the first."""
    both = all_features(fx.letters_train(spark, sf), fx.letters_test(spark, sf), P.features, log=True)
    scaler = fit_scaler_all(both, P.features).first()
    points = stored(both.select(standardised_array(P.features, scaler["mean"], scaler["std"]).alias("x")), "points")
    start = np.array(fx.rule_weights(len(P.features), CENTROIDS, 0)).T * 10
    found = improved_by_bounds(points, start, ROUNDS, tol=-1.0)  # no round is too small
    rows = [(i, j, float(c)) for i, center in enumerate(found.centers, 1) for j, c in enumerate(center, 1)]
    return rounded(spark.createDataFrame(rows, "centroid long, input long, center double"), 8)
