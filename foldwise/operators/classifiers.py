"""First- and second-level estimators: fit on a vector column, score to an array of probabilities.

Every fit reads ``vectors`` frames: ``id, n_fold, target, features`` with ``features`` a vector and
``target`` the label 1..n. All are fitted for all folds together, see ``logistic_fit``, ``boosting`` and ``network_fit``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions.columns import required
from foldwise.operators.boosting import BoostedOptions, BoostedScorer, fit_forests  # noqa: F401
from foldwise.operators.logistic_fit import LogisticOptions, fit_logistics
from foldwise.operators.network import Network, check_size, forward, matrix_function
from foldwise.operators.network_fit import NetworkOptions, fit_networks
from foldwise.operators.scaling import collect_scaler, fit_scaler
from foldwise.schema import Problem


DNN = NetworkOptions()
NN = NetworkOptions(hidden=(512, 512, 512, 512), dropout=0.5, normalise=True, patience=5, min_progress=0.0)
STACKING_XGB = BoostedOptions(rate=0.04, depth=4, min_child=1)
STACKING_DNN = NetworkOptions(hidden=(128, 64, 128))


def default_options(model: str, log: bool = False, kmeans: bool = False):
    """Options of a first-level variant; the boosted variant on all feature kinds stops earlier."""
    if model == "xgb":
        return BoostedOptions(min_progress=0.001) if log and kmeans else BoostedOptions()
    return {"logistic": LogisticOptions(), "dnn": DNN, "nn": NN}[model]


def vectors(view: DataFrame, features) -> DataFrame:
    """Feature columns gathered into one vector; a NULL feature raises."""
    checked = [required(F.col(c).cast("double"), f"feature {c} is NULL") for c in features]
    kept = [c for c in ("id", "n_fold", "target") if c in view.columns]
    return view.select(*kept, array_to_vector(F.array(*checked)).alias("features"))


def _index(problem: Problem) -> Column:
    """Zero-based label with its number of classes, so that no pass is spent on counting them."""
    meta = {"ml_attr": {"type": "nominal", "vals": [f"Class_{k}" for k in problem.labels]}}
    return (F.col("target") - 1).cast("double").alias("y", metadata=meta)


@dataclass(frozen=True)
class LogisticScorer:
    """A model of Spark ML, as ``fit_logistic`` gives it for one set of rows."""

    model: LogisticRegressionModel

    def probabilities(self, df: DataFrame, out: str) -> DataFrame:
        model = self.model.copy().setFeaturesCol("features").setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_v")
        return model.transform(df).withColumn(out, vector_to_array("_v")).drop("_v")


@dataclass(frozen=True)
class NetworkScorer:
    """Scores in Arrow batches; standardisation is already part of the first layer."""

    network: Network

    def probabilities(self, df: DataFrame, out: str) -> DataFrame:
        check_size({0: self.network})
        run = matrix_function(df.sparkSession, forward, self.network.plain, self.network.n_inputs)
        return df.withColumn(out, run(vector_to_array("features")))


@dataclass(frozen=True)
class SoftmaxScorer(NetworkScorer):
    """A logistic model: a network of one layer, and how many steps it took."""

    steps: int = 0


def fit_logistic(fit: DataFrame, problem: Problem, options: LogisticOptions = LogisticOptions()) -> LogisticScorer:
    strength = options.l1 + options.l2
    estimator = LogisticRegression(
        family="multinomial",
        labelCol="y",
        regParam=strength,
        elasticNetParam=options.l1 / strength if strength else 0.0,
        maxIter=options.max_iter,
        tol=options.tol,
    )
    return LogisticScorer(estimator.fit(fit.select("features", _index(problem))))


def concurrently(spark: SparkSession, function, items, parallelism: int) -> list:
    """Independent fits side by side, results in order; the first error is raised and what has not begun is dropped.

    The thread target copies the job properties when it is made, so each item gets one of its own: threads that
    shared one would overwrite each other's properties, such as the id of the statement they belong to.
    """
    items = list(items)
    if parallelism <= 1:
        return [function(i) for i in items]
    with ThreadPoolExecutor(parallelism) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(function), i) for i in items]
        try:
            return [f.result() for f in running]
        except BaseException:
            for f in running:
                f.cancel()
            raise


def fit_folds(model: str, view: DataFrame, problem: Problem, options, parallelism: int = 1) -> dict[int, object]:
    """One scorer per fold, each fitted on the rows of the other folds.

    ``view`` is a ``vectors`` frame, best one stored: each pass reads it once for all folds.
    """
    if model == "xgb":
        return fit_forests(view, problem, options)
    if model == "logistic":
        scalers = collect_scaler(fit_scaler(view, problem, F.col("features")))
        layers, steps = fit_logistics(view, problem, scalers, options)
        return {k: SoftmaxScorer(layers[k], steps[k]) for k in problem.folds}

    if model in ("dnn", "nn"):
        # all folds in one pass per step
        scalers = collect_scaler(fit_scaler(view, problem, F.col("features")))
        networks, _ = fit_networks(view, problem, scalers, options)
        return {k: NetworkScorer(n) for k, n in networks.items()}

    raise ValueError(f"model {model!r} is not one of logistic, dnn, xgb, nn")
