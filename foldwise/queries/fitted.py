"""Fitted models. Their numbers depend on seeds and on the order of sums, so what is compared are
properties: which rows a table has, that probabilities are probabilities, that a model has learnt.

All of them share one run per input folder. Estimators are fitted with their own options, but boosted trees other than those of the raw view learn
at a higher rate, so that their stop rule, which ends them, is reached in fewer rounds. The rows are always all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise import fixtures as fx
from foldwise.functions.features import all_features
from foldwise.operators.classifiers import BoostedOptions, NetworkScorer, concurrently, vectors
from foldwise.operators.clusters import fit_clusters, predict_clusters
from foldwise.operators.metrics import evaluate_models
from foldwise.operators.predict import oof_predictions
from foldwise.plans.stacking_run import RunOptions, StackingRun
from foldwise.queries.base import BASE, query
from foldwise.queries.features import ORDER_FEATURES, _ORDERS, lab
from foldwise.queries.tables import dataset
from foldwise.schema import FIRST_LEVEL, METRICS, Variant
from foldwise.sources.models import Models
from foldwise.sources.scratch import remove, scratch_path, stored

P = fx.LETTERS

OPTIONS = {
    "xgb_model": BoostedOptions(),
    "xgb": BoostedOptions(rate=0.3),
    "xgb_stacking": BoostedOptions(rate=0.3, depth=4, min_child=1),
}


def new_run(spark, sf, options: RunOptions) -> StackingRun:
    tables = dataset(spark)
    run = StackingRun(tables, Models(tables, scratch_path(spark, "models")), P, options)
    run.load(fx.letters_train(spark, sf), fx.letters_test(spark, sf))
    return run


def shared_run(spark, sf) -> StackingRun:
    return fx.once(spark, sf, "run", lambda: new_run(spark, sf, RunOptions(options=OPTIONS)))


def clusters(spark, sf, log: bool) -> StackingRun:
    run = shared_run(spark, sf)
    fx.once(spark, sf, f"clusters-{log}", lambda: run.fit_clusters(log) or True)
    return run


def first_level(spark, sf, *variants: Variant) -> StackingRun:
    """Fits and predictions of some variants, side by side, unless the session has them."""
    run = shared_run(spark, sf)
    concurrently(spark, lambda log: clusters(spark, sf, log), sorted({v.log for v in variants if v.kmeans}), 2)

    def build(variant):
        run.fit(variant)
        run.predict_oof(variant)
        run.predict_test(variant)
        return True

    missing = [v for v in variants if not fx.made(spark, sf, f"fit-{v.model_name}")]
    run.side_by_side(lambda v: fx.once(spark, sf, f"fit-{v.model_name}", lambda: build(v)), missing)
    return run


def second_level(spark, sf, *models: str) -> StackingRun:
    run = first_level(spark, sf, *FIRST_LEVEL)

    def build(model):
        run.fit_second_level(model)
        run.predict_oof_second_level(model)
        run.predict_test_second_level(model)
        return True

    run.second_level_view()  # not by several at once
    concurrently(spark, lambda m: fx.once(spark, sf, f"second-{m}", lambda: build(m)), models, len(models))
    return run


def probability_checks(long: DataFrame, *keys: str) -> DataFrame:
    """One row per id: how many labels, and whether the numbers are a distribution."""
    return long.groupBy(*keys).agg(
        F.count_distinct("label").alias("n_labels"),
        F.count("*").alias("n_rows"),
        ((F.min("prob") >= 0) & (F.max("prob") <= 1)).alias("in_unit"),
        (F.abs(F.sum("prob") - 1) < 1e-6).alias("sums_to_one"),
    )


_OOF = f"{BASE} SELECT id, n_fold, target, 4::BIGINT AS n_labels, 4::BIGINT AS n_rows, true AS in_unit, true AS sums_to_one FROM lab"
_TEST = f"{BASE} SELECT id, 4::BIGINT AS n_labels, 4::BIGINT AS n_rows, true AS in_unit, true AS sums_to_one FROM test"


def _register(variant: Variant) -> None:
    name = f"{variant.model}{variant.suffix}"

    @query(f"fitted_oof_{name}", _OOF)
    def oof(spark, sf):
        return probability_checks(first_level(spark, sf, variant).tables.read(variant.oof_table), "id", "n_fold", "target")

    @query(f"fitted_test_{name}", _TEST)
    def test(spark, sf):
        return probability_checks(first_level(spark, sf, variant).tables.read(variant.test_table), "id")


for _variant in FIRST_LEVEL:
    _register(_variant)


def learnt(spark, sf, oof_tables: dict[str, DataFrame]) -> DataFrame:
    """Metrics of each table against guessing with the class shares of the fold itself."""
    shares = lab(spark, sf).groupBy("n_fold", "target").agg(F.count("*").alias("n"))
    total = F.sum("n")
    prior = shares.groupBy("n_fold").agg((F.ln(total) - F.sum(F.col("n") * F.ln("n")) / total).alias("prior"))
    rows = evaluate_models(oof_tables, P)
    bounded = reduce(lambda a, b: a & b, [F.col(m).between(0, 1) for m in METRICS if m != "log_loss"])
    return rows.join(F.broadcast(prior), "n_fold").select(
        "model_name", "n_fold", bounded.alias("bounded"), (F.col("log_loss") < F.col("prior")).alias("beats_prior")
    )


def _learnt_sql(names) -> str:
    values = ", ".join(f"('{n}')" for n in names)
    return f"SELECT model_name, n_fold, true AS bounded, true AS beats_prior FROM (VALUES {values}) v(model_name), (SELECT DISTINCT doc_id % 5 AS n_fold FROM documents)"


for _model in ("logistic", "dnn", "xgb", "nn"):
    _variants = [v for v in FIRST_LEVEL if v.model == _model]

    @query(f"fitted_metrics_{_model}", _learnt_sql([v.model_name for v in _variants]))
    def _metrics(spark, sf, variants=tuple(_variants)):
        run = first_level(spark, sf, *variants)
        return learnt(spark, sf, {v.model_name: run.tables.read(v.oof_table) for v in variants})


for _model in ("xgb", "dnn"):

    @query(f"second_level_oof_{_model}", _OOF)
    def _second_oof(spark, sf, model=_model):
        run = second_level(spark, sf, model)
        return probability_checks(run.tables.read(f"{model}_stacking_oof_pred"), "id", "n_fold", "target")

    @query(f"second_level_test_{_model}", _TEST)
    def _second_test(spark, sf, model=_model):
        return probability_checks(second_level(spark, sf, model).tables.read(f"{model}_stacking_test_pred"), "id")


@query("second_level_metrics", _learnt_sql(["xgb_stacking_model", "dnn_stacking_model"]))
def second_level_metrics(spark, sf):
    run = second_level(spark, sf, "xgb", "dnn")
    return learnt(spark, sf, {f"{m}_stacking_model": run.tables.read(f"{m}_stacking_oof_pred") for m in ("xgb", "dnn")})


@query(
    "saved_models",
    f"{BASE} SELECT n_fold, 'logistic' AS kind, 'raw features' AS description, count(*) AS n, 0::BIGINT AS n_different FROM lab GROUP BY n_fold",
)
def saved_models(spark, sf):
    """Models read back from their folders score as the ones that wrote the stored table."""
    variant = Variant("logistic")
    run = first_level(spark, sf, variant)
    run.models.describe(variant.model_name, "raw features")
    view, problem = run.train_view()
    again = oof_predictions(vectors(view, problem.features), run.models.load_folds(variant.model_name), P.n_classes)
    stored = run.tables.read(variant.oof_table).withColumnRenamed("prob", "before")
    both = stored.join(again.select("id", "label", "prob"), ["id", "label"])
    counts = both.groupBy("n_fold").agg(
        F.count_distinct("id").alias("n"), F.count_if(F.abs(F.col("prob") - F.col("before")) > 1e-12).alias("n_different")
    )
    listed = run.models.list(variant.model_name).select("n_fold", "kind", "description")
    return listed.join(counts, "n_fold").select("n_fold", "kind", "description", "n", "n_different")


@query(
    "deleted_model",
    f"{BASE} SELECT n_fold, count(*) AS n, true AS listed_before, false AS listed_after, false AS files_after FROM lab GROUP BY n_fold",
)
def deleted_model(spark, sf):
    """Given networks saved under a name with a quote, scored after loading, and deleted with their files."""
    tables = dataset(spark)
    models, name = Models(tables, scratch_path(spark, "models")), "somebody's model"
    models.save_folds(name, {k: NetworkScorer(n) for k, n in fx.linear_networks(P).items()})
    rows = lab(spark, sf)
    scored = oof_predictions(vectors(rows, P.features), models.load_folds(name), P.n_classes)
    counts = stored(scored.groupBy("n_fold").agg(F.count_distinct("id").alias("n")), "scored")
    before = {r["n_fold"]: r["path"] for r in models.list(name).collect()}
    models.delete(name)
    after = {r["n_fold"] for r in models.list(name).collect()}
    checks = [(k, True, k in after, remove(spark, path)) for k, path in before.items()]
    return counts.join(spark.createDataFrame(checks, "n_fold long, listed_before boolean, listed_after boolean, files_after boolean"), "n_fold")


def cluster_checks(points: DataFrame, found) -> DataFrame:
    """One row: ids in range, nearest really nearest, and spread below that of a single cluster."""
    pairs = F.col("NEAREST_CENTROIDS_DISTANCE")
    distance = F.transform(pairs, lambda p: p["DISTANCE"])
    scored = predict_clusters(points, found).select(
        F.col("CENTROID_ID").between(1, found.k).alias("known"),
        (F.lit(found.k) == F.size(pairs)).alias("complete"),
        (pairs[0]["DISTANCE"] == F.array_min(distance)).alias("nearest"),
        (pairs[0]["DISTANCE"] * pairs[0]["DISTANCE"]).alias("squared"),
    )
    # standardised features have variance 1 each, so one cluster at the mean has this mean square
    single = float(len(found.features))
    return scored.agg(
        F.count("*").alias("n"),
        F.count_if(~(F.col("known") & F.col("complete") & F.col("nearest"))).alias("n_wrong"),
        (F.avg("squared") < single).alias("tighter_than_one"),
    )


_CLUSTERS = "count(*) AS n, 0::BIGINT AS n_wrong, true AS tighter_than_one"


for _log in (False, True):

    @query("clusters_log" if _log else "clusters", f"SELECT {_CLUSTERS} FROM documents")
    def _cluster_query(spark, sf, log=_log):
        run = clusters(spark, sf, log)
        points = all_features(run.tables.read("train_folds"), run.tables.read("test"), P.features, log)
        return cluster_checks(points, run.models.load_clusters(run.clusters_name(log)))


@query("customer_clusters", f"{_ORDERS} SELECT {_CLUSTERS} FROM counts")
def customer_clusters(spark, sf):
    """Customers by their order-line counts; those with more open than finished lines as the second table."""
    counts = stored(fx.orders_counts(spark, sf), "customers")
    finished, unfinished = counts.filter("feat_4 >= feat_5"), counts.filter("feat_4 < feat_5")
    found = fit_clusters(finished, unfinished, ORDER_FEATURES, log=True)
    return cluster_checks(all_features(finished, unfinished, ORDER_FEATURES, log=True), found)


_SECOND = [f"{m}_stacking_model" for m in ("xgb", "dnn")]
_MODELS = ", ".join(f"'{n}'" for n in [*[v.model_name for v in FIRST_LEVEL], *_SECOND])


@query(
    "whole_run",
    f"""{BASE}, names AS (SELECT unnest([{_MODELS}]) AS model_name)
    SELECT model_name, n_fold, (SELECT {len(FIRST_LEVEL) + 2} * count(*) FROM test)::BIGINT AS submitted
    FROM names, (SELECT DISTINCT n_fold FROM lab)""",
)
def whole_run(spark, sf):
    """Every step over all variants and both second levels: the metrics it stored and the submission rows it wrote.

    Steps that an earlier query of the session has done for the same folder are not done again.
    """
    run = second_level(spark, sf, "xgb", "dnn")
    run.evaluate_all()
    folder = scratch_path(spark, "submissions")
    run.submissions(folder)
    written = reduce(
        DataFrame.unionByName,
        [spark.read.csv(f"{folder}/{t}_sub", header=True, schema=run.submission(t).schema) for t in run.submission_tables()],
    )
    metrics = run.tables.read("eval")
    return metrics.select("model_name", "n_fold", F.lit(written.count()).alias("submitted"))
