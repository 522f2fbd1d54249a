"""Plans of a run, and what it refuses. ``check.py whole_run`` runs all steps on the given tables."""

import re
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from foldwise.operators.classifiers import BoostedOptions, LogisticOptions, NetworkOptions, concurrently, fit_folds, vectors
from foldwise.functions.features import fit_part, labelled
from foldwise.operators.metrics import upsert_metrics
from foldwise.operators.predict import oof_predictions, test_predictions as predict_test
from foldwise.plans.stacking_run import RunOptions, StackingRun
from foldwise.queries.tables import dataset
from foldwise.schema import EVAL_SCHEMA, Problem, Variant
from foldwise.sources.models import Models
from foldwise.sources.scratch import scratch_path

P = Problem(("feat_1", "feat_2"), n_classes=2, n_folds=2)
VARIANTS = (Variant("logistic"), Variant("logistic", True))
OPTIONS = RunOptions(
    variants=VARIANTS,
    second_level=("dnn", "xgb"),
    parallelism=4,
    buckets=3,
    options={"logistic": LogisticOptions(l1=0.0, l2=0.01, max_iter=5), "dnn_stacking": NetworkOptions(hidden=(3,), max_iter=5), "xgb_stacking": BoostedOptions(rounds=2, depth=2)},
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark):
    base = spark.range(60).select(
        "id",
        (F.col("id") % 3 * 5 + F.col("id") % 7).cast("double").alias("feat_1"),
        (F.col("id") % 11).cast("double").alias("feat_2"),
        F.concat(F.lit("Class_"), (F.col("id") % 3 > 0).cast("int") + 1).alias("target"),
    )
    return base.filter("id < 50"), base.filter("id >= 50").drop("target")


@pytest.fixture(scope="module")
def run(spark, inputs):
    tables = dataset(spark)
    made = StackingRun(tables, Models(tables, scratch_path(spark, "models")), P, OPTIONS)
    made.load(*inputs)
    return made


def test_a_run_end_to_end(spark, run):
    folder = scratch_path(spark, "subs")
    metrics = run.run(folder)
    assert sorted(metrics.columns) == sorted(EVAL_SCHEMA.names)
    assert {(r.model_name, r.n_fold) for r in metrics.collect()} == {
        (m, k) for m in ("logistic_model", "logistic_log_model", "dnn_stacking_model", "xgb_stacking_model") for k in (0, 1)
    }
    for name in run.submission_tables():
        rows = spark.read.csv(f"{folder}/{name}_sub", header=True).collect()
        assert len(rows) == 10 and sorted(rows[0].asDict()) == ["Class_1", "Class_2", "id"]
    # a later process scores with the saved models
    later = StackingRun(run.tables, run.models, P, OPTIONS)
    before = {(r.id, r.label): r.prob for r in run.tables.read("dnn_stacking_test_pred").collect()}
    later.predict_test_second_level("dnn")
    after = {(r.id, r.label): r.prob for r in run.tables.read("dnn_stacking_test_pred").collect()}
    assert before == pytest.approx(after)


def test_scoring_does_not_shuffle_and_reads_one_fold_at_a_time(run):
    scorers = run._scorers("logistic_model") if run.tables.exists("logistic_oof_pred") else None
    if scorers is None:
        run.fit(VARIANTS[0])
        scorers = run._scorers("logistic_model")
    view, problem = run.train_view()
    oof = plan(oof_predictions(vectors(view, problem.features), scorers, 2))
    assert "Exchange" not in oof
    assert len(re.findall(r"PartitionFilters: \[isnotnull\(n_fold#\d+L\), \(n_fold#\d+L = \d\)\]", oof)) == 2
    tests, _ = run.test_view()
    assert "Exchange" not in plan(predict_test(vectors(tests, problem.features), scorers, 2))


def test_second_level_features_do_not_shuffle_stored_predictions(spark, run):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(run.joined_first_level())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("SortMergeJoin") == 2
    assert text.count("Exchange") == 1  # the ids the features are joined to
    assert "Exchange" not in plan(run.submission(VARIANTS[0].test_table))


def test_repeated_ids_are_refused(spark, inputs):
    train, test = inputs
    tables = dataset(spark)
    run = StackingRun(tables, Models(tables, scratch_path(spark, "models")), P, OPTIONS)
    with pytest.raises(ValueError, match="test has ids that occur more than once"):
        run.load(train, test.unionByName(test))


def test_second_level_scores_from_one_stored_view(run):
    scorers = run._scorers("dnn_stacking_model")
    text = plan(oof_predictions(run.second_level_view(), scorers, 2))
    assert "Join" not in text and "Exchange" not in text
    assert {*re.findall(r"FileScan parquet (\S+)\[", text)} == {f"spark_catalog.{run.tables.dataset}.{run.tables.version('view_second_level')}"}


def test_a_fold_is_fitted_on_the_directories_of_the_others(run):
    view, _ = run.train_vectors()
    read = {f.rsplit("/", 2)[-2] for f in fit_part(view, 1).inputFiles()}
    assert read == {"n_fold=0"}


def test_bad_ids_are_refused_before_anything_is_replaced(spark, run, inputs):
    train, test = inputs
    before = run.tables.read("train_folds").count()
    for bad in (-3, None):
        row = spark.createDataFrame([(bad, 1.0, 2.0, "Class_1")], "id long, feat_1 double, feat_2 double, target string")
        with pytest.raises(ValueError, match="train has ids that are NULL or negative"):
            run.load(train.unionByName(row), test)
        with pytest.raises(Exception, match="a labelled id is NULL or negative"):
            labelled(row, P).collect()
    assert run.tables.read("train_folds").count() == before
    ids = {r.id for r in run.tables.read("logistic_oof_pred").select("id").collect()}
    assert ids == {r.id for r in train.select("id").collect()}


def test_rows_and_models_of_unknown_folds_raise(spark, run):
    scorers = run._scorers("logistic_model")
    view, _ = run.train_vectors()
    for fold in (7, None):
        odd = view.limit(1).withColumn("n_fold", F.lit(fold).cast("bigint"))
        with pytest.raises(Exception, match="no model for fold"):
            oof_predictions(view.unionByName(odd), scorers, 2).collect()
    run.models.save_folds("half_model", {0: scorers[0]})
    with pytest.raises(ValueError, match="has folds"):
        run._checked("half_model")


def test_buckets_follow_the_ids(run):
    options = RunOptions(variants=VARIANTS, ids_per_bucket=20)
    assert StackingRun(run.tables, run.models, P, options).buckets == 3


def test_models_are_deleted_with_their_files(spark, run):
    name = "it's a model"
    run.models.save_folds(name, run._scorers("logistic_model"))
    path = run.models.list(name).first()["path"]
    assert spark.read.parquet(path).count() == 1
    assert run.models.delete(name) and not run.models.delete(name)
    assert run.models.list(name).isEmpty()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_threads_have_job_properties_of_their_own(spark):
    begun = Barrier(2)

    def work(i):
        spark.sparkContext.setLocalProperty("foldwise.test", str(i))
        begun.wait(20)
        return spark.sparkContext.getLocalProperty("foldwise.test")

    assert concurrently(spark, work, range(2), 2) == ["0", "1"]


def test_saves_fits_and_upserts_side_by_side(spark, run):
    """Different models written at once stay complete, and the session's setting is left alone."""
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    scorers = run._scorers("logistic_model")
    rows = run.tables.read("eval").filter("model_name = 'logistic_model'").collect()
    metrics = spark.createDataFrame([r.asDict() for r in rows], EVAL_SCHEMA)
    view, problem = run.train_vectors()

    def work(i):
        if i % 3 == 0:
            run.models.save_folds(f"m{i}", scorers)
        elif i % 3 == 1:
            upsert_metrics(metrics.withColumn("model_name", F.lit(f"m{i}")), run.tables.name("eval"))
        else:
            fit_folds("logistic", view, problem, LogisticOptions(max_iter=2), 2)
        return spark.conf.get("spark.sql.sources.partitionOverwriteMode")

    assert {*concurrently(spark, work, range(12), 6)} == {mode}
    assert run.tables.read("eval").filter("model_name LIKE 'm%'").count() == 8
    assert run.models.list().filter("model_name LIKE 'm%'").count() == 8
    assert run.tables.read("eval").filter("model_name NOT LIKE 'm%'").count() == 8


def test_a_refit_makes_later_tables_stale(run, spark):
    """Own run, so that the shared one stays whole."""
    tables = dataset(spark)
    again = StackingRun(tables, Models(tables, scratch_path(spark, "models")), P, OPTIONS)
    again.load(run.tables.read("train_folds").select("id", "feat_1", "feat_2", F.concat(F.lit("Class_"), "target").alias("target")), run.tables.read("test"))
    folder = scratch_path(spark, "subs")
    again.run(folder)
    items = [f"table {t}" for t in ("logistic_oof_pred", "logistic_oof_log_pred", "logistic_test_pred", "view_second_level", "dnn_stacking_oof_pred")]
    fresh = lambda: [again.ledger().fresh(i) for i in items]
    assert fresh() == [True] * 5
    again.fit(VARIANTS[0])
    assert fresh() == [False, True, False, False, False]
    with pytest.raises(ValueError, match="logistic_oof_pred"):
        again.evaluate_all()
    with pytest.raises(ValueError, match="logistic_test_pred"):
        again.submissions(folder)
    with pytest.raises(ValueError, match="older than what they are made from: logistic_oof_pred"):
        again.fit_second_level("dnn")
    # a run that is resumed does the stale steps only, and a killed one goes on where it stopped
    done = []
    for name in ("fit", "predict_oof", "predict_test", "fit_second_level", "predict_oof_second_level", "predict_test_second_level"):
        step = getattr(again, name)

        def told(what, step=step, name=name):
            done.append((name, getattr(what, "model_name", what)))
            if killed and name == "predict_oof_second_level":
                raise RuntimeError("killed")
            step(what)

        setattr(again, name, told)
    killed = True
    with pytest.raises(RuntimeError, match="killed"):
        again.run(folder, resume=True)
    first = [("predict_oof", "logistic_model"), ("predict_test", "logistic_model"), ("fit_second_level", "dnn")]
    assert done == [*first, ("predict_oof_second_level", "dnn")]
    killed = False
    done.clear()
    again.run(folder, resume=True)
    assert done == [(n, m) for m in ("dnn", "xgb") for n in ("fit_second_level", "predict_oof_second_level", "predict_test_second_level")][1:]
    assert fresh() == [True] * 5
    # new rows make everything stale
    again.load(run.tables.read("train_folds").filter("id < 40").select("id", "feat_1", "feat_2", F.concat(F.lit("Class_"), "target").alias("target")), run.tables.read("test"))
    assert fresh() == [False] * 5


def test_variants_are_fitted_side_by_side_and_long_ones_behind_the_others(run, monkeypatch):
    """One after the other, most of a pass over few rows was waiting."""
    meet, done = Barrier(2), []

    def fit(variant):
        if variant.model != "nn":
            meet.wait(60)
        done.append(variant.model)

    monkeypatch.setattr(run, "fit", fit)
    run.first_level()
    assert done == ["logistic", "logistic"]
    done.clear()
    run.side_by_side(fit, [Variant("nn"), Variant("logistic"), Variant("dnn", True)])
    assert sorted(done[:2]) == ["dnn", "logistic"] and done[2] == "nn"
