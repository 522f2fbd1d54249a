import math
import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from foldwise.operators.metrics import evaluate, evaluate_models, log_loss, merge_metrics, outcomes, roc_auc, tally, threshold_metrics, upsert_metrics
from foldwise.operators.predict import mean_over_folds, submission, to_wide, unnest, unnest_positions
from foldwise.operators.stacking import joined_arrays, missing_predictions, stacking_test, stacking_vectors, wide_features
from foldwise.queries.tables import dataset
from foldwise.schema import EVAL_SCHEMA, METRICS, Problem

P = Problem((), n_classes=3, n_folds=2)
OOF = "id long, n_fold long, target long, label long, prob double"


def oof(spark, rows):
    """rows: (id, fold, target, (p1, p2, p3))"""
    return spark.createDataFrame([(i, f, t, k, p) for i, f, t, ps in rows for k, p in enumerate(ps, 1)], OOF)


def test_unnest_drops_empty_and_missing_arrays(spark):
    df = spark.createDataFrame([(1, [(1, 0.4), (2, 0.6)]), (2, []), (3, None)], "id long, predicted_target_probs array<struct<label:long,prob:double>>")
    assert sorted(map(tuple, unnest(df, "id").collect())) == [(1, 1, 0.4), (1, 2, 0.6)]
    arrays = spark.createDataFrame([(1, [0.4, 0.6]), (2, [])], "id long, output array<double>")
    assert sorted(map(tuple, unnest_positions(arrays, "id").collect())) == [(1, 1, 0.4), (1, 2, 0.6)]


def test_mean_and_wide(spark):
    long = spark.createDataFrame([(1, 1, 0.2), (1, 1, 0.4), (1, 3, 0.5), (2, 2, 1.0)], "id long, label long, prob double")
    wide = {r["id"]: r for r in submission(mean_over_folds(long), P).collect()}
    assert wide[1]["Class_1"] == pytest.approx(0.3) and wide[1]["Class_2"] is None and wide[2]["Class_2"] == 1.0
    assert to_wide(long, P, "id", prefix="t_").columns == ["id", "t_Class_1", "t_Class_2", "t_Class_3"]


def test_stacking_features_with_a_gap(spark):
    template = spark.createDataFrame([(1, 1), (2, 2)], "id long, target long")
    a = spark.createDataFrame([(i, k, i + k / 10) for i in (1, 2) for k in (3, 1, 2)], "id long, label long, prob double")
    b = a.filter("id = 1")
    wide = {r["id"]: r for r in wide_features(template, {"a": a, "b": b}, P).collect()}
    assert [wide[1][f"b_Class_{k}"] for k in P.labels] == [1.1, 1.2, 1.3]
    assert wide[2]["b_Class_1"] is None and wide[2]["a_Class_3"] == 2.3
    gaps = {r["table_name"]: r["n_missing"] for r in missing_predictions(template, {"a": a, "b": b}, P).collect()}
    assert gaps == {"a": 0, "b": 1}
    with pytest.raises(Exception, match="no prediction in b"):
        stacking_vectors(template, {"a": a, "b": b}, P).collect()
    assert stacking_test(template, {"x_test_pred": a}, P).columns[:2] == ["id", "x_oof_pred_Class_1"]


def test_stacked_tables_meet_in_one_join_with_few_buffers(spark):
    template = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 3), (None, 1)], "id long, target long")
    expected = {t: {i: [i + t / 100 + k / 10 for k in P.labels] for i in (1, 2, 3, 9) if (i + t) % 4} for t in range(14)}
    expected[3][2][1] = None  # a label without a row
    tables = {}
    for t, by_id in expected.items():
        rows = [(i, k, p) for i, ps in by_id.items() for k, p in zip(P.labels, ps) if p is not None]
        again = [(i, k, p - 1) for i, k, p in rows if i == 3]  # the largest of several counts
        tables[f"t{t}"] = spark.createDataFrame([*rows, *again, (None, 1, 0.5)], "id long, label long, prob double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joined_arrays(template, tables, P)
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        executed = joined._jdf.queryExecution().executedPlan().toString()
        rows = joined.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Join ") == 1 and executed.count("Exchange hashpartitioning") == 2
    assert executed.count("HashAggregate(") == 2 and executed.count("Sort [") == 2
    assert sorted((r.id or 0, r.target) for r in rows) == [(0, 1), (1, 1), (1, 2), (2, 2), (3, 3)]
    for r in rows:
        assert all(r[f"t{t}"] == by_id.get(r.id) for t, by_id in expected.items())
    assert joined_arrays(template, {}, P).columns == ["id", "target"]


def test_ties_go_to_the_smaller_label_and_absent_classes_do_not_count(spark):
    df = oof(spark, [(1, 0, 1, (0.4, 0.4, 0.2)), (2, 0, 2, (0.4, 0.4, 0.2)), (3, 0, 1, (0.1, 0.1, 0.8))])
    counts = {(r.target, r.predicted): r.n for r in outcomes(df, P).collect()}
    assert counts == {(1, 1): 1, (2, 1): 1, (1, 3): 1}
    m = threshold_metrics(outcomes(df, P)).first()
    assert m.accuracy == pytest.approx(1 / 3)
    assert m.precision == pytest.approx((1 / 2 + 0) / 2)
    assert m.recall == pytest.approx((1 / 2 + 0) / 2)
    assert m.f1_score == pytest.approx((1 / 2 + 0) / 2)


def test_probability_zero_gives_a_finite_loss(spark):
    df = oof(spark, [(1, 0, 1, (0.0, 1.0, 0.0)), (2, 1, 2, (0.0, 1.0, 0.0))])
    losses = {r.n_fold: r.log_loss for r in log_loss(df, "n_fold").collect()}
    assert losses[0] == pytest.approx(-math.log(1e-15)) and losses[1] == 0
    assert log_loss(df).first()["log_loss"] == pytest.approx(-math.log(1e-15) / 2)


def brute_auc(rows, fold, k):
    pos = [ps[k - 1] for _, f, t, ps in rows if f == fold and t == k]
    neg = [ps[k - 1] for _, f, t, ps in rows if f == fold and t != k]
    if not pos or not neg:
        return None
    return sum((a > b) + 0.5 * (a == b) for a, b in product(pos, neg)) / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_auc_equals_pair_counting_with_a_hot_tie(spark, buckets):
    """A third of all rows share one probability; the cuts must not change the result."""
    rng = random.Random(buckets)
    rows = []
    for i in range(300):
        p = 0.25 if i % 3 == 0 else rng.random() ** 4
        rows.append((i, i % 2, rng.choice([1, 2]), (p, (1 - p) / 2, (1 - p) / 2)))
    got = {(r.n_fold, r.label): r.roc_auc for r in roc_auc(oof(spark, rows), buckets).collect()}
    for fold, k in product((0, 1), (1, 2, 3)):
        want = brute_auc(rows, fold, k)
        assert got[fold, k] is None if want is None else got[fold, k] == pytest.approx(want, abs=1e-12)


def metrics_frame(spark, *rows):
    return spark.createDataFrame([(m, f, *[float(v)] * 6) for m, f, v in rows], EVAL_SCHEMA)


def as_map(df):
    return {(r.model_name, r.n_fold): r.log_loss for r in df.collect()}


def test_merge_replaces_adds_and_keeps(spark):
    old = metrics_frame(spark, ("a", 0, 1), ("a", 1, 2))
    new = metrics_frame(spark, ("a", 1, 5), ("b", 0, 6))
    assert as_map(merge_metrics(old, new)) == {("a", 0): 1, ("a", 1): 5, ("b", 0): 6}
    with pytest.raises(Exception, match="metrics given twice"):
        merge_metrics(old, new.unionByName(new)).collect()


def test_upsert_on_a_stored_table(spark):
    tables = dataset(spark)
    name = tables.name("eval")
    upsert_metrics(metrics_frame(spark, ("a", 0, 1), ("a", 1, 2)), name)
    upsert_metrics(metrics_frame(spark, ("a", 1, 5), ("b", 0, 6)), name)
    assert as_map(tables.read("eval")) == {("a", 0): 1, ("a", 1): 5, ("b", 0): 6}
    holes = metrics_frame(spark, ("c", 0, 1)).withColumn("recall", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="recall is NULL"):
        upsert_metrics(holes, name)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_evaluate_shape(spark):
    rows = [(i, i % 2, i % 3 + 1, (0.5, 0.3, 0.2)) for i in range(12)]
    out = evaluate(oof(spark, rows), "m", P)
    assert out.columns == ["model_name", "n_fold", *METRICS]
    assert [r.roc_auc for r in out.collect()] == [0.5, 0.5]


def random_oof(seed, n=200):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        weights = [rng.choice([0.1, rng.random()]) for _ in range(3)]
        rows.append((i, i % 2, rng.choice([1, 2, 3]), tuple(w / sum(weights) for w in weights)))
    return rows


def brute_metrics(rows, fold):
    rows = [r for r in rows if r[1] == fold]
    best = {i: max((1, 2, 3), key=lambda k: (ps[k - 1], -k)) for i, _, _, ps in rows}
    precision, recall, f1 = [], [], []
    for k in sorted({t for _, _, t, _ in rows}):
        tp = sum(t == k == best[i] for i, _, t, _ in rows)
        said, real = sum(best[i] == k for i, *_ in rows), sum(t == k for _, _, t, _ in rows)
        precision.append(tp / said if said else 0.0)
        recall.append(tp / real)
        f1.append(2 * tp / (said + real))
    areas = [a for k in (1, 2, 3) if (a := brute_auc(rows, fold, k)) is not None]
    mean = lambda values: sum(values) / len(values)
    return {
        "precision": mean(precision),
        "recall": mean(recall),
        "accuracy": mean([t == best[i] for i, _, t, _ in rows]),
        "f1_score": mean(f1),
        "log_loss": mean([-math.log(max(ps[t - 1], 1e-15)) for _, _, t, ps in rows]),
        "roc_auc": mean(areas),
    }


def test_metrics_of_several_models_by_definition(spark):
    made = {f"m{s}": random_oof(s) for s in (1, 2, 3)}
    made["sure"] = [(i, i % 2, 1, (1.0, 0.0, 0.0)) for i in range(6)]
    got = {(r.model_name, r.n_fold): r for r in evaluate_models({n: oof(spark, rows) for n, rows in made.items()}, P, 5).collect()}
    assert set(got) == set(product(made, (0, 1)))
    for (name, fold), row in got.items():
        if name != "sure":
            want = brute_metrics(made[name], fold)
            assert {m: row[m] for m in METRICS} == pytest.approx(want, abs=1e-12)
    assert got["sure", 0].roc_auc == 0.5 and got["sure", 0].accuracy == 1 and got["sure", 0].log_loss == 0


def test_every_table_is_read_once(spark):
    tables = dataset(spark)
    for name in ("a", "b"):
        tables.insert_frame(oof(spark, random_oof(1)), name)
    plan = tally({n: tables.read(n) for n in ("a", "b")}, P)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    files = evaluate_models({n: tables.read(n) for n in ("a", "b")}, P).inputFiles()
    assert files and all("/tally-" in f for f in files)


def test_a_label_without_probability_ranks_lowest(spark):
    rows = [(1, 0, 1, (0.9, 0.1, 0.0)), (2, 0, 2, (0.2, 0.8, 0.0)), (3, 0, 1, (None, 0.6, 0.4))]
    got = evaluate(oof(spark, rows).filter("prob IS NOT NULL"), "m", P).first()
    # class 1: one positive above the negative, one below; class 2: 0.8 above 0.6 and 0.1
    assert got.roc_auc == pytest.approx((0.5 + 1) / 2) and got.accuracy == pytest.approx(2 / 3)
    assert got.log_loss == pytest.approx(-(math.log(0.9) + math.log(0.8) + math.log(1e-15)) / 3)


def test_no_rows_give_no_metrics(spark):
    assert evaluate(oof(spark, [(1, 0, 1, (1.0, 0.0, 0.0))]).limit(0), "m", P).count() == 0


def test_two_writers_of_one_key_leave_one_whole_row(spark):
    from foldwise.operators.classifiers import concurrently
    from foldwise.operators.metrics import compact_metrics

    tables = dataset(spark)
    name = tables.name("eval")
    upsert_metrics(metrics_frame(spark, ("b", 0, 6)), name)
    concurrently(spark, lambda i: upsert_metrics(metrics_frame(spark, ("a", 0, i), ("a", 1, i)), name), range(1, 9), 8)
    rows = {(r.model_name, r.n_fold): {r[m] for m in METRICS} for r in tables.read("eval").collect()}
    assert sorted(rows) == [("a", 0), ("a", 1), ("b", 0)] and rows["a", 0] == rows["a", 1] and len(rows["a", 0]) == 1
    compact_metrics(spark, name)
    assert {(r.model_name, r.n_fold): {r[m] for m in METRICS} for r in tables.read("eval").collect()} == rows
    assert spark.table(tables.name("eval_log")).count() == 3
