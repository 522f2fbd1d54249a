"""Labels, folds, feature views, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise import fixtures as fx
from foldwise.functions.columns import all_but, class_index, class_last_digit_index, doubles, element
from foldwise.functions.features import all_features, eval_part, feature_columns, fit_part, labelled, log_view, split_flag
from foldwise.operators.scaling import attach_fold_constants, fit_scaler, fit_scaler_all, standardise
from foldwise.queries.base import BASE, FEATS, LONG, query, r6, rounded

P = fx.LETTERS
_F = ", ".join(FEATS)


def lab(spark, sf):
    return labelled(fx.letters_train(spark, sf), P)


@query("labels_and_folds", f"{BASE} SELECT id, n_fold, target FROM lab")
def labels_and_folds(spark, sf):
    return lab(spark, sf).select("id", "n_fold", "target")


@query(
    "zero_based_labels",
    f"{BASE} SELECT id, target - 1 AS by_split, right('Class_' || target, 1)::BIGINT - 1 AS by_last_character FROM lab",
)
def zero_based_labels(spark, sf):
    target = F.col("target")
    return fx.letters_train(spark, sf).select(
        "id", class_index(target).alias("by_split"), class_last_digit_index(target).alias("by_last_character")
    )


@query("feature_table_train", f"{BASE} SELECT * FROM train")
def feature_table_train(spark, sf):
    return fx.letters_train(spark, sf)


@query("feature_table_test", f"{BASE} SELECT * FROM test")
def feature_table_test(spark, sf):
    return fx.letters_test(spark, sf)


@query("log_features", f"{BASE} SELECT id, n_fold, target, " + ", ".join(r6(f"ln({f} + 1)", f) for f in FEATS) + " FROM lab")
def log_features(spark, sf):
    return rounded(log_view(lab(spark, sf), P.features))


@query("features_by_exclusion", f"{BASE} SELECT {_F} FROM train")
def features_by_exclusion(spark, sf):
    train = fx.letters_train(spark, sf)
    return train.select(*all_but(train, "id", "target"))


@query("split_flag", f"{BASE} SELECT n_fold = 2 AS is_eval, target, {_F} FROM lab")
def split_flag_query(spark, sf):
    return split_flag(lab(spark, sf), 2, P)


@query("fold_parts", f"{BASE} SELECT id, CASE WHEN n_fold = 2 THEN 'eval' ELSE 'fit' END AS side FROM lab")
def fold_parts(spark, sf):
    """Both sides of one split."""
    folds = lab(spark, sf)
    return fit_part(folds, 2).select("id", F.lit("fit").alias("side")).unionByName(
        eval_part(folds, 2).select("id", F.lit("eval").alias("side"))
    )


@query(
    "all_features_log",
    f"{BASE} SELECT {', '.join(r6(f'ln({f} + 1)', f) for f in FEATS)} FROM (SELECT {_F} FROM train UNION ALL SELECT {_F} FROM test)",
)
def all_features_log(spark, sf):
    return rounded(all_features(fx.letters_train(spark, sf), fx.letters_test(spark, sf), P.features, log=True))


@query("array_positions", f"{BASE} SELECT id, 26::BIGINT AS n, feat_1 AS first, feat_26 AS last FROM test")
def array_positions(spark, sf):
    features = fx.letters_test(spark, sf).select("id", doubles(P.features).alias("x"))
    x = F.col("x")
    return features.select("id", F.size(x).cast("bigint").alias("n"), element(x, 0).alias("first"), element(x, 25).alias("last"))


def scaler_rows(params):
    return params.select("n_fold", F.posexplode(F.arrays_zip("mean", "std")).alias("i", "p")).select(
        "n_fold", (F.col("i") + 1).cast("bigint").alias("position"), F.col("p.mean").alias("mean"), F.col("p.std").alias("std")
    )


@query("fold_scaler", f"{LONG} SELECT n_fold, j AS position, round(mean, 8) AS mean, round(std, 8) AS std FROM scaler")
def fold_scaler(spark, sf):
    # a mean over 2^a 5^b rows ends after a few digits: round where it cannot lie halfway
    return rounded(scaler_rows(fit_scaler(lab(spark, sf), P)), 8)


_EMB = """WITH long AS (
  SELECT vec_id AS id, vec_id % 5 AS n_fold, unnest(range(1, 65)) AS j, unnest(embedding::DOUBLE[]) AS x FROM embeddings
), scaler AS (
  SELECT k AS n_fold, j, avg(x) AS mean, stddev_pop(x) AS std
  FROM long, (SELECT unnest(range(0, 5)) AS k) WHERE n_fold <> k GROUP BY k, j
)"""


@query("fold_scaler_vectors", f"{_EMB} SELECT n_fold, j AS position, {r6('mean')}, {r6('std')} FROM scaler")
def fold_scaler_vectors(spark, sf):
    return rounded(scaler_rows(fit_scaler(labelled(fx.vectors_train(spark, sf), fx.VECTORS), fx.VECTORS)))


@query(
    "standardised",
    f"""{LONG} SELECT id, n_fold, target, {', '.join(f'max(z) FILTER (j = {i}) AS feat_{i}' for i in range(1, 27))}
    FROM (SELECT id, n_fold, target, j, round((x - mean) / std, 6) + 0.0 AS z FROM long JOIN scaler USING (n_fold, j))
    GROUP BY id, n_fold, target""",
)
def standardised(spark, sf):
    rows = lab(spark, sf)
    return rounded(standardise(rows, fit_scaler(rows, P), P.features))


@query(
    "standardised_vectors",
    f"""{_EMB} SELECT id, n_fold, {', '.join(f'max(z) FILTER (j = {i}) AS feat_{i}' for i in range(1, 65))}
    FROM (SELECT id, n_fold, j, round((x - mean) / std, 6) + 0.0 AS z FROM long JOIN scaler USING (n_fold, j)) GROUP BY id, n_fold""",
)
def standardised_vectors(spark, sf):
    rows = labelled(fx.vectors_train(spark, sf), fx.VECTORS).drop("target")
    return rounded(standardise(rows, fit_scaler(rows, fx.VECTORS), fx.VECTORS.features))


@query(
    "fold_constants",
    f"""{LONG} SELECT id, n_fold, round(m.mean, 8) AS mean_1, round(m.std, 8) AS std_1
    FROM lab JOIN (SELECT * FROM scaler WHERE j = 1) m USING (n_fold)""",
)
def fold_constants(spark, sf):
    rows = lab(spark, sf)
    joined = attach_fold_constants(rows.select("id", "n_fold"), fit_scaler(rows, P))
    return rounded(joined.select("id", "n_fold", element(F.col("mean"), 0).alias("mean_1"), element(F.col("std"), 0).alias("std_1")), 8)


_ORDERS = """WITH counts AS (
  SELECT o_custkey AS id, """ + ", ".join(
    f"count(*) FILTER ({c})::DOUBLE AS feat_{i}"
    for i, c in enumerate(["l_returnflag = 'A'", "l_returnflag = 'N'", "l_returnflag = 'R'", "l_linestatus = 'F'", "l_linestatus = 'O'"], 1)
) + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)"

ORDER_FEATURES = tuple(f"feat_{i}" for i in range(1, 6))


@query("customer_log_counts", f"{_ORDERS} SELECT id, {', '.join(r6(f'ln({f} + 1)', f) for f in ORDER_FEATURES)} FROM counts")
def customer_log_counts(spark, sf):
    """Count features of every customer from the order lines, as a log view."""
    return rounded(fx.orders_counts(spark, sf).select("id", *feature_columns(ORDER_FEATURES, log=True)))


@query(
    "customer_scaler",
    f"""{_ORDERS}, long AS (SELECT unnest(range(1, 6)) AS position, unnest([{', '.join(ORDER_FEATURES)}]) AS x FROM counts)
    SELECT position, {r6('avg(x)', 'mean')}, {r6('stddev_pop(x)', 'std')} FROM long GROUP BY position""",
)
def customer_scaler(spark, sf):
    params = fit_scaler_all(fx.orders_counts(spark, sf), ORDER_FEATURES)
    return rounded(scaler_rows(params.withColumn("n_fold", F.lit(0))).drop("n_fold"))
