"""Wide tables: submissions and second-level features from fourteen first-level tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise import fixtures as fx
from foldwise.operators.classifiers import concurrently
from foldwise.operators.predict import submission, to_arrays
from foldwise.operators.stacking import (
    feature_names,
    missing_predictions,
    stacking_test,
    stacking_train,
    train_template,
    wide_features,
)
from foldwise.queries.base import BASE, oof_sql, query, rounded, test_sql
from foldwise.queries.scoring import linear_oof, linear_test
from foldwise.schema import FIRST_LEVEL

P = fx.LETTERS
OOF_NAMES = [v.oof_table for v in FIRST_LEVEL]


def _side_by_side(spark, sf, one) -> list:
    fx.letters_train(spark, sf)
    return concurrently(spark, lambda i: one(spark, sf, i), range(len(FIRST_LEVEL)), 8)


def oof_tables(spark, sf):
    return dict(zip([v.oof_table for v in FIRST_LEVEL], _side_by_side(spark, sf, linear_oof)))


def test_tables(spark, sf):
    return dict(zip([v.test_table for v in FIRST_LEVEL], _side_by_side(spark, sf, linear_test)))


def _wide(long: str, prefix: str = "") -> str:
    columns = ", ".join(f"round(max(prob) FILTER (label = {k}), 6) + 0.0 AS {prefix}Class_{k}" for k in P.labels)
    return f"(SELECT id, {columns} FROM {long} GROUP BY id)"


def _joined(template: str, one) -> str:
    joins = " ".join(f"LEFT JOIN {_wide(one(i), name + '_')} USING (id)" for i, name in enumerate(OOF_NAMES))
    return f"{template} {joins}"


_NAMES = ", ".join(feature_names(OOF_NAMES, P))


@query("submission_wide", f"{BASE} SELECT * FROM {_wide(test_sql())}")
def submission_wide(spark, sf):
    return rounded(submission(linear_test(spark, sf), P))


@query(
    "class_order",
    f"""{BASE} SELECT id, round(p[1], 6) + 0.0 AS first, round(p[4], 6) + 0.0 AS last, len(p)::BIGINT AS n
    FROM (SELECT id, list(prob ORDER BY label) AS p FROM {test_sql()} GROUP BY id)""",
)
def class_order(spark, sf):
    """One array per id in label order, by position instead of by sorting."""
    arrays = to_arrays(linear_test(spark, sf), P, "id")
    p = F.col("probs")
    return rounded(arrays.select("id", p[0].alias("first"), p[3].alias("last"), F.size(p).cast("bigint").alias("n")))


@query("stacking_train", f"{BASE} SELECT n_fold = 1 AS is_eval, target, {_NAMES} FROM {_joined('lab', oof_sql)}")
def stacking_train_query(spark, sf):
    return rounded(stacking_train(fx.letters_train(spark, sf), oof_tables(spark, sf), P, 1))


@query("stacking_test", f"{BASE} SELECT id, {_NAMES} FROM {_joined('test', test_sql)}")
def stacking_test_query(spark, sf):
    return rounded(stacking_test(fx.letters_test(spark, sf), test_tables(spark, sf), P))


_HOLED = f"(SELECT * FROM {oof_sql(1)} WHERE id IN (SELECT doc_id FROM labels))"


def holed_tables(spark, sf):
    """Table a knows every document, table b only those somebody has judged."""
    judged = fx.load(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return {"a": linear_oof(spark, sf, 0), "b": linear_oof(spark, sf, 1).join(judged, "id", "left_semi")}



@query(
    "stacking_left_join_gaps",
    f"""{BASE} SELECT id, n_fold, target, a_Class_1, b_Class_1 FROM lab
    LEFT JOIN {_wide(oof_sql(0), 'a_')} USING (id) LEFT JOIN {_wide(_HOLED, 'b_')} USING (id)""",
)
def stacking_left_join_gaps(spark, sf):
    """An id that one table lacks keeps its row and has no value there."""
    wide = wide_features(train_template(fx.letters_train(spark, sf), P), holed_tables(spark, sf), P)
    return rounded(wide.select("id", "n_fold", "target", "a_Class_1", "b_Class_1"))


@query(
    "stacking_missing",
    f"{BASE} SELECT 'a' AS table_name, 0::BIGINT AS n_missing UNION ALL SELECT 'b', count(*) FILTER (id NOT IN (SELECT doc_id FROM labels)) FROM lab",
)
def stacking_missing(spark, sf):
    return missing_predictions(train_template(fx.letters_train(spark, sf), P), holed_tables(spark, sf), P)
