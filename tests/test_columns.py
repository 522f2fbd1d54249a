import math

import pytest
from pyspark.sql import functions as F

from foldwise.functions.columns import (
    all_but,
    array_mean,
    class_index,
    class_last_digit_index,
    class_number,
    element,
    fold_number,
    is_eval,
    log_count,
    lookup,
)
from foldwise.functions.features import all_features, labelled, log_view, split_flag
from foldwise.schema import FIRST_LEVEL, Problem, Variant, oof_name

P = Problem(("feat_1", "feat_2"), n_classes=3)


def one(spark, column, value, ddl):
    return spark.createDataFrame([(value,)], f"x {ddl}").select(column(F.col("x")).alias("y")).first()["y"]


def test_class_number_takes_the_part_after_the_underscore(spark):
    assert one(spark, class_number, "Class_12", "string") == 12
    assert one(spark, class_index, "Class_12", "string") == 11
    assert one(spark, class_last_digit_index, "Class_7", "string") == 6


@pytest.mark.parametrize("bad", ["Class7", "Class_x", "", None])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_bad_label_raises(spark, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a class label"):
            one(spark, class_number, bad, "string")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_fold_and_flag(spark):
    rows = spark.createDataFrame([(0,), (7,), (-7,), (None,)], "id long")
    got = rows.select(fold_number(F.col("id")).alias("f"), is_eval(F.col("id"), 2).alias("e")).collect()
    assert [(r.f, r.e) for r in got] == [(0, False), (2, True), (-2, False), (None, False)]


def test_log_raises_outside_its_domain(spark):
    assert one(spark, log_count, 3.0, "double") == pytest.approx(math.log(4))
    assert one(spark, log_count, None, "double") is None
    with pytest.raises(Exception, match="above -1"):
        one(spark, log_count, -1.0, "double")


def test_element_raises_past_the_end_but_keeps_null(spark):
    assert one(spark, lambda c: element(c, 1), [1.0, None], "array<double>") is None
    with pytest.raises(Exception, match="no position 2"):
        one(spark, lambda c: element(c, 2), [1.0, 2.0], "array<double>")


def test_lookup_gives_null_for_an_absent_key(spark):
    pairs = [(1, 0.5), (2, 0.25)]
    assert one(spark, lambda c: lookup(c, "k", 2, "v"), pairs, "array<struct<k:int,v:double>>") == 0.25
    assert one(spark, lambda c: lookup(c, "k", 3, "v"), pairs, "array<struct<k:int,v:double>>") is None


def test_array_mean(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 6.0])], "a array<double>, b array<double>")
    assert df.select(array_mean([F.col("a"), F.col("b")], 2).alias("m")).first()["m"] == [2.0, 4.0]


def test_views(spark):
    train = spark.createDataFrame([(6, 1.0, 0.0, "Class_2")], "id long, feat_1 double, feat_2 double, target string")
    test = spark.createDataFrame([(9, 3.0, 1.0)], "id long, feat_1 double, feat_2 double")
    rows = labelled(train, P)
    assert rows.columns == ["id", "n_fold", "target", "feat_1", "feat_2"]
    assert rows.first().asDict() == {"id": 6, "n_fold": 1, "target": 2, "feat_1": 1.0, "feat_2": 0.0}
    assert log_view(rows, P.features).first()["feat_1"] == pytest.approx(math.log(2))
    assert all_features(train, test, P.features).count() == 2
    assert split_flag(rows, 1, P).first()[:2] == (True, 2)
    assert all_but(train, "id", "target") == ["feat_1", "feat_2"]


def test_variant_names():
    assert len(FIRST_LEVEL) == 14
    assert Variant("xgb", True, True).oof_table == "xgb_oof_kmeans_log_pred"
    assert Variant("dnn", False, True).model_name == "dnn_kmeans_model"
    assert oof_name("dnn_test_log_pred") == "dnn_oof_log_pred"
