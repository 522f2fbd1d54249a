"""From the two input tables to the feature views the models read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.columns import class_number, fold_number, is_eval, log_count
from foldwise.schema import Problem


def labelled(train: DataFrame, problem: Problem) -> DataFrame:
    """``id, n_fold, target, features``: text label to number, fold from the id, one projection.

    An id that is NULL or negative has no fold and raises.
    """
    key = F.col("id").cast("bigint")
    known = F.when(key >= 0, key).otherwise(F.raise_error(F.lit("a labelled id is NULL or negative")).cast("bigint"))
    return train.select(
        known.alias("id"),
        fold_number(known, problem.n_folds).alias("n_fold"),
        class_number(F.col("target")).alias("target"),
        *problem.features,
    )


def feature_columns(features, log: bool = False) -> list[Column]:
    """Raw or ln(x + 1) feature columns under their own names."""
    return [log_count(F.col(c)).alias(c) if log else F.col(c) for c in features]


def log_view(df: DataFrame, features) -> DataFrame:
    """Replace the features by their logarithm and keep every other column, in place and in order."""
    chosen = set(features)
    return df.select(*[log_count(F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns])


def all_features(train: DataFrame, test: DataFrame, features, log: bool = False) -> DataFrame:
    """Features of both tables, for steps that need no label."""
    return train.select(*feature_columns(features, log)).unionByName(test.select(*feature_columns(features, log)))


def split_flag(df: DataFrame, fold: int, problem: Problem) -> DataFrame:
    """Training input of one fold with the evaluation flag in front and the id left out."""
    return df.select(is_eval(F.col("id"), fold, problem.n_folds).alias("is_eval"), "target", *problem.features)


def repeated_ids(df: DataFrame) -> DataFrame:
    """Ids that occur more than once; only ids are shuffled, counted on the way."""
    return df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def fit_part(df: DataFrame, fold: int) -> DataFrame:
    return df.filter(F.col("n_fold") != fold)


def eval_part(df: DataFrame, fold: int) -> DataFrame:
    return df.filter(F.col("n_fold") == fold)
