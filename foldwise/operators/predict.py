"""Out-of-fold and fold-averaged predictions, and the long and wide forms of prediction tables.

A scorer is anything with ``probabilities(df, out)``: it adds one array column with the probability
of label 1, 2, ... and passes every input column through.
"""

from __future__ import annotations

from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.columns import array_mean, doubles
from foldwise.functions.features import eval_part
from foldwise.operators.network import Network, fold_output, mean_output, prob_structs
from foldwise.schema import Problem

PROBS = "predicted_target_probs"


class Scorer(Protocol):
    def probabilities(self, df: DataFrame, out: str) -> DataFrame: ...


def predict(df: DataFrame, scorer: Scorer, n_classes: int) -> DataFrame:
    """Input columns plus ``predicted_target_probs``, an array of (label, prob)."""
    scored = scorer.probabilities(df, "_p")
    return scored.select(*df.columns, prob_structs(F.col("_p"), n_classes).alias(PROBS))


def unnest(df: DataFrame, *keys: str, pairs: str = PROBS) -> DataFrame:
    """One row per (label, prob); rows with an empty array vanish.

    The array goes into the generator as an expression. For a bare column the optimizer adds a filter
    on its size, and where the column is computed that repeats the whole computation, models included.
    """
    return df.select(*keys, F.inline(F.coalesce(F.col(pairs), F.array())))


def long_rows(df: DataFrame, n_classes: int, *keys: str, probs: str = "probs") -> DataFrame:
    """One row per (label, prob) of an array of probabilities."""
    return df.select(*keys, F.inline(prob_structs(F.col(probs), n_classes)))


def unnest_positions(df: DataFrame, *keys: str, output: str = "output") -> DataFrame:
    """One row per array position, label = position + 1."""
    exploded = df.select(*keys, F.posexplode(F.coalesce(F.col(output), F.array())).alias("_i", "prob"))
    return exploded.select(*keys, (F.col("_i") + 1).cast("bigint").alias("label"), "prob")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def mean_over_folds(long: DataFrame) -> DataFrame:
    """Mean probability per (id, label) of stacked fold predictions."""
    return long.groupBy("id", "label").agg(F.avg("prob").alias("prob"))


def oof_arrays(view: DataFrame, scorers: dict[int, Scorer]) -> DataFrame:
    """``id, n_fold, target, probs``: every row scored once, by the model that did not train on it.

    A row of a fold without a model raises. From a view stored by fold, that part reads no file.
    """
    parts = [
        scorer.probabilities(eval_part(view, k), "probs").select("id", "n_fold", "target", "probs")
        for k, scorer in sorted(scorers.items())
    ]
    unknown = view.filter(~F.coalesce(F.col("n_fold").isin(*scorers), F.lit(False)))
    message = F.concat(F.lit("no model for fold "), F.coalesce(F.col("n_fold").cast("string"), F.lit("NULL")))
    parts.append(unknown.select("id", "n_fold", "target", F.raise_error(message).cast("array<double>").alias("probs")))
    return union_all(parts)


def oof_predictions(view: DataFrame, scorers: dict[int, Scorer], n_classes: int) -> DataFrame:
    return long_rows(oof_arrays(view, scorers), n_classes, "id", "n_fold", "target")


def test_arrays(view: DataFrame, scorers: dict[int, Scorer], n_classes: int) -> DataFrame:
    """``id, probs``: every row through all fold models in one pass, averaged in place.

    ``id`` is the key of the unlabelled table, so the mean over folds needs no shuffle. Tables whose
    ids repeat go through ``mean_over_folds``.
    """
    scored, names = view, []
    for k, scorer in sorted(scorers.items()):
        names.append(f"_p{k}")
        scored = scorer.probabilities(scored, names[-1])
    return scored.select("id", array_mean([F.col(n) for n in names], n_classes).alias("probs"))


def test_predictions(view: DataFrame, scorers: dict[int, Scorer], n_classes: int) -> DataFrame:
    return long_rows(test_arrays(view, scorers, n_classes), n_classes, "id")


def network_oof(view: DataFrame, networks: dict[int, Network], features) -> DataFrame:
    """Long out-of-fold table of an externally fitted network per fold: one pass, no union."""
    score = fold_output(view.sparkSession, networks)
    scored = view.select("id", "n_fold", "target", score(doubles(features), F.col("n_fold")).alias("probs"))
    return long_rows(scored, next(iter(networks.values())).n_outputs, "id", "n_fold", "target")


def network_test(view: DataFrame, networks: dict[int, Network], features) -> DataFrame:
    """Long test table, mean over the networks of all folds: one pass, no shuffle."""
    mean = mean_output(view.sparkSession, networks)
    scored = view.select("id", mean(doubles(features)).alias("probs"))
    return long_rows(scored, next(iter(networks.values())).n_outputs, "id")


def label_probs(labels) -> list[Column]:
    """Conditional maxima that turn long rows into one probability per label.

    Plain double aggregates: hash aggregation with map-side combining, one shuffle, fixed-size state
    however many rows share a key.
    """
    return [F.max(F.when(F.col("label") == k, F.col("prob"))) for k in labels]


def to_wide(long: DataFrame, problem: Problem, *keys: str, prefix: str = "") -> DataFrame:
    """Keys plus ``<prefix>Class_1..n``."""
    columns = [p.alias(f"{prefix}Class_{k}") for k, p in zip(problem.labels, label_probs(problem.labels))]
    return long.groupBy(*keys).agg(*columns)


def to_arrays(long: DataFrame, problem: Problem, *keys: str, out: str = "probs") -> DataFrame:
    """Keys plus one array with the probability of each label, in label order."""
    return long.groupBy(*keys).agg(F.array(*label_probs(problem.labels)).alias(out))


def submission(test_long: DataFrame, problem: Problem) -> DataFrame:
    return to_wide(test_long, problem, "id")
