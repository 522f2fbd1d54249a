"""Second-level features: one row per id, one probability column per first-level table and class."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.columns import is_eval, required
from foldwise.functions.features import labelled
from foldwise.operators.predict import to_arrays, union_all
from foldwise.schema import Problem, oof_name

FEW_TABLES = 4  # with a join each


def joined_arrays(template: DataFrame, tables: dict[str, DataFrame], problem: Problem) -> DataFrame:
    """``template`` with one array of class probabilities per table, left-joined on ``id``.

    The long tables are stacked and dealt by ``id`` once; grouping by id and table, grouping by id and the one join reuse that.
    A task so keeps the same few buffers however many tables there are; a join for each table keeps one to group it and one to
    sort it, all at the same time. That is little for a few tables, which are joined one by one: those stored in buckets of ``id`` in place.
    """
    if len(tables) <= FEW_TABLES:
        sides = [to_arrays(long.select("id", "label", "prob"), problem, "id", out=name) for name, long in tables.items()]
        return reduce(lambda left, right: left.join(right, "id", "left"), sides, template)
    long = union_all([t.select("id", F.lit(i).alias("_table"), "label", "prob") for i, t in enumerate(tables.values())])
    arrays = to_arrays(long.repartition("id"), problem, "id", "_table", out="_probs")
    sides = arrays.groupBy("id").agg(*[F.max(F.when(F.col("_table") == i, F.col("_probs"))).alias(t) for i, t in enumerate(tables)])
    return template.join(sides, "id", "left")


def feature_names(tables, problem: Problem) -> list[str]:
    return [f"{t}_Class_{k}" for t in tables for k in problem.labels]


def _columns(tables, problem: Problem):
    return [F.col(t)[i].alias(f"{t}_Class_{k}") for t in tables for i, k in enumerate(problem.labels)]


def wide_features(template: DataFrame, tables: dict[str, DataFrame], problem: Problem) -> DataFrame:
    """Template columns plus ``<table>_Class_k``. An id a table does not know gets NULL there."""
    joined = joined_arrays(template, tables, problem)
    return joined.select(*template.columns, *_columns(tables, problem))


def train_template(train: DataFrame, problem: Problem) -> DataFrame:
    return labelled(train, problem.with_features(()))


def renamed(test_tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Test tables under the out-of-fold names the second level was fitted with."""
    return {oof_name(name): long for name, long in test_tables.items()}


def stacking_train(train: DataFrame, oof_tables: dict[str, DataFrame], problem: Problem, fold: int) -> DataFrame:
    """Fit input of one fold: flag, label and features; the id is left out."""
    wide = wide_features(train_template(train, problem), oof_tables, problem)
    flagged = wide.withColumn("is_eval", is_eval(F.col("id"), fold, problem.n_folds))
    return flagged.select("is_eval", "target", *feature_names(oof_tables, problem))


def stacking_test(test: DataFrame, test_tables: dict[str, DataFrame], problem: Problem) -> DataFrame:
    return wide_features(test.select("id"), renamed(test_tables), problem)


def stacking_vectors(template: DataFrame, tables: dict[str, DataFrame], problem: Problem) -> DataFrame:
    """The same features as one vector, without ever being 126 columns. Missing predictions raise."""
    joined = joined_arrays(template, tables, problem)
    checked = [required(F.col(t), f"an id has no prediction in {t}") for t in tables]
    return joined.select(*template.columns, array_to_vector(F.concat(*checked)).alias("features"))


def missing_predictions(template: DataFrame, tables: dict[str, DataFrame], problem: Problem) -> DataFrame:
    """How many ids of the template each table lacks or covers only in part."""
    joined = joined_arrays(template, tables, problem)
    holes = [
        F.count_if(F.col(t).isNull() | F.exists(t, lambda p: p.isNull())).alias(t) for t in tables
    ]
    counts = joined.agg(*holes)
    pairs = F.array(*[F.struct(F.lit(t).alias("table_name"), F.col(t).alias("n_missing")) for t in tables])
    return counts.select(F.inline(pairs))
