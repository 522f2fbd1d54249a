"""Standardisation with population statistics of each fold's training rows."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.columns import doubles
from foldwise.schema import Problem


def _moments(df: DataFrame, vector: Column, *keys: str) -> DataFrame:
    """Count, mean and sum of squared deviations of a vector column, one row per key.

    The features travel as one vector: a pair of aggregates per column would leave code generation
    at this width. Partial aggregation leaves one small row per task and key to shuffle.
    """
    vectors = df.select(*keys, vector.alias("v"))
    summary = Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s")
    grouped = vectors.groupBy(*keys).agg(summary)
    n = F.col("s.count").cast("double")
    return grouped.select(
        *keys,
        n.alias("n"),
        vector_to_array("s.mean").alias("mean"),
        F.transform(vector_to_array("s.variance"), lambda v: v * (n - 1)).alias("m2"),
    )


def _scale(variance: Column, mean: Column) -> Column:
    """Square root of the variance; a feature that is constant up to rounding keeps scale 1."""
    std = F.sqrt(F.greatest(variance, F.lit(0.0)))
    return F.when(std <= F.abs(mean) * 1e-12, F.lit(1.0)).otherwise(std)


def fit_scaler(df: DataFrame, problem: Problem, vector: Column | None = None) -> DataFrame:
    """``n_fold, mean, std``: for fold k, statistics over the rows of every other fold.

    Reads the feature columns, or ``vector`` where they are already gathered.

    The table is read once. Each fold's moments are computed on its own rows and then merged into
    the statistics of the folds that train on it (parallel-variance update), so no row is copied.
    Everything after the first aggregate has folds x features rows.
    """
    gathered = array_to_vector(doubles(problem.features)) if vector is None else vector
    per_fold = _moments(df, gathered, "n_fold")
    folds = F.array(*[F.lit(k).cast("bigint") for k in problem.folds])
    users = per_fold.select(
        F.explode(F.filter(folds, lambda k: k != F.col("n_fold"))).alias("k"),
        "n",
        F.posexplode(F.arrays_zip("mean", "m2")).alias("position", "f"),
    )
    # at most n_folds - 1 parts per group
    parts = users.groupBy("k", "position").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("f.mean")) / F.sum("n")).alias("mean"),
        F.collect_list(F.struct("n", F.col("f.mean").alias("mean"), F.col("f.m2").alias("m2"))).alias("parts"),
    )
    total = F.aggregate(
        "parts",
        F.lit(0.0),
        lambda acc, p: acc + p["m2"] + p["n"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean")),
    )
    scaled = parts.select("k", "position", "mean", _scale(total / F.col("n"), F.col("mean")).alias("std"))
    ordered = F.array_sort(F.collect_list(F.struct("position", "mean", "std")))
    return scaled.groupBy(F.col("k").alias("n_fold")).agg(ordered.alias("p")).select(
        "n_fold", F.col("p.mean").alias("mean"), F.col("p.std").alias("std")
    )


def fit_scaler_all(df: DataFrame, features) -> DataFrame:
    """``mean, std`` over all rows, as one row."""
    whole = _moments(df, array_to_vector(doubles(features)))
    variance = F.transform("m2", lambda m: m / F.col("n"))
    std = F.zip_with(variance, F.col("mean"), _scale)
    return whole.select("mean", std.alias("std"))


def attach_fold_constants(df: DataFrame, params: DataFrame) -> DataFrame:
    """Add each row's fold parameters. ``params`` has one row per fold, so it is broadcast."""
    return df.join(F.broadcast(params), "n_fold")


def standardise(df: DataFrame, params: DataFrame, features) -> DataFrame:
    """(x - mean) / std with the parameters of the row's own fold; other columns pass through."""
    position = {c: i for i, c in enumerate(features)}
    joined = attach_fold_constants(df, params)
    return joined.select(
        *[
            ((F.col(c) - F.col("mean")[position[c]]) / F.col("std")[position[c]]).alias(c) if c in position else F.col(c)
            for c in df.columns
        ]
    )


def standardised_array(features, means, stds) -> Column:
    """The features as one standardised array, for parameters already on the driver."""
    return F.array(*[(F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(features, means, stds)])


def collect_scaler(params: DataFrame) -> dict[int, tuple[list[float], list[float]]]:
    """Fold parameters on the driver: folds x features x 2 numbers, whatever the data size."""
    return {int(r["n_fold"]): (list(r["mean"]), list(r["std"])) for r in params.collect()}
