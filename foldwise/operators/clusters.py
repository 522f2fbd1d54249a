"""K-means on standardised features, and the distance to every centroid as features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.columns import all_but, doubles, lookup
from foldwise.functions.features import all_features
from foldwise.operators.distance_bounds import improved_by_bounds
from foldwise.operators.network import matrix_function
from foldwise.operators.scaling import fit_scaler_all, standardised_array
from foldwise.sources.scratch import stored

CLUSTER_SCHEMA = T.StructType(
    [
        T.StructField("centroid_id", T.LongType(), False),
        T.StructField("features", T.ArrayType(T.StringType(), False), False),
        T.StructField("mean", T.ArrayType(T.DoubleType(), False), False),
        T.StructField("std", T.ArrayType(T.DoubleType(), False), False),
        T.StructField("center", T.ArrayType(T.DoubleType(), False), False),
    ]
)


@dataclass(frozen=True)
class Clusters:
    """Centroids in the standardised space, with the statistics that lead there. Ids are 1..k."""

    features: tuple[str, ...]
    mean: np.ndarray
    std: np.ndarray
    centers: np.ndarray  # k x features

    @property
    def k(self) -> int:
        return len(self.centers)

    @property
    def distance_columns(self) -> list[str]:
        return [f"distance_{i}" for i in range(1, self.k + 1)]


def fit_clusters(
    train: DataFrame,
    test: DataFrame,
    features,
    k: int = 5,
    max_iter: int = 50,
    tol: float = 0.0008,
    seed: int = 7,
    log: bool = False,
) -> Clusters:
    """Fit on the features of both tables (no label is used).

    Scalable k-means++ start, Euclidean distance. Ends when a round improves the loss (the sum of squared distances)
    by less than ``tol`` of itself. A round compares only points whose centroid may have changed, see ``distance_bounds``.
    """
    points = all_features(train, test, features, log)
    scaler = fit_scaler_all(points, features).first()
    mean, std = np.array(scaler["mean"]), np.array(scaler["std"])
    arrays = stored(points.select(standardised_array(features, mean, std).alias("x")), "points")
    start = KMeans(k=k, initMode="k-means||", maxIter=1, seed=seed).fit(arrays.select(array_to_vector("x").alias("features")))
    found = improved_by_bounds(arrays, np.array(start.clusterCenters()), max_iter - 1, tol)
    return Clusters(tuple(features), mean, std, found.centers)


def clusters_table(spark, clusters: Clusters) -> DataFrame:
    rows = [
        (i + 1, list(clusters.features), clusters.mean.tolist(), clusters.std.tolist(), c.tolist())
        for i, c in enumerate(clusters.centers)
    ]
    return spark.createDataFrame(rows, CLUSTER_SCHEMA)


def read_clusters(table: DataFrame) -> Clusters:
    """Centroids on the driver: k rows of the feature width."""
    rows = table.orderBy("centroid_id").collect()
    if [r["centroid_id"] for r in rows] != list(range(1, len(rows) + 1)):
        raise ValueError("centroid ids must be 1..k")
    return Clusters(
        tuple(rows[0]["features"]),
        np.array(rows[0]["mean"]),
        np.array(rows[0]["std"]),
        np.array([r["center"] for r in rows]),
    )


def _distances(held, x: np.ndarray) -> np.ndarray:
    mean, std, centers = held
    z = (x - mean) / std
    return np.stack([np.sqrt(np.square(z - c).sum(axis=1)) for c in centers], axis=1)


def distances(df: DataFrame, clusters: Clusters) -> Column:
    """Distance to centroid 1..k as an array.

    In Arrow batches: at 93 features and 5 centroids the equivalent column expressions exceed what
    the JVM compiles well and took about five times as long.
    """
    shared = (clusters.mean, clusters.std, clusters.centers)
    return matrix_function(df.sparkSession, _distances, shared, len(clusters.features))(doubles(clusters.features))


def predict_clusters(df: DataFrame, clusters: Clusters) -> DataFrame:
    """Input columns plus the nearest centroid and the distance to each, nearest first."""
    ranked = F.array_sort(
        F.transform(F.col("_d"), lambda d, i: F.struct(d.alias("DISTANCE"), (i + 1).cast("bigint").alias("CENTROID_ID")))
    )
    pairs = F.transform(ranked, lambda p: F.struct(p["CENTROID_ID"].alias("CENTROID_ID"), p["DISTANCE"].alias("DISTANCE")))
    scored = df.withColumn("_d", distances(df, clusters)).withColumn("NEAREST_CENTROIDS_DISTANCE", pairs)
    return scored.select(
        *df.columns, F.col("NEAREST_CENTROIDS_DISTANCE")[0]["CENTROID_ID"].alias("CENTROID_ID"), "NEAREST_CENTROIDS_DISTANCE"
    )


def distance_features(predicted: DataFrame, k: int) -> DataFrame:
    """Replace the two prediction columns by ``distance_1..k``, looked up by centroid id."""
    kept = all_but(predicted, "CENTROID_ID", "NEAREST_CENTROIDS_DISTANCE")
    looked_up = [
        lookup(F.col("NEAREST_CENTROIDS_DISTANCE"), "CENTROID_ID", i, "DISTANCE").alias(f"distance_{i}") for i in range(1, k + 1)
    ]
    return predicted.select(*kept, *looked_up)


def add_distances(df: DataFrame, clusters: Clusters) -> DataFrame:
    """``distance_features(predict_clusters(df))`` without building the sorted pairs in between."""
    scored = df.withColumn("_d", distances(df, clusters))
    return scored.select(*df.columns, *[F.col("_d")[i].alias(c) for i, c in enumerate(clusters.distance_columns)])
