"""The driver's tables in the shape of the modelling problem.

Letters of a document predict its language: counts of a..z are the features, four languages the
classes. A document is unlabelled when ``floor(doc_id / 5) mod 5 = 0``, so folds stay balanced.
"""

from __future__ import annotations

from string import ascii_lowercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.operators.network import Dense, Network
from foldwise.schema import Problem
from foldwise.sources.scratch import stored

LETTERS = Problem(tuple(f"feat_{i}" for i in range(1, 27)), n_classes=4)
VECTORS = Problem(tuple(f"feat_{i}" for i in range(1, 65)), n_classes=10)
LANGUAGES = ("de", "en", "es", "fr")

_MADE: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build):
    """What ``build`` returns, built on first use in this session: stored tables and fitted models."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _MADE:
        _MADE[key] = build()
    return _MADE[key]


def made(spark: SparkSession, sf_dir: str, name: str) -> bool:
    return (spark.sparkContext.applicationId, sf_dir, name) in _MADE


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        (F.expr("floor(doc_id / 5)") % 5 == 0).alias("unlabelled"),
        F.concat(F.lit("Class_"), F.array_position(F.array(*[F.lit(x) for x in LANGUAGES]), F.col("lang"))).alias("target"),
        letter_counts(F.lower("text")).alias("counts"),
    )
    counts = [F.col("counts")[i].alias(f"feat_{i + 1}") for i in range(26)]
    return docs.select("id", "unlabelled", *counts, "target")


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def letter_counts(texts: pa.Array) -> pa.Array:
    """How often a..z occur in each text, which is read once for all letters; NULL for NULL. In UTF-8 no other character holds these bytes."""
    found = np.zeros((len(texts), 26))
    for i, text in enumerate(texts):
        if text.is_valid:
            found[i] = np.bincount(np.frombuffer(text.as_buffer(), np.uint8), minlength=256)[97:123]
    lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), 26).cast(pa.list_(pa.float64()))
    return pc.if_else(texts.is_valid(), lists, pa.scalar(None, lists.type))


def _stored_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counted documents as a table of the session, as a user has a table of features.

    Written on first use, split by the flag; every later query scans only the columns it needs.
    """
    return once(spark, sf_dir, "letters", lambda: stored(_letters(spark, sf_dir), "letters", ("unlabelled",)))


def letters_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_letters(spark, sf_dir).filter(~F.col("unlabelled")).drop("unlabelled")


def letters_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_letters(spark, sf_dir).filter("unlabelled").drop("unlabelled", "target")


def vectors_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as features. The labels are noise: for scoring, not for learning."""
    return load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        *[F.col("embedding")[i].cast("double").alias(f"feat_{i + 1}") for i in range(64)],
        F.concat(F.lit("Class_"), F.col("label") + 1).alias("target"),
    )


def orders_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer: number of lines by return flag and by line status. No label."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    wanted = [F.col("l_returnflag") == f for f in "ANR"] + [F.col("l_linestatus") == s for s in "FO"]
    counts = [F.count_if(c).cast("double").alias(f"feat_{i}") for i, c in enumerate(wanted, 1)]
    return joined.groupBy(F.col("o_custkey").alias("id")).agg(*counts)


def rule_weights(n_inputs: int, n_outputs: int, fold: int, model: int = 0) -> list[list[float]]:
    """Weights from a rule, inputs x outputs: ((31 k + 17 j + 7 fold + 3 model) mod 13 - 6) / 100."""
    return [
        [((31 * k + 17 * j + 7 * fold + 3 * model) % 13 - 6) / 100.0 for k in range(1, n_outputs + 1)]
        for j in range(1, n_inputs + 1)
    ]


def rule_hidden(n_inputs: int, n_units: int, fold: int) -> tuple[list[list[float]], list[float]]:
    """Hidden weights ((13 h + 29 j + 5 fold) mod 11 - 5) / 50 and biases ((7 h) mod 5 - 2) / 10."""
    weights = [[((13 * h + 29 * j + 5 * fold) % 11 - 5) / 50.0 for h in range(1, n_units + 1)] for j in range(1, n_inputs + 1)]
    return weights, [((7 * h) % 5 - 2) / 10.0 for h in range(1, n_units + 1)]


def linear_networks(problem: Problem, model: int = 0) -> dict[int, Network]:
    """One softmax layer per fold."""
    bias = np.zeros(problem.n_classes)
    return {
        k: Network((Dense(np.array(rule_weights(len(problem.features), problem.n_classes, k, model)), bias, "softmax"),))
        for k in problem.folds
    }


def hidden_networks(problem: Problem, n_units: int = 8) -> dict[int, Network]:
    """One rectified hidden layer and a softmax per fold."""
    out = {}
    for k in problem.folds:
        weights, bias = rule_hidden(len(problem.features), n_units, k)
        top = np.array(rule_weights(n_units, problem.n_classes, k))
        out[k] = Network((Dense(np.array(weights), np.array(bias), "relu"), Dense(top, np.zeros(problem.n_classes), "softmax")))
    return out
