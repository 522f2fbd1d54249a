"""Shapes shared by every module: the modelling problem, table schemas, model variants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Prediction tables and the metrics table never hold NULL; ``sources.tables.enforce`` checks it.
OOF_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("n_fold", T.LongType(), False),
        T.StructField("target", T.LongType(), False),
        T.StructField("label", T.LongType(), False),
        T.StructField("prob", T.DoubleType(), False),
    ]
)

TEST_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("label", T.LongType(), False),
        T.StructField("prob", T.DoubleType(), False),
    ]
)

METRICS = ("precision", "recall", "accuracy", "f1_score", "log_loss", "roc_auc")

EVAL_SCHEMA = T.StructType(
    [
        T.StructField("model_name", T.StringType(), False),
        T.StructField("n_fold", T.LongType(), False),
        *[T.StructField(m, T.DoubleType(), False) for m in METRICS],
    ]
)


@dataclass(frozen=True)
class Problem:
    """What is being modelled: the feature columns, how many classes (labels 1..n) and folds (0..n-1)."""

    features: tuple[str, ...]
    n_classes: int = 9
    n_folds: int = 5

    @property
    def labels(self) -> range:
        return range(1, self.n_classes + 1)

    @property
    def folds(self) -> range:
        return range(self.n_folds)

    def with_features(self, features) -> "Problem":
        return Problem(tuple(features), self.n_classes, self.n_folds)


@dataclass(frozen=True)
class Variant:
    """One first-level model: an estimator on one feature view, and the names of what it writes."""

    model: str
    log: bool = False
    kmeans: bool = False

    @property
    def suffix(self) -> str:
        return ("_kmeans" if self.kmeans else "") + ("_log" if self.log else "")

    @property
    def model_name(self) -> str:
        return f"{self.model}{self.suffix}_model"

    @property
    def oof_table(self) -> str:
        return f"{self.model}_oof{self.suffix}_pred"

    @property
    def test_table(self) -> str:
        return f"{self.model}_test{self.suffix}_pred"


VIEWS = ((False, False), (True, False), (False, True), (True, True))  # (log, kmeans)

# Three estimators on four views, and the standardising network on the two views without distances.
FIRST_LEVEL = tuple(Variant(m, log, km) for m in ("logistic", "dnn", "xgb") for log, km in VIEWS) + (
    Variant("nn", False, False),
    Variant("nn", True, False),
)


def oof_name(test_table: str) -> str:
    """Name under which a test prediction table enters the second level (its out-of-fold twin)."""
    return test_table.replace("test", "oof")
