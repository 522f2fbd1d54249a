"""Registration, and the SQL pieces the checks share."""

from __future__ import annotations

from string import ascii_lowercase

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

FEATS = [f"feat_{i}" for i in range(1, 27)]


def query(name: str, sql: str | None = None):
    """Register ``f(spark, sf_dir)`` under ``name``, with the SQL that must give the same rows."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Double columns to a fixed number of digits, without negative zero, for comparison."""
    return df.select(
        *[
            (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def r6(expression: str, name: str | None = None, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {name or expression}"


# WITH letters, train, test, lab

_COUNTS = ", ".join(f"(length(t) - length(replace(t, '{c}', '')))::DOUBLE AS feat_{i}" for i, c in enumerate(ascii_lowercase, 1))
_F = ", ".join(FEATS)

BASE = f"""WITH letters AS (
  SELECT id, target, unlabelled, {_COUNTS} FROM (
    SELECT doc_id AS id, lower(text) AS t, (doc_id // 5) % 5 = 0 AS unlabelled,
           'Class_' || list_position(['de', 'en', 'es', 'fr'], lang) AS target
    FROM documents)
), train AS (SELECT id, {_F}, target FROM letters WHERE NOT unlabelled
), test AS (SELECT id, {_F} FROM letters WHERE unlabelled
), lab AS (SELECT id, id % 5 AS n_fold, split_part(target, '_', 2)::BIGINT AS target, {_F} FROM train
)"""

_LOGS = "[" + ", ".join(f"ln(feat_{i} + 1)" for i in range(1, 27)) + "]"
_RAWS = "[" + _F + "]"


def softmax(source: str, inputs: str, n_inputs: int, n_classes: int, model: int = 0, fold: str = "n_fold", keys: str = "id, n_fold, target", by: str = "id") -> str:
    """Rows (keys, label, prob) of a rule-weighted softmax over a list expression."""
    weight = f"((31 * label + 17 * j + 7 * {fold} + 3 * {model}) % 13 - 6) / 100::DOUBLE"
    return f"""(SELECT {keys}, label, e / sum(e) OVER (PARTITION BY {by}) AS prob FROM (
      SELECT *, exp(z - max(z) OVER (PARTITION BY {by})) AS e FROM (
        SELECT *, list_inner_product({inputs}, list_transform(range(1, {n_inputs + 1}), lambda j: {weight})) AS z
        FROM {source}, (SELECT unnest(range(1, {n_classes + 1})) AS label))))"""


def oof_sql(model: int = 0) -> str:
    return softmax("lab", _LOGS, 26, 4, model)


def test_sql(model: int = 0) -> str:
    scored = softmax("(SELECT test.*, fold FROM test, (SELECT unnest(range(0, 5)) AS fold))", _LOGS, 26, 4, model, "fold", "id, fold", "id, fold")
    return f"(SELECT id, label, avg(prob) AS prob FROM {scored} GROUP BY id, label)"


# per fold: mean and population deviation over the rows of the other folds, long form

LONG = f"""{BASE}, long AS (
  SELECT id, n_fold, target, unnest(range(1, 27)) AS j, unnest({_RAWS}) AS x FROM lab
), scaler AS (
  SELECT k AS n_fold, j, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1 ELSE stddev_pop(x) END AS std
  FROM long, (SELECT unnest(range(0, 5)) AS k) WHERE n_fold <> k GROUP BY k, j
)"""
