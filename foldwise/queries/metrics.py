"""Metrics of out-of-fold tables and the metrics table."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise import fixtures as fx
from foldwise.operators.metrics import evaluate, log_loss, merge_metrics, outcomes, roc_auc, threshold_metrics, upsert_metrics
from foldwise.queries.base import BASE, oof_sql, query, r6, rounded
from foldwise.queries.scoring import linear_oof
from foldwise.queries.tables import dataset
from foldwise.schema import EVAL_SCHEMA, METRICS
from foldwise.sources.scratch import stored

P = fx.LETTERS
D = 10  # ratios of counts can lie exactly between two values at fewer digits


def _oof(model: int) -> str:
    return f"{BASE}, oof AS {oof_sql(model)}"


_PARTS = """, best AS (
  SELECT id, n_fold, target, arg_max(label, (prob, -label)) AS predicted, max(prob) FILTER (label = target) AS p_true
  FROM oof GROUP BY id, n_fold, target
), cls AS (
  SELECT f.n_fold, k AS label, count(*) FILTER (target = k AND predicted = k) AS tp,
         count(*) FILTER (target = k AND predicted <> k) AS fn, count(*) FILTER (target <> k AND predicted = k) AS fp
  FROM best f, (SELECT unnest(range(1, 5)) AS k) GROUP BY f.n_fold, k
), per_class AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS pr, CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS re,
         2 * tp / (2 * tp + fp + fn)::DOUBLE AS f1
  FROM cls WHERE tp + fn > 0
), thr AS (
  SELECT n_fold, avg(pr) AS precision, avg(re) AS recall, avg(f1) AS f1_score FROM per_class GROUP BY n_fold
), acc AS (
  SELECT n_fold, avg((target = predicted)::INT) AS accuracy, avg(-ln(greatest(p_true, 1e-15))) AS log_loss FROM best GROUP BY n_fold
), tied AS (
  SELECT n_fold, label, prob, count(*) FILTER (target = label) AS pos, count(*) FILTER (target <> label) AS neg FROM oof GROUP BY ALL
), below AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY n_fold, label ORDER BY prob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM tied
), auc AS (
  SELECT n_fold, label, CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(pos * (b + neg / 2.0)) / (sum(pos) * sum(neg)) END AS roc_auc FROM below GROUP BY n_fold, label
), ev AS (
  SELECT n_fold, precision, recall, accuracy, f1_score, log_loss, a.roc_auc
  FROM thr JOIN acc USING (n_fold) JOIN (SELECT n_fold, coalesce(avg(roc_auc), 0.5) AS roc_auc FROM auc GROUP BY n_fold) a USING (n_fold)
)"""

_SIX = ", ".join(r6(m, digits=D) for m in METRICS)


@query("log_loss_overall", f"{_oof(2)} SELECT round(avg(-ln(greatest(prob, 1e-15))), {D}) + 0.0 AS log_loss FROM oof WHERE label = target")
def log_loss_overall(spark, sf):
    return rounded(log_loss(linear_oof(spark, sf, 2)), D)


@query("confusion", f"{_oof(2)}{_PARTS} SELECT n_fold, target, predicted, count(*) AS n FROM best GROUP BY ALL")
def confusion(spark, sf):
    return outcomes(linear_oof(spark, sf, 2), P).select("n_fold", "target", "predicted", "n")


@query(
    "threshold_metrics",
    f"{_oof(2)}{_PARTS} SELECT n_fold, {', '.join(r6(m, digits=D) for m in METRICS if m != 'roc_auc')} FROM ev",
)
def threshold_metrics_query(spark, sf):
    return rounded(threshold_metrics(outcomes(linear_oof(spark, sf, 2), P)), D)


@query("roc_auc", f"{_oof(2)}{_PARTS} SELECT n_fold, label, {r6('roc_auc', digits=D)} FROM auc")
def roc_auc_query(spark, sf):
    return rounded(roc_auc(linear_oof(spark, sf, 2)), D)


@query("evaluate", f"{_oof(3)}{_PARTS} SELECT 'linear' AS model_name, n_fold, {_SIX} FROM ev")
def evaluate_query(spark, sf):
    return rounded(evaluate(linear_oof(spark, sf, 3), "linear", P), D)


_MERGED = f"""{_oof(3)}{_PARTS} SELECT * FROM (
  SELECT 'a' AS model_name, n_fold, {', '.join(f'CASE WHEN n_fold = 0 THEN 0.0 ELSE round({m}, {D}) + 0.0 END AS {m}' for m in METRICS)} FROM ev
  UNION ALL SELECT 'b', n_fold, {_SIX} FROM ev)"""


def _rows(spark, sf):
    rows = fx.once(spark, sf, "metrics-3", lambda: stored(rounded(evaluate(linear_oof(spark, sf, 3), "a", P), D), "metrics"))
    zeros = rows.filter("n_fold = 0").select("model_name", "n_fold", *[F.lit(0.0).alias(m) for m in METRICS])
    return rows, zeros, rows.withColumn("model_name", F.lit("b"))


@query("metrics_merge", _MERGED)
def metrics_merge(spark, sf):
    """Fold 0 of model a is replaced, model b is added, the rest stays."""
    rows, zeros, other = _rows(spark, sf)
    return merge_metrics(rows, zeros.unionByName(other)).select(*EVAL_SCHEMA.names)


@query("metrics_upsert", _MERGED)
def metrics_upsert(spark, sf):
    """The same on a stored table: three writes, each replacing only its own partitions."""
    rows, zeros, other = _rows(spark, sf)
    tables = dataset(spark)
    for part in (rows, other, zeros):
        upsert_metrics(part, tables.name("eval"))
    return tables.read("eval").select(*EVAL_SCHEMA.names)
