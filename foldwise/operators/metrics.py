"""Classification metrics per fold from out-of-fold tables, and the upserted metrics table."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwise.functions.columns import required
from foldwise.operators.predict import to_arrays, union_all
from foldwise.schema import EVAL_SCHEMA, METRICS, Problem
from foldwise.sources.scratch import add_partition, stored

EPS = 1e-15


def _surprise(prob: Column, eps: float = EPS) -> Column:
    return -F.ln(F.greatest(prob, F.lit(eps)))


def log_loss(oof: DataFrame, *keys: str, eps: float = EPS) -> DataFrame:
    """Mean negative log probability of the true class, over all rows or per key."""
    true_rows = oof.filter(F.col("label") == F.col("target"))
    return true_rows.groupBy(*keys).agg(F.avg(_surprise(F.col("prob"), eps)).alias("log_loss"))


def _decided(oof: DataFrame, problem: Problem) -> DataFrame:
    """One row per id: its probabilities, the class with the highest one (the smaller label of a tie), the surprise of its true class."""
    probs = F.col("probs")
    return to_arrays(oof, problem, "id", "n_fold", "target").select(
        "n_fold",
        "target",
        "probs",
        F.array_position(probs, F.array_max(probs)).cast("bigint").alias("predicted"),
        _surprise(F.get(probs, (F.col("target") - 1).cast("int"))).alias("surprise"),
    )


def outcomes(oof: DataFrame, problem: Problem) -> DataFrame:
    """Rows, and total surprise of the true class, per (fold, true class, predicted class)."""
    return _decided(oof, problem).groupBy("n_fold", "target", "predicted").agg(
        F.count(F.lit(1)).alias("n"), F.sum("surprise").alias("surprise")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def threshold_metrics(counts: DataFrame, keys: tuple[str, ...] = ("n_fold",)) -> DataFrame:
    """Accuracy, log loss and class-averaged precision, recall, F1 per fold from ``outcomes``.

    Averages run over the classes that occur as true class; a zero denominator counts as 0. The
    input has at most folds x classes^2 rows, or as many for each further key.
    """
    hit = F.col("target") == F.col("predicted")
    n = F.col("n")
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("target").alias("label"),
            F.when(hit, n).otherwise(none).alias("tp"),
            F.when(hit, none).otherwise(n).alias("fn"),
            none.alias("fp"),
            F.col("surprise").alias("surprise"),
        ),
        F.struct(
            F.col("predicted").alias("label"),
            none.alias("tp"),
            none.alias("fn"),
            F.when(hit, none).otherwise(n).alias("fp"),
            F.lit(0.0).alias("surprise"),
        ),
    )
    per_class = (
        counts.select(*keys, F.inline(sides))
        .groupBy(*keys, "label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "fn", "fp", "surprise")])
    )
    precision = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    present = F.col("tp") + F.col("fn") > 0
    rows = F.sum(F.col("tp") + F.col("fn"))
    return per_class.groupBy(*keys).agg(
        F.avg(F.when(present, precision)).alias("precision"),
        F.avg(F.when(present, recall)).alias("recall"),
        (F.sum("tp") / rows).alias("accuracy"),
        F.avg(F.when(present, f1)).alias("f1_score"),
        (F.sum("surprise") / rows).alias("log_loss"),
    )


def roc_auc(oof: DataFrame, buckets: int = 64) -> DataFrame:
    """Exact one-versus-rest area under the curve per (fold, label): ``n_fold, label, roc_auc``.

    Rows with the same probability are counted together before anything is sorted; these counts are stored, and ``oof`` is read once.
    NULL where a class has no positive or no negative row.
    """
    side = F.col("label") == F.col("target")
    tied = oof.groupBy("n_fold", "label", "prob").agg(F.count_if(side).alias("pos"), F.count_if(~side).alias("neg"))
    return areas(stored(tied, "tied"), ("n_fold", "label"), buckets)


def areas(tied: DataFrame, group: tuple[str, ...], buckets: int) -> DataFrame:
    """``group`` and the area under its curve, from the positive and negative rows of each probability.

    The different probabilities of a group are cut into value ranges of about equal size, so no
    window holds a whole class: the running sum inside a range starts from the sum of the ranges
    below it. The cuts only decide where a range ends, never the result. NULL is below every probability. Reads ``tied`` twice.
    """
    steps = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    # one row per group, buckets - 1 numbers each; only sketches are shuffled
    cuts = tied.groupBy(*group).agg(F.percentile_approx("prob", steps, F.lit(1000)).alias("cuts"))
    placed = tied.join(F.broadcast(cuts), list(group)).withColumn(
        "bucket", F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("prob"))), F.lit(0))
    ).drop("cuts")
    below = W.partitionBy(*group, "bucket").orderBy("prob").rowsBetween(W.unboundedPreceding, -1)
    inside = placed.withColumn("below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    # sums per range: pairs won inside the range, and what is needed to add the ranges below
    ranges = inside.groupBy(*group, "bucket").agg(
        F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("won"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
    )
    before = W.partitionBy(*group).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    shifted = ranges.withColumn("before", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    area = F.sum(F.col("won") + F.col("pos").cast("double") * F.col("before"))
    return shifted.groupBy(*group).agg(F.when(pairs > 0, area / pairs).alias("roc_auc"))


def tally(oof_tables: dict[str, DataFrame], problem: Problem) -> DataFrame:
    """What all metrics of all models follow from, in one read of each table and one shuffle of the counts.

    Two kinds of rows. ``curve``: positive and negative rows of (model, fold, label, prob). Others: rows (``pos``) and surprise of
    (model, fold, label, predicted), where ``label`` is the true class. An id that lacks a label counts with a NULL probability there.
    """
    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    nothing = F.lit(None).cast("bigint")

    def row(curve, label, predicted, prob, pos, neg, surprise):
        parts = {"curve": F.lit(curve), "label": label, "predicted": predicted, "prob": prob, "pos": pos, "neg": neg, "surprise": surprise}
        return F.struct(*[c.alias(name) for name, c in parts.items()])

    target = F.col("target").cast("bigint")
    rows = [row(False, target, F.col("predicted"), F.lit(None).cast("double"), one, none, F.col("surprise"))]
    for k in problem.labels:
        hit = target == k
        rows.append(row(True, F.lit(k).cast("bigint"), nothing, F.col("probs")[k - 1], F.when(hit, one).otherwise(none), F.when(hit, none).otherwise(one), F.lit(0.0)))
    parts = [
        _decided(oof, problem).select(F.lit(name).alias("model_name"), "n_fold", F.inline(F.array(*rows))) for name, oof in oof_tables.items()
    ]
    return union_all(parts).groupBy("model_name", "n_fold", "curve", "label", "predicted", "prob").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "surprise")])


def evaluate_models(oof_tables: dict[str, DataFrame], problem: Problem, buckets: int = 64) -> DataFrame:
    """One row per (model, fold) with all six metrics, in the shape of the metrics table.

    Each table is read once, all in one job; the counts are stored, split into curves and the few rows of classes, and the metrics read
    only them. ROC AUC is the mean over classes that have both positive and negative rows; a fold where no class has both gets 0.5, the
    value of an uninformative score. ``buckets`` cut each class as in ``areas``.
    """
    counts = stored(tally(oof_tables, problem), "tally", ("curve",))
    keys = ("model_name", "n_fold")
    classes = counts.filter(~F.col("curve")).select(*keys, F.col("label").alias("target"), "predicted", F.col("pos").alias("n"), "surprise")
    curves = areas(counts.filter("curve").select(*keys, "label", "prob", "pos", "neg"), (*keys, "label"), buckets)
    means = curves.groupBy(*keys).agg(F.coalesce(F.avg("roc_auc"), F.lit(0.5)).alias("roc_auc"))
    return threshold_metrics(classes, keys).join(means, list(keys)).select(*keys, *METRICS)


def evaluate(oof: DataFrame, model_name: str, problem: Problem, buckets: int = 64) -> DataFrame:
    """``evaluate_models`` of one table."""
    return evaluate_models({model_name: oof}, problem, buckets)


def merge_metrics(target: DataFrame, source: DataFrame) -> DataFrame:
    """Rows of ``source`` replace rows of ``target`` with the same (model, fold); the rest stays.

    A key that occurs twice in ``source`` has no defined result and raises.
    """
    keys = ["model_name", "n_fold"]
    copies = F.count(F.lit(1))
    checked = source.groupBy(*keys).agg(
        F.when(copies > 1, F.raise_error(F.concat(F.lit("metrics given twice for "), F.first("model_name"))))
        .otherwise(F.first(F.struct(*METRICS)))
        .alias("m")
    )
    fresh = checked.select(*keys, *[F.col("m")[m].alias(m) for m in METRICS])
    return target.join(fresh, keys, "left_anti").select(*EVAL_SCHEMA.names).unionByName(fresh)


def upsert_metrics(source: DataFrame, table: str) -> None:
    """Merge into a stored table by (model, fold).

    The table is a view over a log: each call adds its rows as one file in a partition of its own, and the last row of a key is the one that
    counts. So writers of the same key leave one whole row, and a call that dies leaves nothing.
    """
    spark = source.sparkSession
    create_metrics_table(spark, table)
    nothing = spark.createDataFrame([], EVAL_SCHEMA)
    rows = merge_metrics(nothing, source).select("model_name", "n_fold", *[required(F.col(m), f"metric {m} is NULL").alias(m) for m in METRICS])
    found = [tuple(r) for r in rows.collect()]  # models x folds
    if any(r[0] is None or r[1] is None for r in found):
        raise ValueError("metrics need a model_name and a n_fold")
    written = (time.time_ns(), uuid.uuid4().hex)
    if found:
        add_partition(spark, [(*r, *written) for r in found], f"{_ROW}, written bigint, writer string", _log(table))


_ROW = "model_name string, n_fold bigint, " + ", ".join(f"{m} double" for m in METRICS)


def _log(table: str) -> str:
    quoted = table.endswith("`")
    return table.rstrip("`") + "_log" + "`" * quoted


def create_metrics_table(spark, table: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_log(table)} ({_ROW}, written bigint, writer string) USING parquet PARTITIONED BY (writer)")
    last = ", ".join(f"last.{m} AS {m}" for m in METRICS)
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {table} AS SELECT model_name, n_fold, {last} FROM ("
        f"SELECT model_name, n_fold, max_by(struct({', '.join(METRICS)}), struct(written, writer)) AS last FROM {_log(table)} GROUP BY model_name, n_fold)"
    )


def compact_metrics(spark, table: str) -> None:
    """One file with the last rows instead of one per call. Rows that others add meanwhile stay: only what was read is dropped."""
    log = spark.table(_log(table))
    read = [r["writer"] for r in log.select("writer").distinct().collect()]
    key = ["model_name", "n_fold"]
    whole = F.struct(*METRICS, "written")
    last = log.filter(F.col("writer").isin(read)).groupBy(*key).agg(F.max_by(whole, F.struct("written", "writer")).alias("last")).select(*key, "last.*")
    rows = [(*r, uuid.uuid4().hex) for r in last.collect()]  # models x folds
    if rows:
        add_partition(spark, [(*r[:-1], rows[0][-1]) for r in rows], log.schema, _log(table))
    for writer in read:
        spark.sql(f"ALTER TABLE {_log(table)} DROP IF EXISTS PARTITION (writer = '{writer}')")
