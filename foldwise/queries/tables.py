"""Sources, sinks and table operations, each on a dataset of its own."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise import fixtures as fx
from foldwise.operators.predict import submission
from foldwise.operators.scaling import fit_scaler
from foldwise.queries.base import BASE, FEATS, LONG, oof_sql, query, r6, rounded, test_sql
from foldwise.queries.features import lab, scaler_rows
from foldwise.queries.scoring import linear_oof, linear_test
from foldwise.schema import OOF_SCHEMA
from foldwise.sources.models import load_scaler, save_scaler
from foldwise.sources.scratch import scratch_path
from foldwise.sources.tables import Tables, enforce, read_csv, write_csv

P = fx.LETTERS


def dataset(spark) -> Tables:
    """A new, empty dataset in the shared folder."""
    tables = Tables(spark, f"ds_{uuid.uuid4().hex[:12]}")
    tables.create_dataset(scratch_path(spark, tables.dataset))
    return tables


TRAIN_CSV = T.StructType(
    [T.StructField("id", T.LongType()), *[T.StructField(f, T.DoubleType()) for f in FEATS], T.StructField("target", T.StringType())]
)


@query("csv_source", f"{BASE} SELECT * FROM train")
def csv_source(spark, sf):
    path = scratch_path(spark, "train-csv")
    write_csv(fx.letters_train(spark, sf), path)
    return read_csv(spark, path, TRAIN_CSV)


@query("frame_to_table", f"{BASE} SELECT * FROM test")
def frame_to_table(spark, sf):
    tables = dataset(spark)
    tables.insert_frame(fx.letters_test(spark, sf), "test")
    return tables.read("test")


@query("declared_table", f"{BASE} SELECT id, n_fold, target, label, {r6('prob')} FROM {oof_sql()}")
def declared_table(spark, sf):
    """A prediction table with its declared schema, stored twice (replaced) in buckets of the id."""
    tables = dataset(spark)
    for _ in range(2):
        tables.replace(linear_oof(spark, sf), "oof_pred", OOF_SCHEMA, buckets=8)
    return rounded(tables.read("oof_pred"))


@query("not_null_checked", f"{BASE} SELECT id, n_fold, target, label, {r6('prob')} FROM {oof_sql(1)}")
def not_null_checked(spark, sf):
    """A declared table that no writer can put a NULL into, also after its rows were replaced."""
    tables = dataset(spark)
    tables.replace(enforce(linear_oof(spark, sf, 1), OOF_SCHEMA), "pred", OOF_SCHEMA)
    bad = "SELECT id, n_fold, target, label, CAST(NULL AS DOUBLE) AS prob FROM pred LIMIT 1"
    writers = (
        lambda: tables.append(tables.fetch(bad), "pred"),
        lambda: tables.insert_frame(tables.fetch(bad), "pred"),
        lambda: tables.insert_query("pred", bad, "WRITE_APPEND"),
        lambda: tables.insert_query("pred", bad),
        lambda: tables.replace(tables.fetch(bad), "pred", OOF_SCHEMA),
    )
    for write in writers:
        try:
            write()
        except Exception as error:
            if "column prob is NULL" not in str(error):
                raise
        else:
            raise AssertionError("a NULL was written into a required column")
        tables.insert_query("pred", "SELECT * FROM pred")
    return rounded(tables.read("pred"))


@query("write_modes", f"{BASE} SELECT id, count(*) AS n FROM (SELECT id FROM test UNION ALL SELECT id FROM test WHERE feat_1 > 100) GROUP BY id")
def write_modes(spark, sf):
    """Truncate replaces what was there, append adds, empty refuses a table with rows."""
    tables = dataset(spark)
    tables.insert_frame(fx.letters_test(spark, sf), "test")
    tables.insert_query("picked", "SELECT id FROM test WHERE feat_1 < 0", "WRITE_EMPTY")
    tables.insert_query("picked", "SELECT id FROM test")
    tables.insert_query("picked", "SELECT id FROM test WHERE feat_1 > 100", "WRITE_APPEND")
    try:
        tables.insert_query("picked", "SELECT id FROM test", "WRITE_EMPTY")
    except ValueError:
        return tables.read("picked").groupBy("id").agg(F.count("*").alias("n"))
    raise AssertionError("a table with rows was written as if it were empty")


EVENTS = {
    "schema": {
        "fields": [
            {"name": "event_id", "type": "INTEGER", "mode": "REQUIRED"},
            {"name": "user_id", "type": "INTEGER", "mode": "REQUIRED"},
            {"name": "event_type", "type": "STRING", "mode": "NULLABLE"},
            {"name": "value", "type": "FLOAT", "mode": "NULLABLE"},
            {"name": "day", "type": "DATE", "mode": "REQUIRED"},
        ]
    },
    "timePartitioning": {"field": "day"},
    "clustering": {"fields": ["user_id"], "buckets": 4},
}


@query(
    "partitioned_table",
    "SELECT event_type, count(*) AS n, round(sum(value), 4) + 0.0 AS total, count(DISTINCT ts::DATE) AS days FROM events GROUP BY event_type",
)
def partitioned_table(spark, sf):
    """A table from a schema dictionary, partitioned by day and clustered by user."""
    tables = dataset(spark)
    tables.create("events", EVENTS, "events by day")
    rows = fx.load(spark, sf, "events").withColumn("day", F.to_date("ts"))
    tables.append(rows.repartition("day"), "events")
    found = tables.read("events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("value").alias("total"), F.count_distinct("day").alias("days")
    )
    return rounded(found, 4)


@query("load_date_table", "SELECT event_type, count(*) AS n, round(sum(value), 4) + 0.0 AS total FROM events GROUP BY event_type")
def load_date_table(spark, sf):
    """A table partitioned by the day its rows come in, which its columns do not show; all of them came today or, past midnight, yesterday."""
    tables = dataset(spark)
    tables.create("events", {**EVENTS, "timePartitioning": {"type": "DAY"}})
    tables.append(fx.load(spark, sf, "events").withColumn("day", F.to_date("ts")), "events")
    today = F.current_date()
    found = tables.loaded("events", F.date_sub(today, 1), today)
    return rounded(found.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")), 4)


@query("copied_table", f"{BASE} SELECT * FROM test")
def copied_table(spark, sf):
    source, target = dataset(spark), dataset(spark)
    source.insert_frame(fx.letters_test(spark, sf), "test")
    target.insert_frame(spark.range(3), "test")
    source.copy("test", target)
    return target.read("test")


@query(
    "table_lifecycle",
    f"""{BASE} SELECT false AS before, true AS created, count(*) AS n, 'letters, "unlabelled" it''s' AS description, false AS after FROM test""",
)
def table_lifecycle(spark, sf):
    tables = dataset(spark)
    before = tables.exists("test")
    tables.insert_frame(fx.letters_test(spark, sf), "test")
    tables.set_description("test", 'letters, "unlabelled" it\'s')
    created, text, n = tables.exists("test"), tables.description("test"), tables.read("test").count()
    tables.delete("test")
    tables.delete("test")
    row = (before, created, n, text, tables.exists("test"))
    return spark.createDataFrame([row], "before boolean, created boolean, n bigint, description string, after boolean")


@query("query_in_dataset", f"{BASE} SELECT id % 5 AS fold, count(*) AS n, sum(feat_5) AS e FROM test GROUP BY id % 5")
def query_in_dataset(spark, sf):
    tables = dataset(spark)
    tables.insert_frame(fx.letters_test(spark, sf), "test")
    return tables.fetch("SELECT id % 5 AS fold, count(*) AS n, sum(feat_5) AS e FROM test GROUP BY id % 5")


_CLASSES = ", ".join(f"round(max(prob) FILTER (label = {k}), 6) + 0.0 AS Class_{k}" for k in P.labels)


@query("submission_csv", f"{BASE} SELECT id, {_CLASSES} FROM {test_sql()} GROUP BY id")
def submission_csv(spark, sf):
    path = scratch_path(spark, "submission")
    wide = submission(linear_test(spark, sf), P)
    write_csv(wide, path)
    return rounded(read_csv(spark, path, wide.schema))


@query("stored_scaler", f"{LONG} SELECT n_fold, j AS position, round(mean, 8) AS mean, round(std, 8) AS std FROM scaler")
def stored_scaler(spark, sf):
    path = scratch_path(spark, "scaler")
    save_scaler(fit_scaler(lab(spark, sf), P), path)
    return rounded(scaler_rows(load_scaler(spark, path)), 8)
