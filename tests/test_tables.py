import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.queries.tables import EVENTS, dataset
from foldwise.schema import TEST_SCHEMA
from foldwise.sources.models import Models
from foldwise.sources.scratch import remove, scratch_path, stored
from foldwise.sources.tables import enforce, read_csv, schema_of, write_csv


def test_not_null_is_enforced_on_write(spark):
    good = spark.createDataFrame([(1, 1, 0.5)], "id int, label int, prob double")
    assert enforce(good, TEST_SCHEMA).schema["id"].dataType == T.LongType()
    tables = dataset(spark)
    bad = good.withColumn("prob", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="column prob is NULL"):
        tables.replace(bad, "pred", TEST_SCHEMA)


def test_created_table_keeps_its_declaration(spark):
    tables = dataset(spark)
    tables.create("events", EVENTS, "by day")
    assert tables.description("events") == "by day"
    nullable = {f.name: f.nullable for f in tables.schema("events").fields}
    assert nullable == {"event_id": False, "user_id": False, "event_type": True, "value": True, "day": False}
    row = (1, 2, "x", 1.0, datetime.date(2024, 1, 2))
    ddl = "event_id long, user_id long, event_type string, value double, day date"
    tables.append(spark.createDataFrame([row], ddl), "events")
    assert tuple(tables.read("events").first()) == row
    with pytest.raises(Exception, match="user_id is NULL"):
        tables.append(spark.createDataFrame([(1, None, "x", 1.0, row[4])], ddl), "events")
    details = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {tables.name(tables.version('events'))}").collect()}
    assert details["Num Buckets"] == "4"


def test_partitioned_by_the_day_rows_came_in(spark):
    tables = dataset(spark)
    tables.create("events", {**EVENTS, "timePartitioning": {"type": "DAY"}})
    row = (1, 2, "x", 1.0, datetime.date(2024, 1, 2))
    frame = spark.createDataFrame([row], "event_id long, user_id long, event_type string, value double, day date")
    tables.append(frame, "events")
    tables.insert_frame(frame, "events")
    assert tables.read("events").columns == frame.columns and tables.read("events").count() == 2
    assert tables.fetch("SELECT * FROM events").columns == frame.columns
    today = spark.sql("SELECT current_date() AS d").first()["d"]
    assert tables.loaded("events", today, today).count() == 2
    before = tables.loaded("events", "2020-01-01", "2020-12-31")
    assert before.count() == 0 and "PartitionFilters: [isnotnull(_load_date" in before._jdf.queryExecution().executedPlan().toString()
    # an answer with new rows keeps partitions and declaration
    tables.insert_query("events", "SELECT * FROM events WHERE event_id = 1")
    assert tables.loaded("events", today, today).count() == 2 and not tables.schema("events")["day"].nullable
    with pytest.raises(ValueError, match="not partitioned by its load date"):
        dataset_with(tables, "plain", spark.range(3)).loaded("plain", today, today)


def dataset_with(tables, name, frame):
    tables.replace(frame, name)
    return tables


BAD = {
    "append": lambda t, q, df: t.append(df, "pred"),
    "insert_frame": lambda t, q, df: t.insert_frame(df, "pred"),
    "truncate": lambda t, q, df: t.insert_query("pred", q),
    "query append": lambda t, q, df: t.insert_query("pred", q, "WRITE_APPEND"),
}


@pytest.mark.parametrize("made", ["replace", "create", "copy"])
@pytest.mark.parametrize("writer", BAD)
def test_null_raises_through_every_writer(spark, made, writer):
    tables = dataset(spark)
    good = spark.createDataFrame([(1, 1, 0.5)], TEST_SCHEMA)
    if made == "create":
        fields = [{"name": n, "type": t, "mode": "REQUIRED"} for n, t in (("id", "INTEGER"), ("label", "INTEGER"), ("prob", "FLOAT"))]
        tables.create("pred", {"schema": {"fields": fields}})
        tables.append(good, "pred")
    else:
        tables.replace(good, "pred", TEST_SCHEMA)
    if made == "copy":
        source, tables = tables, dataset(spark)
        source.copy("pred", tables)
    query = "SELECT id, label, CAST(NULL AS DOUBLE) AS prob FROM pred"
    with pytest.raises(Exception, match="column prob is NULL"):
        BAD[writer](tables, query, tables.fetch(query))
    assert [tuple(r) for r in tables.read("pred").collect()] == [(1, 1, 0.5)]
    # the declaration outlives a truncation, and holds for the next writer
    tables.insert_query("pred", "SELECT prob + 0.25 AS prob, id, label FROM pred")
    assert [tuple(r) for r in tables.read("pred").collect()] == [(1, 1, 0.75)]
    assert not any(f.nullable for f in tables.schema("pred").fields)
    with pytest.raises(Exception, match="column prob is NULL"):
        BAD[writer](tables, query, tables.fetch(query))
    with pytest.raises(ValueError, match="needs the columns"):
        tables.insert_frame(good.drop("label"), "pred")


def test_a_failing_replacement_leaves_the_table(spark):
    tables = dataset(spark)
    tables.replace(spark.range(5), "t")
    tables.set_description("t", "five")
    version, reader = tables.version("t"), tables.read("t")
    for write in (lambda: tables.insert_query("t", "SELECT id, assert_true(id < 3) AS ok FROM t"), lambda: tables.replace(spark.range(9).selectExpr("id", "raise_error('no') AS x"), "t")):
        with pytest.raises(Exception):
            write()
        assert tables.version("t") == version and tables.read("t").count() == 5
    # a query may read what it replaces, and a reader stays with the version it began with
    tables.insert_query("t", "SELECT id + 10 AS id FROM t")
    assert sorted(r.id for r in reader.collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.id for r in tables.read("t").collect()) == [10, 11, 12, 13, 14] and tables.description("t") == "five"
    assert tables.sweep("t") >= 1 and tables.sweep("t") == 0 and tables.read("t").count() == 5
    tables.delete("t")
    assert not tables.exists("t") and not [r for r in spark.sql(f"SHOW TABLES IN `{tables.dataset}`").collect()]


def test_readers_meet_whole_versions_only(spark):
    from foldwise.operators.classifiers import concurrently

    tables = dataset(spark)
    tables.replace(spark.range(100).selectExpr("id", "0 AS v"), "t")

    def work(i):
        if i == 0:
            for v in range(1, 6):
                tables.replace(spark.range(100).selectExpr("id", f"{v} AS v"), "t")
            return set()
        seen = set()
        for _ in range(8):
            try:
                seen.add(tuple(tables.read("t").selectExpr("count(*)", "min(v) = max(v)").first()))
            except Exception as error:  # two replacements later, a version is gone
                assert "TABLE_OR_VIEW_NOT_FOUND" in str(error) or "PATH_NOT_FOUND" in str(error) or "FILE_NOT_EXIST" in str(error)
        return seen

    assert set().union(*concurrently(spark, work, range(3), 3)) == {(100, True)}


def test_copy_keeps_partitions_and_buckets(spark):
    source, target = dataset(spark), dataset(spark)
    source.create("events", EVENTS, "by day")
    source.copy("events", target)
    assert target.entry("events").layout == source.entry("events").layout and target.description("events") == "by day"
    assert target.schema("events") == source.schema("events")


def test_a_save_that_dies_leaves_the_model(spark, monkeypatch):
    import numpy as np

    from foldwise.operators.classifiers import NetworkScorer
    from foldwise.operators.network import Dense, Network
    from foldwise.sources import models as module

    tables = dataset(spark)
    models = Models(tables, scratch_path(spark, "models"))
    scorer = lambda v: NetworkScorer(Network((Dense(np.eye(2) * v, np.zeros(2), "softmax"),)))
    models.save_folds("n", {k: scorer(1.0) for k in range(3)})
    version, plain, calls = models.version("n"), module.network_table, []

    def dies(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("killed")
        return plain(*args)

    monkeypatch.setattr(module, "network_table", dies)
    with pytest.raises(RuntimeError, match="killed"):
        models.save_folds("n", {k: scorer(2.0) for k in range(3)})
    weights = lambda: [float(s.network.layers[0].weights[0, 0]) for s in models.load_folds("n").values()]
    assert models.version("n") == version and weights() == [1.0, 1.0, 1.0]
    monkeypatch.undo()
    models.save_folds("n", {k: scorer(3.0) for k in range(3)})
    assert models.version("n") != version and weights() == [3.0, 3.0, 3.0] and models.sweep("n") == 1 and weights() == [3.0] * 3


def test_csv_order(spark):
    rows = spark.range(100).repartition(7)
    for ordered in (False, True):
        path = scratch_path(spark, "csv")
        write_csv(rows, path, ordered)
        ids = [r.id for r in spark.read.csv(path, header=True, schema="id long").collect()]
        assert sorted(ids) == list(range(100))
    assert remove(spark, path) and not remove(spark, path)


def test_schema_dictionary():
    fields = [{"name": "a", "type": "INT64", "mode": "REQUIRED"}, {"name": "b", "type": "STRING", "mode": "REPEATED"}, {"name": "c", "type": "BOOL"}]
    assert schema_of(fields).simpleString() == "struct<a:bigint,b:array<string>,c:boolean>"


def test_buckets_spare_the_second_shuffle(spark):
    tables = dataset(spark)
    long = spark.range(50).select("id", F.expr("explode(sequence(1L, 3L))").alias("label"), F.lit(0.5).alias("prob"))
    tables.replace(long, "pred", TEST_SCHEMA, buckets=4)
    plan = tables.read("pred").groupBy("id").agg(F.max("prob"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert tables.read("pred").count() == 150


def test_csv_is_strict(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("1", "x")], "id string, n string").write.csv(path, header=True)
    with pytest.raises(Exception):
        read_csv(spark, path, T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType())])).collect()


def test_run_restores_the_current_database(spark):
    tables = dataset(spark)
    before = spark.catalog.currentDatabase()
    tables.insert_frame(spark.range(3), "t")
    assert tables.fetch("SELECT count(*) AS n FROM t").first()["n"] == 3
    with pytest.raises(Exception):
        tables.run("SELECT * FROM nowhere")
    assert spark.catalog.currentDatabase() == before


def test_models_are_listed_described_and_deleted(spark):
    import numpy as np

    from foldwise.operators.classifiers import NetworkScorer
    from foldwise.operators.network import Dense, Network

    tables = dataset(spark)
    models = Models(tables, scratch_path(spark, "models"))
    scorer = NetworkScorer(Network((Dense(np.eye(2), np.zeros(2), "softmax"),)))
    models.save_folds("n", {0: scorer, 1: scorer}, "first")
    models.save_folds("n", {0: scorer, 1: scorer}, "second")
    assert sorted((r.n_fold, r.description) for r in models.list("n").collect()) == [(0, "second"), (1, "second")]
    models.describe("n", "third")
    assert {r.description for r in models.list("n").collect()} == {"third"}
    assert sorted(models.load_folds("n")) == [0, 1]
    assert models.delete("n") and not models.delete("n")
    with pytest.raises(KeyError):
        models.load_folds("n")


def test_stored_keeps_columns_and_types(spark):
    df = spark.range(4).select((F.col("id") % 2).alias("part"), "id", F.lit("x").alias("s"))
    again = stored(df, "t", ("part",))
    assert again.columns == df.columns and again.schema["part"].dataType == T.LongType()
    assert again.count() == 4
