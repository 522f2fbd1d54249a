"""op3 against its SQL; targets, ties and repeats by hand."""

from collections import defaultdict

import duckdb
import pytest

import foldwise.llm.mixing as module
from foldwise.llm.mixing import mix, mixture
from foldwise.llm.mixing_query import SQL


def compare(frame, db):
    got = sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 4), r["taken"]) for r in mixture(frame).collect()), key=repr)
    assert got == sorted(db.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({SQL})").fetchall(), key=repr)
    return got


def test_given_documents(documents, db):
    got = compare(documents, db)
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for _, size, source_size, target, words in got:
        assert words in (0, size, 2 * size, 3 * size)
        sizes[source_size] += size
        taken[source_size] += words
        targets[source_size] = target
    largest = max(g[1] for g in got)
    assert all(abs(taken[s] - targets[s]) <= largest for s in sizes)


def test_awkward_rows(awkward):
    db = duckdb.connect()
    frame = awkward.select("doc_id", "text", "source").toPandas()
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    db.register("documents", frame)
    compare(awkward, db)


def test_targets_stop_at_three_times_their_source(spark):
    frame = spark.createDataFrame([(1, "a", "w " * 10), (2, "b", "w " * 100), (3, None, "w " * 100)], "doc_id long, source string, text string")
    got = {r["source"]: r["target"] for r in mixture(frame).collect()}
    assert got["a"] == 30 and got["b"] == pytest.approx(120) and got[None] == pytest.approx(60)


def test_mix_repeats_rows(documents):
    plan = {r["doc_id"]: r["copies"] for r in mixture(documents).collect()}
    mixed = mix(documents)
    assert mixed.columns == documents.columns
    got = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {d: n for d, n in plan.items() if n}
    assert sorted(r["doc_id"] for r in mix(documents).collect()) == sorted(r["doc_id"] for r in mixed.collect())


def test_texts_are_not_shuffled(documents, monkeypatch):
    plan = mix(documents)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    few = sorted(map(tuple, mix(documents).collect()), key=repr)
    monkeypatch.setattr(module, "MOST_SOURCES", 0)
    assert sorted(map(tuple, mix(documents).collect()), key=repr) == few


def test_empty(nothing):
    assert mixture(nothing).count() == 0 and mix(nothing).count() == 0
