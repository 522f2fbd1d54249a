"""Queries against their SQL at the smallest size: all that fit nothing, and one of each estimator. ``check.py`` runs every one."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, canonical
from foldwise.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SLOW = ("fitted_", "second_level", "whole_run")
ONE_EACH = ("fitted_oof_logistic", "fitted_oof_dnn", "fitted_oof_xgb", "fitted_test_xgb")
#: of the queries for corpora, those with SQL are compared in tests/llm
OWN = [n for n in contract.queries() if n in ORACLES]
NAMES = [n for n in OWN if not n.startswith(SLOW) or n in ONE_EACH]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["n_fold", "log_loss"] and frame.count() == 5


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, db, name):
    got = contract.queries()[name](spark, SF).toPandas()
    want = db.execute(contract.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want) and canonical(got) == canonical(want)
