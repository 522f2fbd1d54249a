"""Fitted models and their parameters, saved by name and fold, with a table of what there is."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators.classifiers import LogisticScorer, NetworkScorer, SoftmaxScorer, concurrently
from foldwise.operators.boosting import FOREST, BoostedScorer, forest_table, read_forest
from foldwise.operators.clusters import Clusters, clusters_table, read_clusters
from foldwise.operators.network import NETWORK_SCHEMA, Network, network_table, read_networks
from foldwise.sources.scratch import add_partition, remove
from foldwise.sources.tables import Tables

_COLUMNS = "model_name string, n_fold bigint, kind string, path string, n_parts bigint, description string, made_from string, version string, written bigint, deleted boolean, writer string"
NO_FOLD = -1  # one model for all folds
SIDE_BY_SIDE = 8  # small files written or read at a time


class Models:
    """Models of one dataset below ``root``, a folder every executor can reach.

    Files of a version are written once, into a folder of their own. The table ``models`` is a log: the rows of all folds of a version are
    added as one file, after its files, and the last version of a name is the model. So a save that dies leaves the model before it whole, for
    all folds, and a reader never meets folds of two versions.
    """

    def __init__(self, tables: Tables, root: str):
        self.spark: SparkSession = tables.spark
        self.tables = tables
        self.root = root.rstrip("/")
        self.table = tables.name("models")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({_COLUMNS}) USING parquet PARTITIONED BY (writer)")

    def _put(self, rows: list[tuple], version: str, made_from: dict[str, str], deleted: bool = False) -> None:
        """One file for all rows: (name, fold, kind, path, parts, description)."""
        facts = (json.dumps(made_from), version, time.time_ns(), deleted, uuid.uuid4().hex)
        add_partition(self.spark, [(*r, *facts) for r in rows], _COLUMNS, self.table)

    def list(self, name: str | None = None) -> DataFrame:
        every = self.spark.table(self.table)
        every = every if name is None else every.filter(F.col("model_name") == name)
        # versions of a name differ in the time of their rows or, written at once, in their names
        last = every.groupBy("model_name").agg(F.max(F.struct("written", "version")).alias("last"))
        current = every.join(last, "model_name").filter((F.col("written") == F.col("last.written")) & (F.col("version") == F.col("last.version")))
        return current.filter(~F.col("deleted")).drop("last", "deleted", "writer")

    def _rows(self, name: str) -> list:
        return sorted(self.list(name).collect(), key=lambda r: r["n_fold"])

    def version(self, name: str) -> str | None:
        """Names the model that is there now; another one after each save."""
        rows = self._rows(name)
        return rows[0]["version"] if rows else None

    def made_from(self, name: str) -> dict[str, str]:
        rows = self._rows(name)
        return json.loads(rows[0]["made_from"]) if rows else {}

    def save_clusters(self, name: str, clusters: Clusters, description: str = "", made_from: dict[str, str] | None = None) -> None:
        version = uuid.uuid4().hex
        path = f"{self.root}/{name}/{version}"
        clusters_table(self.spark, clusters).coalesce(1).write.parquet(path)
        self._put([(name, NO_FOLD, "clusters", path, 1, description)], version, made_from or {})

    def load_clusters(self, name: str) -> Clusters:
        rows = self._rows(name)
        if not rows:
            raise KeyError(f"no model {name}")
        return read_clusters(self.spark.read.parquet(rows[0]["path"]))

    def save_folds(self, name: str, scorers: dict[int, object], description: str = "", made_from: dict[str, str] | None = None) -> None:
        """Save, or replace, the models of all folds."""
        rows, files, version = [], [], uuid.uuid4().hex
        for k, scorer in sorted(scorers.items()):
            path, parts = f"{self.root}/{name}/{version}/fold={k}", 1
            if isinstance(scorer, LogisticScorer):
                kind = "spark logistic"
                files.append((scorer.model, path))
            elif isinstance(scorer, SoftmaxScorer):
                kind = "logistic"
                files.append((scorer.network, path))
            elif isinstance(scorer, BoostedScorer):
                kind, parts = "boosted", len(scorer.labels)
                files.append((scorer, path))
            elif isinstance(scorer, NetworkScorer):
                kind = "network"
                files.append((scorer.network, path))
            else:
                raise TypeError(f"cannot save {type(scorer).__name__}")
            rows.append((name, k, kind, path, parts, description))

        def save(job):
            model, path = job
            if isinstance(model, Network):
                network_table(self.spark, {0: model}).coalesce(1).write.parquet(path)
            elif isinstance(model, BoostedScorer):
                forest_table(self.spark, model).coalesce(1).write.parquet(path)
            else:
                model.write().save(path)

        concurrently(self.spark, save, files, SIDE_BY_SIDE)
        self._put(rows, version, made_from or {})

    def load_folds(self, name: str) -> dict[int, object]:
        rows = self._rows(name)
        if not rows:
            raise KeyError(f"no model {name}")

        def load(r):
            path = r["path"]
            if r["kind"] == "spark logistic":
                return LogisticScorer(LogisticRegressionModel.load(path))
            if r["kind"] == "boosted":
                return read_forest(self.spark.read.schema(FOREST).parquet(path))
            kind = SoftmaxScorer if r["kind"] == "logistic" else NetworkScorer
            return kind(read_networks(self.spark.read.schema(NETWORK_SCHEMA).parquet(path))[0])

        return dict(zip([int(r["n_fold"]) for r in rows], concurrently(self.spark, load, rows, SIDE_BY_SIDE)))

    def describe(self, name: str, description: str) -> None:
        """The same version with another description."""
        rows = self._rows(name)
        if not rows:
            raise KeyError(f"no model {name}")
        again = [(name, r["n_fold"], r["kind"], r["path"], r["n_parts"], description) for r in rows]
        self._put(again, rows[0]["version"], json.loads(rows[0]["made_from"]))

    def delete(self, name: str) -> bool:
        """Forget a model of all folds, then delete its files, older versions too; False if there was none."""
        rows = self._rows(name)
        if rows:
            self._put([(name, r["n_fold"], r["kind"], r["path"], r["n_parts"], r["description"]) for r in rows], uuid.uuid4().hex, {}, deleted=True)
            remove(self.spark, f"{self.root}/{name}")
        return bool(rows)

    def sweep(self, name: str) -> int:
        """Delete the files of versions that are no longer the model's. Run it while nobody loads or saves it."""
        kept = self.version(name)
        every = {r["version"] for r in self.spark.table(self.table).filter(F.col("model_name") == name).filter(~F.col("deleted")).select("version").distinct().collect()}
        return sum(remove(self.spark, f"{self.root}/{name}/{version}") for version in every - {kept})


def save_scaler(params: DataFrame, path: str) -> None:
    """Fold means and scales as a small table, one row per fold."""
    params.coalesce(1).write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("n_fold bigint, mean array<double>, std array<double>").parquet(path)
