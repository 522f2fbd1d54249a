"""The whole two-level run over stored tables: views, first level, metrics, second level, submissions."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.features import feature_columns, labelled, repeated_ids
from foldwise.operators.classifiers import STACKING_DNN, STACKING_XGB, concurrently, default_options, fit_folds, vectors
from foldwise.operators.clusters import add_distances, fit_clusters
from foldwise.operators.metrics import evaluate, evaluate_models, upsert_metrics
from foldwise.operators.predict import oof_predictions, submission, test_predictions
from foldwise.operators.stacking import renamed, stacking_vectors
from foldwise.schema import FIRST_LEVEL, OOF_SCHEMA, TEST_SCHEMA, Problem, Variant
from foldwise.sources.models import Models
from foldwise.sources.tables import Tables, write_csv


MODELS = ("xgb", "dnn", "logistic", "nn")
LONG_TASKS = ("nn",)


@dataclass(frozen=True)
class RunOptions:
    """``options`` overrides estimator options per variant name or per model; the rest are defaults.

    Without ``buckets``, prediction tables get one for every ``ids_per_bucket`` ids of the larger input.
    """

    variants: tuple[Variant, ...] = FIRST_LEVEL
    second_level: tuple[str, ...] = ("xgb", "dnn")
    n_clusters: int = 5
    cluster_iterations: int = 50
    parallelism: int = 8
    buckets: int | None = None
    ids_per_bucket: int = 500_000
    options: dict = field(default_factory=dict)

    def of(self, variant: Variant):
        for name in (variant.model_name, variant.model):
            if name in self.options:
                return self.options[name]
        return default_options(variant.model, variant.log, variant.kmeans)

    def of_second(self, model: str):
        return self.options.get(f"{model}_stacking", STACKING_XGB if model == "xgb" else STACKING_DNN)


class Ledger:
    """What tables and models were made from, as of now: items are "table <name>" and "model <name>"."""

    def __init__(self, tables: Tables, models: Models):
        self.tables = tables
        rows = models.list().select("model_name", "version", "made_from").distinct().collect()
        self._known = {f"model {r['model_name']}": (r["version"], json.loads(r["made_from"])) for r in rows}

    def _entry(self, item: str) -> tuple[str | None, dict[str, str]]:
        if item not in self._known:
            kind, name = item.split(" ", 1)
            found = self.tables.entry(name) if kind == "table" and self.tables.exists(name) else None
            self._known[item] = (found.version, found.made_from) if found else (None, {})
        return self._known[item]

    def versions(self, *items: str) -> dict[str, str]:
        return {item: self._entry(item)[0] for item in items}

    def fresh(self, item: str) -> bool:
        """It is there, and all it was made from still is what it was then."""
        version, made_from = self._entry(item)
        return version is not None and all(self._entry(i)[0] == then and self.fresh(i) for i, then in made_from.items())


class StackingRun:
    """Steps read and write tables of one dataset, so each can be repeated after a failure.

    Prediction tables are stored in buckets of ``id``: the second level and the submissions then
    group and join them without a shuffle. Feature views are stored once, by fold, and shared by fits and
    scoring; so is the second-level view. Every table and model remembers the versions of what it was made from: a stored view that is
    older than its inputs is built anew, and predictions older than their model are refused by the second level, metrics and submissions.
    """

    def __init__(self, tables: Tables, models: Models, problem: Problem, options: RunOptions = RunOptions()):
        self.tables = tables
        self.models = models
        self.problem = problem
        self.options = options
        self._fitted: dict[str, tuple[str, dict]] = {}
        self._buckets: int | None = options.buckets

    def ledger(self) -> Ledger:
        return Ledger(self.tables, self.models)

    def _require_fresh(self, *tables: str) -> None:
        ledger = self.ledger()
        if stale := [t for t in tables if not ledger.fresh(f"table {t}")]:
            raise ValueError(f"missing, or older than what they are made from: {', '.join(stale)}")

    @property
    def buckets(self) -> int:
        if self._buckets is None:
            largest = max(self.tables.read(t).count() for t in ("train_folds", "test"))
            self._buckets = max(1, -(-largest // self.options.ids_per_bucket))
        return self._buckets

    def _keep(self, name: str, scorers: dict, made_from: dict[str, str]) -> None:
        self.models.save_folds(name, scorers, made_from=made_from)
        self._fitted[name] = (self.models.version(name), scorers)

    def _scorers(self, name: str) -> dict:
        """Models fitted by this run, or those saved since or before."""
        version = self.models.version(name)
        if name not in self._fitted or self._fitted[name][0] != version:
            self._fitted[name] = (version, self.models.load_folds(name))
        return self._fitted[name][1]

    def load(self, train: DataFrame, test: DataFrame) -> None:
        """Store the inputs, labelled rows by fold, so that a fold's rows are read alone.

        Ids that are NULL, negative or occur twice raise before any table is replaced: prediction tables are keyed by
        them, and a labelled one gives the fold.
        """
        for name, frame in (("train", train), ("test", test)):
            if not frame.filter("id IS NULL OR id < 0").isEmpty():
                raise ValueError(f"table {name} has ids that are NULL or negative")
            if not repeated_ids(frame).isEmpty():
                raise ValueError(f"table {name} has ids that occur more than once")
        self._buckets = self.options.buckets
        self.tables.replace(test, "test")
        rows = labelled(train, self.problem)
        spread = rows.repartition("n_fold", F.pmod(F.xxhash64("id"), F.lit(self.options.parallelism)))
        self.tables.replace(spread, "train_folds", partition_by=("n_fold",))

    # feature views

    @staticmethod
    def clusters_name(log: bool) -> str:
        return "kmeans_log_model" if log else "kmeans_model"

    def fit_clusters(self, log: bool) -> None:
        made_from = self.ledger().versions("table train_folds", "table test")
        found = fit_clusters(
            self.tables.read("train_folds"),
            self.tables.read("test"),
            self.problem.features,
            k=self.options.n_clusters,
            max_iter=self.options.cluster_iterations,
            log=log,
        )
        self.models.save_clusters(self.clusters_name(log), found, made_from=made_from)

    def _view(self, base: DataFrame, log: bool, kmeans: bool) -> tuple[DataFrame, Problem]:
        keys = [c for c in ("id", "n_fold", "target") if c in base.columns]
        view = base.select(*keys, *feature_columns(self.problem.features, log))
        if not kmeans:
            return view, self.problem
        clusters = self.models.load_clusters(self.clusters_name(log))
        return add_distances(view, clusters), self.problem.with_features((*self.problem.features, *clusters.distance_columns))

    @staticmethod
    def view_name(log: bool, kmeans: bool) -> str:
        return "view" + ("_kmeans" if kmeans else "") + ("_log" if log else "")

    def _inputs(self, base: str, log: bool, kmeans: bool) -> list[str]:
        return [f"table {base}", *([f"model {self.clusters_name(log)}"] if kmeans else [])]

    def _by_fold(self, view: DataFrame, name: str, made_from: dict[str, str]) -> DataFrame:
        self.tables.replace(view, name, partition_by=("n_fold",), made_from=made_from)
        return self.tables.read(name)

    def train_vectors(self, log: bool = False, kmeans: bool = False) -> tuple[DataFrame, Problem]:
        """The view as vectors, stored by fold on first use and when its inputs have changed."""
        name, ledger = self.view_name(log, kmeans), self.ledger()
        view, problem = self.train_view(log, kmeans)
        if ledger.fresh(f"table {name}"):
            return self.tables.read(name), problem
        return self._by_fold(vectors(view, problem.features), name, ledger.versions(*self._inputs("train_folds", log, kmeans))), problem

    def train_view(self, log: bool = False, kmeans: bool = False) -> tuple[DataFrame, Problem]:
        return self._view(self.tables.read("train_folds"), log, kmeans)

    def test_view(self, log: bool = False, kmeans: bool = False) -> tuple[DataFrame, Problem]:
        return self._view(self.tables.read("test"), log, kmeans)

    # first level

    def fit(self, variant: Variant) -> None:
        view, problem = self.train_vectors(variant.log, variant.kmeans)
        made_from = self.ledger().versions(f"table {self.view_name(variant.log, variant.kmeans)}")
        scorers = fit_folds(variant.model, view, problem, self.options.of(variant), self.options.parallelism)
        self._keep(variant.model_name, scorers, made_from)

    def _store_oof(self, long: DataFrame, table: str, made_from: dict[str, str]) -> None:
        self.tables.replace(long, table, OOF_SCHEMA, self.buckets, made_from=made_from)

    def _store_test(self, long: DataFrame, table: str, made_from: dict[str, str]) -> None:
        self.tables.replace(long, table, TEST_SCHEMA, self.buckets, made_from=made_from)

    def predict_oof(self, variant: Variant) -> None:
        view, problem = self.train_vectors(variant.log, variant.kmeans)
        scorers = self._checked(variant.model_name)
        made_from = self.ledger().versions(f"table {self.view_name(variant.log, variant.kmeans)}", f"model {variant.model_name}")
        self._store_oof(oof_predictions(view, scorers, problem.n_classes), variant.oof_table, made_from)

    def _checked(self, name: str) -> dict:
        scorers = self._scorers(name)
        if sorted(scorers) != list(self.problem.folds):
            raise ValueError(f"model {name} has folds {sorted(scorers)}, not {list(self.problem.folds)}")
        return scorers

    def predict_test(self, variant: Variant) -> None:
        view, problem = self.test_view(variant.log, variant.kmeans)
        scorers = self._scorers(variant.model_name)
        made_from = self.ledger().versions(*self._inputs("test", variant.log, variant.kmeans), f"model {variant.model_name}")
        self._store_test(test_predictions(vectors(view, problem.features), scorers, problem.n_classes), variant.test_table, made_from)

    def evaluate(self, oof_table: str, model_name: str) -> None:
        """Metrics of any out-of-fold table, from the predictions the variant itself made; they must not be older than its model."""
        self._require_fresh(oof_table)
        upsert_metrics(evaluate(self.tables.read(oof_table), model_name, self.problem), self.tables.name("eval"))

    # second level

    def _oof_tables(self) -> dict[str, DataFrame]:
        return {v.oof_table: self.tables.read(v.oof_table) for v in self.options.variants}

    def _test_tables(self) -> dict[str, DataFrame]:
        return renamed({v.test_table: self.tables.read(v.test_table) for v in self.options.variants})

    def second_level_view(self) -> DataFrame:
        """The joined first-level tables, stored by fold on first use and when they have changed: fits and out-of-fold scoring join nothing again."""
        ledger = self.ledger()
        if ledger.fresh("table view_second_level"):
            return self.tables.read("view_second_level")
        names = [v.oof_table for v in self.options.variants]
        self._require_fresh(*names)
        return self._by_fold(self.joined_first_level(), "view_second_level", ledger.versions("table train_folds", *(f"table {n}" for n in names)))

    def joined_first_level(self) -> DataFrame:
        template = self.tables.read("train_folds").select("id", "n_fold", "target")
        return stacking_vectors(template, self._oof_tables(), self.problem)

    def second_level_test_view(self) -> DataFrame:
        return stacking_vectors(self.tables.read("test").select("id"), self._test_tables(), self.problem)

    def fit_second_level(self, model: str) -> None:
        options = self.options.of_second(model)
        view = self.second_level_view()
        made_from = self.ledger().versions("table view_second_level")
        self._keep(f"{model}_stacking_model", fit_folds(model, view, self.problem, options, self.options.parallelism), made_from)

    def predict_oof_second_level(self, model: str) -> None:
        scorers, view = self._checked(f"{model}_stacking_model"), self.second_level_view()
        made_from = self.ledger().versions("table view_second_level", f"model {model}_stacking_model")
        self._store_oof(oof_predictions(view, scorers, self.problem.n_classes), f"{model}_stacking_oof_pred", made_from)

    def predict_test_second_level(self, model: str) -> None:
        names = [v.test_table for v in self.options.variants]
        self._require_fresh(*names)
        scorers = self._scorers(f"{model}_stacking_model")
        made_from = self.ledger().versions("table test", *(f"table {n}" for n in names), f"model {model}_stacking_model")
        long = test_predictions(self.second_level_test_view(), scorers, self.problem.n_classes)
        self._store_test(long, f"{model}_stacking_test_pred", made_from)

    # output

    def submission(self, test_table: str) -> DataFrame:
        return submission(self.tables.read(test_table), self.problem)

    def write_submission(self, test_table: str, folder: str) -> str:
        path = f"{folder.rstrip('/')}/{test_table}_sub"
        write_csv(self.submission(test_table), path)
        return path

    # grid

    def first_level(self, resume: bool = False) -> None:
        """All fits; with ``resume`` only of models that are missing or older than their inputs."""
        ledger, logs = self.ledger(), sorted({v.log for v in self.options.variants if v.kmeans})
        needed = [log for log in logs if not (resume and ledger.fresh(f"model {self.clusters_name(log)}"))]
        concurrently(self.tables.spark, self.fit_clusters, needed, self.options.parallelism)
        ledger = self.ledger()
        self.side_by_side(self.fit, [v for v in self.options.variants if not (resume and ledger.fresh(f"model {v.model_name}"))])

    def side_by_side(self, step, variants) -> None:
        """``step`` for each variant, several at once: most of a pass over few rows is waiting for Spark, which others fill.

        Those that take longest begin first. Variants with long tasks come behind the others, which would wait for each of these in every pass.
        """
        for log, kmeans in sorted({(v.log, v.kmeans) for v in variants}):
            self.train_vectors(log, kmeans)  # not by several at once
        slowest = sorted(variants, key=lambda v: MODELS.index(v.model))
        for late in (False, True):
            concurrently(self.tables.spark, step, [v for v in slowest if (v.model in LONG_TASKS) == late], self.options.parallelism)

    def predict_all(self, resume: bool = False) -> None:
        """The tables are independent of each other, so their jobs share the cluster."""
        ledger = self.ledger()
        for log, kmeans in sorted({(v.log, v.kmeans) for v in self.options.variants}):
            self.train_vectors(log, kmeans)  # not by several at once

        def both(variant):
            for predict, table in ((self.predict_oof, variant.oof_table), (self.predict_test, variant.test_table)):
                if not (resume and ledger.fresh(f"table {table}")):
                    predict(variant)

        concurrently(self.tables.spark, both, self.options.variants, self.options.parallelism)

    def evaluate_all(self) -> None:
        """Metrics of every out-of-fold table, written together."""
        tables = {v.model_name: v.oof_table for v in self.options.variants}
        tables |= {f"{m}_stacking_model": f"{m}_stacking_oof_pred" for m in self.options.second_level}
        self._require_fresh(*tables.values())
        found = evaluate_models({name: self.tables.read(table) for name, table in tables.items()}, self.problem)
        upsert_metrics(found, self.tables.name("eval"))

    def second_level(self, resume: bool = False) -> None:
        for model in self.options.second_level:
            steps = (
                (self.fit_second_level, f"model {model}_stacking_model"),
                (self.predict_oof_second_level, f"table {model}_stacking_oof_pred"),
                (self.predict_test_second_level, f"table {model}_stacking_test_pred"),
            )
            for step, item in steps:
                if not (resume and self.ledger().fresh(item)):
                    step(model)

    def submission_tables(self) -> list[str]:
        first = [v.test_table for v in self.options.variants]
        return first + [f"{m}_stacking_test_pred" for m in self.options.second_level]

    def submissions(self, folder: str) -> list[str]:
        self._require_fresh(*self.submission_tables())
        return [self.write_submission(name, folder) for name in self.submission_tables()]

    def run(self, folder: str, resume: bool = False) -> DataFrame:
        """Everything in order; the first error ends the run. Returns the metrics table.

        With ``resume`` a run goes on where an earlier one ended: what is there and not older than its inputs stays.
        """
        self.first_level(resume)
        self.predict_all(resume)
        self.second_level(resume)
        self.evaluate_all()
        self.submissions(folder)
        return self.tables.read("eval")
