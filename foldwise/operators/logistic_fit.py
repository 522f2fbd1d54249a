"""Multinomial logistic models with absolute and squared penalties, of all folds together.

Each fold is minimised by limited-memory steps inside one orthant at a time, which the absolute penalty asks for. A step needs the loss and its
gradient at one point; all folds that still move ask for theirs together, and one pass over the rows answers: tasks sum loss and
gradient of every fold over the rows it does not evaluate on, the sums are merged, and the driver, which holds nothing but weights, goes on.
Penalties act on weights of standardised features, on the mean loss; intercepts have none.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.network import Dense, Network, _matrix
from foldwise.schema import Problem
from foldwise.sources.scratch import spread

MEMORY = 10  # steps that the shape of the loss is learnt from
HALVINGS = 30
ROWS_PER_TASK = 4096
COLLECTED_BYTES = 64 << 20  # sums of all tasks that may go to the driver unmerged


@dataclass(frozen=True)
class LogisticOptions:
    """Penalties on the mean loss: l1 on absolute values, l2 on halves of squares. A fold ends when a step improves its loss by less than ``tol`` of itself."""

    l1: float = 0.1
    l2: float = 0.1
    max_iter: int = 100
    tol: float = 1e-6


def pseudo_gradient(x: np.ndarray, g: np.ndarray, l1: np.ndarray) -> np.ndarray:
    """The steepest direction of the smooth part's gradient ``g`` and the absolute penalties; zero at a minimum."""
    at_zero = np.where(g + l1 < 0, g + l1, np.where(g - l1 > 0, g - l1, 0.0))
    return np.where(x == 0, at_zero, g + l1 * np.sign(x))


def _direction(pseudo: np.ndarray, moves: list[np.ndarray], turns: list[np.ndarray]) -> np.ndarray:
    d, kept = -pseudo, []
    for s, y in zip(reversed(moves), reversed(turns)):
        a = (s @ d) / (s @ y)
        d = d - a * y
        kept.append(a)
    if moves:
        d = d * ((moves[-1] @ turns[-1]) / (turns[-1] @ turns[-1]))
    for s, y, a in zip(moves, turns, reversed(kept)):
        d = d + (a - (y @ d) / (s @ y)) * s
    # only where it goes down
    return np.where(d * pseudo < 0, d, 0.0)


def minimised(x: np.ndarray, l1: np.ndarray, options: LogisticOptions) -> Generator[np.ndarray, tuple[float, np.ndarray], tuple[np.ndarray, int]]:
    """Asks for (smooth loss, gradient) at points; returns the minimum and the number of steps."""
    value, g = yield x
    total = value + l1 @ np.abs(x)
    moves: list[np.ndarray] = []
    turns: list[np.ndarray] = []
    for taken in range(options.max_iter):
        pseudo = pseudo_gradient(x, g, l1)
        d = _direction(pseudo, moves, turns)
        if not d.any():
            return x, taken
        orthant = np.where(x != 0, np.sign(x), -np.sign(pseudo))
        step = 1.0 if moves else min(1.0, 1.0 / np.abs(pseudo).sum())
        for _ in range(HALVINGS):
            after = x + step * d
            after = np.where((l1 > 0) & (after * orthant <= 0), 0.0, after)
            new_value, new_g = yield after
            new_total = new_value + l1 @ np.abs(after)
            if new_total <= total + 1e-4 * (pseudo @ (after - x)):
                break
            step /= 2
        else:
            return x, taken
        s, y = after - x, new_g - g
        if s @ y > 1e-12 * (y @ y):
            moves, turns = [*moves[1 - MEMORY :], s], [*turns[1 - MEMORY :], y]
        gained = total - new_total
        x, g, total = after, new_g, new_total
        if gained <= options.tol * max(abs(total), 1e-12):
            return x, taken + 1
    return x, options.max_iter


def _losses(rows: DataFrame, points: dict[int, np.ndarray], scalers: dict, width: int, classes: int) -> dict[int, tuple[float, np.ndarray]]:
    """Mean loss and gradient of each fold's point over the rows of the others; one pass.

    Rows are centred once, by the means of one fold. What else standardises them for a fold is taken to its weights and gradient, so that all folds share two products.
    """
    folds = sorted(points)
    center = np.asarray(scalers[folds[0]][0], float)
    layers = []
    for k in folds:
        w, std = points[k].reshape(width + 1, classes), np.asarray(scalers[k][1], float)
        layers.append((w[:-1] / std[:, None], w[-1] - (np.asarray(scalers[k][0], float) - center) / std @ w[:-1]))
    held = rows.sparkSession.sparkContext.broadcast((center, np.hstack([w for w, _ in layers]), np.concatenate([b for _, b in layers])))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros(2 + (width + 1) * classes) for k in folds}
        center, weights, bias = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x, labels, own = _matrix(batch.column("x"), width) - center, batch.column("label").to_numpy(), batch.column("n_fold").to_numpy()
            every = np.arange(len(x))
            logits = (x @ weights + bias).reshape(len(x), len(folds), classes)
            logits -= logits.max(axis=2, keepdims=True)
            p = np.exp(logits)
            whole = p.sum(axis=2)
            lost = np.log(whole) - logits[every, :, labels]
            p /= whole[:, :, None]
            p[every, :, labels] -= 1
            mine = own[:, None] != np.array(folds)
            p *= mine[:, :, None]
            products = (x.T @ p.reshape(len(x), -1)).reshape(width, len(folds), classes)
            for i, k in enumerate(folds):
                sums[k] += np.concatenate([[mine[:, i].sum(), lost[mine[:, i], i].sum()], products[:, i].ravel(), p[:, i].sum(axis=0)])
        yield _rows_of(sums)

    def add(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _rows_of({key[0].as_py(): sum(np.frombuffer(p.as_py()) for batch in parts for p in batch.column("sums"))})

    schema = "fold long, sums binary"
    parts = rows.select("n_fold", "label", "x").mapInArrow(gather, schema)
    if rows.rdd.getNumPartitions() * len(points) * ((width + 1) * classes + 2) * 8 > COLLECTED_BYTES:
        parts = parts.groupBy("fold").applyInArrow(add, schema)
    found: dict[int, np.ndarray] = {}
    for r in parts.collect():
        found[r["fold"]] = found.get(r["fold"], 0) + np.frombuffer(bytes(r["sums"]))
    held.destroy()
    return {k: (v[1] / max(v[0], 1), _standardised(v[2:], center, scalers[k], classes) / max(v[0], 1)) for k, v in found.items()}


def _standardised(gradient: np.ndarray, center: np.ndarray, scaler, classes: int) -> np.ndarray:
    """The gradient of weights on standardised features from that on centred ones."""
    g = gradient.reshape(-1, classes)
    mean, std = (np.asarray(c, float) for c in scaler)
    return np.vstack([(g[:-1] - np.outer(mean - center, g[-1])) / std[:, None], g[-1:]]).ravel()


def _rows_of(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["fold", "sums"])


def penalties(width: int, classes: int, strength: float) -> np.ndarray:
    """``strength`` on every weight, none on intercepts."""
    return np.repeat([strength, 0.0], [width * classes, classes])


def logistic_rows(view: DataFrame) -> DataFrame:
    rows = view.select("n_fold", (F.col("target") - 1).cast("int").alias("label"), vector_to_array("features").alias("x"))
    return rows.coalesce(max(1, -(-view.count() // ROWS_PER_TASK)))  # fewer tasks for few rows; never more than partitions


def fit_logistics(view: DataFrame, problem: Problem, scalers: dict, options: LogisticOptions) -> tuple[dict[int, Network], dict[int, int]]:
    """A softmax layer on raw inputs per fold, and how many steps each took. ``view``: n_fold, target, features (a vector), best stored."""
    width, classes = len(scalers[problem.folds[0]][0]), problem.n_classes
    rows = spread(logistic_rows(view), ROWS_PER_TASK, "logistic")
    l1, l2 = penalties(width, classes, options.l1), penalties(width, classes, options.l2)
    running = {k: minimised(np.zeros((width + 1) * classes), l1, options) for k in problem.folds}
    points = {k: next(r) for k, r in running.items()}
    found: dict[int, tuple[np.ndarray, int]] = {}
    while points:
        answers = _losses(rows, points, scalers, width, classes)
        asked, points = points, {}
        for k, x in asked.items():
            value, g = answers.get(k, (0.0, np.zeros_like(x)))
            try:
                points[k] = running[k].send((value + 0.5 * (l2 * x) @ x, g + l2 * x))
            except StopIteration as end:
                found[k] = end.value
    networks = {}
    for k, (x, _) in found.items():
        w = x.reshape(width + 1, classes)
        networks[k] = Network((Dense(w[:-1], w[-1], "softmax"),)).on_raw_inputs(*scalers[k])
    return networks, {k: steps for k, (_, steps) in found.items()}
