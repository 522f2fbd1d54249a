"""Quantiles of many columns by summaries that can be merged: sorted values with weights.

A task summarises its batches, keeping two summaries of one size only until they become one of the next, so that a value is rounded once for
every doubling of the rows, not for every batch. Summaries are dealt by column and merged in two levels. Up to ``SIZE`` different values
are kept as they are, and quantiles are exact; beyond, each merge moves a rank by at most 1 / (2 SIZE) of the rows merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.network import _matrix

SIZE = 2048
FAN = 64  # tasks whose summaries are merged at once

Summary = tuple[np.ndarray, np.ndarray]  # values in order, weights


def summary(values: np.ndarray, weights: np.ndarray | None = None, size: int = SIZE) -> Summary:
    """At most ``size`` different values; each stands for the ranks around it."""
    names, place = np.unique(values, return_inverse=True)
    held = np.bincount(place, weights, len(names)).astype(float)
    if len(names) <= size:
        return names, held
    ends = np.cumsum(held)
    at = np.minimum(np.searchsorted(ends, (np.arange(size) + 0.5) / size * ends[-1]), len(names) - 1)
    kept, many = np.unique(at, return_counts=True)
    return names[kept], many * (ends[-1] / size)


def merged(parts: list[Summary], size: int = SIZE) -> Summary:
    values, weights = (np.concatenate(c) for c in zip(*parts))
    return summary(values, weights, size)


class Growing:
    """The summary of a column that comes in batches: like a binary counter, never two parts of one level."""

    def __init__(self, size: int = SIZE):
        self.size, self.levels = size, []

    def add(self, values: np.ndarray) -> None:
        level, part = 0, summary(values, None, self.size)
        while self.levels and self.levels[-1][0] == level:
            part = merged([self.levels.pop()[1], part], self.size)
            level += 1
        self.levels.append((level, part))

    def whole(self) -> Summary:
        return merged([p for _, p in self.levels], self.size)


def quantile(found: Summary, shares: np.ndarray) -> np.ndarray:
    """The smallest values with at least these shares of the weight at or below them."""
    values, weights = found
    ends = np.cumsum(weights)
    at = np.searchsorted(ends, shares * ends[-1] * (1 - 1e-12), "left")
    return values[np.minimum(at, len(values) - 1)]


ROWS = "feature int, slot int, vals binary, weights binary"


def _row(feature: int, slot: int, found: Summary) -> pa.RecordBatch:
    columns = [pa.array([feature], pa.int32()), pa.array([slot], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in found]]
    return pa.RecordBatch.from_arrays(columns, names="feature slot vals weights".split())


def _collected(batches: Iterator[pa.RecordBatch]) -> Summary:
    """All summaries of a group as one, with at most FAN of them held."""
    parts: list[Summary] = []
    for batch in batches:
        for v, w in zip(batch.column("vals"), batch.column("weights")):
            parts.append((np.frombuffer(v.as_py()), np.frombuffer(w.as_py())))
            if len(parts) == FAN:
                parts = [merged(parts)]
    return merged(parts)


def column_quantiles(vectors: DataFrame, width: int, shares: np.ndarray) -> list[np.ndarray]:
    """Per element of the array column ``x``, ``width`` wide, its different quantiles; none where there are no rows."""
    slots = max(1, math.isqrt(vectors.rdd.getNumPartitions()))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, seen = [Growing() for _ in range(width)], False
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            for j, growing in enumerate(columns if len(x) else ()):
                growing.add(x[:, j])
                seen = True
        for j, growing in enumerate(columns if seen else ()):
            yield _row(j, TaskContext.get().partitionId() % slots, growing.whole())

    def gather(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _row(key[0].as_py(), key[1].as_py() if len(key) > 1 else 0, _collected(batches))

    def cut(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = np.unique(quantile(_collected(batches), shares))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([cuts], pa.list_(pa.float64()))], names=["feature", "cuts"])

    parts = vectors.select("x").mapInArrow(summarise, ROWS)
    if slots * slots > FAN:
        parts = parts.groupBy("feature", "slot").applyInArrow(gather, ROWS)
    found = parts.groupBy("feature").applyInArrow(cut, "feature int, cuts array<double>")
    by_feature = {r["feature"]: np.array(r["cuts"], float) for r in found.filter(F.col("feature").isNotNull()).collect()}
    return [by_feature.get(j, np.empty(0)) for j in range(width)]
