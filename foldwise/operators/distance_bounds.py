"""Rounds of k-means that compare again only the points whose nearest centroid may have changed.

At an anchor round every point is stored with its nearest centroid and its slack: how much farther the second nearest one is. After the
centroids have moved, a point of centroid ``a`` keeps it as long as its slack is above the move of ``a`` plus the largest move of another
centroid (triangle inequality). So a later round reads the points whose slack is at most that, and corrects the anchor's sums by those
that did change. The slack is an ordinary column, and files are sorted by it: the bound is a filter that Parquet answers from its
statistics, and pages of points far from any border are not read. No state is carried from round to round, so a lost executor costs
nothing but its tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.sources.scratch import stored


@dataclass
class Rounds:
    """Centroids, and what it took to find them."""

    centers: np.ndarray
    rounds: int = 0
    anchors: int = 0
    points: int = 0  # summed over rounds
    compared: int = 0  # of these, how many were compared with every centroid

    @property
    def skipped(self) -> float:
        return 1 - self.compared / self.points if self.points else 0.0


@dataclass
class Anchor:
    """All points with centroid and slack at ``centers``, and per centroid the sum and number of its points."""

    points: DataFrame
    centers: np.ndarray
    sums: np.ndarray
    counts: np.ndarray
    squares: float  # of all points, from the origin
    move: float  # the largest of the round that led here


def improved_by_bounds(points: DataFrame, centers: np.ndarray, rounds: int, tol: float, stale: float = 0.5) -> Rounds:
    """Centroids after at most ``rounds`` rounds over ``points`` (x array<double>), the same as without bounds but for rounding.

    Ends when a round improves the loss by less than ``tol`` of itself. A centroid without points stays where it is; a point as near to
    two centroids belongs to the smaller number. Points are anchored anew when more than the share ``stale`` of them had to be compared
    and the centroids move less than half as far as they did at the last anchor, so the number of anchors is logarithmic in the moves.
    ``points`` is read once per anchor: give it a stored table.
    """
    found, anchor, before, move, share = Rounds(np.asarray(centers, float)), None, None, np.inf, 0.0
    for _ in range(rounds):
        if anchor is None or (share > stale and move < anchor.move / 2):
            anchor = anchored(points, found.centers, move)
            sums, counts, again, share = anchor.sums, anchor.counts, int(anchor.counts.sum()), 0.0
            found.anchors += 1
        else:
            sums, counts, again = corrected(anchor, found.centers)
            share = again / max(counts.sum(), 1)
        found.points, found.compared = found.points + int(counts.sum()), found.compared + again
        loss = anchor.squares - 2 * (found.centers * sums).sum() + (counts * np.square(found.centers).sum(axis=1)).sum()
        if before is not None and before - loss <= tol * before:
            break
        after = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], found.centers)
        move = np.sqrt(np.square(after - found.centers).sum(axis=1)).max()
        found.centers, before = after, loss
        found.rounds += 1
    return found


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.stack([np.square(x - c).sum(axis=1) for c in centers], axis=1)


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid from 0, and the slack less what rounding may have added to it."""
    squares = _squares(x, centers)
    first = squares.argmin(axis=1)
    if len(centers) == 1:
        return first, np.full(len(x), np.inf)
    low, high = np.sqrt(np.partition(squares, 1, axis=1)[:, :2]).T
    return first, high - low - 1e-9 * (high + low) - 1e-12 * np.sqrt(np.square(x).sum(axis=1))


def anchored(points: DataFrame, centers: np.ndarray, move: float) -> Anchor:
    k, width = centers.shape

    def per_task(batches):
        for batch in batches:
            first, slack = nearest(_matrix(batch.column(0), width), centers)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first, pa.int32()), pa.array(slack)], names=["x", "centroid", "slack"])

    marked = points.select("x").mapInArrow(per_task, "x array<double>, centroid int, slack double")
    table = stored(marked.sortWithinPartitions("slack"), "anchor")

    def own(x, centroid):
        return [(centroid, x, 1)]

    sums, counts, squares, _ = _summed(table, k, width, own)
    return Anchor(table, centers, sums, counts, squares, move)


def doubtful(anchor: Anchor, centers: np.ndarray) -> DataFrame:
    """The anchor's points that may have another nearest centroid now. The first condition reaches the scan."""
    moves = np.sqrt(np.square(centers - anchor.centers).sum(axis=1))
    others = [float(np.delete(moves, i).max(initial=0.0)) for i in range(len(moves))]
    need = [float(m) + o for m, o in zip(moves, others)]
    slack = F.col("slack")
    return anchor.points.filter((slack <= max(need)) & (slack <= F.get(F.array(*map(F.lit, need)), F.col("centroid"))))


def corrected(anchor: Anchor, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums and numbers at ``centers``: the anchor's, less the points that left a centroid, plus those that came. And how many were compared."""
    k, width = centers.shape

    def changed(x, centroid):
        now = _squares(x, centers).argmin(axis=1)
        other = now != centroid
        return [(centroid[other], x[other], -1), (now[other], x[other], 1)]

    sums, counts, _, seen = _summed(doubtful(anchor, centers), k, width, changed)
    return anchor.sums + sums, anchor.counts + counts, seen


_PARTS = pa.schema([("centroid", pa.int32()), ("part", pa.list_(pa.float64())), ("n", pa.float64()), ("square", pa.float64()), ("seen", pa.int64())])


def _summed(table: DataFrame, k: int, width: int, parts) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Per centroid the signed sum and number of what ``parts`` makes of a batch; the squares and the number of all rows read."""

    def per_task(batches):
        sums, counts, square, seen = np.zeros((k, width)), np.zeros(k), 0.0, 0
        for batch in batches:
            x, centroid = _matrix(batch.column(0), width), batch.column(1).to_numpy()
            square, seen = square + float(np.square(x).sum()), seen + len(x)
            for to, rows, sign in parts(x, centroid):
                np.add.at(sums, to, sign * rows)
                counts += sign * np.bincount(to, minlength=k)
        if seen:
            rows = [{"centroid": i, "part": sums[i].tolist(), "n": counts[i], "square": square * (i == 0), "seen": seen * (i == 0)} for i in range(k)]
            yield pa.RecordBatch.from_pylist(rows, schema=_PARTS)

    partial = table.select("x", "centroid").mapInArrow(per_task, "centroid int, part array<double>, n double, square double, seen long")
    totals = [F.sum(F.col("part")[j]).alias(f"s{j}") for j in range(width)]
    merged = partial.groupBy("centroid").agg(F.array(*totals).alias("s"), *[F.sum(c).alias(c) for c in ("n", "square", "seen")])
    sums, counts, square, seen = np.zeros((k, width)), np.zeros(k), 0.0, 0
    for row in merged.collect():  # one row per centroid
        sums[row["centroid"]], counts[row["centroid"]] = row["s"], row["n"]
        square, seen = square + row["square"], seen + row["seen"]
    return sums, counts, square, seen
