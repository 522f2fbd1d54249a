"""Boosted trees for several classes: one ensemble per fold on the softmax loss, all folds and classes grown together.

Features are cut into bins by quantiles once. Rows are packed into chunks with the margins of every fold's ensemble. A level of the trees of
all folds and classes is one pass. Tasks sum gradients and second derivatives by (fold, class, node, feature, bin), of the lighter child of each
split only: the other child is its parent, whose sums stay where they were merged, less the lighter one. What tasks hand on are the filled bins
of the columns drawn for a tree; it is merged in two levels where there are many tasks. Splits are found where the sums are merged, and only
they reach the driver. The first pass of a round also gives the loss of each fold's own rows, which ends the fold. Penalties act on leaf
values, child weight on second derivatives, columns are drawn per tree, rows per round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from foldwise.operators.network import MAX_BROADCAST_BYTES, _matrix, matrix_function
from foldwise.operators.quantiles import column_quantiles
from foldwise.schema import Problem
from foldwise.sources.scratch import planned_once, stored

CHUNK = 32_768  # rows packed into one, at most
ROWS_PER_TASK = 16_384  # fewer tasks for few rows
WRITTEN_EVERY = 16  # rounds after which margins are written, which cuts their lineage
MERGED_BYTES = 256 << 20  # sums a task holds before it hands them on
MERGING_TASKS = 200  # that find the splits of a level, at most
NODES_PER_TASK = 128  # whose splits a task finds, about, where nodes are few
NODES_AT_ONCE = 16  # whose splits are found together
MERGED_TASKS = 64  # whose sums are merged at once; more are merged in two levels
TREES_AT_ONCE = 64  # when rows are scored


@dataclass(frozen=True)
class BoostedOptions:
    """``min_child`` is a sum of second derivatives. With ``early_stop`` a fold ends when its evaluation loss improves by less than
    ``min_progress`` of itself, so its out-of-fold scores are slightly optimistic; switch it off to compare variants on fixed rounds.
    """

    rate: float = 0.05
    depth: int = 8
    rounds: int = 1000
    l1: float = 0.1
    l2: float = 0.1
    min_child: float = 2.0
    row_sample: float = 0.8
    column_sample: float = 0.8
    early_stop: bool = True
    min_progress: float = 0.0008
    bins: int = 64
    seed: int = 7


def cut_points(view: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Per feature at most ``bins - 1`` different quantiles; a value goes into the bin of the first one not below it."""
    values = view.select(vector_to_array("features").alias("x"))
    return column_quantiles(values, width, np.arange(1, bins) / bins)


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8)


@dataclass(frozen=True)
class Tree:
    """Nodes in level order, children of i at 2 i + 1 and 2 i + 2. ``feature`` is -1 in a leaf; a value above ``cut`` goes right."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray


def descended(trees: tuple, x: np.ndarray, depth: int) -> np.ndarray:
    """(rows, trees): the node that each row of bins or values ends in; trees = (feature, cut), each (trees, nodes)."""
    feature, cut = (t.ravel() for t in trees)
    count, nodes = trees[0].shape
    values, begins, firsts = np.ascontiguousarray(x).ravel(), np.arange(len(x))[:, None] * x.shape[1], np.arange(count) * nodes
    at = np.zeros((len(x), count), np.int64)
    for _ in range(depth):
        here = at + firsts
        f = feature.take(here)
        inside = f >= 0
        if not inside.any():
            break
        right = values.take(begins + np.maximum(f, 0)) > cut.take(here)
        at = np.where(inside, 2 * at + 1 + right, at)
    return at


def walked(feature: np.ndarray, cut: np.ndarray, bins: np.ndarray, rows: np.ndarray, depth: int) -> np.ndarray:
    """The node ``depth`` levels down that each of ``rows`` of bins is in; below a leaf it goes on to the left."""
    leaf = feature < 0
    feature, cut = np.where(leaf, 0, feature), np.where(leaf, 255, cut).astype(np.uint8)  # no bin is above 255
    values, begins, at = bins.ravel(), rows * bins.shape[1], np.zeros(len(rows), np.int64)
    for _ in range(depth):
        right = values.take(begins + feature.take(at)) > cut.take(at)
        at *= 2
        at += 1
        at += right
    return at


def _perfect(feature: np.ndarray, threshold: np.ndarray, value: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """Trees whose leaves all lie at ``depth``: a higher leaf goes on to its left, and takes its value along."""
    feature, threshold, value = feature.copy(), threshold.copy(), value.copy()
    for level in range(depth):
        nodes = np.arange(2**level - 1, 2 ** (level + 1) - 1)
        tree, at = np.nonzero(feature[:, nodes] < 0)
        at = nodes[at]
        value[tree, 2 * at + 1] = value[tree, at]
        feature[tree, at], threshold[tree, at] = 0, np.inf
        feature[tree, 2 * at + 1] = -1
    inner = 2**depth - 1
    return feature[:, :inner], threshold[:, :inner], value[:, inner:]


def score_forest(shared, x: np.ndarray) -> np.ndarray:
    """Class probabilities of rows of values. Trees pass by in blocks, each made perfect so that a level is three lookups."""
    feature, threshold, value, labels, classes, depth = shared
    margins = np.zeros((len(x), classes))
    values, begins = np.ascontiguousarray(x, float).ravel(), np.arange(len(x))[:, None] * x.shape[1]
    # no value is above an infinite threshold, and NaN goes left as it does from any other
    for a in range(0, len(feature), TREES_AT_ONCE):
        part = slice(a, a + TREES_AT_ONCE)
        f, t, v = _perfect(feature[part].astype(np.int64), threshold[part], value[part], depth)
        inner, leaves = np.arange(len(f)) * f.shape[1], np.arange(len(f)) * v.shape[1]
        f, t = f.ravel(), t.ravel()
        at = np.zeros((len(x), len(inner)), np.int64)
        for _ in range(depth):
            here = at + inner
            at = 2 * at + 1 + (values.take(begins + f.take(here)) > t.take(here))
        got = v.ravel().take(at - (2**depth - 1) + leaves)
        for c in range(classes):
            margins[:, c] += got[:, labels[part] == c].sum(axis=1)
    return _softmax(margins)


def _softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class BoostedScorer:
    """An ensemble as plain arrays; a row per tree."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    labels: np.ndarray  # class of each tree, from 0
    classes: int
    depth: int
    width: int

    @property
    def n_rounds(self) -> int:
        return len(self.labels) // self.classes

    def probabilities(self, df: DataFrame, out: str) -> DataFrame:
        shared = (self.feature.astype(np.int32), self.threshold, self.value, self.labels, self.classes, self.depth)
        if sum(a.nbytes for a in shared[:4]) > MAX_BROADCAST_BYTES:
            raise ValueError(f"boosted trees of {self.feature.size} nodes are too large to send to every executor")
        return df.withColumn(out, matrix_function(df.sparkSession, score_forest, shared, self.width)(vector_to_array("features")))


FOREST = "tree long, label long, feature array<long>, threshold array<double>, value array<double>, n_classes long, depth long, width long"


def forest_table(spark, forest: BoostedScorer) -> DataFrame:
    """A row per tree; an ensemble without trees is one row without nodes."""
    about = (forest.classes, forest.depth, forest.width)
    parts = zip(forest.labels.tolist(), forest.feature.tolist(), forest.threshold.tolist(), forest.value.tolist())
    rows = [(i, label, f, t, v, *about) for i, (label, f, t, v) in enumerate(parts)]
    return spark.createDataFrame(rows or [(-1, -1, [], [], [], *about)], FOREST)


def read_forest(table: DataFrame) -> BoostedScorer:
    rows = table.orderBy("tree").collect()
    trees = [r for r in rows if r["tree"] >= 0]
    nodes = len(trees[0]["feature"]) if trees else 1
    arrays = [np.array([r[n] for r in trees], kind).reshape(len(trees), nodes) for n, kind in (("feature", np.int64), ("threshold", float), ("value", float))]
    return BoostedScorer(*arrays, np.array([r["label"] for r in trees], np.int64), rows[0]["n_classes"], rows[0]["depth"], rows[0]["width"])


PACKED = "n binary, folds binary, labels binary, keys binary, bins binary, margins binary"


def _of_size(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``most``, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, most - sum(b.num_rows for b in held))
            batch = batch.slice(part.num_rows)
            held.append(part)
            if sum(b.num_rows for b in held) == most:
                yield pa.concat_batches(held)
                held = []
    if held:
        yield pa.concat_batches(held)


def packed(view: DataFrame, problem: Problem, cuts: list[np.ndarray]) -> DataFrame:
    width, models = len(cuts), problem.n_folds * problem.n_classes

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _of_size(batches, CHUNK):
            columns = [
                np.int64(part.num_rows).tobytes(),
                part.column("n_fold").to_numpy().astype(np.int32).tobytes(),
                part.column("label").to_numpy().astype(np.int32).tobytes(),
                part.column("key").to_numpy().tobytes(),
                binned(_matrix(part.column("x"), width), cuts).tobytes(),
                np.zeros((part.num_rows, models), np.float32).tobytes(),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names="n folds labels keys bins margins".split())

    rows = view.select("n_fold", (F.col("target") - 1).cast("int").alias("label"), F.xxhash64("id").alias("key"), vector_to_array("features").alias("x"))
    return rows.mapInArrow(pack, PACKED)


def _unpacked(row: dict, problem: Problem, width: int):
    n = int(np.frombuffer(row["n"], np.int64)[0])
    folds, labels = np.frombuffer(row["folds"], np.int32), np.frombuffer(row["labels"], np.int32)
    bins = np.frombuffer(row["bins"], np.uint8).reshape(n, width)
    margins = np.frombuffer(row["margins"], np.float32).reshape(n, problem.n_folds, problem.n_classes)
    return folds, labels, np.frombuffer(row["keys"], np.int64), bins, margins


def drawn(keys: np.ndarray, seed: int, turn: int, share: float) -> np.ndarray:
    """Which rows a round grows its trees on."""
    h = keys.view(np.uint64) ^ np.uint64((seed * 1_000_003 + turn) % (1 << 64))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(11)).astype(np.float64) / (1 << 53) < share


def best_splits(sums: np.ndarray, options: BoostedOptions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, bin, gain) of the best split of each node's sums (nodes, features, bins, 2); feature -1 if none improves the loss."""
    g, h = (np.cumsum(sums[..., i], axis=2) for i in range(2))
    all_g, all_h = g[..., -1:].copy(), h[..., -1:].copy()
    gain = _gain(g, h, options)
    ok = h >= options.min_child
    np.subtract(all_g, g, out=g)
    np.subtract(all_h, h, out=h)
    ok &= h >= options.min_child
    gain += _gain(g, h, options)
    gain -= _gain(all_g, all_h, options)
    gain = np.where(ok, gain, 0.0).reshape(len(sums), -1)
    most = gain.max(axis=1)
    # equal splits differ by the order of sums; the first one counts
    at = (gain >= (most - 1e-9 * np.maximum(most, 1.0))[:, None]).argmax(axis=1)
    feature, cut = np.divmod(at, sums.shape[2])
    found = most > 1e-9
    return np.where(found, feature, -1), np.where(found, cut, 0), np.where(found, most, 0.0)


def _gain(g: np.ndarray, h: np.ndarray, options: BoostedOptions) -> np.ndarray:
    return np.square(np.maximum(np.abs(g) - options.l1, 0.0)) / np.maximum(h + options.l2, 1e-12)


def _shrunk(g, options: BoostedOptions):
    return np.sign(g) * np.maximum(np.abs(g) - options.l1, 0.0)


def leaf_value(g: float, h: float, options: BoostedOptions) -> float:
    return float(-options.rate * _shrunk(g, options) / max(h + options.l2, 1e-12))


def encoded(sums: np.ndarray) -> bytes:
    """Sums (columns, bins, 2): the filled bins with their places, or all of them where that is shorter."""
    flat = sums.reshape(-1, 2)
    at = np.nonzero(flat.any(axis=1))[0].astype(np.int32)
    if 20 * len(at) < 16 * len(flat):
        return b"s" + np.int32(len(at)).tobytes() + at.tobytes() + flat[at].tobytes()
    return b"d" + np.ascontiguousarray(flat).tobytes()


def added(total: np.ndarray, part: bytes) -> None:
    """``total`` (columns, bins, 2) and what ``encoded`` made of such sums."""
    flat = total.reshape(-1, 2)
    if part[:1] == b"d":
        flat += np.frombuffer(part, offset=1).reshape(-1, 2)
    else:
        n = int(np.frombuffer(part, np.int32, 1, 1)[0])
        at = np.frombuffer(part, np.int32, n, 5)
        flat[at] += np.frombuffer(part, offset=5 + 4 * n).reshape(-1, 2)


SUMS = "fold long, label long, node long, slot long, sums binary"
#: what a node becomes; ``lighter`` is the child to be summed next, ``sums`` are kept where that is needed
NODES = "fold long, label long, node long, feature long, cut long, gl double, hl double, g double, h double, lighter long, sums binary"


def level_sums(state: DataFrame, problem: Problem, width: int, columns: dict, bins: int, growing: dict, summed: dict, level: int, turn: int, options: BoostedOptions, evaluating: bool) -> DataFrame:
    """Rows (fold, label, node, slot, sums): for each node the encoded sums (columns, bins, 2); with label -1, a fold's loss and number of own rows.

    columns: those drawn for the tree by (fold, label); growing: (feature, cut) of the trees so far; summed: their nodes to sum at ``level``.
    """
    folds_left = sorted({k for k, _ in growing})

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        slot = TaskContext.get().partitionId()

        def out():
            for (k, c), sums in held.items():
                nodes = [-1] if c < 0 else summed[k, c]
                values = [sums.tobytes()] if c < 0 else [encoded(v) for v in sums]
                columns = [pa.array(x, pa.int64()) for x in ([k] * len(nodes), [c] * len(nodes), nodes, [slot] * len(nodes))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.binary())], names="fold label node slot sums".split())
            held.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                folds, labels, keys, x, margins = _unpacked({c: batch.column(c)[i].as_py() for c in batch.schema.names}, problem, width)
                sampled = drawn(keys, options.seed, turn, options.row_sample)
                by_feature = np.ascontiguousarray(x.T)
                for k in folds_left:
                    p = _softmax(margins[:, k].astype(float))
                    if evaluating:
                        own = folds == k
                        loss = -np.log(np.maximum(p[own, labels[own]], 1e-15)).sum()
                        held[k, -1] = held.get((k, -1), 0) + np.array([loss, own.sum()])
                    rows = np.nonzero((folds != k) & sampled)[0]
                    for c in range(problem.n_classes):
                        nodes = summed.get((k, c))
                        if not nodes:
                            continue
                        feature, cut = growing[k, c]
                        place = np.full(len(feature), -1)
                        place[nodes] = np.arange(len(nodes))
                        local = place.take(walked(feature, cut, x, rows, level))
                        inside = np.nonzero(local >= 0)[0]
                        mine, first = rows.take(inside), local.take(inside) * bins
                        p_own = p[:, c].take(mine)
                        g, h = p_own - (labels.take(mine) == c), p_own * (1 - p_own)
                        sums = np.empty((len(nodes), len(columns[k, c]), bins, 2))
                        for i, j in enumerate(columns[k, c].tolist()):
                            index = first + by_feature[j].take(mine)
                            for which, v in enumerate((g, h)):
                                # without rows, bincount gives integers
                                sums[:, i, :, which] = np.bincount(index, v, len(nodes) * bins).reshape(len(nodes), bins)
                        if (k, c) in held:
                            held[k, c] += sums
                        else:
                            held[k, c] = sums
                        if sum(v.nbytes for v in held.values()) > MERGED_BYTES:
                            yield from out()
        yield from out()

    return state.mapInArrow(gather, SUMS)


def _shape(columns: dict, bins: int, fold: int, label: int) -> tuple[int, int, int]:
    return len(columns[fold, label]), bins, 2


def _fewer(parts: DataFrame, columns: dict, bins: int, slots: int) -> DataFrame:
    """The sums of many tasks as those of ``slots``."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, label, node, slot = (k.as_py() for k in key)
        total = np.zeros(2 if label < 0 else _shape(columns, bins, fold, label))
        for batch in batches:
            for part in batch.column("sums"):
                if label < 0:
                    total += np.frombuffer(part.as_py())
                else:
                    added(total, part.as_py())
        names = [pa.array([v], pa.int64()) for v in (fold, label, node, slot)]
        yield pa.RecordBatch.from_arrays([*names, pa.array([total.tobytes() if label < 0 else encoded(total)], pa.binary())], names="fold label node slot sums".split())

    return parts.withColumn("slot", F.col("slot") % slots).groupBy("fold", "label", "node", "slot").applyInArrow(add, SUMS)


class Family:
    """A node that was summed, its parent if it has one, and so the other child."""

    def __init__(self, columns: dict, bins: int, options: BoostedOptions, last: bool):
        self.columns, self.bins, self.options, self.last = columns, bins, options, last
        self.found: dict[tuple, np.ndarray] = {}
        self.parents: dict[tuple, np.ndarray] = {}
        self.lighter: dict[tuple, int] = {}

    def add(self, batch: pa.RecordBatch) -> None:
        for fold, label, node, slot, sums in zip(*(batch.column(c).to_pylist() for c in ("fold", "label", "node", "slot", "sums"))):
            if label < 0:
                self.found[fold, label, node] = self.found.get((fold, label, node), 0) + np.frombuffer(sums)
                continue
            # a parent comes with the child that was summed in place of the task's number, below zero
            key = (fold, label, node if slot >= 0 else -slot)
            if slot < 0:
                self.lighter[key] = node
            kept = self.parents if slot < 0 else self.found
            if key not in kept:
                kept[key] = np.zeros(_shape(self.columns, self.bins, fold, label))
            added(kept[key], sums)

    def rows(self) -> list[tuple]:
        out = []
        for (fold, label, node), parent in self.parents.items():
            child = self.found.setdefault((fold, label, node), np.zeros_like(parent))
            other = parent - child
            # what rounding leaves of bins that all belong to the child
            other[(np.abs(other) < 1e-9).all(axis=-1)] = 0
            self.found[fold, label, node + 1 if node % 2 else node - 1] = other
        keys = [key for key in self.found if key[1] >= 0]
        for a in range(0, len(keys), NODES_AT_ONCE):
            out += self._split(keys[a : a + NODES_AT_ONCE])
        for (fold, label, node), sums in self.found.items():
            if label < 0:
                out.append((fold, label, node, -1, 0, 0.0, 0.0, *sums.tolist(), -1, None))
        return out

    def _split(self, keys: list[tuple]) -> list[tuple]:
        """Rows of NODES of some nodes; as many columns are drawn for every tree."""
        out = []
        every = np.stack([self.found[key] for key in keys])
        for (fold, label, node), sums, feature, cut in zip(keys, every, *(v.tolist() for v in best_splits(every, self.options)[:2])):
            g, h = sums[0].sum(axis=0).tolist()
            gl, hl = sums[max(feature, 0), : cut + 1].sum(axis=0).tolist()
            lighter = 2 * node + (1 if hl <= h - hl else 2)
            feature = int(self.columns[fold, label][feature]) if feature >= 0 else -1
            out.append((fold, label, node, feature, cut, gl, hl, g, h, lighter, encoded(sums) if feature >= 0 and not self.last else None))
        return out


def _batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.float64()] * 4 + [pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * 11, kinds)], names="fold label node feature cut gl hl g h lighter sums".split())


def split_nodes(parts: DataFrame, parents: DataFrame | None, columns: dict, bins: int, options: BoostedOptions, last: bool, tasks: int) -> DataFrame:
    """NODES of a level: the merged sums of the nodes that were summed, those of their siblings, and the best split of each, found by ``tasks``."""
    if parents is not None:
        split = parents.filter("sums IS NOT NULL")
        parts = parts.unionByName(split.select("fold", "label", "node", (-F.col("lighter")).alias("slot"), "sums"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = Family(columns, bins, options, last)
        for batch in batches:
            family.add(batch)
        yield _batch_of(family.rows())

    # a node meets its parent: the child that was summed names both
    child = F.when(F.col("slot") < 0, -F.col("slot")).otherwise(F.col("node"))
    dealt = parts.repartition(1) if tasks == 1 else parts.repartition(tasks, "fold", "label", child)
    return dealt.mapInArrow(find, NODES)


def grown(state: DataFrame, problem: Problem, cuts: list[np.ndarray], active: set, turn: int, options: BoostedOptions) -> tuple[dict, dict]:
    """The trees of a round by (fold, label), and the evaluation loss of each fold before it."""
    width, bins, size = len(cuts), options.bins, 2 ** (options.depth + 1) - 1
    pairs = [(k, c) for k in sorted(active) for c in range(problem.n_classes)]
    trees = {pair: Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)) for pair in pairs}
    some = max(1, round(options.column_sample * width))
    columns = {(k, c): np.sort(np.random.default_rng([options.seed, turn, k, c]).choice(width, some, replace=False)) for k, c in pairs}
    summed, losses, parents = {pair: [0] for pair in pairs}, {}, None
    tasks = state.rdd.getNumPartitions()
    for level in range(options.depth):
        growing = {pair: (t.feature, t.cut) for pair, t in trees.items()}
        parts = level_sums(state, problem, width, columns, bins, growing, summed, level, turn, options, level == 0)
        nodes = sum(map(len, summed.values()))
        held = 3 * nodes * some * bins * 16  # parents and children too
        merging = min(MERGING_TASKS, max(min(tasks, -(-nodes // NODES_PER_TASK)), -(-held // MERGED_BYTES)))
        if tasks > MERGED_TASKS:
            parts = _fewer(parts, columns, bins, math.isqrt(tasks))
        nodes = split_nodes(parts, parents, columns, bins, options, level == options.depth - 1, merging).persist(StorageLevel.MEMORY_AND_DISK)
        following = {}
        for r in nodes.drop("sums").collect():
            pair, node = (r["fold"], r["label"]), r["node"]
            if r["label"] < 0:
                losses[r["fold"]] = r["g"] / r["h"] if r["h"] else None
                continue
            tree = trees[pair]
            if level == 0:
                tree.value[0] = leaf_value(r["g"], r["h"], options)
            if r["feature"] < 0:
                continue
            tree.feature[node], tree.cut[node] = r["feature"], r["cut"]
            tree.value[2 * node + 1] = leaf_value(r["gl"], r["hl"], options)
            tree.value[2 * node + 2] = leaf_value(r["g"] - r["gl"], r["h"] - r["hl"], options)
            following.setdefault(pair, []).append(r["lighter"])
        if parents is not None:
            parents.unpersist()
        parents, summed = nodes, {pair: sorted(lighter) for pair, lighter in following.items()}
        if not summed:
            break
    if parents is not None:
        parents.unpersist()
    return trees, losses


def _lowered(tree: Tree, depth: int) -> np.ndarray:
    """Values by node, where a row that walks ``depth`` levels finds that of the leaf it has passed."""
    value = tree.value.astype(np.float32)
    for node in range(2**depth - 1):
        if tree.feature[node] < 0:
            value[2 * node + 1] = value[node]
    return value


def advanced(state: DataFrame, problem: Problem, width: int, trees: dict, depth: int) -> DataFrame:
    """Margins after a round's trees."""
    below = {pair: _lowered(t, depth) for pair, t in trees.items()}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                _, _, _, x, margins = _unpacked(row, problem, width)
                margins, every = margins.copy(), np.arange(len(x))
                for (k, c), t in trees.items():
                    margins[:, k, c] += below[k, c].take(walked(t.feature, t.cut, x, every, depth))
                row["margins"] = margins.tobytes()
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    return state.mapInArrow(add, PACKED)


def fit_forests(view: DataFrame, problem: Problem, options: BoostedOptions) -> dict[int, BoostedScorer]:
    """An ensemble per fold on the rows of the others. ``view``: id, n_fold, target, features (a vector), best stored."""
    if not 2 <= options.bins <= 256:
        raise ValueError("bins must be 2 to 256")
    width = len(view.select(vector_to_array("features").alias("x")).first()["x"])
    cuts = cut_points(view, width, options.bins)
    # a view stored by fold may have fewer files than tasks that run at once, and a fold's rows side by side
    running = max(view.rdd.getNumPartitions(), view.sparkSession.sparkContext.defaultParallelism)
    tasks = max(1, min(running, -(-view.count() // ROWS_PER_TASK)))
    state = planned_once(stored(packed(view.repartition(tasks), problem, cuts), "boosting"), tasks)
    forests: dict[int, list] = {k: [] for k in problem.folds}
    active, before, kept = set(problem.folds), {}, []
    for turn in range(options.rounds):
        # the first pass of a round also computes the margins after the last one, which stay with their rows
        trees, losses = grown(state, problem, cuts, active, turn, options)
        for old in kept[:-1]:
            old.unpersist()
        kept = kept[-1:]
        if options.early_stop:
            for k in sorted(active):
                if losses.get(k) is not None and k in before and before[k] - losses[k] < options.min_progress * before[k]:
                    active.discard(k)
                before[k] = losses.get(k, before.get(k)) if losses.get(k) is not None else before.get(k, np.inf)
        trees = {(k, c): t for (k, c), t in trees.items() if k in active}
        for (k, c), t in sorted(trees.items()):
            forests[k].append((c, t))
        if not active:
            break
        state = advanced(state, problem, width, trees, options.depth)
        if (turn + 1) % WRITTEN_EVERY == 0:
            state = stored(state, "boosting")
        else:
            kept.append(state.persist(StorageLevel.MEMORY_AND_DISK))
    for old in kept:
        old.unpersist()
    padded = [np.append(c, np.full(256 - len(c), np.inf)) for c in cuts]
    return {k: _scorer(forests[k], padded, problem.n_classes, options.depth, width) for k in problem.folds}


def _scorer(trees: list, cuts: list[np.ndarray], classes: int, depth: int, width: int) -> BoostedScorer:
    size = 2 ** (depth + 1) - 1
    feature = np.array([t.feature for _, t in trees], np.int64).reshape(-1, size)
    cut = np.array([t.cut for _, t in trees], np.int64).reshape(-1, size)
    value = np.array([t.value for _, t in trees], float).reshape(-1, size)
    threshold = np.where(feature >= 0, np.stack(cuts)[np.maximum(feature, 0), cut], 0.0)
    return BoostedScorer(feature, threshold, value, np.array([c for c, _ in trees], np.int64), classes, depth, width)
