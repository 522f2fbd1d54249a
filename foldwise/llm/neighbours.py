"""Approximate nearest neighbours by largest inner product, with vantage-point trees per shard.

A shard's vectors are cut into shells whose norms differ by less than a factor of two, with a tree for each. In a shell with norms up to R a
vector x becomes the point (x / R, sqrt(1 - |x / R|^2)) of the unit sphere and a query q the point (q / |q|, 0); then q.x = |q| R (1 - d^2 / 2) for
their distance d, so the nearest points are those of the largest inner product, whatever the norms of other shells and of the query. A node of
a tree keeps the distances of its two halves from its vantage point. By the triangle inequality every point of a half is at least some gap
away from the query. A half is skipped when ``factor`` times its gap leads beyond the distance at which a point of this shell would have the
product of the worst neighbour found so far: with factor 1 the search is exact, larger ones skip more. Products that decide are those of the
original vectors, added in order of the components; a faster product only rules out what is worse by more than its rounding.

Shards hold rows by hash of their ids and are kept in memory one at a time; the queries stream by, in batches, against trees that are built
once. Equal vectors of a shard are one point with its smallest ids, as many as can ever be asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from foldwise.sources.scratch import stored

LEAF = 96
GAP_ERROR = 1e-7  # of the difference of two computed distances on the unit sphere, at most 6e-8
NONE = np.iinfo(np.int64).max  # the id where no neighbour is


@dataclass
class Node:
    begin: int
    end: int
    bounds: tuple[float, float, float, float] | None = None  # least and largest distance of the near and the far half; None in a leaf
    near: Node | None = None
    far: Node | None = None


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, added in order of the components."""
    total = np.zeros(len(queries))
    with np.errstate(all="ignore"):
        for j in range(queries.shape[1]):
            total += queries[:, j] * vectors[:, j]
    return total


def _scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows divided by a power of two so that their largest component is 0.5 to 1, and its exponent."""
    exponent = np.frexp(np.abs(vectors).max(axis=1))[1]
    return np.ldexp(vectors, -exponent[:, None]), exponent


class Tree:
    """Of vectors in one shell, with norms above 2^(shell - 1) and up to 2^shell."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, shell: int, seed: int = 5):
        points = np.ldexp(vectors, -shell)
        lifted = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", points, points), 0.0))
        self.points, self.shell = np.concatenate([points, lifted[:, None]], axis=1), shell
        self.order, self.rng = np.arange(len(vectors)), np.random.default_rng(seed)
        self.root = self._grow(0, len(vectors))
        self.points, self.vectors, self.ids = self.points[self.order], vectors[self.order], ids[self.order]
        with np.errstate(all="ignore"):
            # what a fast product of these may be off by, per norm of the query
            self.rounding = np.ldexp(4e-16 * (vectors.shape[1] + 4), min(shell, 1000))

    def _grow(self, begin: int, end: int) -> Node:
        if end - begin <= LEAF:
            return Node(begin, end)
        pick = begin + int(self.rng.integers(end - begin))
        self.order[[begin, pick]] = self.order[[pick, begin]]
        rest = self.order[begin + 1 : end]
        distance = _distance(self.points[rest] @ self.points[self.order[begin]])
        by = np.argsort(distance, kind="stable")
        self.order[begin + 1 : end], distance = rest[by], distance[by]
        half = len(rest) // 2
        bounds = (distance[0], distance[half - 1], distance[half], distance[-1])
        return Node(begin, end, bounds, self._grow(begin + 1, begin + 1 + half), self._grow(begin + 1 + half, end))


def _distance(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * dots, 0.0))


class Search:
    """The best ``k`` points of some trees for each query: by product, ties to the smaller id."""

    def __init__(self, queries: np.ndarray, k: int, factor: float):
        self.queries, self.k, self.factor = queries, k, factor
        scaled, self.exponents = _scaled(queries)
        self.norms = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))  # of the queries over 2^exponent
        self.units = scaled / self.norms[:, None]
        self.scores = np.full((len(queries), k), -np.inf)
        self.ids = np.full((len(queries), k), NONE)

    def run(self, tree: Tree) -> None:
        # products over 2^shell and the query's norm: a neighbour's share of the largest product a point of this shell can have
        with np.errstate(all="ignore"):
            self.largest = np.ldexp(self.norms, self.exponents + tree.shell)
        self._visit(tree, tree.root, np.arange(len(self.queries)))

    def _offer(self, tree: Tree, asking: np.ndarray, begin: int, end: int) -> None:
        worst = self.scores[asking, -1]
        with np.errstate(all="ignore"):
            fast = self.queries[asking] @ tree.vectors[begin:end].T
            off = np.ldexp(self.norms[asking] * tree.rounding, self.exponents[asking]) + 1e-300
            row, column = np.nonzero(~(fast < (worst - off)[:, None]))  # also where overflow left no number
        if not len(row):
            return
        exact = products(self.queries[asking[row]], tree.vectors[begin + column])
        some, place = np.unique(row, return_inverse=True)
        first = np.searchsorted(row, some)
        wide = np.arange(len(row)) - first[place]
        scores = np.full((len(some), self.k + wide.max() + 1), -np.inf)
        ids = np.full(scores.shape, NONE)
        scores[:, : self.k], ids[:, : self.k] = self.scores[asking[some]], self.ids[asking[some]]
        scores[place, self.k + wide], ids[place, self.k + wide] = np.where(np.isnan(exact), -np.inf, exact), tree.ids[begin + column]
        best = np.lexsort((ids, -scores), axis=1)[:, : self.k]
        self.scores[asking[some]] = np.take_along_axis(scores, best, axis=1)
        self.ids[asking[some]] = np.take_along_axis(ids, best, axis=1)

    def _visit(self, tree: Tree, node: Node, asking: np.ndarray) -> None:
        if not len(asking):
            return
        if node.bounds is None:
            self._offer(tree, asking, node.begin, node.end)
            return
        self._offer(tree, asking, node.begin, node.begin + 1)
        away = _distance(self.units[asking] @ tree.points[node.begin, :-1])
        a, b, c, d = node.bounds
        gaps = {"near": np.maximum(a - away, away - b), "far": np.maximum(c - away, away - d)}
        nearer = away <= (b + c) / 2
        for chosen, first, second in ((nearer, "near", "far"), (~nearer, "far", "near")):
            own = asking[chosen]
            for half in (first, second):
                if len(own):
                    gap = self.factor * np.maximum(gaps[half][chosen] - GAP_ERROR, 0.0)
                    with np.errstate(all="ignore"):
                        beyond = (1 - gap * gap / 2 + 1e-12) * self.largest[own] < self.scores[own, -1] - 1e-300
                    self._visit(tree, getattr(node, half), own[~beyond])


class Shard:
    """Trees of a shard's shells, those of the largest norms first, and the ids of its points, at most ``copies`` of each."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, copies: int):
        order = np.lexsort((ids, *vectors.T[::-1]))
        vectors, ids = vectors[order], ids[order]
        begins = np.nonzero(np.append(True, (vectors[1:] != vectors[:-1]).any(axis=1)))[0]
        # points are numbered in order of their smallest ids, so that ties by number are ties by id
        owned = sorted((ids[b : min(e, b + copies)] for b, e in zip(begins, np.append(begins[1:], len(ids)))), key=lambda x: x[0])
        by = np.argsort(ids[begins], kind="stable")
        self.ids, self.many = np.concatenate(owned), np.array([len(x) for x in owned])
        self.begins = np.cumsum(self.many) - self.many
        vectors, numbers = vectors[begins[by]], np.arange(len(by))
        scaled, exponents = _scaled(vectors)
        shells = exponents + np.ceil(np.log2(np.sqrt(np.einsum("ij,ij->i", scaled, scaled)) * (1 + 1e-12))).astype(np.int64)
        self.trees = [Tree(vectors[shells == s], numbers[shells == s], int(s)) for s in np.unique(shells)[::-1]]

    def nearest(self, queries: np.ndarray, query_ids: np.ndarray, k: int, factor: float) -> list[np.ndarray]:
        """(query, id, score) of each query's nearest here, without its own row."""
        # one more than asked for, since a query's own row is among them
        search = Search(queries, k + 1, factor)
        for tree in self.trees:
            search.run(tree)
        query, slot = np.nonzero(search.ids != NONE)
        number, score = search.ids[query, slot], search.scores[query, slot]
        many = self.many[number]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        query, score, point = np.repeat(query, many), np.repeat(score, many), self.ids[np.repeat(self.begins[number], many) + within]
        other = point != query_ids[query]
        query, score, point = query[other], score[other], point[other]
        by = np.lexsort((point, -score, query))
        query, score, point = query[by], score[by], point[by]
        best = np.arange(len(query)) - np.searchsorted(query, query, "left") < k
        return [query_ids[query[best]], point[best], score[best]]


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(key, vector) as doubles: without NULL, zero, or non-finite vectors and rows without an id."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
    return rows.filter(F.forall("vector", finite)).filter(F.exists("vector", lambda x: x != 0))


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), size).astype(np.float64)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int, bool], pa.RecordBatch]]:
    """Slices of a sorted batch with one size, shard and side."""
    keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("size", "shard", "asks")])
    edges = np.append(np.nonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))[0] + 1, keys.shape[1])
    begin = 0
    for end in edges.tolist():
        if end > begin:
            size, shard, asks = keys[:, begin].tolist()
            yield (size, shard, bool(asks)), batch.slice(begin, end - begin)
        begin = end


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, factor: float = 1.1, shard_rows: int = 32768, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Of each query (ids divisible by ``every``) the ``k`` nearest other rows found: query_id, rank, vec_id, score.

    Nearness is the largest inner product in double precision, ties go to the smaller id; a product that overflows to no number counts as the
    least. Rows without an id and vectors that are NULL, zero, or hold a NULL or non-finite component take no part. A vector meets those of
    its own length only. Rows that repeat an id with an equal vector are one; with different vectors, they are candidates each and one
    query each. Fewer candidates than ``k`` are all returned. An empty table gives an empty table.
    """
    rows = stored(usable(vectors, key, column).distinct(), "vectors")
    rows = rows.withColumn("size", F.size("vector"))
    counts = {r["size"]: r["count"] for r in rows.groupBy("size").count().collect()}  # one row per vector length
    # a few shards also where one would do, for as many tasks
    shards = F.coalesce(*[F.when(F.col("size") == s, F.lit(max(-(-n // shard_rows), min(8, -(-n // 512))))) for s, n in counts.items()], F.lit(1)).cast("int")
    held = rows.withColumn("shard", F.pmod(F.xxhash64("id"), shards).cast("int")).withColumn("asks", F.lit(False))
    # every query once for each shard
    asking = rows.filter(F.col("id") % every == 0).withColumn("shard", F.explode(F.sequence(F.lit(0), shards - 1))).withColumn("asks", F.lit(True))
    sides = held.unionByName(asking).repartition("size", "shard").sortWithinPartitions("size", "shard", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, points, shard = None, [], None
        for batch in batches:
            for (size, number, asks), part in _runs(batch):
                if (size, number) != at:
                    at, points, shard = (size, number), [], None
                mine = _matrix(part.column("vector"), size), part.column("id").to_numpy()
                if not asks:
                    points.append(mine)
                elif points:
                    shard = shard or Shard(*(np.concatenate(c) for c in zip(*points)), k + 1)
                    out = shard.nearest(*mine, k, factor)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["query_id", "vec_id", "score"])

    found = sides.select("size", "shard", "asks", "id", "vector").mapInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = found.distinct().withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
