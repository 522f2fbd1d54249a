"""Near-duplicate vectors by cosine: products of int8 tiles with error bounds, and full precision where those leave a pair open.

Vectors are dealt into tiles by row. A tile is packed once: equal vectors of it are one point that counts for all its rows, and each point
is scaled to length one and rounded to whole numbers of -127 to 127 times a scale of its own. The length e of what rounding left out is
kept, so the cosine of two points differs from the scaled product of their whole numbers by at most e1 + e2 + e1 e2. Every two tiles meet in one
task, which multiplies them block by block: the product of whole numbers is exact in single precision. A pair whose bound lies above the
least cosine is a link, one whose bound lies below is none, and only pairs in between are computed again from the vectors in double precision.

A task gives back how many rows each point is linked to, and a forest of its links; so neither copies nor groups of near copies become pairs.
Comparing all tiles with all is work that grows with the square of the number of different vectors; memory and rows written do not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.components import components
from foldwise.llm.simhash import _forest
from foldwise.sources.scratch import stored

TILE = 8192  # rows
SIDE = 1024  # points of a block
EXACT = 1024  # dimensions whose products of whole numbers add up exactly in single precision: 1024 * 127^2 < 2^24
SLACK = 1e-9  # for rounding in double precision, far above it

TILES = "size int, tile int, ids array<long>, points array<int>, firsts array<long>, many array<long>, codes binary, scales binary, errors binary, vectors binary"


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows in doubles, divided by a power of two, which changes no cosine and lets no square overflow."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors.astype(np.float64), -exponent)


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers, scale and length of the rounding error of each vector scaled to length one."""
    x = scaled(vectors)
    unit = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    left = unit - codes * scale[:, None]
    return codes, scale, np.sqrt(np.einsum("ij,ij->i", left, left)) + 1e-12


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows, in double precision."""
    total = np.zeros((3, len(x)))
    for j in range(x.shape[1]):  # in order of the components, whatever the number of rows
        total += (x[:, j] * y[:, j], x[:, j] * x[:, j], y[:, j] * y[:, j])
    return total[0] / (np.sqrt(total[1]) * np.sqrt(total[2]))


def _packed(table: pa.Table, size: int) -> dict:
    """One tile. Points are in order of their scales, so that blocks have scales of their own."""
    flat = table.column("vector").combine_chunks()
    vectors = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), size)
    ids = table.column("id").to_pylist()
    order = np.lexsort(vectors.T[::-1])
    new = np.append(True, (vectors[order][1:] != vectors[order][:-1]).any(axis=1))
    point = np.empty(len(order), np.int64)
    point[order] = np.cumsum(new) - 1
    vectors = vectors[order[new]]
    codes, scales, errors = quantised(vectors)
    by = np.argsort(scales, kind="stable")
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    point = rank[point]
    firsts: list = [None] * len(by)
    for i, p in zip(ids, point):
        if i is not None and (firsts[p] is None or i < firsts[p]):
            firsts[p] = i
    return {
        "ids": ids,
        "points": point.tolist(),
        "firsts": firsts,
        "many": np.bincount(point).tolist(),
        "codes": codes[by].tobytes(),
        "scales": scales[by].tobytes(),
        "errors": errors[by].tobytes(),
        "vectors": vectors[by].tobytes(),
    }


PACKED = pa.schema(
    [("size", pa.int32()), ("tile", pa.int32()), ("ids", pa.list_(pa.int64())), ("points", pa.list_(pa.int32())), ("firsts", pa.list_(pa.int64())), ("many", pa.list_(pa.int64()))]
    + [(c, pa.binary()) for c in ("codes", "scales", "errors", "vectors")]
)


class Tile:
    def __init__(self, row: dict, size: int, kind: np.dtype):
        self.number, self.firsts = row["tile"], row["firsts"]
        self.many = np.array(row["many"], np.int64)
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(-1, size)
        self.scales, self.errors = np.frombuffer(row["scales"]), np.frombuffer(row["errors"])
        self.vectors = np.frombuffer(row["vectors"], kind).reshape(-1, size)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of all rows of whole numbers."""
    total = None
    for j in range(0, a.shape[1], EXACT):
        part = a[:, j : j + EXACT].astype(np.float32) @ b[:, j : j + EXACT].astype(np.float32).T
        total = part if total is None else total.astype(np.float64) + part
    return total


def links_between(a: Tile, b: Tile, least: float):
    """(point of a, point of b) in blocks: all pairs with a cosine of ``least`` or more, in a tile with itself those of a larger second point."""
    same = a is b
    for i in range(0, len(a.codes), SIDE):
        left = slice(i, i + SIDE)
        for j in range(i if same else 0, len(b.codes), SIDE):
            right = slice(j, j + SIDE)
            dots = product(a.codes[left], b.codes[right])
            off = (1 + a.errors[left].max()) * (1 + b.errors[right].max()) - 1 + SLACK
            # the largest scales make the least product that could reach the bound
            x, y = np.nonzero(dots >= (least - off) / (a.scales[left].max() * b.scales[right].max()) if off < least else dots == dots)
            if same and i == j:
                x, y = x[x < y], y[x < y]
            near, off = dots[x, y].astype(np.float64) * a.scales[left][x] * b.scales[right][y], (1 + a.errors[left][x]) * (1 + b.errors[right][y]) - 1 + SLACK
            sure, open_ = near - off >= least, (near - off < least) & (near + off >= least)
            at = np.nonzero(open_)[0]
            for begin in range(0, len(at), 1 << 16):
                some = at[begin : begin + (1 << 16)]
                sure[some] = cosines(scaled(a.vectors[i + x[some]]), scaled(b.vectors[j + y[some]])) >= least
            if sure.any():
                yield i + x[sure], j + y[sure]


def met(a: Tile, b: Tile, least: float) -> tuple[list[tuple], list[tuple]]:
    """Of two tiles, or of one with itself: (tile, point, linked rows), and links ((tile, point), (tile, point)) that join all that is linked."""
    counts = [np.zeros(len(t.codes), np.int64) for t in ((a,) if a is b else (a, b))]
    forest, shift = np.empty((0, 2), np.uint64), 0 if a is b else len(a.codes)
    for x, y in links_between(a, b, least):
        np.add.at(counts[0], x, b.many[y])
        np.add.at(counts[-1], y, a.many[x])
        forest = _forest(np.concatenate([forest, np.stack([x, y + shift], axis=1).astype(np.uint64)]))
    name = lambda p: (a, p) if p < len(a.codes) else (b, p - len(a.codes))
    found = [(t, int(p), int(c[p])) for t, c in zip((a, b), counts) for p in np.nonzero(c)[0]]
    return found, [(*name(int(p)), *name(int(q))) for p, q in forest]


MET = "size int, tile int, point int, first long, tile2 int, point2 int, first2 long, n long"


def near_vectors(vectors: DataFrame, least: float = 0.95, tile_rows: int = TILE, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links (other rows linked directly), component_id (the smallest vec_id reachable), kept (it is the row's own).

    Two rows are linked if their cosine in double precision is ``least`` or more. Vectors that are NULL, empty, zero, or hold a NULL or
    non-finite component link with nothing, nor do vectors of different lengths. Rows that repeat an id are rows of their own, equal vectors
    are linked. Rows without an id are linked and counted like others; they name a component only where there is no id, with NULL. Other
    columns are ignored. An empty table gives an empty table.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine must be above 0 and at most 1")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    single = vectors.schema[column].dataType.elementType.typeName() == "float"
    kind, name = (np.dtype(np.float32), "float") if single else (np.dtype(np.float64), "double")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast(f"array<{name}>").alias("vector"))
    usable = F.col("vector").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    apart = rows.filter(~usable).select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    rows = rows.filter(usable).withColumn("size", F.size("vector"))
    # one row per length of vectors; a few tiles also where one would do, for as many tasks
    sizes = {r["size"]: max(-(-r["count"] // tile_rows), min(4, -(-r["count"] // 512))) for r in rows.groupBy("size").count().collect()}
    number = F.coalesce(*[F.when(F.col("size") == s, F.lit(n)) for s, n in sizes.items()], F.lit(1)).cast("int")
    # by row, not by id: ids and vectors may repeat as they like
    dealt = rows.withColumn("tile", F.pmod(F.xxhash64(F.monotonically_increasing_id()), number).cast("int"))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        size, tile = (k.as_py() for k in key)
        return pa.Table.from_pylist([{"size": size, "tile": tile, **_packed(table, size)}], schema=PACKED)

    tiles = stored(dealt.groupBy("size", "tile").applyInArrow(pack, TILES), "tiles")

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        size = key[0].as_py()
        both = [Tile(row, size, kind) for row in table.to_pylist()]
        counts, links = met(both[0], both[-1], least)
        out = [(size, t.number, p, t.firsts[p], None, None, None, n) for t, p, n in counts]
        out += [(size, s.number, p, s.firsts[p], t.number, q, t.firsts[q], None) for s, p, t, q in links]
        kinds = [pa.int32(), *[pa.int32(), pa.int32(), pa.int64()] * 2, pa.int64()]
        return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out) if out else [()] * 8, kinds)], names="size tile point first tile2 point2 first2 n".split())

    # each tile once for every tile it meets
    meeting = tiles.drop("ids", "points").withColumn("other", F.explode(F.sequence(F.lit(0), number - 1)))
    meeting = meeting.withColumn("one", F.least("tile", "other")).withColumn("two", F.greatest("tile", "other"))
    found = stored(meeting.groupBy("size", "one", "two").applyInArrow(meet, MET), "links")
    # the least node of a component is that of its smallest id
    node = lambda tile, point, first: F.struct(F.col(first).isNull().alias("nameless"), F.col(first).alias("first"), "size", F.col(tile).alias("tile"), F.col(point).alias("point"))
    links = found.filter("n IS NULL").select(node("tile", "point", "first").alias("a"), node("tile2", "point2", "first2").alias("b"))
    roots = components(links).select("node.size", "node.tile", "node.point", F.lit(True).alias("joined"), F.col("root.first").alias("root"))
    counts = found.filter("n IS NOT NULL").groupBy("size", "tile", "point").agg(F.sum("n").alias("n"))
    member = F.explode(F.arrays_zip("ids", "points")).alias("m")
    members = tiles.select("size", "tile", "firsts", "many", member).select("size", "tile", F.col("m.points").alias("point"), F.col("m.ids").alias("id"), F.get("firsts", "m.points").alias("first"), F.get("many", "m.points").alias("many"))
    place = ["size", "tile", "point"]
    whole = members.join(counts, place, "left").join(roots, place, "left")
    component = F.when(F.col("joined"), F.col("root")).otherwise(F.col("first"))
    linked = whole.select(F.col("id").alias(key), (F.col("many") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), component.alias("component_id"))
    return linked.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id"))).unionByName(apart)
