"""Exact repeats of a fixed length across documents, by a difference cover of content-chosen positions.

Whole suffix arrays need every suffix sorted to a depth of ``LENGTH`` bytes. The difference-cover idea sorts a sample only, chosen so that any
two equal strings hold a sampled position at the same distance from their starts; the other suffixes follow from the few bytes before
the next sampled one and the sampled one's name. Here the sample are the positions whose hash of GRAM bytes is the smallest in some
window of LENGTH bytes: equal windows hold equal samples, at one distance below LENGTH - GRAM + 1, about one position in 14.

1. Documents are dealt into chunks and stored once. Texts equal to that of a smaller doc_id are repeats as a whole and leave here.
2. Samples are dealt by hash; those of one document alone can be in no repeat. A chunk gets a bit for each of its samples back. This only
   drops suffixes that have no equal.
3. The rest go, with the bytes around them, to the task of their hash range. It sorts the samples' triples (three 8-byte symbols) and
   names them by rank, names the triples that follow, and recurses on these names until they reach LENGTH bytes. Then the remaining
   suffixes are merged: the one d bytes before a sample is placed by those d bytes and by the sample's name. Adjacent entries whose common
   prefix has LENGTH bytes form a class, and the smallest doc_id of each class goes back to the chunks.
4. A chunk marks the windows that a smaller document also has, and cuts their union out.

Equal entries of a chunk are one row, so a passage that every document holds is one row per chunk. A sample with different bytes around it in
each document would be one row per occurrence, all in one bucket: names of more than HOT occurrences leave step 3. Every window that
touches one of their samples as it would there is sent instead, one row per chunk and window, dealt by a hash of its 50 bytes and
compared by them, so such a name spreads over as many tasks as its windows need.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import tasks, utf8
from foldwise.sources.scratch import scratch_path, stored

LENGTH, GRAM = 50, 24
REACH = LENGTH - GRAM  # bytes on either side of a sample that windows with it can touch
WIDE = REACH + GRAM + REACH
NONE = np.iinfo(np.int64).max
BLOCK = 1 << 20
#: samples that occur more often than this are not merged in one task
HOT = 100_000
GROUP = 1e6  # rows a task should merge
ROW = np.dtype([("near", np.uint8, WIDE), ("left", np.uint8), ("right", np.uint8), ("doc", "<i8")])
WINDOW = np.dtype([("bytes", np.uint8, LENGTH), ("doc", "<i8")])


def _slide(a: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        a = pick(a[:-have], a[have:])
        have *= 2
    return pick(a[: len(a) - (width - have)], a[width - have :]) if width > have else a


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_M = 0xD6E8FEB86659FD93


def _grams(raw: np.ndarray) -> np.ndarray:
    """A hash of the GRAM (24 = 16 + 8) bytes at every position."""
    h, factor = _BYTES[raw], _M
    have = 1
    for have in (1, 2, 4, 8):
        eight, h = h, h[:-have] * np.uint64(factor) + h[have:]
        factor = factor * factor % (1 << 64)
    # h covers 16 bytes, eight covers 8
    h = h[:-8] * np.uint64(pow(_M, 8, 1 << 64)) + eight[16:]
    return _mix(h)


def samples(raw: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sampled positions of concatenated texts and their names' hashes; room: bytes from each position to its text's end."""
    if len(raw) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = _grams(raw)
    least = _slide(h, REACH + 1, np.minimum)  # of the window that begins here
    least[room[: len(least)] < LENGTH] = 0  # not a window of one text
    padded = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
    at = np.nonzero((_slide(padded, REACH + 1, np.maximum) == h) & (h > 0))[0]
    return at, _mix(h[at] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


class Chunk:
    """The texts of a chunk that take part, and their samples."""

    def __init__(self, docs: list[pa.RecordBatch], sides: list[dict]):
        copies: dict[int, set[str]] = {}
        for row in sides:
            if row["kind"] == "copy":
                copies.setdefault(row["doc"], set()).add(bytes(row["blob"]).decode())
        rows = [(d, t) for batch in docs for d, t in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist())]
        rows.sort()
        self.copies = [(d, t) for d, t in rows if d in copies and hashlib.sha256(t).hexdigest() in copies[d]]
        gone = {d for d, _ in self.copies}
        self.rows = [(d, t) for d, t in rows if d not in gone or hashlib.sha256(t).hexdigest() not in copies[d]]
        sizes = np.array([len(t) for _, t in self.rows], np.int64)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.raw = np.frombuffer(b"".join(t for _, t in self.rows), np.uint8)
        self.docs = np.array([d for d, _ in self.rows], np.int64)
        at, names = [], []
        begin = 0
        while begin < len(sizes):  # blocks of whole texts that fit the cache
            end = max(begin + 1, int(np.searchsorted(self.ends, self.begins[begin] + BLOCK, "right")))
            a, b = self.begins[begin], self.ends[end - 1]
            room = np.repeat(self.ends[begin:end], sizes[begin:end]) - np.arange(a, b)
            x, y = samples(self.raw[a:b], room)
            at.append(x + a)
            names.append(y)
            begin = end
        self.at = np.concatenate([*at, np.empty(0, np.int64)])
        self.names = np.concatenate([*names, np.empty(0, np.uint64)])
        self.owner = np.searchsorted(self.ends, self.at, "right")

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct names in order, whether two documents have them, and how often they occur."""
        order = np.argsort(self.names, kind="stable")
        names, docs = self.names[order], self.docs[self.owner[order]]
        first = np.nonzero(np.append(True, names[1:] != names[:-1]))[0] if len(names) else np.empty(0, np.int64)
        last = np.append(first[1:], len(names)) - 1 if len(names) else first
        # rows are in order of doc, and so are equal names
        return names[first], docs[first] != docs[last], last - first + 1

    def shared(self, sides: list[dict], buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Which samples some other document also has: those that are merged by name, and those that occur too often for it."""
        names, *_ = self.distinct()
        bits = {row["bucket"]: np.frombuffer(row["blob"], np.uint8) for row in sides if row["kind"] == "bits"}
        found, hot = np.zeros(len(names), bool), np.zeros(len(names), bool)
        for bucket, a, b in _runs(_bucket(names, buckets)):
            wide = (b - a + 7) // 8
            found[a:b] = np.unpackbits(bits[bucket][:wide], count=b - a)
            if len(bits[bucket]) > wide:
                hot[a:b] = np.unpackbits(bits[bucket][wide:], count=b - a)
        place = np.searchsorted(names, self.names)
        return (found & ~hot)[place], hot[place]

    def windows(self, hot: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where windows with one of the ``hot`` samples begin, the row of each; different windows with their smallest doc, their buckets (ascending)."""
        begun = np.zeros(len(self.raw) + 1, bool)
        at, owner = self.at[hot], self.owner[hot]
        for d in range(REACH + 1):
            begun[at[(at - d >= self.begins[owner]) & (at - d + LENGTH <= self.ends[owner])] - d] = True
        at = np.nonzero(begun)[0]
        words = np.ndarray((max(len(self.raw) - 7, 0),), "<u8", self.raw, strides=(1,)) if len(at) else np.empty(0, "<u8")
        offsets = [*range(0, LENGTH - 8, 8), LENGTH - 8]
        h = np.zeros(len(at), np.uint64)
        for k in offsets:
            h = _mix(h * np.uint64(_M) + words[at + k])
        order = np.argsort(h, kind="stable")  # positions, and so docs, ascend among equal hashes
        h, sorted_at = h[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = h[1:] != h[:-1]
        for k in offsets:  # equal hashes are compared by their bytes
            w = words[sorted_at + k]
            new[1:] |= w[1:] != w[:-1]
        place = np.empty(len(at), np.int64)
        place[order] = np.cumsum(new) - 1
        first = sorted_at[new]
        rows = np.zeros(len(first), WINDOW)
        for a in range(0, len(first), 1 << 16):
            rows["bytes"][a : a + (1 << 16)] = self.raw[first[a : a + (1 << 16), None] + np.arange(LENGTH)]
        rows["doc"] = self.docs[np.searchsorted(self.ends, first, "right")]
        return at, place, rows, _bucket(h[new], buckets)

    def entries(self, chosen: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different rows around the chosen samples, their buckets (ascending), and the row of each sample."""
        at, owner = self.at[chosen], self.owner[chosen]
        rows = np.zeros(len(at), ROW)
        padded = np.concatenate([np.zeros(REACH, np.uint8), self.raw, np.zeros(WIDE, np.uint8)])
        rows["left"] = np.minimum(at - self.begins[owner], REACH)
        rows["right"] = np.minimum(self.ends[owner] - at - GRAM, REACH)
        rows["doc"] = self.docs[owner]
        columns = np.arange(WIDE)
        hashed = np.empty(len(at), np.uint64)
        for a in range(0, len(at), 1 << 16):
            part = rows[a : a + (1 << 16)]
            near = padded[at[a : a + (1 << 16), None] + columns]
            near *= (columns >= REACH - part["left"][:, None].astype(int)) & (columns < REACH + GRAM + part["right"][:, None].astype(int))
            part["near"] = near
            words = np.zeros((len(part), 80), np.uint8)
            words[:, :WIDE], words[:, WIDE], words[:, WIDE + 1] = near, part["left"], part["right"]
            h = self.names[chosen][a : a + (1 << 16)].copy()
            for k in range(10):
                h = _mix(h * np.uint64(_M) + words.view("<u8")[:, k])
            hashed[a : a + (1 << 16)] = h
        bucket = _bucket(self.names[chosen], buckets)
        order = np.lexsort((rows["doc"], hashed, bucket))
        rows, bucket, hashed = rows[order], bucket[order], hashed[order]
        new = np.ones(len(rows), bool)
        if len(rows):  # equal hashes are compared by their bytes
            new[1:] = (hashed[1:] != hashed[:-1]) | (bucket[1:] != bucket[:-1]) | (rows["left"][1:] != rows["left"][:-1]) | (rows["right"][1:] != rows["right"][:-1]) | (rows["near"][1:] != rows["near"][:-1]).any(axis=1)
        place = np.empty(len(rows), np.int64)
        place[order] = np.cumsum(new) - 1
        return rows[new], bucket[new], place


def _bucket(names: np.ndarray, buckets: int) -> np.ndarray:
    return ((names >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _runs(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    names, starts = np.unique(sorted_values, return_index=True)
    for name, a, b in zip(names.tolist(), starts.tolist(), [*starts[1:].tolist(), len(sorted_values)]):
        yield name, a, b


def _five(names: np.ndarray, flags: np.ndarray) -> bytes:
    """39 bits of each name and a flag, in five bytes. Too few bits only let more samples through."""
    values = ((names << np.uint64(1)) & np.uint64((1 << 40) - 2)) | flags.astype(np.uint64)
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unfive(blob: bytes) -> np.ndarray:
    packed = np.zeros((len(blob) // 5, 8), np.uint8)
    packed[:, :5] = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    return packed.view("<u8").ravel()


def name_triples(*symbols: np.ndarray) -> np.ndarray:
    """The rank of each triple of symbols among all; equal triples have one rank."""
    order = np.lexsort(symbols[::-1])
    new = np.zeros(len(order), bool)
    for s in symbols:
        s = s[order]
        new[1:] |= s[1:] != s[:-1]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new)
    return names


def _prefixes(text: np.ndarray, sort_by: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by ``sort_by``, and the bytes each entry shares with the one before it in that order; -1 for the first."""
    order = np.argsort(sort_by, kind="stable")
    common = np.empty(len(order), np.int16)
    for a in range(0, len(order), 1 << 16):
        rows = text[order[max(a - 1, 0) : a + (1 << 16)]]
        differs = rows[1:] != rows[:-1]
        found = np.where(differs.any(axis=1), differs.argmax(axis=1), text.shape[1])
        common[max(a, 1) : a + (1 << 16)] = found
    if len(common):
        common[0] = -1
    return order, common


def _words(text: np.ndarray, n: int) -> list[np.ndarray]:
    padded = np.zeros((len(text), 8 * n), np.uint8)
    padded[:, : text.shape[1]] = text
    return [c.astype(np.uint64) for c in padded.view(">u8").T]


def classes(rows: np.ndarray) -> np.ndarray:
    """For each entry and each distance d up to REACH, the smallest document that has the window beginning d bytes before the sample.

    NONE where the text has no such window.
    """
    n = len(rows)
    least = np.full((n, REACH + 1), NONE)
    if not n:
        return least
    onward = rows["near"][:, REACH:]
    w = _words(onward, 7)
    # triples of symbols, then triples of their names: 24, then 50 bytes and padding
    names = name_triples(name_triples(*w[:3]), name_triples(*w[3:6]), w[6])
    order, onward_common = _prefixes(onward, names, GRAM)
    back = rows["near"][:, REACH - 1 :: -1]
    v = _words(back, 4)
    back_order, back_common = _prefixes(back, name_triples(name_triples(*v[:3]), v[3]), 0)
    for d in range(REACH + 1):
        taking = (rows["left"] >= d) & (rows["right"] >= REACH - d)
        after, before = np.empty(n, np.int64), np.empty(n, np.int64)
        after[order] = np.cumsum(onward_common < LENGTH - d)
        before[back_order] = np.cumsum(back_common < d)
        key = after[taking] * np.int64(n + 1) + before[taking]
        by = np.argsort(key, kind="stable")
        key, docs = key[by], rows["doc"][taking][by]
        if len(key):
            first = np.nonzero(np.append(True, key[1:] != key[:-1]))[0]
            low = np.minimum.reduceat(docs, first)
            own = np.empty(len(key), np.int64)
            own[by] = np.repeat(low, np.diff(np.append(first, len(key))))
            least[taking, d] = own
    return least


def window_classes(rows: np.ndarray) -> np.ndarray:
    """For each window the smallest document that has it."""
    w = _words(rows["bytes"], 7)
    names = name_triples(name_triples(*w[:3]), name_triples(*w[3:6]), w[6])
    least = np.full(len(rows), NONE)
    np.minimum.at(least, names, rows["doc"])
    return least[names]


def _counted(names: np.ndarray, twice: np.ndarray, counts: np.ndarray) -> bytes:
    """``_five``, then a byte for each count: the power of two that is not below it."""
    return _five(names, twice) + np.ceil(np.log2(counts)).astype(np.uint8).tobytes()


def _shorten(least: np.ndarray) -> bytes:
    """Rows of few different values: where each value begins, and the value."""
    new = np.ones(least.shape, bool)
    new[:, 1:] = least[:, 1:] != least[:, :-1]
    return zstandard.ZstdCompressor(1).compress(np.packbits(new, axis=1).tobytes() + least[new].astype("<i8").tobytes())


def _lengthen(blob: bytes, n: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    wide = (REACH + 8) // 8
    new = np.unpackbits(np.frombuffer(raw, np.uint8, n * wide).reshape(n, wide), axis=1, count=REACH + 1).astype(bool)
    values = np.frombuffer(raw, "<i8", offset=n * wide)
    return values[np.cumsum(new.ravel()) - 1].reshape(n, REACH + 1)


SIDES = "chunk long, kind string, bucket long, doc long, blob binary"


def removed_repeats(docs: DataFrame, chunk_bytes: float = 8e6) -> DataFrame:
    """What is left of each document without the 50-byte strings that a smaller doc_id also holds.

    ``docs`` needs doc_id and text; other columns are ignored. Texts are UTF-8 bytes, NULL is empty. Every byte covered by such a string is
    removed; overlaps count, and strings are judged on the input. Returns doc_id, n_bytes, n_removed, n_spans, spans (begin and end, in
    turn, of each run removed) and kept_sha256. Rows that repeat a doc_id are not smaller than each other. NULL ids are larger than all
    others. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NONE)).alias("doc"), utf8().alias("text"))
    size = own.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = tasks(spark, size, chunk_bytes)
    buckets = tasks(spark, size / 14, GROUP)
    bound = HOT
    dealt = own.select(F.pmod(F.xxhash64("doc", "text"), F.lit(chunks)).alias("chunk"), "doc", "text")
    # stored by chunk: each pass below reads whole chunks without shuffling a text again
    name = f"foldwise_chunks_{uuid.uuid4().hex}"
    path = scratch_path(spark, "chunks")
    by_chunk = dealt.repartition(chunks, "chunk").write.bucketBy(chunks, "chunk").option("path", path).option("compression", "zstd")
    by_chunk.saveAsTable(name)
    base = spark.table(name)
    small = stored(base.select("chunk", "doc", F.sha2("text", 256).alias("sha")), "shas")
    firsts = small.groupBy("sha").agg(F.min("doc").alias("first"))
    later = small.join(firsts, "sha").filter("doc > first")
    sides = stored(later.select("chunk", F.lit("copy").alias("kind"), F.lit(-1).cast("long").alias("bucket"), "doc", F.col("sha").cast("binary").alias("blob")), "copies")

    def passing(function, schema: str, given: DataFrame) -> DataFrame:
        def run(key: tuple, texts: pa.Table, rows: pa.Table) -> pa.Table:
            extra = rows.to_pylist()
            return function(key[0].as_py(), Chunk(texts.to_batches(), extra), extra)

        return base.groupBy("chunk").cogroup(given.groupBy("chunk")).applyInArrow(run, schema)

    def hashes(chunk: int, own: Chunk, _: list) -> pa.Table:
        names, twice, counts = own.distinct()
        runs = list(_runs(_bucket(names, buckets)))
        blobs = [_counted(names[a:b], twice[a:b], counts[a:b]) for _, a, b in runs]
        return pa.table({"bucket": pa.array([r[0] for r in runs], pa.int64()), "chunk": pa.array([chunk] * len(runs), pa.int64()), "blob": pa.array(blobs, pa.binary())})

    def in_two(key: tuple, rows: pa.Table) -> pa.Table:
        given = rows.column("blob").to_pylist()
        sizes = [len(b) // 6 for b in given]
        both = np.concatenate([_unfive(b[: 5 * n]) for b, n in zip(given, sizes)])
        often = np.ldexp(1.0, np.concatenate([np.frombuffer(b, np.uint8, offset=5 * n) for b, n in zip(given, sizes)]).astype(np.int32))
        _, place, counts = np.unique(both >> np.uint64(1), return_inverse=True, return_counts=True)
        hit = ((both & np.uint64(1)) == 1) | (counts > 1)[place]
        hot = hit & (np.bincount(place, often) > bound)[place]
        blobs, weights = [], []
        for e, n in zip(np.cumsum(sizes).tolist(), sizes):
            own, much = hit[e - n : e], hot[e - n : e]
            blobs.append(np.packbits(own).tobytes() + (np.packbits(much).tobytes() if much.any() else b""))
            weights.append(int(often[e - n : e][much].sum()))
        n = len(blobs)
        # doc: how many occurrences are hot
        return pa.table({"chunk": rows.column("chunk"), "kind": pa.array(["bits"] * n), "bucket": pa.array([key[0].as_py()] * n, pa.int64()), "doc": pa.array(weights, pa.int64()), "blob": pa.array(blobs, pa.binary())})

    found = passing(hashes, "bucket long, chunk long, blob binary", sides)
    shared = stored(found.groupBy("bucket").applyInArrow(in_two, SIDES), "shared-samples")
    sides = sides.union(shared)
    # each hot sample is in at most REACH + 1 windows; their buckets are numbered after the others
    spread = tasks(spark, (REACH + 1.0) * (shared.agg(F.sum("doc")).first()[0] or 0), GROUP)

    def entries(chunk: int, own: Chunk, extra: list) -> pa.Table:
        cold, hot = own.shared(extra, buckets)
        rows, bucket, _ = own.entries(cold, buckets)
        _, _, windows, window_bucket = own.windows(hot, spread)
        runs = list(_runs(bucket))
        blobs = [zstandard.ZstdCompressor(1).compress(rows[a:b].tobytes()) for _, a, b in runs]
        for b, x, y in _runs(window_bucket):
            runs.append((buckets + b, x, y))
            blobs.append(zstandard.ZstdCompressor(1).compress(windows[x:y].tobytes()))
        return pa.table({"bucket": pa.array([r[0] for r in runs], pa.int64()), "chunk": pa.array([chunk] * len(runs), pa.int64()), "blob": pa.array(blobs, pa.binary())})

    def merged(key: tuple, given: pa.Table) -> pa.Table:
        by_window = key[0].as_py() >= buckets
        parts = [np.frombuffer(zstandard.ZstdDecompressor().decompress(b), WINDOW if by_window else ROW) for b in given.column("blob").to_pylist()]
        least = (window_classes if by_window else classes)(np.concatenate(parts))
        pack = (lambda x: zstandard.ZstdCompressor(1).compress(x.astype("<i8").tobytes())) if by_window else _shorten
        ends = np.cumsum([len(p) for p in parts])
        blobs = [pack(least[e - len(p) : e]) for p, e in zip(parts, ends)]
        n = len(blobs)
        return pa.table({"chunk": given.column("chunk"), "kind": pa.array(["least"] * n), "bucket": pa.array([key[0].as_py()] * n, pa.int64()), "doc": pa.nulls(n, pa.int64()), "blob": pa.array(blobs, pa.binary())})

    around = passing(entries, "bucket long, chunk long, blob binary", sides)
    sides = sides.union(stored(around.groupBy("bucket").applyInArrow(merged, SIDES), "least-documents"))

    def cut(chunk: int, own: Chunk, extra: list) -> pa.Table:
        chosen, hot = own.shared(extra, buckets)
        rows, bucket, place = own.entries(chosen, buckets)
        blobs = {row["bucket"]: row["blob"] for row in extra if row["kind"] == "least"}
        begins = np.zeros(len(own.raw) + LENGTH + 1, np.int32)
        at, docs = own.at[chosen], own.docs[own.owner[chosen]]
        order = np.argsort(place, kind="stable")
        reached = np.searchsorted(place[order], np.arange(len(rows) + 1))
        for b, x, y in _runs(bucket):
            least = _lengthen(blobs[b], y - x)
            mine = order[reached[x] : reached[y]]
            for a in range(0, len(mine), 1 << 16):
                part = mine[a : a + (1 << 16)]
                who, d = np.nonzero(least[place[part] - x] < docs[part, None])
                begins[at[part[who]] - d] = 1
        where, place, windows, window_bucket = own.windows(hot, spread)
        least = np.empty(len(windows), np.int64)
        for b, x, y in _runs(window_bucket):
            least[x:y] = np.frombuffer(zstandard.ZstdDecompressor().decompress(blobs[buckets + b]), "<i8")
        begins[where[least[place] < own.docs[np.searchsorted(own.ends, where, "right")]]] = 1
        # windows that began up to here, less those that began LENGTH bytes ago
        begun = np.cumsum(begins, dtype=np.int32)
        covered = begun[: len(own.raw)] > np.concatenate([np.zeros(LENGTH, np.int32), begun])[: len(own.raw)]
        out = []
        for (doc, text), a, b in zip(own.rows, own.begins.tolist(), own.ends.tolist()):
            gone = covered[a:b]
            edge = np.nonzero(np.diff(np.concatenate([[False], gone, [False]])))[0]
            kept = text if not len(edge) else own.raw[a:b][~gone].tobytes()
            out.append((doc, len(text), len(text) - len(kept), len(edge) // 2, edge.tolist(), hashlib.sha256(kept).hexdigest()))
        for doc, text in own.copies:
            whole = len(text) >= LENGTH
            out.append((doc, len(text), len(text) if whole else 0, int(whole), [0, len(text)] if whole else [], hashlib.sha256(b"" if whole else text).hexdigest()))
        columns = list(zip(*out)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string())
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names="doc n_bytes n_removed n_spans spans kept_sha256".split())

    result = passing(cut, "doc long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept_sha256 string", sides)
    spark.sql(f"DROP TABLE {name}")  # its files stay until the shared folder is cleared
    return result.select(F.when(F.col("doc") != NONE, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256")
