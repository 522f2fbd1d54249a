"""SimHash near-duplicates found through the perfect Golay code.

The 64 bits are three segments of 22, 21 and 21 bits. With at most three differing bits, two of the segments differ by at most one bit
each (two segments with two or more would make four). Every 23-bit word is within three bits of exactly one of the 4096 Golay
codewords. Of two words one bit apart, the codeword of the one is among the codewords of the other and of its neighbours at one
bit, which are at most six: one, when the word is within two bits of its codeword. So a fingerprint is stored under the pair of its
codeword indices for each of the three pairs of segments, and looks up all pairs of its neighbours' indices.

Equal fingerprints are one row before any of this. Keys are packed by bucket; a task verifies the pairs of its bucket by their bits and
returns links to one member of each group only, so a group of n near copies gives n - 1 links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from foldwise.llm.common import tasks, utf8
from foldwise.llm.components import components
from foldwise.sources.scratch import stored

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, which generates the (23, 12) Golay code
BLOCK = 1 << 21


def fingerprint(text: bytes, words: int = 3) -> int:
    """A bit is set if it is set in over half of the hashes of the text's shingles of ``words`` words; 0 without words."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    n = max(1, len(parts) - words + 1)
    begins = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins, ends[len(parts) - n :].tolist())]
    ones = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 16):
        bits = np.unpackbits(np.array(hashes[a : a + (1 << 16)], "<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, bits): the fingerprint as the 64 bits of a long."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], names=["doc_id", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", utf8().alias("text")).mapInArrow(batches_of, f"doc_id {kind}, bits long")


def _errors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pattern of at most three bits for each syndrome, and the syndromes of the upper and lower halves of a word."""
    single = []
    for i in range(23):
        r = 1 << i
        for b in range(22, 10, -1):
            if r >> b & 1:
                r ^= GENERATOR << (b - 11)
        single.append(r)
    pattern = np.zeros(2048, np.uint32)
    for i in range(23):
        pattern[single[i]] = 1 << i
        for j in range(i):
            pattern[single[i] ^ single[j]] = 1 << i | 1 << j
            for k in range(j):
                pattern[single[i] ^ single[j] ^ single[k]] = 1 << i | 1 << j | 1 << k
    half = np.arange(4096)
    low, high = np.zeros(4096, np.uint32), np.zeros(4096, np.uint32)
    for i in range(12):
        low ^= np.where(half >> i & 1, single[i], 0).astype(np.uint32)
        if i < 11:
            high ^= np.where(half >> i & 1, single[i + 12], 0).astype(np.uint32)
    return pattern, low, high


PATTERN, LOW, HIGH = _errors()


def codeword(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword within three bits of each 23-bit word."""
    return (words ^ PATTERN[LOW[words & 4095] ^ HIGH[words >> 12]]) >> np.uint32(11)


def neighbours(words: np.ndarray, bits: int) -> np.ndarray:
    """Codeword indices of each word and of the words one of its ``bits`` bits away: at most 6 in a row, -1 beyond."""
    flips = np.concatenate([[0], 1 << np.arange(bits)]).astype(np.uint32)
    found = np.sort(codeword(words[:, None] ^ flips).astype(np.int32), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return -np.sort(-found, axis=1)[:, :6]


def stored_keys(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) for the three pairs of segments."""
    index = [codeword(_segment(bits, s)) for s in range(3)]
    keys = np.concatenate([_key(p, index[a], index[b]) for p, (a, b) in enumerate(PAIRS)])
    return keys, np.tile(bits, 3)


def probe_keys(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) for all pairs of neighbouring indices."""
    near = [neighbours(_segment(bits, s), SEGMENTS[s][1]) for s in range(3)]
    keys, owners = [], []
    for p, (a, b) in enumerate(PAIRS):
        both = (near[a][:, :, None] >= 0) & (near[b][:, None, :] >= 0)
        key = _key(p, near[a][:, :, None].astype(np.uint32), near[b][:, None, :].astype(np.uint32))
        keys.append(key[both])
        owners.append(np.broadcast_to(bits[:, None, None], both.shape)[both])
    return np.concatenate(keys), np.concatenate(owners)


def _segment(bits: np.ndarray, s: int) -> np.ndarray:
    begin, width = SEGMENTS[s]
    return ((bits >> np.uint64(begin)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def _key(pair: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.uint32(pair << 24) | a.astype(np.uint32) << np.uint32(12) | b.astype(np.uint32)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys * np.uint32(2654435761)).astype(np.uint64) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


ROW = np.dtype([("key", "<u4"), ("bits", "<u8")])


def _packed(keys: np.ndarray, bits: np.ndarray, buckets: int) -> dict[int, bytes]:
    bucket = _bucket(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    rows = np.empty(len(keys), ROW)
    rows["key"], rows["bits"] = keys[order], bits[order]
    names, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts[1:], len(rows))
    return {int(b): rows[x:y].tobytes() for b, x, y in zip(names, starts, ends)}


def near_links(distinct: DataFrame, n: int, distance: int = 3) -> DataFrame:
    """(a, b): links that join all fingerprints of ``distinct`` (bits, n rows) with at most ``distance`` (3 or less) differing bits."""
    if distance > 3:
        raise ValueError("three segments tell at most three differing bits")
    buckets = tasks(distinct.sparkSession, 111.0 * n, 1e6)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy().view(np.uint64)
            for a in range(0, len(bits), 4096):
                stored_rows = _packed(*stored_keys(bits[a : a + 4096]), buckets)
                probing = _packed(*probe_keys(bits[a : a + 4096]), buckets)
                names = sorted({*stored_rows, *probing})
                columns = [pa.array(names, pa.int64())] + [pa.array([x.get(b, b"") for b in names], pa.binary()) for x in (stored_rows, probing)]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "stored", "probing"])

    def verify(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = ([], [])
        for batch in rows:
            for side, name in zip(parts, ("stored", "probing")):
                side += [np.frombuffer(x.as_py(), ROW) for x in batch.column(name)]
        a, b = links_within(*(np.concatenate(side) for side in parts), distance)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    # few fingerprints in many partitions would be dealt into many small rows
    spread = distinct.select("bits").coalesce(max(1, -(-n // 50_000)))
    return spread.mapInArrow(deal, "bucket long, stored binary, probing binary").groupBy("bucket").applyInArrow(verify, "a long, b long")


def links_within(held: np.ndarray, probing: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of links between the fingerprints of a bucket that share a key and differ by at most ``distance`` bits.

    Candidates are looked at in blocks of bounded size; after each block its links shrink to a forest.
    """
    held = held[np.argsort(held["key"], kind="stable")]
    low = np.searchsorted(held["key"], probing["key"], "left")
    many = np.searchsorted(held["key"], probing["key"], "right") - low
    probing, low, many = probing[many > 0], low[many > 0], many[many > 0]
    forest = np.empty((0, 2), np.uint64)
    begin, reach = 0, np.cumsum(many)
    while begin < len(many):
        done = reach[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(reach, done + BLOCK, "right")))
        for part in range(0, int(many[begin]) if end == begin + 1 else 1, BLOCK):
            count = many[begin:end] if end > begin + 1 else np.minimum(many[begin:end] - part, BLOCK)
            total = np.cumsum(count)
            where = np.repeat(low[begin:end] + part - (total - count), count) + np.arange(total[-1])
            a, b = np.repeat(probing["bits"][begin:end], count), held["bits"][where]
            near = (a > b) & (np.bitwise_count(a ^ b) <= distance)
            if near.any():
                forest = _forest(np.concatenate([forest, np.stack([a[near], b[near]], axis=1)]))
        begin = end
    return forest[:, 0].copy(), forest[:, 1].copy()


def _forest(links: np.ndarray) -> np.ndarray:
    """Links of every node to the smallest node of its component."""
    nodes, place = np.unique(links, return_inverse=True)
    a, b = place.reshape(links.shape).T
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    away = root != np.arange(len(nodes))
    return np.stack([nodes[away], nodes[root[away]]], axis=1)


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text; other columns are ignored).

    Texts are lower-cased in A-Z and cut into shingles of ``words`` words; a text of fewer words is one shingle, one without words (also
    NULL) has fingerprint zero and is linked like any other. component_id is the smallest doc_id of all that can be reached by links of
    at most ``distance`` differing bits, the document's own included; NULL ids count for it only where there is no other. Rows that
    repeat a doc_id stay. An empty table gives an empty table.
    """
    own = stored(fingerprints(docs, words), "fingerprints")
    distinct = stored(own.groupBy("bits").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    n = distinct.count()
    roots = components(near_links(distinct, n, distance))
    labelled = distinct.join(roots, distinct["bits"] == roots["node"], "left").select("bits", "first", F.coalesce("root", "bits").alias("root"))
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stored(labelled.join(least, "root").select("bits", "component_id"), "classes")
    return own.join(classes, "bits").select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest doc_id, all columns kept.

    Groups are of rows, not of ids: rows that repeat an id, or have none, are each judged by their text. NULL ids are larger than all
    others; of rows with one id in a group the one of the smallest hash of its text stays.
    """
    # 32 bytes of the text's hash, then the id, if any
    row = F.concat(F.unhex(F.sha2(utf8(), 256)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"), F.when(F.col("doc_id").isNull(), b"\xff").otherwise(b""))
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", row.alias("row")).alias("doc_id"), "text")
    first = near_duplicates(named, words, distance).filter("doc_id = component_id").select(F.col("doc_id.row").alias("__row")).distinct()
    # rows equal in id and text are one before the shuffle: the limit of this window is taken per task first
    nth = F.row_number().over(W.partitionBy("__row").orderBy("text"))
    rows = docs.withColumn("__row", row).withColumn("__nth", nth).filter("__nth = 1")
    return rows.join(first, "__row", "left_semi").select(*docs.columns)
