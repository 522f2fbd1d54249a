"""Line dedup with two Bloom filters.

First pass: each task puts the keys of its lines into a filter of keys seen once and a filter of keys seen twice; the filters of all tasks
are merged segment by segment. Merging two pairs of filters gives "once" by or, and "twice" by or with what both saw once, so a key of
two documents is always found in "twice". Second pass: only lines whose key "twice" knows are shuffled, and counted exactly by
their text. Third pass: documents drop their lines.

The filters have at most ``MAX_BITS`` bits, whatever the input. Beyond the number of keys that fit, more lines are suspected and shuffled;
the result stays exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import utf8
from foldwise.sources.scratch import stored

MIN_BITS, MAX_BITS = 1 << 20, 1 << 28
SEGMENT = 1 << 16  # bytes of a filter that are merged as one
PROBES = 3
STRIP = b" \t\n\x0b\x0c\r"


def key(line: bytes) -> bytes:
    """The line without blanks at its ends, A-Z in lower case."""
    return line.strip(STRIP).lower()


def long_keys(text: bytes, min_chars: int) -> set[bytes]:
    """The different keys of at least ``min_chars`` code points."""
    found = set()
    for line in text.split(b"\n"):
        k = key(line)
        if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode(errors="replace")) >= min_chars):
            found.add(k)
    return found


def probes(keys: list[bytes], bits: int) -> np.ndarray:
    """PROBES places in a filter per key, by double hashing."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return (h[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)


def _put(filters: np.ndarray, keys: list[bytes], bits: int) -> None:
    """filters[0] once, filters[1] twice. Keys of one document differ, so a key whose places are all set came from another document."""
    at = probes(keys, bits)
    byte, mask = at >> np.uint64(3), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    seen = ((filters[0][byte] & mask) != 0).all(axis=1)
    np.bitwise_or.at(filters[1], byte[seen], mask[seen])
    np.bitwise_or.at(filters[0], byte, mask)


def filter_bits(docs: DataFrame, min_chars: int) -> int:
    """About two bits for each code point that a key needs at least, in the bounds; no pass over line ends is needed for it."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    wanted = 2 * chars // min_chars
    return min(MAX_BITS, max(MIN_BITS, 1 << int(wanted).bit_length()))


def twice_filter(docs: DataFrame, min_chars: int) -> np.ndarray:
    """The merged filter of keys that at least two rows have. Its size is bounded, so it may pass through the driver."""
    bits = filter_bits(docs, min_chars)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = np.zeros((2, bits // 8), np.uint8)
        for batch in batches:
            for text in batch.column(0):
                if keys := long_keys(text.as_py(), min_chars):
                    _put(filters, list(keys), bits)
        packer = zstandard.ZstdCompressor(1)
        parts = filters.reshape(2, -1, min(SEGMENT, bits // 8))
        for s in np.nonzero(parts[0].any(axis=1))[0]:
            yield pa.RecordBatch.from_arrays([pa.array([int(s)], pa.int32())] + [pa.array([packer.compress(p[s].tobytes())], pa.binary()) for p in parts], names=["segment", "once", "twice"])

    def merge(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        once = twice = np.zeros(1, np.uint8)
        for batch in rows:
            for o, t in zip(batch.column("once"), batch.column("twice")):
                o, t = (np.frombuffer(unpack(x.as_py()), np.uint8) for x in (o, t))
                twice = twice | t | (once & o)
                once = once | o
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([zstandard.ZstdCompressor(1).compress(twice.tobytes())], pa.binary())], names=["segment", "twice"])

    parts = docs.select(utf8().alias("text")).mapInArrow(gather, "segment int, once binary, twice binary")
    merged = parts.groupBy("segment").applyInArrow(merge, "segment int, twice binary").collect()
    out = np.zeros((bits // 8 // min(SEGMENT, bits // 8), min(SEGMENT, bits // 8)), np.uint8)
    for row in merged:
        out[row["segment"]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row["twice"])), np.uint8)
    return out.ravel()


def repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, keys): the keys whose lines a document loses.

    A key counts once per doc_id; rows without an id count as one document, which is below all others.
    """
    spark = docs.sparkSession
    twice = twice_filter(docs, min_chars)
    bits = len(twice) * 8
    packed = spark.sparkContext.broadcast(zstandard.ZstdCompressor(1).compress(twice.tobytes()))  # at most MAX_BITS / 8 bytes

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed.value), np.uint8)
        for batch in batches:
            ids, found = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if keys := list(long_keys(text.as_py(), min_chars)):
                    at = probes(keys, bits)
                    hit = ((known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
                    for k in np.nonzero(hit)[0]:
                        ids.append(doc)
                        found.append(keys[k])
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(found, pa.binary())], names=["doc_id", "key"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    lines = stored(docs.select("doc_id", utf8().alias("text")).mapInArrow(suspects, f"doc_id {kind}, key binary").distinct(), "suspect-lines")
    last = lines.groupBy("key").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last")).filter(F.col("docs") >= min_docs).drop("docs")
    lost = lines.join(last, "key").filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    return lost.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with its text replaced by what is left, and n_lines (before), n_dropped, kept_sha256 added.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of at least ``min_chars`` code points in at least ``min_docs``
    documents lose all their lines except in the largest doc_id that holds them. A NULL or empty text is one empty line and stays as
    it is. All other columns are kept; columns of the names added are replaced. Rows that repeat a doc_id are one document of several
    texts. An empty table gives an empty table.
    """
    lost = repeated_lines(docs, min_chars, min_docs).select(F.col("doc_id").alias("__doc"), F.col("keys").alias("__keys"))
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped", "kept_sha256")]
    joined = docs.join(lost.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(lost["__doc"]), "left")
    wide = joined.select(*[docs[c] for c in rest], docs["text"], "__keys")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, dropped, shas = [], [], [], []
            for text, keys in zip(batch.column(len(rest)), batch.column(len(rest) + 1)):
                whole = text.as_py()
                raw = (whole or "").encode()
                parts = raw.split(b"\n")
                lines.append(len(parts))
                if keys.is_valid:
                    gone = set(keys.as_py())
                    parts = [p for p in parts if key(p) not in gone]
                    raw = b"\n".join(parts)
                    whole = raw.decode()
                dropped.append(lines[-1] - len(parts))
                texts.append(whole)
                shas.append(hashlib.sha256(raw).hexdigest())
            added = [pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *added], names=[*rest, "text", "n_lines", "n_dropped", "kept_sha256"])

    schema = wide.select(*rest, "text").schema.add("n_lines", "long").add("n_dropped", "long").add("kept_sha256", "string")
    return wide.mapInArrow(drop, schema)
