"""Best-fit decreasing packing of tokenized documents into sequences of a fixed length.

Tokens are counted in Arrow batches, once; everything after that works on one small row per piece. Best-fit decreasing depends on
the lengths alone, so the packing is planned on the driver over a histogram with at most ``capacity`` entries: a segment tree over
remaining capacities finds the tightest open bins, and pieces of one length go into bins of one remaining capacity as a run. The
plan has a few thousand runs whatever the number of documents. Pieces are then numbered within their length, in parallel, and each
looks up the run that holds its number.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from foldwise.sources.scratch import stored

END = 0
_MORE_BLANKS = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class OpenBins:
    """Runs of bins by remaining capacity; a segment tree says which capacities have any."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, room: int) -> None:
        node, value = room + self.leaves, bool(self.runs[room])
        while node and self.any[node] != value:
            self.any[node] = value
            node //= 2
            value = node > 0 and (self.any[2 * node] or self.any[2 * node + 1])

    def add(self, room: int, first: int, bins: int) -> None:
        if room > 0 and bins > 0:
            self.runs[room].append((first, bins))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self._mark(room)
        return run

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least ``length`` that some bin has."""
        node = length + self.leaves
        if self.any[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, number of the first piece, pieces, first bin, pieces per bin, offset) for ``counts`` pieces by length.

    Gives the bins that placing the pieces one by one, longest first, each into the tightest bin, would give: after a piece of length l
    went into the tightest bin, that bin is again the tightest for the next piece of length l until it has no room for one.
    """
    bins, runs, opened = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        done, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                needed = -(-left // (capacity // length))
                bins.add(capacity, opened, needed)
                opened += needed
                continue
            first, n = bins.take(room)
            each = room // length
            full, rest = (n, 0) if left >= n * each else divmod(left, each)
            if full:
                runs.append((length, done, full * each, first, each, capacity - room))
                bins.add(room - each * length, first, full)
            if rest:
                runs.append((length, done + full * each, rest, first + full, rest, capacity - room))
                bins.add(room - rest * length, first + full, 1)
            used = full + (rest > 0)
            bins.add(room, first + used, n - used)
            done, left = done + full * each + rest, left - full * each - rest
    return runs


class Encoder:
    """Token ids of many texts. Text between white space is encoded once and remembered: tokens never cross white space.

    Text of plain letters, digits and signs goes to the model directly; all other text goes through the whole tokenizer.
    """

    REMEMBERED = 400_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        # letters up to U+017F without those whose lower case is more than one letter; combining marks are beyond this range
        self.plain = re.compile("[!-~À-ÖØ-öø-įĹ-ňŊ-ž]+").fullmatch
        self.parts = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+").findall
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.bytes = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.starts = array("I"), array("q", [0])

    def _encode(self, word: str) -> list[int]:
        if not self.plain(word):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        found = []
        for part in self.parts(word.lower()):
            symbols = part if part.isascii() else part.encode().decode("latin-1").translate(self.bytes)
            found += [t.id for t in self.model.tokenize(symbols)]
        return found

    def numbers(self, text: str) -> list[int]:
        words = _split(text)
        known = list(map(self.number.get, words))
        if None in known:
            for i, n in enumerate(known):
                if n is None:
                    word = words[i]
                    n = self.number.get(word)
                    if n is None:
                        n = self.number[word] = len(self.number)
                        self.ids.extend(self._encode(word))
                        self.starts.append(len(self.ids))
                    known[i] = n
        return known

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text ends in them; every text ends with END."""
        if len(self.number) > self.REMEMBERED:
            self.forget()
        end_of = self.number.get("\n")
        if end_of is None:  # no word holds a line feed
            end_of = self.number["\n"] = len(self.number)
            self.ids.append(END)
            self.starts.append(len(self.ids))
        flat, sizes = [], np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            known = self.numbers(text)
            known.append(end_of)
            flat.append(np.array(known, np.int32))
            sizes[i] = len(known)
        words = np.concatenate(flat)
        ids, starts = np.frombuffer(self.ids, np.uint32), np.frombuffer(self.starts, np.int64)
        lengths = (starts[1:] - starts[:-1])[words]
        ends = np.cumsum(lengths)
        where = np.repeat(starts[:-1][words] - (ends - lengths), lengths) + np.arange(ends[-1])
        found = ids[where]
        del ids, starts  # the arrays cannot grow while they are looked at
        return found, ends[np.cumsum(sizes) - 1]


def _split(text: str) -> list[str]:
    """The parts between blanks of ASCII. ``str.split`` knows more blanks, so a text with any of those is split by its bytes."""
    return [w.decode() for w in text.encode().split()] if _MORE_BLANKS(text) else text.split()


def _encoder(path: str) -> Encoder:
    """One per worker process. Functions travel by value, so what this module held would be new with every task."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_kept_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): documents as token ids and END, only those above ``capacity`` cut."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _slices(texts):
                ids, ends = encoder.encode(texts[a:b])
                out, begin = [], 0
                raw = memoryview(ids.astype("<u4").tobytes())
                for doc, end in zip(batch.column(0)[a:b].to_pylist(), ends.tolist()):
                    for k, at in enumerate(range(begin, end, capacity)):
                        stop = min(at + capacity, end)
                        out.append((doc, k, at - begin, stop - at, zlib.crc32(raw[4 * at : 4 * stop])))
                    begin = end
                columns = list(zip(*out))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(cut, PIECES)


def _slices(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` characters, so that a batch of very long texts stays small in memory."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """Pack ``docs`` (doc_id, text; other columns are ignored) into sequences of at most ``capacity`` tokens.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A NULL or empty text is the one token END. Rows
    that repeat a doc_id, also NULL, are packed each on its own. An empty table gives an empty table. Each sequence is filled from 0
    without gaps. Which of several pieces of equal length goes where follows from hashes of their ids; ties change nothing but the place.
    """
    cut = stored(pieces(docs, tokenizer, capacity), "pieces")
    by_length = cut.groupBy("length").count()
    counts = {r["length"]: r["count"] for r in by_length.collect()}  # at most ``capacity`` rows
    return place(cut, plan(counts, capacity), sum(counts.values()))


RUNS = T.StructType([T.StructField(n, T.LongType(), False) for n in ("run_length", "from_number", "run_pieces", "first_bin", "per_bin", "base")])


def place(cut: DataFrame, runs: list[tuple], total: int, chunk: int = 50_000) -> DataFrame:
    """Number the pieces of each length, and give each the place that the run with its number has."""
    spark: SparkSession = cut.sparkSession
    chunks = max(1, -(-total // chunk))
    dealt = cut.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(chunks)))
    # a length may hold most pieces: its numbers are running totals of chunks plus places within a chunk
    sums = dealt.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    within = W.partitionBy("length", "chunk").orderBy("doc_id", "piece")
    numbered = dealt.withColumn("nth", F.row_number().over(within) - 1).join(sums.select("length", "chunk", before.alias("before")), ["length", "chunk"])
    numbered = numbered.withColumn("number", F.col("before") + F.col("nth"))
    table = F.broadcast(spark.createDataFrame(runs, RUNS))  # bounded by the capacity, not by the documents
    inside = (F.col("length") == F.col("run_length")) & (F.col("number") >= F.col("from_number")) & (F.col("number") < F.col("from_number") + F.col("run_pieces"))
    at = F.col("number") - F.col("from_number")
    return numbered.join(table, inside).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_bin") + F.floor(at / F.col("per_bin"))).alias("sequence_id"),
        (F.col("base") + at % F.col("per_bin") * F.col("length")).alias("offset"),
    )
