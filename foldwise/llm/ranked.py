"""Ranked lexical search by a pipeline of term owners.

Documents are read once for a block of items. Consecutive documents become a shard: for every term of the items that occurs in it, the
documents and how often, beside the number of terms of each document. Terms are dealt to ``owners`` of equal numbers of postings, the rarest
terms to the first, and a shard's postings become one row per owner. Items travel in bundles, one for every shard and ``BUNDLE`` items, which
carry sparse accumulators: for each item the documents met so far and their integer scores. A stage cogroups the bundles with the postings of one
owner and adds what its terms contribute; then the bundles go on to the next owner. Behind the last, each bundle gives its best documents,
and the best of all bundles are chosen.

Accumulators stay sparse without a change of the result: after each stage the k-th best score reached for an item is known, and a document that
stays below it even if each term still to come contributes the most it does in that shard is dropped, or not taken in.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from foldwise.llm.common import utf8
from foldwise.sources.scratch import stored

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 with A-Z in lower case
BUNDLE = 256  # items
SHARD_DOCS, SHARD_BYTES = 8192, 8 << 20  # documents and bytes of text of a shard; at least one document
BLOCK_BYTES = 32 << 20  # of the items' texts that one reading of the documents serves; at least one item


def terms(text: bytes) -> list[bytes]:
    """Runs of digits, letters and everything beyond ASCII; only A-Z are lower-cased."""
    return TERM.findall(text.lower())


def term_weight(holding: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def contribution(tf: np.ndarray, length: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Of a term that occurs ``tf`` times in a document of ``length`` terms, before its weight."""
    m = 100 - 75 + (75 * length.astype(np.int64) * documents) // total
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m)


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """(number, text) of the items, as many at a time as fit BLOCK_BYTES."""
    block, size = [], 0
    for r in items.select("number", utf8().alias("text")).orderBy("number").toLocalIterator():
        if block and size + len(r["text"]) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((r["number"], bytes(r["text"])))
        size += len(r["text"])
    if block:
        yield block


def _cuts(texts: pa.Array) -> list[tuple[int, int]]:
    """Where a batch is cut into shards."""
    ends, out, begin = np.cumsum(pc.binary_length(texts).to_numpy()), [], 0
    while begin < len(texts):
        done = ends[begin - 1] if begin else 0
        end = min(begin + SHARD_DOCS, max(begin + 1, int(np.searchsorted(ends, done + SHARD_BYTES, "right"))))
        out.append((begin, min(end, len(texts))))
        begin = out[-1][1]
    return out


#: docs, known: ids of the documents and which of them are not NULL; lengths: their numbers of terms; at, term, tf: postings in order of term
SHARDS = "shard long, holding long, total long, docs binary, known binary, lengths binary, at binary, term binary, tf binary"


def _shards(documents: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Shards with the postings of ``numbers``, the terms of a block of items."""
    known_terms = documents.sparkSession.sparkContext.broadcast(numbers)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = known_terms.value.get, TaskContext.get().partitionId() << 32
        for batch in batches:
            for begin, end in _cuts(batch.column(1)):
                ids, texts = batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin)
                lengths, at, term, tf = np.zeros(len(ids), np.int64), [], [], []
                for i, text in enumerate(texts):
                    found = terms(text.as_py())
                    lengths[i] = len(found)
                    counts = Counter(map(number, found))
                    counts.pop(None, None)
                    at += [i] * len(counts)
                    term += counts.keys()
                    tf += counts.values()
                at, term, tf = np.array(at, np.int32), np.array(term, np.int32), np.array(tf, np.int32)
                order = np.argsort(term, kind="stable")
                arrays = [ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), lengths, at[order], term[order], tf[order]]
                columns = [pa.array([n], pa.int64()) for n in (shard, int((lengths > 0).sum()), int(lengths.sum()))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array([a.tobytes()], pa.binary()) for a in arrays], names="shard holding total docs known lengths at term tf".split())
                shard += 1

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text")).mapInArrow(read, SHARDS)


def _holding(shards: DataFrame) -> dict[int, int]:
    """In how many documents each term of the block occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0):
                term, df = np.unique(np.frombuffer(part.as_py(), np.int32), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(df, pa.int64())], names=["term", "df"])

    counts = shards.select("term").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r["term"]: r["df"] for r in counts.collect()}  # no more than the items have


def _owned(df: dict[int, int], owners: int) -> np.ndarray:
    """Owner of each term: the rarest belong to the first, and each has about the same number of postings."""
    order = sorted(df, key=lambda t: (df[t], t))
    ends = np.cumsum([df[t] for t in order])
    out = np.zeros(max(df, default=-1) + 1, np.int32)
    out[order] = np.minimum((ends - 1) * owners // max(int(ends[-1]) if len(ends) else 1, 1), owners - 1)
    return out


POSTINGS = "shard long, n int, at binary, term binary, part binary, next_term binary, next_part binary, owner int"


def _postings(shards: DataFrame, owner_of: np.ndarray, owners: int, documents: int, total: int) -> DataFrame:
    """A row per shard and owner: contributions of its terms, and the most that each term of later owners contributes to a document of the shard."""
    owner = shards.sparkSession.sparkContext.broadcast(owner_of)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], np.int64)
                at, term, tf = (np.frombuffer(row[c], np.int32) for c in ("at", "term", "tf"))
                part = contribution(tf, lengths[at], documents, max(total, 1)).astype(np.int32)  # below 10^6
                whose = owner.value[term]
                names, begins = np.unique(term, return_index=True)
                most = np.maximum.reduceat(part, begins) if len(begins) else part
                for s in range(owners):
                    mine, later = whose == s, owner.value[names] > s
                    arrays = [at[mine], term[mine], part[mine], names[later], most[later]]
                    columns = [pa.array([row["shard"]], pa.int64()), pa.array([len(lengths)], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([s], pa.int32())], names="shard n at term part next_term next_part owner".split())

    return shards.select("shard", "lengths", "at", "term", "tf").mapInArrow(split, POSTINGS)


BUNDLES = "shard long, bundle int, item binary, doc binary, score binary, best_item array<int>, best_score array<long>"


def _highest(scores: np.ndarray, k: int) -> np.ndarray:
    return np.sort(np.partition(scores, len(scores) - k)[-k:] if len(scores) > k else scores)[::-1]


def _stage(bundles: DataFrame, postings: DataFrame, owner: int, asked: list, owner_of: np.ndarray, bars: np.ndarray, k: int) -> DataFrame:
    """Bundles after the postings of ``owner``. asked: per item {term: weight times occurrences}; bars: the k-th best score of each item so far."""
    held = bundles.sparkSession.sparkContext.broadcast((asked, owner_of, bars))  # of one block of items

    def add(key: tuple, carried: pa.Table, own: pa.Table) -> pa.Table:
        asked, owner_of, bars = held.value
        begin = key[1].as_py() * BUNDLE
        (row,), (old,) = own.to_pylist(), carried.to_pylist()
        at, term, part, next_term, next_part = (np.frombuffer(row[c], np.int32) for c in ("at", "term", "part", "next_term", "next_part"))
        places = {int(t): slice(a, b) for t, a, b in zip(*_runs(term))}
        most = dict(zip(next_term.tolist(), next_part.tolist()))
        item, doc, score = np.frombuffer(old["item"], np.int32), np.frombuffer(old["doc"], np.int32), np.frombuffer(old["score"], np.int64)
        out, best_item, best_score = [], [], []
        for i in range(begin, min(begin + BUNDLE, len(asked))):
            mine = slice(*np.searchsorted(item, [i, i + 1]))
            reached = np.zeros(row["n"], np.int64)
            reached[doc[mine]] = score[mine]
            rest = 0
            for t, weight in asked[i].items():
                if owner_of[t] == owner and t in places:
                    reached[at[places[t]]] += weight * part[places[t]].astype(np.int64)
                elif owner_of[t] > owner:
                    rest += weight * most.get(t, 0)
            kept = np.nonzero(reached >= max(int(bars[i]) - rest, 1))[0]
            best = _highest(reached[kept], k)
            if rest and len(best) == k:
                kept = kept[reached[kept] >= best[-1] - rest]
            out.append((np.full(len(kept), i, np.int32), kept.astype(np.int32), reached[kept]))
            best_item += [i] * len(best)
            best_score += best.tolist()
        packed = [pa.array([np.concatenate(c).tobytes()], pa.binary()) for c in zip(*out)]
        columns = [pa.array([key[0].as_py()], pa.int64()), pa.array([key[1].as_py()], pa.int32()), *packed, pa.array([best_item], pa.list_(pa.int32())), pa.array([best_score], pa.list_(pa.int64()))]
        return pa.Table.from_arrays(columns, names="shard bundle item doc score best_item best_score".split())

    count = -(-len(asked) // BUNDLE)
    dealt = postings.filter(F.col("owner") == owner).drop("owner").withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    return bundles.drop("best_item", "best_score").groupBy("shard", "bundle").cogroup(dealt.groupBy("shard", "bundle")).applyInArrow(add, BUNDLES)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, begin, end) of the runs of a sorted array."""
    names, begins = np.unique(values, return_index=True)
    return names, begins, np.append(begins[1:], len(values))


def _bars(bundles: DataFrame, items: int, k: int) -> np.ndarray:
    """The k-th best score that each item has reached in any shard, 0 where there are fewer."""
    scores = bundles.select(F.explode(F.arrays_zip("best_item", "best_score")).alias("b")).select("b.best_item", "b.best_score")
    place = F.row_number().over(W.partitionBy("best_item").orderBy(F.desc("best_score")))
    found = scores.withColumn("place", place).filter(F.col("place") <= k).filter(F.col("place") == k)
    bars = np.zeros(items, np.int64)
    for r in found.collect():  # at most one row per item of the block
        bars[r["best_item"]] = r["best_score"]
    return bars


def _chosen(bundles: DataFrame, shards: DataFrame, numbers: list[int], k: int) -> DataFrame:
    """(number, doc_id, score): the best of every bundle."""

    def choose(key: tuple, carried: pa.Table, own: pa.Table) -> pa.Table:
        ids, known = np.frombuffer(own.column("docs")[0].as_py(), np.int64), np.frombuffer(own.column("known")[0].as_py(), bool)
        out: list[list] = [[], [], []]
        for row in carried.to_pylist():
            item, doc, score = np.frombuffer(row["item"], np.int32), np.frombuffer(row["doc"], np.int32), np.frombuffer(row["score"], np.int64)
            order = np.lexsort((ids[doc], ~known[doc], -score, item))
            item, doc, score = item[order], doc[order], score[order]
            best = np.arange(len(item)) - np.searchsorted(item, item, "left") < k
            for i, d, s in zip(item[best].tolist(), doc[best].tolist(), score[best].tolist()):
                out[0].append(numbers[i])
                out[1].append(int(ids[d]) if known[d] else None)
                out[2].append(s)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("number", "doc_id", "score"), out)})

    return bundles.select("shard", "item", "doc", "score").groupBy("shard").cogroup(shards.select("shard", "docs", "known").groupBy("shard")).applyInArrow(choose, "number long, doc_id long, score long")


def _searched(documents: DataFrame, block: list[tuple[int, bytes]], k: int, owners: int) -> DataFrame:
    """(number, doc_id, score): the best of every shard for the items of a block."""
    spark = documents.sparkSession
    counts = [Counter(terms(text)) for _, text in block]
    numbers = {name: i for i, name in enumerate(sorted(set().union(*counts)))}
    shards = stored(_shards(documents, numbers), "shards")
    n, total = shards.agg(F.coalesce(F.sum("holding"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    df = _holding(shards)
    owner_of = _owned(df, owners)
    asked = [{numbers[t]: c * term_weight(df[numbers[t]], n) for t, c in item.items() if numbers[t] in df} for item in counts]
    postings = stored(_postings(shards, owner_of, owners, n, total), "postings", ("owner",))
    nothing = [F.lit(b"").alias(c) for c in ("item", "doc", "score")]
    bundles = shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(-(-len(block) // BUNDLE) - 1))).alias("bundle"), *nothing, F.lit(None).alias("best_item"), F.lit(None).alias("best_score"))
    bars = np.zeros(len(block), np.int64)
    for owner in range(owners):
        bundles = stored(_stage(bundles, postings, owner, asked, owner_of, bars, k), "bundles")
        if owner < owners - 1:
            bars = _bars(bundles, len(block), k)
    return _chosen(bundles, shards, [number for number, _ in block], k)


def ranked(documents: DataFrame, items: DataFrame, k: int = 10, owners: int = 4) -> DataFrame:
    """Of each item the ``k`` documents with the highest score above 0, fewer if there are fewer: item_id, rank (from 1), doc_id, score.

    documents: doc_id, text; items: item_id, text; other columns are ignored. Equal scores are in order of doc_id, NULL last. A NULL text has no
    term. Documents that repeat an id are documents each; items that repeat an id and text are one, with another text they are ranked each on
    their own, under the same id. Items without a term, or without a document that has one, have no row. Empty tables give an empty table.
    """
    own = items.select("item_id", "text").distinct().withColumn("number", F.monotonically_increasing_id())
    own = stored(own, "items")
    found = None
    for block in _blocks(own):
        part = stored(_searched(documents, block, k, owners), "found")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = items.sparkSession.createDataFrame([], "number long, doc_id long, score long")
    place = F.row_number().over(W.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return best.join(own, "number").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
