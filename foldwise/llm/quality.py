"""Document quality by a convolutional network over bytes.

A text is read in overlapping chunks, so that learned filters pass over every place of the whole document. Each filter's largest
response in a chunk is the chunk's feature; a document is described by the largest and the mean of its chunks' features, and a logistic
unit makes one probability of them. The network is trained here, in numpy, on a bounded sample of labelled documents. Scoring is one
pass over the table without a shuffle, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.folds import held_out, sample

EMBEDDING, FILTERS, WIDTH, STRIDE = 8, 24, 8, 2
PLACES = 125  # of a filter in a chunk
CHUNK = (PLACES - 1) * STRIDE + WIDTH
STEP = PLACES * STRIDE  # chunks overlap, so the places of a filter are STRIDE apart over the whole text
PAD = 256
#: the bound on the documents of each label that are learned from; they are learned from whole, this many chunks of one at a time
PER_LABEL, CHUNKS = 1500, 16
#: every so many documents of a label give an excerpt
EXCERPTS = 4


class Network:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.w = {
            "bytes": rng.normal(0, 0.5, (PAD + 1, EMBEDDING)),
            "filters": rng.normal(0, 1 / np.sqrt(WIDTH * EMBEDDING), (WIDTH * EMBEDDING, FILTERS)),
            "bias": np.zeros(FILTERS),
            "out": np.zeros(2 * FILTERS),
            "out_bias": np.zeros(1),
        }
        self.w["bytes"][PAD] = 0
        self.w = {name: x.astype(np.float32) for name, x in self.w.items()}

    def responses(self, chunks: np.ndarray) -> np.ndarray:
        """(n, PLACES, FILTERS): every filter at every place of chunks (n, CHUNK)."""
        n = len(chunks)
        flat = self.w["bytes"][chunks].reshape(n, CHUNK * EMBEDDING)
        size = flat.itemsize
        views = np.lib.stride_tricks.as_strided(flat, (n, PLACES, WIDTH * EMBEDDING), (CHUNK * EMBEDDING * size, STRIDE * EMBEDDING * size, size))
        return views.reshape(n * PLACES, WIDTH * EMBEDDING).dot(self.w["filters"]).reshape(n, PLACES, FILTERS)

    def features(self, chunks: np.ndarray, block: int = 128) -> np.ndarray:
        """(n, FILTERS): the largest response of a rectified unit in each chunk."""
        out = np.empty((len(chunks), FILTERS), np.float32)
        for a in range(0, len(chunks), block):
            out[a : a + block] = self.responses(chunks[a : a + block]).max(axis=1)
        return np.maximum(out + self.w["bias"], 0)

    def documents(self, features: np.ndarray, begins: np.ndarray) -> np.ndarray:
        counts = np.diff(np.append(begins, len(features)))[:, None]
        return np.concatenate([np.maximum.reduceat(features, begins), np.add.reduceat(features, begins) / counts], axis=1)

    def probabilities(self, chunks: np.ndarray, begins: np.ndarray) -> np.ndarray:
        z = self.documents(self.features(chunks), begins) @ self.w["out"] + self.w["out_bias"]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))

    def gradients(self, chunks: np.ndarray, begins: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Of the mean loss of documents; only a filter's best place in a chunk passes anything back."""
        every = self.responses(chunks)
        best = every.argmax(axis=1)
        raw = np.take_along_axis(every, best[:, None, :], axis=1)[:, 0] + self.w["bias"]
        features = np.maximum(raw, 0)
        counts = np.diff(np.append(begins, len(chunks)))
        owner = np.repeat(np.arange(len(begins)), counts)
        described = self.documents(features, begins)
        p = 1 / (1 + np.exp(-np.clip(described @ self.w["out"] + self.w["out_bias"], -30, 30)))
        loss = -float(np.mean(labels * np.log(p + 1e-9) + (1 - labels) * np.log(1 - p + 1e-9)))
        d = ((p - labels) / len(labels)).astype(np.float32)
        g = {name: np.zeros_like(x) for name, x in self.w.items()}
        g["out"], g["out_bias"] = described.T @ d, np.array([d.sum()], np.float32)
        largest = features == described[owner, :FILTERS]
        largest = largest / np.maximum(np.add.reduceat(largest, begins), 1)[owner]
        d_features = d[owner, None] * (self.w["out"][:FILTERS] * largest + self.w["out"][FILTERS:] / counts[owner, None])
        d_raw = (d_features * (raw > 0)).astype(np.float32)
        g["bias"] = d_raw.sum(axis=0)
        for f in range(FILTERS):
            codes = chunks[np.arange(len(chunks))[:, None], best[:, f, None] * STRIDE + np.arange(WIDTH)]
            seen = self.w["bytes"][codes].reshape(len(chunks), -1)
            g["filters"][:, f] = d_raw[:, f] @ seen
            back = d_raw[:, f, None] * self.w["filters"][:, f]
            np.add.at(g["bytes"], codes.ravel(), back.reshape(-1, EMBEDDING))
        g["bytes"][PAD] = 0
        return loss, g


def chunks_of(text: bytes) -> np.ndarray:
    """(n, CHUNK): a text's bytes in overlapping chunks; PAD after the end."""
    n = max(1, -(-(len(text) - CHUNK + STEP) // STEP))
    padded = np.full((n - 1) * STEP + CHUNK, PAD, np.int16)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (n, CHUNK), (STEP * 2, 2))


def drawn_groups(n_chunks: int, turn: int, passes: int) -> list[slice]:
    """The chunks of a text that pass ``turn`` learns from, as groups of at most CHUNKS spread evenly over it.

    After all passes every chunk was in some group. A text with more groups than passes gives several in each.
    """
    groups = -(-n_chunks // CHUNKS)
    return [slice(j, None, groups) for j in range(turn, groups, passes) or [turn % groups]]


def train(texts: list[bytes], labels: list[int], seed: int = 11, passes: int = 10, batch: int = 32, rate: float = 0.01) -> Network:
    """Adam on the mean loss of small batches of documents.

    Short excerpts of documents of both labels are added, with their label: few documents are short, and a short one shows few features.
    """
    network, rng = Network(seed), np.random.default_rng(seed)
    long = [(t, label) for t, label in zip(texts, labels) if len(t) > 100]
    for text, label in [x for own in (1, 0) for x in [y for y in long if y[1] == own][::EXCERPTS]]:
        begin, size = int(rng.integers(0, len(text) - 80)), int(rng.integers(4, 80))
        texts, labels = [*texts, text[begin : begin + size]], [*labels, label]
    # (text, chunks of it) of every pass; the chunks themselves are made a batch at a time
    sizes = [len(chunks_of(t)) for t in texts]
    turns = [[(i, part) for i, n in enumerate(sizes) for part in drawn_groups(n, turn, passes)] for turn in range(passes)]
    answers = np.array(labels, np.float32)
    share = float(np.clip(answers.mean(), 0.01, 0.99))
    network.w["out_bias"][:] = np.log(share / (1 - share))
    first = {n: np.zeros_like(x) for n, x in network.w.items()}
    second = {n: np.zeros_like(x) for n, x in network.w.items()}
    step, steps = 0, sum(-(-len(items) // batch) for items in turns)
    network.w["out"][:] = rng.normal(0, 0.1, 2 * FILTERS)
    for items in turns:
        order = rng.permutation(len(items))
        for a in range(0, len(order), batch):
            chosen = [items[i] for i in order[a : a + batch]]
            mine = [chunks_of(texts[i])[part] for i, part in chosen]
            begins = np.cumsum([0, *[len(m) for m in mine[:-1]]])
            _, g = network.gradients(np.concatenate(mine), begins, answers[[i for i, _ in chosen]])
            step += 1
            size = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for name, x in g.items():
                first[name] += 0.1 * (x - first[name])
                second[name] += 0.01 * (x * x - second[name])
                network.w[name] -= (size * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
            network.w["bytes"][PAD] = 0
    return network


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Network | None:
    """A network from the labelled documents that are not held out; None without both labels. Bound: PER_LABEL documents of each.

    A doc_id with several labels counts with its smallest.
    """
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).cast("int").alias("__label"))
    known = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & ~held_out())
    # ids are drawn before texts are read
    drawn = sample(known.select("doc_id").join(marked, "doc_id"), "__label", PER_LABEL, 2 * PER_LABEL)
    if len({r["__label"] for r in drawn}) < 2:
        return None
    spark = docs.sparkSession
    chosen = F.broadcast(spark.createDataFrame([(r["doc_id"], r["__label"]) for r in drawn], "doc_id long, __label int").distinct())
    rows = known.join(chosen, "doc_id").orderBy("doc_id", "text").collect()
    return train([(r["text"] or "").encode() for r in rows], [r["__label"] for r in rows])


def score(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with score, the probability of label 1, and predicted (0 or 1) added; columns of these names are replaced.

    Every byte of a text is read. NULL counts as empty; empty texts have a score as any other. Without a network, scores are 0.5. An
    empty table gives an empty table.
    """
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    docs = docs.select(*rest)

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = rest.index("text")
        for batch in batches:
            scores: list[float] = []
            waiting: list[np.ndarray] = []
            for text in batch.column(at):
                waiting.append(chunks_of((text.as_py() or "").encode()))
                if sum(map(len, waiting)) >= 4096:
                    scores += _scores(network, waiting)
                    waiting = []
            scores += _scores(network, waiting)
            found = [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*rest, "score", "predicted"])

    return docs.mapInArrow(batches_of, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def _scores(network: Network | None, parts: list[np.ndarray]) -> list[float]:
    if network is None or not parts:
        return [0.5] * len(parts)
    return network.probabilities(np.concatenate(parts), np.cumsum([0, *[len(p) for p in parts[:-1]]])).tolist()
