"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of a text's bytes in both directions and gives every byte a distribution over languages; a document's
distribution is the mean over all of its bytes. It is trained here, by backpropagation through time, on windows of a bounded sample of
labelled documents. Scoring is one pass over the table without a shuffle, in Arrow batches.

To reject texts in no learnt language, a network is given one more class, learnt from what is made of the sampled texts and is no
language of theirs: letters in another order, letters drawn anew, letters put consistently for others, also of other scripts, and noise. How
much of that class a clean text of some length may have is measured on labelled documents that the network has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.folds import held_out, sample

HIDDEN, WINDOW = 12, 128
#: the bound on what is learned from: documents of each language and in all, and windows of each document
PER_LANGUAGE, MOST, WINDOWS = 240, 2400, 4
UNDETERMINED, OTHER = "und", "other"
#: lengths in bytes up to which a limit on the share of OTHER is measured, and the least limit
LENGTHS, LEAST_LIMIT, MARGIN = (24, 64, 160, 400, 1000), 0.5, 0.1
#: first letters and numbers of letters of other scripts
SCRIPTS = ((0x0100, 96), (0x0391, 50), (0x0410, 64), (0x05D0, 27), (0x0627, 36), (0x0905, 50), (0x0E01, 46), (0x3041, 80), (0x4E00, 400), (0xAC00, 400))


class Network:
    """Weights of both directions are stacked in the first axis. Gates are in the order update, reset, new."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.limits: list[float] = []  # of the share of OTHER, by length
        k, h = len(languages), HIDDEN
        self.w = {
            "bytes": rng.normal(0, 0.3, (2, 3 * h, 256)),
            "state": rng.normal(0, 1 / np.sqrt(h), (2, 3 * h, h)),
            "bias": np.zeros((2, h, 1)),
            "out": rng.normal(0, 1 / np.sqrt(2 * h), (k, 2 * h)),
            "out_bias": np.zeros((k, 1)),
        }
        self.w = {name: x.astype(np.float32) for name, x in self.w.items()}

    def states(self, codes: np.ndarray, real: np.ndarray, keep: list | None = None) -> np.ndarray:
        """codes, real: (WINDOW, n). The states after each byte, (WINDOW, 2, HIDDEN, n); the second direction reads from the end.

        Bytes that are not real leave the state as it is, so a short window begins with zeros in both directions.
        """
        w, h, (steps, n) = self.w, HIDDEN, codes.shape
        out = np.empty((steps, 2, h, n), np.float32)
        state = np.zeros((2, h, n), np.float32)
        into = np.empty((2, 3 * h, n), np.float32)
        whole = bool(real.all())
        for t in range(steps):
            ends = (t, steps - 1 - t)
            for side in (0, 1):
                np.take(w["bytes"][side], codes[ends[side]], axis=1, out=into[side], mode="clip")
            inner = w["state"] @ state
            gates = np.tanh(0.5 * (into[:, : 2 * h] + inner[:, : 2 * h])) * 0.5 + 0.5
            z, r = gates[:, :h], gates[:, h:]
            back = inner[:, 2 * h :] + w["bias"]
            new = np.tanh(into[:, 2 * h :] + r * back)
            after = new + z * (state - new)
            if not whole:
                live = np.stack([real[e] for e in ends])[:, None, :]
                after = np.where(live, after, state)
            if keep is not None:
                keep.append((state, z, r, back, new))
            state = after
            for side in (0, 1):
                out[ends[side], side] = state[side]
        return out

    def positions(self, states: np.ndarray) -> np.ndarray:
        """(WINDOW, languages, n): the distribution at every byte."""
        steps, _, h, n = states.shape
        logits = self.w["out"] @ states.reshape(steps, 2 * h, n) + self.w["out_bias"]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def gradients(self, codes: np.ndarray, real: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss of every real byte's label, and its gradient by backpropagation through time."""
        w, h, (steps, n) = self.w, HIDDEN, codes.shape
        kept: list = []
        states = self.states(codes, real, kept)
        p = self.positions(states)
        total = real.sum()
        loss = -float((np.log(p[:, labels, np.arange(n)] + 1e-9) * real).sum() / total)
        p[:, labels, np.arange(n)] -= 1
        p *= real[:, None, :] / np.float32(total)
        flat = states.reshape(steps, 2 * h, n)
        g = {name: np.zeros_like(x) for name, x in w.items()}
        g["out"] = np.einsum("tkn,tjn->kj", p, flat, optimize=True)
        g["out_bias"] = p.sum(axis=(0, 2))[:, None]
        upward = (w["out"].T @ p).reshape(steps, 2, h, n)
        carried = np.zeros((2, h, n), np.float32)
        for t in reversed(range(steps)):
            ends = (t, steps - 1 - t)
            state, z, r, back, new = kept[t]
            live = np.stack([real[e] for e in ends])[:, None, :]
            d = carried + np.stack([upward[ends[0], 0], upward[ends[1], 1]])
            moved = d * live
            d_new = moved * (1 - z) * (1 - new * new)
            d_z = moved * (state - new) * z * (1 - z)
            d_r = d_new * back * r * (1 - r)
            d_back = d_new * r
            d_inner = np.concatenate([d_z, d_r, d_back], axis=1)
            d_into = np.concatenate([d_z, d_r, d_new], axis=1)
            g["bias"] += d_back.sum(axis=2, keepdims=True)
            g["state"] += d_inner @ state.transpose(0, 2, 1)
            for side in (0, 1):
                np.add.at(g["bytes"][side].T, codes[ends[side]], d_into[side].T)
            carried = d * ~live + moved * z + w["state"].transpose(0, 2, 1) @ d_inner
        return loss, g


def windows(text: bytes) -> np.ndarray:
    """All bytes of a text in rows of WINDOW; -1 after the end."""
    rows = max(1, -(-len(text) // WINDOW))
    out = np.full(rows * WINDOW, -1, np.int16)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(rows, WINDOW)


def unlike(text: str, rng: np.random.Generator) -> str:
    """A text that is no language of the sample's, made from one that is."""
    kind = int(rng.choice([0, 0, 0, 1, 2, 3, 4]))  # the first is the hardest to tell
    letters = sorted({c for c in text.lower() if c.isalpha()}) or ["a"]
    if kind == 0:  # the same characters in another order, word by word or all
        parts = [text] if rng.random() < 0.5 else text.split(" ")
        return " ".join("".join(rng.permutation(list(p))) if p else p for p in parts)
    if kind == 1:  # letters drawn anew
        many = int(rng.integers(8, 26))
        alphabet = list(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), many, replace=False))
        return "".join(str(rng.choice(alphabet)) if c.isalpha() else c for c in text)
    if kind == 2:  # a consistent exchange of letters, some of them for letters with marks
        others = [*rng.permutation(list("abcdefghijklmnopqrstuvwxyz")), *(chr(0x0100 + int(i)) for i in rng.integers(0, 128, 10))]
        put = dict(zip(letters, rng.choice(others, len(letters), replace=len(letters) > len(others))))
        return "".join(str(put.get(c.lower(), c)) for c in text)
    if kind == 3:  # another script
        first, many = SCRIPTS[int(rng.integers(len(SCRIPTS)))]
        put = {c: chr(first + int(i)) for c, i in zip(letters, rng.integers(0, many, len(letters)))}
        return "".join(put.get(c.lower(), c) for c in text)
    return "".join(chr(int(i)) for i in rng.integers(33, 127, len(text)))


def train(texts: list[bytes], labels: list[str], seed: int = 7, passes: int = 6, batch: int = 128, rate: float = 0.02, least: int = 240) -> Network:
    """Adam over windows spread evenly over each text: so many passes, or more where they make fewer than ``least`` steps."""
    languages = sorted(set(labels))
    network, rng = Network(languages, seed), np.random.default_rng(seed)
    rows, answers = [], []
    for text, label in zip(texts, labels):
        own = windows(text)
        own = own[np.unique(np.linspace(0, len(own) - 1, WINDOWS).astype(int))]
        rows.append(own)
        answers += [languages.index(label)] * len(own)
    rows, answers = np.concatenate(rows), np.array(answers)
    some = (rows >= 0).any(axis=1)
    rows, answers = rows[some], answers[some]
    first = {n: np.zeros_like(x) for n, x in network.w.items()}
    second = {n: np.zeros_like(x) for n, x in network.w.items()}
    passes = max(passes, -(-least * batch // len(rows)))
    step, steps = 0, passes * -(-len(rows) // batch)
    for _ in range(passes):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), batch):
            part = order[a : a + batch]
            codes = rows[part].T
            _, g = network.gradients(np.maximum(codes, 0), codes >= 0, answers[part])
            step += 1
            size = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            for name, x in g.items():
                x = x * min(1.0, 1.0 / (norm + 1e-9))
                first[name] += 0.1 * (x - first[name])
                second[name] += 0.01 * (x * x - second[name])
                network.w[name] -= (size * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return network


def pooled(network: Network, texts: list[bytes], block: int = 1024) -> np.ndarray:
    """(texts, languages): the mean of the distributions at all bytes of each text; zeros for an empty one."""
    rows = [windows(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(r) for r in rows])
    rows = np.concatenate(rows)
    sums = np.zeros((len(texts), len(network.languages)))
    # full windows first, so that they need no mask
    order = np.argsort(rows[:, -1] < 0, kind="stable")
    for a in range(0, len(order), block):
        part = order[a : a + block]
        codes = rows[part].T
        real = codes >= 0
        p = network.positions(network.states(np.maximum(codes, 0), real))
        np.add.at(sums, owner[part], np.einsum("tkn,tn->nk", p, real.astype(np.float32)))
    return sums / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


def _learnt_with_other(texts: list[bytes], labels: list[str], seed: int = 7) -> Network:
    """A network with the class OTHER. Each fifth text is kept back, to measure how much of OTHER a clean text of some length may have."""
    rng = np.random.default_rng(seed)
    kept_back = texts[::5]
    learnt = [(t, n) for i, (t, n) in enumerate(zip(texts, labels)) if i % 5] or [*zip(texts, labels)]
    wanted = max(1, 3 * len(learnt) // len(set(labels)))
    drawn = [learnt[int(i)][0].decode() for i in rng.integers(0, len(learnt), wanted)]
    # also short ones, as documents may be short
    made = [unlike(t[: int(rng.integers(20, 200))] if rng.random() < 0.5 else t, rng).encode() for t in drawn]
    short = [(t[: int(rng.integers(12, 100))], n) for t, n in learnt[::2]]
    both = learnt + short
    network = train([t for t, _ in both] + made, [n for _, n in both] + [OTHER] * len(made), seed)
    other = network.languages.index(OTHER)
    begins = [t[int(rng.integers(0, max(1, len(t) - n))) :][:n] for n in LENGTHS for t in kept_back]
    shares = pooled(network, [*begins, *kept_back])[:, other].reshape(len(LENGTHS) + 1, -1) if kept_back else np.zeros((len(LENGTHS) + 1, 1))
    network.limits = [min(0.98, max(LEAST_LIMIT, float(s.max()) + MARGIN)) for s in shares]
    return network


def judged(network: Network, p: np.ndarray, lengths: np.ndarray) -> tuple[list[str], list[float]]:
    """The language of each text and its share among the languages; OTHER where its share is above the limit."""
    if OTHER not in network.languages:
        best = p.argmax(axis=1)
        return [network.languages[i] for i in best], np.minimum(1.0, p[np.arange(len(p)), best]).tolist()
    other = network.languages.index(OTHER)
    share, rest = p[:, other], np.delete(p, other, axis=1)
    names = [n for n in network.languages if n != OTHER]
    best, limit = rest.argmax(axis=1), np.array(network.limits)[np.searchsorted(LENGTHS, lengths)]
    scores = np.minimum(1.0, rest.max(axis=1) / np.maximum(rest.sum(axis=1), 1e-12))
    return [OTHER if s > m else names[i] for s, m, i in zip(share, limit, best)], np.where(share > limit, np.minimum(1.0, share), scores).tolist()


def learn(docs: DataFrame, other: bool = False) -> Network | None:
    """A network from labelled documents that are not held out; None without any. The sample's bounds are PER_LANGUAGE, MOST and WINDOWS.

    With ``other`` it also tells texts in no learnt language.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0) & ~held_out())
    # ids are drawn before texts are read
    drawn = sample(labelled.select("doc_id", "lang"), "lang", PER_LANGUAGE, MOST)
    if not drawn:
        return None
    chosen = docs.sparkSession.createDataFrame([(r["doc_id"], r["lang"]) for r in drawn], labelled.select("doc_id", "lang").schema).distinct()
    rows = labelled.join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "text").orderBy("doc_id", "text").collect()
    texts, labels = [r["text"].encode() for r in rows], [r["lang"] for r in rows]
    return _learnt_with_other(texts, labels) if other else train(texts, labels)


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1) added; columns of these names are replaced.

    All bytes of a text are read. A network that knows OTHER gives it to texts in no learnt language. NULL texts and texts without a letter get ``und`` and score 0, as does everything without a network. An
    empty table gives an empty table.
    """
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*rest)

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = rest.index("text")
        for whole in batches:
            for batch in _parts(whole, at):
                texts = batch.column(at).to_pylist()
                named = [i for i, t in enumerate(texts) if t and network and any(map(str.isalpha, t))]
                names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                if named:
                    own = [texts[i].encode() for i in named]
                    for i, name, score in zip(named, *judged(network, pooled(network, own), np.array([len(t) for t in own]))):
                        names[i], scores[i] = name, score
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*rest, "lang_pred", "score"])

    return docs.mapInArrow(batches_of, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def _parts(batch: pa.RecordBatch, text: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of text."""
    sizes = np.array([len(t) if t else 0 for t in batch.column(text).to_pylist()])
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end
