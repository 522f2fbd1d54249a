"""op5: gradients by differences, held-out accuracy, and texts without a language."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm.folds import held_out
from foldwise.llm.language import LENGTHS, OTHER, WINDOW, Network, identify, learn, pooled, train, windows

WIDE = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def wide(spark):
    return spark.read.parquet(WIDE)


@pytest.fixture(scope="module")
def network(wide):
    return learn(wide)


def test_held_out_accuracy(wide, network):
    got = identify(wide, network).filter(held_out()).select("lang", "lang_pred", "score").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)
    assert len(got) > 300


def test_gradients():
    network, rng = Network(["a", "b", "c"], 3), np.random.default_rng(3)
    network.w = {n: x.astype(np.float64) for n, x in network.w.items()}
    codes = rng.integers(0, 256, (9, 5))
    real = np.ones((9, 5), bool)
    real[5:, 2] = real[3:, 4] = False
    labels = rng.integers(0, 3, 5)
    _, g = network.gradients(codes, real, labels)
    for name, x in network.w.items():
        places = np.argwhere(np.abs(g[name]) > 1e-4)
        for place in map(tuple, places[rng.permutation(len(places))[:6]]):
            old = x[place]
            losses = []
            for step in (1e-2, -1e-2):
                x[place] = old + step
                losses.append(network.gradients(codes, real, labels)[0])
            x[place] = old
            assert (losses[0] - losses[1]) / 2e-2 == pytest.approx(g[name][place], rel=0.05, abs=2e-4), name


def test_every_byte_counts(network):
    rng = np.random.default_rng(0)
    text = bytes(rng.integers(97, 123, 3 * WINDOW + 17).astype(np.uint8))
    assert (windows(text).ravel()[: len(text)] == np.frombuffer(text, np.uint8)).all()
    by_hand = [network.positions(network.states(np.maximum(w, 0)[:, None], (w >= 0)[:, None]))[w >= 0] for w in windows(text)]
    whole = np.concatenate(by_hand)[:, :, 0].mean(axis=0)
    assert np.allclose(pooled(network, [text, b"", b"abc"])[0], whole, atol=1e-5)


def by_hand(network, text):
    """Mean distribution over the bytes of a text: one byte, one gate and one window at a time, in double precision."""
    w = {n: x.astype(float) for n, x in network.w.items()}
    h, sums = w["state"].shape[2], np.zeros(len(network.languages))
    sigmoid = lambda v: 1 / (1 + np.exp(-v))

    def read(side, codes):
        state, out = np.zeros(h), []
        for c in codes:
            x, inner = w["bytes"][side][:, c], w["state"][side] @ state
            update, reset = sigmoid(x[:h] + inner[:h]), sigmoid(x[h : 2 * h] + inner[h : 2 * h])
            new = np.tanh(x[2 * h :] + reset * (inner[2 * h :] + w["bias"][side][:, 0]))
            state = (1 - update) * new + update * state
            out.append(state)
        return out

    for a in range(0, len(text), WINDOW):
        part = text[a : a + WINDOW]
        for forth, back in zip(read(0, part), read(1, part[::-1])[::-1]):
            e = np.exp(w["out"] @ np.concatenate([forth, back]) + w["out_bias"][:, 0])
            sums += e / e.sum()
    return sums / len(text)


def test_predictions_by_hand(spark, network):
    """Every given document of the smallest size, whole; the label may differ only where two shares are as good as equal."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen = 0
    for r in identify(docs, network).collect():
        if not any(map(str.isalpha, r["text"] or "")):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        elif len(r["text"]) < 4000:
            p = by_hand(network, r["text"].encode())
            assert r["score"] == pytest.approx(p.max(), abs=2e-4) and p[network.languages.index(r["lang_pred"])] > p.max() - 2e-4
            seen += 1
    assert seen > 100


def test_awkward_rows(awkward, network):
    frame = awkward.withColumn("score", awkward["doc_id"]).withColumn("lang_pred", awkward["lang"])
    got = {r["doc_id"]: r for r in identify(frame, network).collect()}
    assert [got[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and got[0]["score"] == 0
    assert got[3]["lang_pred"] in network.languages and identify(frame, network).count() == awkward.count()


def test_without_labels(spark, awkward):
    frame = awkward.withColumn("lang", awkward["lang"].substr(1, 0))
    assert learn(awkward.filter("lang IS NULL")) is None
    assert {r["lang_pred"] for r in identify(awkward, None).collect()} == {"und"}
    assert learn(frame.filter("text = ''")) is None


def test_learning_is_repeatable():
    texts, labels = [b"aaaa bbbb " * 30, b"cccc dddd " * 30] * 4, ["x", "y"] * 4
    one, two = (train(texts, labels, passes=2, least=0) for _ in range(2))
    assert all((one.w[n] == two.w[n]).all() for n in one.w)


def test_empty(nothing, network):
    assert identify(nothing, network).count() == 0 and learn(nothing) is None


FOREIGN = {
    "polish": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "russian": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "greek": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
    "japanese": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "hungarian": "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván.",
    "finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki.",
}


def test_texts_in_no_learnt_language(spark):
    """Foreign and random texts go, clean ones stay, also short ones: all on documents the network has not learnt from."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    network = learn(docs, other=True)
    assert len(network.limits) == len(LENGTHS) + 1 and max(network.limits) < 0.99
    clean = [r["text"] for r in docs.filter(held_out() & F.col("lang").isNotNull() & (F.length("text") > 300)).select("text").limit(150).collect()]
    rng = np.random.default_rng(11)
    letters = lambda n: " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(2, 9)))) for _ in range(n // 6))
    noise = lambda n: "a" + "".join(chr(int(i)) for i in rng.integers(33, 127, n))
    groups = {
        "whole": clean,
        "excerpts": [t[: int(rng.integers(60, 300))] for t in clean],
        "short": [t[: int(rng.integers(15, 60))] for t in clean],
        "letters": [letters(int(rng.integers(60, 800))) for _ in range(100)],
        "noise": [noise(int(rng.integers(60, 800))) for _ in range(100)],
        "shuffled": ["".join(rng.permutation(list(t))) for t in clean[:100]],
        "foreign": [*FOREIGN.values()] * 3 + [" ".join([t] * 5) for t in FOREIGN.values()],
    }
    rows = [(g, t) for g, texts in groups.items() for t in texts]
    found = identify(spark.createDataFrame(rows, "kind string, text string"), network).collect()
    gone = {g: np.mean([r["lang_pred"] == OTHER for r in found if r["kind"] == g]) for g in groups}
    assert gone["whole"] == 0 and gone["excerpts"] <= 0.01 and gone["short"] <= 0.03, gone
    assert gone["letters"] >= 0.95 and gone["noise"] >= 0.95 and gone["shuffled"] >= 0.85 and gone["foreign"] >= 0.8, gone
