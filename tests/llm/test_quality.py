"""op9: gradients by differences, held-out accuracy, whole documents."""

import numpy as np
import pytest

from foldwise.llm.folds import held_out, sample
from foldwise.llm.quality import CHUNK, CHUNKS, PAD, PLACES, STRIDE, WIDTH, Network, chunks_of, drawn_groups, learn, score, train

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def network(spark):
    return learn(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_accuracy(spark, network):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = score(docs.join(labels, "doc_id").filter(held_out()), network).select("quality", "score", "predicted").collect()
    quality, scores = np.array([r["quality"] for r in got]), np.array([r["score"] for r in got])
    assert np.mean([r["quality"] == r["predicted"] for r in got]) > 0.95
    assert (scores[quality == 1][:, None] > scores[quality == 0]).mean() > 0.97
    assert (scores[quality == 1] >= 0.5).mean() > 0.98


def test_sample_does_not_rank_a_whole_label_in_one_task(spark, monkeypatch):
    """The rows are those of one ranking by label; the ranking by label alone is over few rows."""
    rows = spark.range(130_000).selectExpr("id as doc_id", "cast(id % 7 = 0 as int) as label")
    hashed = sorted((r["h"], r["label"], r["doc_id"]) for r in rows.selectExpr("*", "xxhash64(doc_id) as h").collect())
    want = {d for own in (0, 1) for _, _, d in [x for x in hashed if x[1] == own][:1500]}
    plans, collect = [], type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or collect(df))
    assert {r["doc_id"] for r in sample(rows, "label", 1500, 3000)} == want
    assert sum("Window [" in x and "__part" in x for x in plans[0].splitlines()) == 1


def test_short_texts_of_both_labels():
    """Learnt from long documents only, a short text follows the kind of its own label."""
    rng = np.random.default_rng(4)
    words = ["river", "stone", "garden", "window", "letter", "morning", "village", "bread"]
    good = lambda n: " ".join(rng.choice(words, n)).encode()
    bad = lambda n: " ".join("".join(rng.permutation(list(w))) for w in rng.choice(words, n)).encode()
    network = train([good(120) for _ in range(300)] + [bad(120) for _ in range(60)], [1] * 300 + [0] * 60)
    for make, label, least in ((good, 1, 0.9), (bad, 0, 0.7)):
        scores = [network.probabilities(chunks_of(make(4)), np.array([0]))[0] for _ in range(200)]
        assert np.mean([(x >= 0.5) == label for x in scores]) > least


def by_hand(network, text):
    """The probability of one text: every filter at every place of every chunk, in double precision."""
    w = {n: x.astype(float) for n, x in network.w.items()}
    codes, step = list(text), PLACES * STRIDE
    chunks = max(1, -(-(len(codes) - CHUNK + step) // step))
    codes += [PAD] * ((chunks - 1) * step + CHUNK - len(codes))
    largest = []
    for c in range(chunks):
        places = [w["bytes"][codes[c * step + p * STRIDE :][:WIDTH]].ravel() @ w["filters"] for p in range(PLACES)]
        largest.append(np.maximum(np.max(places, axis=0) + w["bias"], 0))
    z = np.concatenate([np.max(largest, axis=0), np.mean(largest, axis=0)]) @ w["out"] + w["out_bias"][0]
    return 1 / (1 + np.exp(-z))


def test_scores_by_hand(spark, network):
    """Every given document of the smallest size, whole."""
    got = score(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), network).select("text", "score", "predicted").collect()
    assert len(got) >= 200
    for r in got:
        assert r["score"] == pytest.approx(by_hand(network, (r["text"] or "").encode()), abs=1e-4) and r["predicted"] == (r["score"] >= 0.5)


@pytest.mark.parametrize("n", [1, CHUNKS, CHUNKS + 1, 10 * CHUNKS, 10 * CHUNKS + 3, 4321])
def test_every_chunk_is_learnt_from(n):
    seen = np.zeros(n, int)
    for turn in range(10):
        for part in drawn_groups(n, turn, 10):
            mine = np.arange(n)[part]
            assert 0 < len(mine) <= CHUNKS and mine[0] < -(-n // CHUNKS) and mine[-1] >= n - -(-n // CHUNKS)  # spread over the text
            seen[mine] += 1
    assert seen.min() >= 1 and (n > CHUNKS or seen.min() == 10)


def test_a_sign_anywhere_in_a_long_text_is_learnt():
    """Texts of some 60 chunks differ in one stretch that no fixed choice of 16 chunks needs to meet."""
    rng = np.random.default_rng(6)
    words = [bytes(w) for w in rng.integers(97, 123, (60, 6)).astype(np.uint8)]

    def text(label):
        parts = [words[i] for i in rng.integers(0, 60, 2100)]
        if not label:
            at = int(rng.integers(0, 1900))
            parts[at : at + 160] = [b"#$%@!&"] * 160
        return b" ".join(parts)

    labels = [int(i % 2) for i in range(160)]
    network = train([text(y) for y in labels[:120]], labels[:120])
    found = [network.probabilities(chunks_of(text(y)), np.array([0]))[0] >= 0.5 for y in labels[120:]]
    assert np.mean([f == y for f, y in zip(found, labels[120:])]) > 0.9


def test_gradients():
    rng = np.random.default_rng(1)
    network = Network(1)
    network.w = {n: x.astype(np.float64) for n, x in network.w.items()}
    network.w["out"] = rng.normal(0, 1, network.w["out"].shape)
    chunks = np.concatenate([chunks_of(bytes(rng.integers(0, 256, n).astype(np.uint8))) for n in (40, 300, 700)])
    begins, labels = np.array([0, 1, 3]), np.array([1.0, 0.0, 1.0])
    _, g = network.gradients(chunks, begins, labels)
    for name, x in network.w.items():
        places = np.argwhere(np.abs(g[name]) > 1e-3)
        for place in map(tuple, places[rng.permutation(len(places))[:5]]):
            old, losses = x[place], []
            for step in (1e-4, -1e-4):
                x[place] = old + step
                losses.append(network.gradients(chunks, begins, labels)[0])
            x[place] = old
            assert (losses[0] - losses[1]) / 2e-4 == pytest.approx(g[name][place], rel=0.05, abs=1e-4), name


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 255, 256, 257, 258, 506, 507, 5000])
def test_chunks_cover_the_text(n):
    text = bytes(np.random.default_rng(n).integers(0, 256, n).astype(np.uint8))
    chunks = chunks_of(text)
    assert chunks.shape[1] == CHUNK
    places = [chunks[c, p * STRIDE : p * STRIDE + WIDTH] for c in range(len(chunks)) for p in range(PLACES)]
    padded = np.concatenate([np.frombuffer(text, np.uint8), np.full(600, PAD)])
    assert all((place == padded[i * STRIDE : i * STRIDE + WIDTH]).all() for i, place in enumerate(places))
    assert len(places) * STRIDE + WIDTH - STRIDE >= n


def test_features_are_maxima(network):
    chunks = chunks_of(b"some text of more than one chunk " * 40)
    raw = network.responses(chunks)
    assert np.allclose(network.features(chunks, block=3), np.maximum(raw.max(axis=1) + network.w["bias"], 0), atol=1e-5)
    window = network.w["bytes"][chunks[1, 2 * STRIDE : 2 * STRIDE + WIDTH]].ravel()
    assert np.allclose(raw[1, 2], window @ network.w["filters"], atol=1e-4)


def test_awkward_rows(awkward, network):
    got = score(awkward.withColumn("score", awkward["text"]), network)
    assert got.columns == [*awkward.columns, "score", "predicted"] and got.count() == awkward.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.collect())


def test_without_labels(spark, awkward, nothing):
    labels = spark.createDataFrame([(3, 1), (None, 0), (4, None)], "doc_id long, quality int")
    assert learn(awkward, labels) is None and learn(nothing, labels) is None
    assert {r["score"] for r in score(awkward, None).collect()} == {0.5}


def test_empty(nothing, network):
    assert score(nothing, network).count() == 0
