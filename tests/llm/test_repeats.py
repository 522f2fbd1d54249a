"""op1 against every 50-byte string in a dictionary."""

import hashlib

from foldwise.llm.repeats import _grams, removed_repeats, samples

import numpy as np

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def expected(rows):
    """Of (id, text), an id being larger than all if None."""
    key = lambda d: float("inf") if d is None else d
    first: dict[bytes, float] = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - 49):
            w = raw[i : i + 50]
            first[w] = min(first.get(w, key(d)), key(d))
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < key(d):
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, y in zip(raw, gone) if not y)
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_given_documents(documents, rows):
    assert found(removed_repeats(documents)) == expected(rows)


def test_small_chunks_and_awkward_rows(awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(removed_repeats(awkward, chunk_bytes=1e5)) == expected(rows)


def test_overlaps_and_context(spark):
    a = "".join(chr(97 + i * i % 23) for i in range(200))
    b = "".join(chr(97 + i * i * i % 19) for i in range(200))
    texts = [a, "x" * 30 + a[50:99] + "y", "q" + a[20:70] + b[:60], b[:61] + a[69:150], "zz" + a[100:151] + a[100:151], "q" * 300, "r" + "q" * 80, a[:49], a[10:60]]
    rows = list(enumerate(texts))
    assert found(removed_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_frequent_samples_are_not_one_group(spark, monkeypatch):
    """A line between different neighbours in each document: no task merges all its occurrences, and the result is the same."""
    import foldwise.llm.repeats as module

    line = "".join(chr(97 + i * i % 23) for i in range(70))
    other = lambda i, n: "".join(chr(65 + x) for x in np.random.default_rng(i).integers(0, 26, n))
    rows = [(i, other(i, 30 + i % 7) + line[: 30 + i % 41] + other(i // 3 + 5000, 40) + line) for i in range(900)]
    most, names, windows = 300, module.classes, getattr(module, "window_classes", None)

    def bounded(function):
        def run(rows):
            assert len(rows) <= 4 * most
            return function(rows)

        return run

    monkeypatch.setattr(module, "HOT", 100, raising=False)
    monkeypatch.setattr(module, "GROUP", most, raising=False)
    monkeypatch.setattr(module, "classes", bounded(names))
    monkeypatch.setattr(module, "window_classes", bounded(windows), raising=False)
    assert found(removed_repeats(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=2e4)) == expected(rows)


def test_frequent_samples_give_the_same(documents, rows, awkward, monkeypatch):
    import foldwise.llm.repeats as module

    monkeypatch.setattr(module, "HOT", 2, raising=False)
    assert found(removed_repeats(documents)) == expected(rows)
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(removed_repeats(awkward, chunk_bytes=1e5)) == expected(rows)


def test_spans_say_what_is_gone(documents, rows):
    texts = dict(rows)
    for r in removed_repeats(documents).collect():
        raw, left, last = texts[r["doc_id"]].encode(), b"", 0
        for a, b in zip(r["spans"][::2], r["spans"][1::2]):
            left, last = left + raw[last:a], b
        assert hashlib.sha256(left + raw[last:]).hexdigest() == r["kept_sha256"]


def test_equal_windows_hold_equal_samples():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 101, 50)
    places = []
    for before in (0, 7, 40):
        raw = np.concatenate([rng.integers(97, 101, before), shared, rng.integers(97, 101, 30)]).astype(np.uint8)
        at, names = samples(raw, len(raw) - np.arange(len(raw)))
        assert len(_grams(raw)) == len(raw) - 23
        places.append({(int(x) - before, int(n)) for x, n in zip(at, names) if before <= x <= before + 26})
    assert places[0] & places[1] & places[2]


def test_empty(nothing):
    assert removed_repeats(nothing).count() == 0
