"""op8 against the tokenizer, and the plan against best-fit decreasing piece by piece."""

import bisect
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from foldwise.llm.packing import Encoder, OpenBins, pack, plan
from foldwise.llm.packing_query import word_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(word_tokenizer())
    t.encode_special_tokens = True
    return t


def check(frame, rows, tokenizer, capacity):
    want = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want.append((doc, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = pack(frame, word_tokenizer(), capacity).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    bins: dict[int, list] = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) == one_by_one([r[3] for r in want], capacity)


def one_by_one(lengths, capacity):
    rooms, opened = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, length)
        opened += i == len(rooms)
        room = rooms.pop(i) if i < len(rooms) else capacity
        bisect.insort(rooms, room - length)
    return opened


def test_given_documents(documents, rows, tokenizer):
    check(documents, rows, tokenizer, 2048)


def test_awkward_rows(awkward, tokenizer):
    check(awkward, [(r["doc_id"], r["text"]) for r in awkward.collect()], tokenizer, 300)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.randint(5, 60)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
        counts = {x: lengths.count(x) for x in {*lengths}}
        runs = plan(counts, capacity)
        placed, fill = 0, {}
        for length, first, pieces, first_bin, each, base in runs:
            for i in range(pieces):
                fill.setdefault(first_bin + i // each, []).append((base + i % each * length, length))
            placed += pieces
        assert placed == len(lengths) and len(fill) == one_by_one(lengths, capacity)
        for parts in fill.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity


def test_tightest_bin():
    bins = OpenBins(100)
    for room in (7, 30, 100):
        bins.add(room, room, 1)
    assert [bins.tightest(x) for x in (1, 7, 8, 30, 31, 100)] == [7, 7, 30, 30, 100, 100]
    assert bins.take(30) == (30, 1) and bins.tightest(8) == 100 and bins.take(100) and bins.tightest(8) is None


@pytest.mark.parametrize(
    "text",
    ["", " ", "Don't you'LL they've", "naïve façade ÉÀÜ ÿŸ", "a\x1cb\x85c\xa0d\u2003e", "e\u0301 cafe\u0301", "<|endoftext|> x <|startoftext|>", "東京 ΑΣ Σ İstanbul ŉ ſ ß ĸ", "1234 x_y __ 5²½", "x" * 3000, "!!--''s 't", "😀👍🏽 \u200b\u00ad"],
)
def test_ids_are_the_tokenizers(tokenizer, text):
    ids, ends = Encoder(word_tokenizer()).encode([text, text])
    want = tokenizer.encode(text, add_special_tokens=False).ids + [0]
    assert ids.tolist() == want * 2 and ends.tolist() == [len(want), 2 * len(want)]


def test_letters_on_their_own(tokenizer):
    encoder = Encoder(word_tokenizer())
    for code in [*range(1, 0x250), 0x3A3, 0x1E9E, 0x2028]:
        text = f"a{chr(code)}b {chr(code)}"
        assert encoder.encode([text])[0].tolist()[:-1] == tokenizer.encode(text, add_special_tokens=False).ids, hex(code)


def test_remembered_words_are_forgotten(tokenizer, monkeypatch):
    monkeypatch.setattr(Encoder, "REMEMBERED", 3)
    encoder = Encoder(word_tokenizer())
    for text in ("one two three four", "five six", "one seven"):
        assert encoder.encode([text])[0].tolist()[:-1] == tokenizer.encode(text, add_special_tokens=False).ids


def test_empty(nothing):
    assert pack(nothing, word_tokenizer()).count() == 0
