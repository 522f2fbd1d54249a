"""op7 against all pairs; the code's properties; groups without all pairs."""

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from foldwise.llm.components import components
from foldwise.llm.simhash import _errors, _segment, codeword, fingerprint, first_of_each, links_within, near_duplicates, near_links, neighbours, probe_keys, stored_keys


def plain(text, words=3):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(parts[i : i + words]).encode(), 42) for i in range(max(1, len(parts) - words + 1))] if parts else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(bits, distance=3):
    """The smallest place that each place can reach."""
    root = list(range(len(bits)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(bits)):
        for j in np.nonzero(np.bitwise_count(bits[:i] ^ bits[i]) <= distance)[0]:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(bits))]


def check(frame, rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    bits = np.array([plain(t) for _, t in rows], np.uint64)
    want = sorted(((d, f"{int(b):016x}", rows[c][0]) for (d, _), b, c in zip(rows, bits, classes(bits))), key=repr)
    got = near_duplicates(frame)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_given_documents(documents, rows):
    check(documents, rows)


def test_awkward_rows(awkward):
    check(awkward, [(r["doc_id"], r["text"]) for r in awkward.collect()])


def test_spark_hash_is_the_same(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("añb c d")).alias("h")).first()["h"]
    assert fingerprint("Añb  C\td".encode()) == got % (1 << 64)


def test_words_one_bit_apart_share_a_codeword():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 23, 2000).astype(np.uint32)
    assert (np.bitwise_count(words ^ _word(codeword(words))) <= 3).all()
    near = neighbours(words, 23)
    assert ((near >= 0).sum(axis=1) <= 6).all()
    for bit in range(23):
        assert (near == codeword(words ^ np.uint32(1 << bit))[:, None].astype(np.int32)).any(axis=1).all()


def _word(index):
    """The codeword of each index: the word that is its own nearest codeword."""
    pattern, low, high = _errors()
    every = np.arange(1 << 23, dtype=np.uint32)
    exact = every[pattern[low[every & 4095] ^ high[every >> 12]] == 0]
    assert len(exact) == 4096 and (exact >> 11 == np.arange(4096)).all()
    return exact[index]


def test_three_bits_always_meet():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    b = a.copy()
    for n in range(3000):
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            b[n] ^= np.uint64(1 << int(bit))
    held = {(int(k), int(x)) for k, x in zip(*stored_keys(a))}
    probing: dict[int, set] = {}
    for k, x in zip(*probe_keys(b)):
        probing.setdefault(int(x), set()).add(int(k))
    keys: dict[int, set] = {}
    for k, x in held:
        keys.setdefault(x, set()).add(k)
    assert all(keys[int(x)] & probing[int(y)] for x, y in zip(a, b))
    assert int(_segment(a[:1], 0)[0]) == int(a[0]) & (1 << 22) - 1


def test_chains_and_dense_groups(spark):
    """A group in which most pairs are near gives fewer links than members; a chain is one class."""
    rng = np.random.default_rng(6)
    center = np.uint64(rng.integers(0, 1 << 63))
    dense = {int(center)} | {int(center) ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i)}
    chain = [int(rng.integers(0, 1 << 63))]
    for step in range(20):
        chain.append(chain[-1] ^ (7 << (3 * step)))
    far = rng.integers(0, 1 << 63, 500).tolist()
    bits = np.array([*dense, *chain, *far], np.uint64)
    frame = spark.createDataFrame([(int(x),) for x in bits.view(np.int64)], "bits long")
    links = near_links(frame, len(bits))
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    want = classes(bits)
    got = [roots.get(int(x), int(x)) for x in bits.view(np.int64)]
    assert len({*zip(want, got)}) == len({*want}) == len({*got})


def test_blocks_give_the_same_links(monkeypatch):
    import foldwise.llm.simhash as module

    rng = np.random.default_rng(8)
    bits = np.unique(rng.integers(0, 1 << 10, 300).astype(np.uint64))
    row = np.zeros(len(bits), module.ROW)
    row["bits"] = bits
    whole = links_within(row, row, 3)
    monkeypatch.setattr(module, "BLOCK", 64)
    parts = links_within(row, row, 3)
    assert {*zip(*map(np.ndarray.tolist, whole))} == {*zip(*map(np.ndarray.tolist, parts))}


def test_one_of_each_stays(awkward):
    kept = first_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == [0, 3, 4, 5, 7, 9] and ids.count(None) == 1


def test_one_of_each_judges_rows_not_ids(spark):
    """Unrelated texts that share an id, or have none, all stay; their near copies go."""
    text = [" ".join(f"{chr(97 + i)}{j * j % 997}" for j in range(300)) for i in range(9)]
    rows = [(None, t) for t in text[:3]] + [(5, t) for t in text[3:6]] + [(2, text[6]), (5, text[6] + "\n"), (3, text[7]), (None, text[7] + " "), (None, text[8]), (None, text[8])]
    kept = first_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(None, t) for t in text[:3]] + [(5, t) for t in text[3:6]] + [(2, text[6]), (3, text[7]), (None, text[8])]
    assert sorted(map(tuple, kept), key=repr) == sorted(want, key=repr)


def test_empty(nothing):
    assert near_duplicates(nothing).count() == 0 and first_of_each(nothing).count() == 0
