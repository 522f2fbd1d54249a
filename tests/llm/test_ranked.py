"""op13 against SQL over all documents and against a count by hand: ties, bundles, blocks, shards, long and empty texts."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import foldwise.llm.ranked as module
from foldwise.llm.ranked import ranked, terms
from foldwise.llm.ranked_query import SQL

SF = "/root/testdata/sf0.001"


def by_sql(documents, items):
    db = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", documents), ("benchmark", "item_id", items)):
        ids, texts = zip(*rows) if rows else ((), ())
        db.register(name, pa.table({key: pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())}))
    return sorted(db.execute(SQL).fetchall(), key=repr)


def by_hand(documents, items, k=10):
    split = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda c: c.group().lower(), t or ""))
    docs = [(i, Counter(split(t))) for i, t in documents]
    n, total = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    out = []
    for item, text in set(items):
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in c for _, c in docs) + 1))) for t in split(text)}
        scored = []
        for i, c in docs:
            m = 100 - 75 + (75 * sum(c.values()) * n) // max(total, 1)
            score = sum(weight[t] * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in split(text))
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def found(spark, documents, items, **options):
    frames = [spark.createDataFrame(rows, f"{key} long, text string").selectExpr("*", "'x' AS term", "1 AS shard", "2 AS number", "3 AS score").repartition(3) for key, rows in (("doc_id", documents), ("item_id", items))]
    return sorted(map(tuple, ranked(*frames, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def given(spark):
    documents = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return documents, [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]


def test_terms():
    assert terms("Éa-B2_ x Ä 9".encode()) == [t.encode() for t in ("Éa", "b2", " x Ä", "9")]


def test_given_tables(spark, given):
    want = by_sql(*given)
    assert found(spark, *given) == want == by_hand(*given)


@pytest.mark.parametrize("owners", [1, 7])
def test_small_shards_bundles_and_blocks(spark, given, monkeypatch, owners):
    documents, items = given
    monkeypatch.setattr(module, "SHARD_DOCS", 13)
    monkeypatch.setattr(module, "BUNDLE", 2)
    monkeypatch.setattr(module, "BLOCK_BYTES", 1500)
    some = items[:9]
    assert found(spark, documents, some, owners=owners) == by_sql(documents, some)


@pytest.mark.parametrize("size", [1, 200])
def test_pruning_and_ties(spark, monkeypatch, size):
    """Few words, so that many scores are equal or close, and bounds matter."""
    rng = np.random.default_rng(size)
    monkeypatch.setattr(module, "SHARD_DOCS", 20)
    word = lambda: f"w{int(rng.zipf(1.3)) % 60}"
    documents = [(int(i), " ".join(word() for _ in range(int(rng.integers(1, 3 + size))))) for i in rng.permutation(300)]
    items = [(i, " ".join(word() for _ in range(int(rng.integers(1, 12))))) for i in range(30)]
    want = by_hand(documents, items)
    assert found(spark, documents, items) == want == by_sql(documents, items)
    assert found(spark, documents, items, k=3, owners=5) == by_hand(documents, items, 3)


def test_awkward_texts(spark, monkeypatch):
    monkeypatch.setattr(module, "SHARD_BYTES", 100)
    long = " ".join(f"word{i * 7919 % 4001}" for i in range(60_000))
    texts = [None, "", " \t\n", "...", "a", "A", "Ünïcode ÑANDÚ 東京\x85x", long, long, "same text " * 9, "same text " * 9, "\x00nul\x00same"]
    documents = [*enumerate(texts), (None, "same"), (None, "a b"), (9, "same text " * 9), (-5, "a"), (4, "a")]
    items = [(0, "same text a"), (0, "same text a"), (0, "word17 word18 word18"), (1, None), (2, ""), (3, "nowhere"), (None, "ñandú 東京 ÑANDÚ"), (5, long), (6, "A a a A")]
    assert found(spark, documents, items) == by_hand(documents, items)
    everywhere = [(i, "the same everywhere") for i in range(40)]
    assert found(spark, everywhere, [(1, "the the")]) == by_hand(everywhere, [(1, "the the")])


def test_empty(spark, given):
    assert found(spark, [], given[1]) == [] == found(spark, given[0], [])
    assert found(spark, [(1, None)], given[1]) == []
