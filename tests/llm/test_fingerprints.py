"""op10 against the same definition in plain Python, with Spark's hash."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from foldwise.llm.fingerprints import compared, following, kmers, signatures, text_form


def edited(rows):
    """{row: (n_chars, edited text's hash, next text)} for rows in order of id."""
    ordered = sorted(rows)
    out = {}
    for i, (doc, text) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1] or ""
        text = text or ""
        q = len(text) // 4
        out[doc] = (len(text), hashlib.sha256((text[: len(text) - q] + after[:q]).encode()).hexdigest())
    return out


def test_given_documents(documents, rows):
    want = edited(rows)
    got = compared(documents).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == want and len(got) == len(want)
    by_text: dict[str, set] = {}
    for r in got:
        by_text.setdefault(dict(rows)[r["doc_id"]], set()).add(r["fingerprint"])
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    assert all(len(x) == 1 for x in by_text.values()) and len({*map(min, by_text.values())}) > 0.95 * len(by_text)
    long = [r for r in got if r["n_chars"] > 500]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.3 > 0.05 > sum(r["near_next"] for r in long) / len(long)


def test_signature_by_hand(spark):
    """Occurrence numbers, one pick per class, text order."""
    texts = ["a b a b a b c", "c a b a b a b", "x", "a b", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r["signature"] for r in signatures(frame, ["id"], k=2, tuples=4, picks=2).collect()}
    assert 4 not in got

    def java(*values):
        columns = [F.lit(v) if isinstance(v, str) else F.array(*[F.lit(x).cast("long") for x in v]) if isinstance(v, list) else F.lit(v[0]).cast(v[1]) for v in values]
        return spark.range(1).select(F.xxhash64(*columns).alias("h")).first()["h"]

    for i, text in enumerate(texts[:4]):
        words = re.findall(r"[^\x20\x09-\x0D]{1,16}", text)
        seen: dict[int, int] = {}
        picked: dict[int, tuple] = {}
        for pos in range(max(1, len(words) - 1)):
            kmer = java(*words[pos : pos + 2])
            seen[kmer] = seen.get(kmer, 0) + 1
            draw = java((kmer, "long"), (seen[kmer], "int"))
            c = draw % 8
            picked[c] = min(picked.get(c, (draw, pos)), (draw, pos))
        want = []
        for j in range(4):
            # from its first class on, around the end, the filled ones
            filled = [c % 8 for c in range(2 * j, 2 * j + 24) if c % 8 in picked][:2]
            draws = [d for _, d in sorted((picked[c][1], picked[c][0]) for c in filled)]
            want.append(java(draws) >> 32)
        assert got[i] == want


def test_order_matters(spark):
    a, b = " ".join(f"w{i}" for i in range(400)), " ".join(f"v{i}" for i in range(400))
    frame = spark.createDataFrame([(0, f"{a} {b}"), (1, f"{b} {a}")], "id long, text string")
    one, two = (r["signature"] for r in signatures(frame, ["id"], tuples=64).orderBy("id").collect())
    assert 0.2 < sum(x == y for x, y in zip(one, two)) / 64 < 0.8


@pytest.mark.parametrize("words", [12, 24, 60, 200, 1000])
def test_order_matters_at_all_lengths(spark, words):
    """Halves swapped are less alike than one word changed, over many texts."""
    rows = []
    for n in range(40):
        text = [f"w{n}_{i}" for i in range(words)]
        changed = [*text[: words // 3], "other", *text[words // 3 + 1 :]]
        rows += [(n, k, " ".join(t)) for k, t in enumerate((text, text[words // 2 :] + text[: words // 2], changed))]
    frame = spark.createDataFrame(rows, "id long, kind long, text string")
    got = {(r["id"], r["kind"]): r["signature"] for r in signatures(frame, ["id", "kind"]).collect()}
    like = [sum(x == y for n in range(40) for x, y in zip(got[n, 0], got[n, k])) / (40 * 32) for k in (1, 2)]
    assert like[0] < like[1] and like[0] < 0.65


def test_next_of_many_ids(spark):
    ids = sorted({i * i % 10_007 for i in range(3000)})
    got = {r["doc"]: r["next_doc"] for r in following(spark.createDataFrame([(i,) for i in ids], "doc long")).collect()}
    assert got == dict(zip(ids, ids[1:] + ids[:1]))


def test_awkward_rows(awkward):
    got = compared(awkward)
    rows = got.collect()
    assert len(rows) == awkward.count() and sorted(r["doc_id"] or -1 for r in rows) == sorted(r["doc_id"] or -1 for r in awkward.collect())
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["n_chars"] == 0 and by_id[0]["fingerprint"] == "-" * 32 and by_id[0]["near_edited"] == 1.0
    assert by_id[5]["fingerprint"] == by_id[6]["fingerprint"] and by_id[5]["near_next"] == 1.0
    assert by_id[7]["fingerprint"] == by_id[8]["fingerprint"] == next(r["fingerprint"] for r in rows if r["doc_id"] == 7)


def test_single_document(spark):
    row = compared(spark.createDataFrame([(3, "ab cd ef gh")], "doc_id long, text string")).first()
    assert row["edited_sha256"] == hashlib.sha256(b"ab cd ef ab").hexdigest() and row["near_next"] == 1.0


def test_empty(nothing):
    assert compared(nothing).count() == 0


@pytest.mark.parametrize("text,size", [("", 0), ("a", 1), ("a b c d", 2), ("x" * 40, 1)])
def test_kmers(spark, text, size):
    got = spark.createDataFrame([(text,)], "t string").select(F.size(kmers(F.col("t"), 3)).alias("n"), text_form(F.array(F.lit(-1), F.lit(None).cast("int")), 2).alias("f")).first()
    assert got["n"] == size and got["f"] == "ffffffff-"
