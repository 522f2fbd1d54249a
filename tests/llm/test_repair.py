"""op11 against every possible edit of short conversations, and against turn-by-turn SQL."""

import hashlib
import itertools
import re
import zlib

import duckdb
import numpy as np
import pytest

import foldwise.llm.repair as module
from foldwise.llm.repair import _joined, _leaf, FINAL, damage, repair
from foldwise.llm.repair_query import SQL, repaired

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(turns):
    """(cost, audit) over all edits with at most two insertions at a place; turns: (role, fault)."""
    best = None
    for letters in itertools.product(*["D" if f in "bd" and f else "KRD" for _, f in turns]):
        for places in itertools.product(range(3), repeat=len(turns) + 1):
            audit, cost, initials = "", 0, [""]
            for inserted, (letter, turn) in zip(places, [*zip(letters, turns), (None, None)]):
                audit, cost = audit + "I" * inserted, cost + 5 * inserted
                initials = [x + y for x in initials for y in map("".join, itertools.product("ua", repeat=inserted))]
                if letter:
                    audit, cost = audit + letter, cost + {"K": 0, "R": 1, "D": 2}[letter] + 5 * (letter != "D" and turn[1] == "t")
                    if letter != "D":
                        initials = [x + y for x in initials for y in (turn[0] if letter == "K" else "ua")]
            if any(re.fullmatch("(s?(ua)+)?", x) for x in initials):
                best = min(best or (cost, audit), (cost, audit))
    return best


@pytest.mark.parametrize("length", [0, 1, 2, 3, 4])
def test_cells_against_all_edits(length):
    rng = np.random.default_rng(length)
    for _ in range({4: 25, 3: 60}.get(length, 40)):
        turns = [(str(rng.choice(list("suax"))), str(rng.choice(["", "", "t", "b", "d"]))) for _ in range(length)]
        if turns:
            cell = _joined([_leaf(r, f, 0) for r, f in turns]).cell
            assert min(cell[i] for i in FINAL if cell[i]) == cheapest(turns)
        else:
            assert cheapest(turns) == (0, "")


def expected(rows):
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = db.execute(SQL)
    names = [d[0] for d in found.description]
    return {r[0]: dict(zip(names, r)) for r in found.fetchall()}


def got(frame):
    out = {}
    for r in frame.collect():
        assert r["conv_id"] not in out
        out[r["conv_id"]] = r.asDict()
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    texts = ["Fine.", "Cut off", "", " \n\t", "Again!", "What?  ", None, "é", "Two\nlines.", "\xa0"]
    out = []
    for c in range(60):
        for t in range(int(rng.integers(1, 14))):
            role = [*["user", "assistant"] * 4, "system", None, "", "tool"][int(rng.integers(12))]
            out.append((c, int(t * rng.integers(1, 3)) if rng.random() < 0.9 else None, role, texts[int(rng.integers(len(texts)))]))
    out += [(None, t, "user", f"No conversation {t}.") for t in range(5)]
    out += [(100, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(700)]
    out += [(101, 0, "user", "The same row.")] * 300
    out += [(102, None, None, None), (-7, -(1 << 62), "user", "Far."), (-7, 1 << 61, "assistant", "Off.")]
    return out


@pytest.mark.parametrize("block, fan", [(4096, 64), (7, 3)])
def test_awkward_rows(spark, rows, monkeypatch, block, fan):
    monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(module, "FAN", fan)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "'x' AS audit", "1 AS number", "2 AS block", "3 AS digest", "4 AS salt", "5 AS way")
    assert got(repaired(frame)) == expected(rows)


def test_given_conversations(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert got(repaired(frame)) == expected(rows)


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(20) for t in range(10)]
    out = {}
    for r in damage(spark.createDataFrame(rows, SCHEMA)).collect():
        out.setdefault((r["conv_id"], r["turn"]), []).append((r["role"], r["text"]))
    whole = ("assistant", "One. Two!")
    ways = {0: None, 1: [("assistant", "")], 2: [("assistant", "One Two")], 3: [whole] * 2, 4: [("user", "One. Two!")]}
    for c, t, *_ in rows:
        assert out.get((c, t)) == ways.get(zlib.crc32(f"{c}:{t}".encode()) % 20, [whole])


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello."), (1, 2, "user", "Still there?"), (1, 3, "assistant", "Yes."), (2, 0, "assistant", "Nobody asked."), (3, 0, "user", " ")]
    found, turns = repair(spark.createDataFrame(rows, SCHEMA))
    assert {(r["conv_id"], r["cost"], r["audit"]) for r in found.collect()} == {(1, 2, "KDKK"), (2, 2, "D"), (3, 2, "D")}
    kept = [tuple(r) for r in turns.orderBy("conv_id", "place").collect()]
    assert kept == [(1, 0, "K", "system", "Be kind."), (1, 1, "K", "user", "Still there?"), (1, 2, "K", "assistant", "Yes.")]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repaired(none).collect() == []
    gone = next((c, 0) for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = repaired(spark.createDataFrame([(*gone, "user", "Dropped.")], SCHEMA)).collect()
    assert tuple(row) == (gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
