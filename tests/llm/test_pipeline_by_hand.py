"""What the pipeline gives after its first stage, by plain definitions of the other four over the same documents."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from test_packing import one_by_one
from test_simhash import classes, plain
from tokenizers import Tokenizer

import corpus_pipeline
from foldwise.llm.mixing_query import MIX_CTE
from foldwise.llm.packing_query import word_tokenizer
from foldwise.sources.scratch import stored

SF = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"


def without_repeated_lines(rows):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))

    holders = defaultdict(set)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(r["doc_id"])
    out = []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 5 or max(holders[key(x)]) == r["doc_id"]]
        text = r["text"] if len(kept) == len(lines) else "\n".join(kept)
        out.append({**r, "text": text, "n_chars": len(text)})
    return out


def one_of_each(rows):
    rows = sorted(rows, key=lambda r: r["doc_id"])
    roots = classes(np.array([plain(r["text"]) for r in rows], np.uint64))
    return [r for i, r in enumerate(rows) if roots[i] == i]


def mixed(rows):
    db = duckdb.connect()
    columns = ("doc_id", "text", "source")
    db.register("documents", pa.table({c: [r[c] for r in rows] for c in columns}))
    copies = dict(db.execute(f"WITH {MIX_CTE} SELECT doc_id, copies FROM plan").fetchall())
    return [r for r in rows for _ in range(copies[r["doc_id"]])]


def cut(rows, capacity=2048):
    tokenizer = Tokenizer.from_file(word_tokenizer())
    tokenizer.encode_special_tokens = True
    out = []
    for r in rows:
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            out.append((r["doc_id"], k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


@pytest.fixture(scope="module")
def stages(spark, documents):
    out = [documents]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), "by-hand"))
    return [[r.asDict() for r in frame.collect()] for frame in out]


def counted(rows):
    return Counter(repr(sorted(r.items())) for r in rows)


def test_all_stages_after_the_network(stages):
    """Nothing of one stage is given to the next but what the definitions made."""
    rows = stages[1]
    for definition, found in ((without_repeated_lines, stages[2]), (one_of_each, stages[3]), (mixed, stages[4])):
        before = rows
        rows = definition(rows)
        assert counted(rows) == counted(found), definition.__name__
        assert counted(rows) != counted(before), definition.__name__  # the stage does something here
    want = cut(rows)
    assert sorted(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in stages[5]) == sorted(want)
    filled = defaultdict(list)
    for r in stages[5]:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 2048
    assert len(filled) == one_by_one([w[3] for w in want], 2048)
    assert len(filled) <= math.ceil(sum(w[3] for w in want) / 2048) * 1.1


def test_the_network_only_drops_rows(stages):
    assert not counted(stages[1]) - counted(stages[0])
