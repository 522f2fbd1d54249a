"""op2 against its SQL, and the filters against sets."""

import numpy as np

from foldwise.llm.lines import _put, drop_repeated_lines, long_keys, probes, twice_filter
from foldwise.llm.lines_query import SQL

COLUMNS = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


def test_given_documents(documents, db):
    got = sorted(tuple(r) for r in drop_repeated_lines(documents).select(*COLUMNS).collect())
    assert got == sorted(db.execute(f"SELECT {', '.join(COLUMNS)} FROM ({SQL})").fetchall())
    assert any(r[2] for r in got)


def test_last_document_keeps_its_lines(spark):
    line = "x" * 40
    rows = [(i, f"own {i}\n  {line.upper()}\t\nend") for i in range(5)] + [(9, f"{line[1:]}\n{'y' * 40}")]
    left = {r["doc_id"]: r for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [left[i]["text"] for i in range(4)] == [f"own {i}\nend" for i in range(4)]
    assert left[4]["text"] == rows[4][1] and left[9]["n_dropped"] == 0


def test_repeated_ids_count_once(spark):
    frame = spark.createDataFrame([(1, "x" * 50)] * 9 + [(None, "x" * 50)] * 3, "doc_id long, text string")
    assert {r["n_dropped"] for r in drop_repeated_lines(frame).collect()} == {0}


def test_awkward_rows_keep_their_columns(awkward):
    got = drop_repeated_lines(awkward)
    assert got.columns == [*[c for c in awkward.columns if c != "text"], "text", "n_lines", "n_dropped", "kept_sha256"]
    assert got.count() == awkward.count()
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[0]["text"] is None and by_id[0]["n_lines"] == 1 and by_id[2]["n_lines"] == 2 and by_id[9]["n_dropped"] == 0


def test_code_points_not_bytes():
    assert not long_keys(("é" * 39).encode(), 40) and long_keys((" " + "É" * 40).encode(), 40) == {("É" * 40).encode()}


def test_filter_knows_every_repeat(documents, rows):
    bits = 1 << 20
    filters = np.zeros((2, bits // 8), np.uint8)
    seen, twice = set(), set()
    for _, text in rows:
        keys = long_keys((text or "").encode(), 40)
        twice |= seen & keys
        seen |= keys
        if keys:
            _put(filters, list(keys), bits)
    merged = twice_filter(documents, 40)
    for known in (filters[1], merged):
        at = probes(sorted(twice), len(known) * 8)
        assert ((known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all()


def test_empty(nothing):
    assert drop_repeated_lines(nothing).count() == 0
