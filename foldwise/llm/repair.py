"""Conversation structure repair by weighted interval parsing.

A conversation is an optional system turn, then pairs of a user's and an assistant's turn, or nothing at all. Its grammar in Chomsky normal
form has a symbol (p, q) for every two states of that pattern, where states are the start (0) and after a system (1), user (2) or assistant (3)
turn: ``(p, q) -> (p, r) (r, q)``, and ``(p, q) -> turn`` for a turn that is kept, given another role, or deleted. A span's cell holds, for every
symbol, the least (cost, audit) of an edit that makes the span's turns lead from p to q. The audit has a letter for each edit: K(eep), R(erole),
D(elete), I(nsert). Cells of single turns are closed under insertion on both sides; longer cells are combined from shorter ones, bottom-up
by span length. Every symbol over a span can be derived through every cut of it, so one cut a span is enough: lengths double, and a conversation
has as many cells as turns instead of their square. Two audits of one span and symbol with equal cost never are prefixes of each other (an
insertion costs, and the letters tell which turns were kept), so the least of parts make the least of the whole.

On Spark: turns, without their texts, are sorted by range and numbered. Blocks of ``BLOCK`` consecutive turns are parsed each in a group of its
own, whatever conversations they belong to; cells of conversations that go on in other blocks are combined, ``FAN`` blocks into one, until
one is left. So a conversation of any length is spread over tasks. Texts are shuffled once, beside the finished audits, and streamed in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.sources.scratch import stored

BLOCK = 4096  # turns parsed by one group
FAN = 64  # blocks whose cells are combined in one step
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5  # costs
BLANK_CHARS = r"\x20\x09-\x0D"

# states: 0 start, 1 after a system turn, 2 after a user turn, 3 after an assistant turn
REACHED = {0: (0, 1, 2, 3), 1: (1, 2, 3), 2: (2, 3), 3: (2, 3)}
SYMBOLS = [(p, q) for p in REACHED for q in REACHED[p]]
PLACE = {symbol: i for i, symbol in enumerate(SYMBOLS)}
#: for each symbol, the places of the two symbols of each rule that makes it
RULES = [[(PLACE[p, r], PLACE[r, q]) for r in REACHED[p] if q in REACHED[r]] for p, q in SYMBOLS]
FINAL = (PLACE[0, 0], PLACE[0, 3])
USER, ASSISTANT = ((0, 2), (1, 2), (3, 2)), ((2, 3),)

Cell = list  # (cost, audit) or None per symbol


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans."""
    out = []
    for rules in RULES:
        least = None
        for a, b in rules:
            x, y = left[a], right[b]
            if x is not None and y is not None:
                cost = x[0] + y[0]
                if least is None or cost < least[0]:
                    least = (cost, x[1] + y[1])
                elif cost == least[0]:
                    least = min(least, (cost, x[1] + y[1]))
        out.append(least)
    return out


def _cell(entries: dict) -> Cell:
    return [entries.get(symbol) for symbol in SYMBOLS]


def _inserted() -> Cell:
    """The empty span: what insertions alone can do."""
    entries = {(p, p): (0, "") for p in REACHED}
    for step in range(2):
        for p, q in [*entries]:
            for a, b in USER + ASSISTANT:
                if a == q:
                    cost, audit = entries[p, q]
                    entries[p, b] = min(entries.get((p, b), (1 << 30, "")), (cost + INSERT, audit + "I"))
    return _cell(entries)


def _turn(initial: str, fault: str) -> Cell:
    """A turn's cell, closed under insertion. ``fault``: '' or the initial of blank, duplicate, truncated."""
    entries = {(p, p): (DELETE, "D") for p in REACHED}
    if fault not in ("b", "d"):
        more = UNFINISHED if fault == "t" else 0
        for moves, name in ((USER, "u"), (ASSISTANT, "a")):
            for move in moves:
                entries[move] = (KEEP + more, "K") if initial == name else (REROLE + more, "R")
        if initial == "s":
            entries[0, 1] = (KEEP + more, "K")
    empty = _inserted()
    return combined(combined(empty, _cell(entries)), empty)


TURNS = {(i, f): _turn(i, f) for i in ("s", "u", "a", "") for f in ("", "b", "d", "t")}


@dataclass
class Piece:
    """Adjacent turns of one conversation: their cell, and counts that add up over adjacent pieces."""

    cell: Cell
    faults: list[int]  # blank, duplicate, truncated
    illegal: int
    first: str
    last: str
    low: int | None
    high: int | None
    turns: int  # different turn numbers

    def __add__(self, other: "Piece") -> "Piece":
        low, high = self.low if self.low is not None else other.low, other.high if other.high is not None else self.high
        again = self.high is not None and self.high == other.low
        return Piece(
            combined(self.cell, other.cell),
            [a + b for a, b in zip(self.faults, other.faults)],
            self.illegal + other.illegal + (self.last + other.first not in ("su", "ua", "au")),
            self.first,
            other.last,
            low,
            high,
            self.turns + other.turns - again,
        )


def _joined(pieces: list[Piece]) -> Piece:
    """Adjacent pieces as one, neighbours first: spans of one length before spans of the next."""
    while len(pieces) > 1:
        pairs = [a + b for a, b in zip(pieces[::2], pieces[1::2])]
        pieces = pairs + pieces[len(pairs) * 2 :]
    return pieces[0]


def _leaf(initial: str, fault: str, turn: int | None) -> Piece:
    cell = TURNS[initial if initial in ("s", "u", "a") else "", fault]
    return Piece(cell, [int(fault == f) for f in "bdt"], 0, initial, initial, turn, turn, int(turn is not None))


PIECE = "costs array<long>, audits array<string>, faults array<long>, illegal long, first string, last string, low long, high long, turns long"


def _row(p: Piece) -> tuple:
    return ([None if x is None else x[0] for x in p.cell], [None if x is None else x[1] for x in p.cell], p.faults, p.illegal, p.first, p.last, p.low, p.high, p.turns)


def _piece(r: dict) -> Piece:
    cell = [None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"])]
    return Piece(cell, r["faults"], r["illegal"], r["first"], r["last"], r["low"], r["high"], r["turns"])


_KINDS = [pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
_NAMES = "costs audits faults illegal first last low high turns".split()


def _batch(head: list[tuple], head_kinds: list[tuple], pieces: list[Piece]) -> pa.Table:
    rows = [(*h, *_row(p)) for h, p in zip(head, pieces)]
    kinds = [k for _, k in head_kinds] + _KINDS
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=[n for n, _ in head_kinds] + _NAMES)


def prepared(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text (NULL: one space), the text's digest; order within a conversation is by turn (NULL first), role, digest."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), filled("role"), filled("text"))
    return rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


ORDER = ("turn", "role", "digest")


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``number``: consecutive from 0 in the order of conversations and of their turns."""
    # equal rows may be dealt apart: their order does not matter
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    ordered = salted.repartitionByRange("conv_id", *ORDER, "salt").sortWithinPartitions("conv_id", *ORDER, "salt").drop("salt")
    placed = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "turns")
    part = F.shiftright("at", 33)
    counts = sorted(placed.groupBy(part.alias("part")).count().collect())  # one row per partition
    begins = np.cumsum([0] + [r["count"] for r in counts])
    offsets = placed.sparkSession.createDataFrame([(r["part"], int(b)) for r, b in zip(counts, begins)] or [(0, 0)], "part long, begin long")
    number = F.col("begin") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("number", number).drop("part", "begin", "at")


def parsed(prepared_rows: DataFrame) -> DataFrame:
    """Per conversation that has rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    kind = prepared_rows.schema["conv_id"].dataType.simpleString()
    text = F.col("text")
    blank = ~text.rlike(f"[^{BLANK_CHARS}]")
    whole = text.rlike(rf"[.!?][{BLANK_CHARS}]*\z")
    light = prepared_rows.select("conv_id", *ORDER, F.when(blank, "b").when(whole, "").otherwise("t").alias("fault"))
    rows = stored(_numbered(stored(light, "light")), "numbered")
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min("number").alias("number")).select("number", F.lit(True).alias("new"))
    fault = F.when((F.col("fault") != "b") & F.col("new").isNull(), "d").otherwise(F.col("fault"))
    marked = rows.join(first, "number", "left").select(F.floor(F.col("number") / BLOCK).alias("block"), "number", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    blocks = -(-rows.count() // BLOCK)

    def parse(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        ids, columns = table.column("conv_id").to_pylist(), [table.column(c).to_pylist() for c in ("initial", "fault", "turn")]
        leaves = [_leaf(*row) for row in zip(*columns)]
        head, pieces, begin = [], [], 0
        for end in range(1, len(ids) + 1):
            if end == len(ids) or ids[end] != ids[begin]:
                # a conversation at a side of the block may go on beyond it
                head.append((ids[begin], key[0].as_py(), begin == 0 or end == len(ids)))
                pieces.append(_joined(leaves[begin:end]))
                begin = end
        return _batch(head, [("conv_id", table.schema.field("conv_id").type), ("block", pa.int64()), ("open", pa.bool_())], pieces)

    def join(key: tuple, table: pa.Table) -> pa.Table:
        pieces = [_piece(r) for r in table.sort_by("block").to_pylist()]
        return _batch([(key[0].as_py(), key[1].as_py(), True)], [("conv_id", table.schema.field("conv_id").type), ("block", pa.int64()), ("open", pa.bool_())], [_joined(pieces)])

    schema = f"conv_id {kind}, block long, open boolean, {PIECE}"
    cells = stored(marked.groupBy("block").applyInArrow(parse, schema), "cells")
    ends = cells.filter("open")  # at most two in a block
    while blocks > 1:
        blocks = -(-blocks // FAN)
        narrowed = ends.withColumn("into", F.floor(F.col("block") / FAN))
        ends = stored(narrowed.groupBy("conv_id", "into").applyInArrow(join, schema), "cells")
    every = cells.filter(~F.col("open")).unionByName(ends)
    finals = [F.when(F.col("costs")[i].isNotNull(), F.struct(F.col("costs")[i].alias("cost"), F.col("audits")[i].alias("audit"))) for i in FINAL]
    best = F.least(*finals)
    return every.select(
        "conv_id",
        F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        *[F.col("faults")[i].alias(n) for i, n in enumerate(("blank", "duplicate", "truncated"))],
        "illegal",
        best["cost"].alias("cost"),
        best["audit"].alias("audit"),
    )


def _state(at: int, initial: str) -> int:
    return 1 if at == 0 and initial == "s" else 3 if at == 2 else 2


def repaired_turns(prepared_rows: DataFrame, found: DataFrame) -> DataFrame:
    """Turns after repair: conv_id, place (from 0), edit (K, R, I), role, text.

    A conversation's turns come from one partition, in order: ``found`` has its audit, which goes before its rows. Rows are
    streamed, so a long conversation takes time, not memory.
    """
    kind = prepared_rows.schema["conv_id"].dataType.simpleString()
    audits = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("digest"), "audit")
    both = prepared_rows.withColumn("audit", F.lit(None).cast("string")).unionByName(audits)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *ORDER)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, audit, at, state, place = None, "", 0, 0, 0
        for batch in batches:
            ids = batch.column(0)
            out: list[tuple] = []

            def insert() -> None:
                nonlocal at, state, place
                while at < len(audit) and audit[at] == "I":
                    state = _state(state, "")
                    out.append((conversation, place, "I", "user" if state == 2 else "assistant", ""))
                    at, place = at + 1, place + 1

            for i, text in zip(range(batch.num_rows), batch.column("text")):
                new = batch.column("audit")[i]
                if new.is_valid:
                    insert()  # behind the last row of the conversation before
                    conversation, audit, at, state, place = ids[i].as_py(), new.as_py(), 0, 0, 0
                    continue
                insert()
                letter, at = audit[at], at + 1
                if letter != "D":
                    role = batch.column("role")[i].as_py()
                    state = _state(state, role[:1] if letter == "K" else "")
                    if letter == "R":
                        role = "user" if state == 2 else "assistant"
                    out.append((conversation, place, letter, role, text.as_py()))
                    place += 1
            kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)], names="conv_id place edit role text".split())
        last = []
        while at < len(audit):  # insertions behind the last row of all
            state = _state(state, "")
            last.append((conversation, place, "I", "user" if state == 2 else "assistant", ""))
            at, place = at + 1, place + 1
        if last:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*last), kinds)], names="conv_id place edit role text".split())

    return ordered.select("conv_id", "turn", "role", "text", "audit").mapInArrow(edit, f"conv_id {kind}, place long, edit string, role string, text string")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, turns) of a table conv_id, turn, role, text; other columns are ignored.

    ``found`` has a row per conversation: gaps in its turn numbers (NULL ones ignored), how many turns are blank, a duplicate of an earlier
    one, or truncated (the first of these counts), adjacent roles that may not follow each other, the cost of the cheapest repair and its
    audit, the ASCII-least of equal cost. ``turns`` has the repaired turns (see ``repaired_turns``). NULL roles and texts count as one space,
    rows without conv_id are one conversation, turns that repeat are in order of role, then of the text's digest. An empty table gives empty tables.
    """
    rows = prepared(conversations)
    found = stored(parsed(rows), "repairs")
    return found, repaired_turns(rows, found)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows as a faulty export would leave them, by a checksum of ``conv_id:turn``: dropped, emptied, without ends of sentences, twice, or all the user's."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way: Column = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(way == 1, "").when(way == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    role = F.when(way == 4, "user").otherwise(filled("role"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), way.alias("way")).filter("way <> 0")
    return rows.withColumn("copy", F.explode(F.when(F.col("way") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("way", "copy")
