"""Conversation structure repair by Hirschberg's divide-and-conquer.

A conversation's roles shall read ``(s?(ua)+)?`` by their initials: an optional system turn, then pairs of user and
assistant turns.  Rows are kept (K), re-roled to user or assistant (R) or deleted (D), and empty turns may be inserted
(I).  Four states follow what has been written so far: nothing, the system turn, a user turn, an assistant turn.

*Method.*  To cross a stretch of rows from one state to another, forward costs of its first half and backward costs of
its second half (four numbers each) meet in the middle; the cheapest crossing is taken and both halves are solved alike,
so memory stays linear in the rows and no table of decisions is kept.  Of equal costs the audit that is least in ASCII
wins: forward vectors also rank the four states by their least audit.  An audit determines the state it ends in, and the
blocks it is made of (insertions and one letter for each row) are prefix-free, so a rank of the states before and the
order of blocks decide between any two audits.

*Skew.*  Rows are sorted by range over (conversation, turn), so a conversation of any length is spread over partitions.
A conversation that lies inside a partition is finished there.  One that is cut becomes chunks of ``CHUNK_BYTES``; each
has a 4 x 4 table of costs and ranks, the same recursion runs over the chunks' tables, and the chunks are then solved
independently between their states.  Only the digest of a cut conversation, one value, is read by one task, as a stream.
Copies of a row are counted before anything moves and are runs of deletions.

*Defined results.*  Rows are taken by turn, nulls first, then by role and by the text's SHA-256.  Nulls in role and text
are one space.  Conversations are grouped null-safely; conversation ids come back as they were.  Very long texts are
whole.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayloom.llm._spark import arrow_batches, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: The state an inserted or re-roled turn leads to: a user turn, but an assistant's after a user's.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
COMPLETE = (NONE, ASSISTANT)
LEGAL = {"su", "ua", "au"}
FAR = 1 << 60
#: A chunk of a cut conversation ends beyond so many bytes of text or so many rows; rows of an Arrow batch.
CHUNK_BYTES, CHUNK_ROWS, BATCH_ROWS = 4_000_000, 50_000, 2000
#: What a row without a letter to keep by is: it must go.
MUST_GO = 8
WORDLESS = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

Vector = tuple[tuple[int, int], ...]  # by state: cost, and rank of the audit


class Table(tuple):
    """By state before and after: cost, and rank of the audit.  Told apart by identity, so that steps are remembered cheaply."""

    __hash__ = object.__hash__

    def __eq__(self, other: object) -> bool:
        return self is other


def _moves(code: int) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest way of a row between two states, insertions before it included: cost and letters."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before, inserted in product(range(4), range(3)):
        state = before
        for _ in range(inserted):
            state = NEXT[state]
        ways = [(state, DELETE, "D")]
        if code != MUST_GO:
            initial, cut = "sua?"[code // 2], TRUNCATED * (code % 2)
            ways.append((NEXT[state], REROLE + cut, "R"))
            if (initial == "s" and state == NONE) or (initial == "u" and state != USER) or (initial == "a" and state == USER):
                ways.append(({"s": SYSTEM, "u": USER, "a": ASSISTANT}[initial], KEEP + cut, "K"))
        for after, cost, letter in ways:
            way = (cost + INSERT * inserted, "I" * inserted + letter)
            best[before, after] = min(way, best.get((before, after), way))
    return best


MOVES = [_moves(code) for code in range(MUST_GO + 1)]
#: Insertions that complete a conversation; the state after them is called NONE.
ENDING = {(state, NONE): min((INSERT * k, "I" * k) for k in range(3) if (state, *[NEXT[state], NEXT[NEXT[state]]])[k] in COMPLETE)
          for state in range(4)}


def _table(moves: dict[tuple[int, int], tuple[int, str]]) -> Table:
    order = {letters: rank for rank, letters in enumerate(sorted({letters for _, letters in moves.values()}))}
    entry = lambda way: (way[0], order[way[1]]) if way else (FAR, 0)
    return Table(tuple(entry(moves.get((p, q))) for q in range(4)) for p in range(4))


TABLES = [_table(moves) for moves in MOVES]
END_TABLE = _table(ENDING)


def _start(state: int) -> Vector:
    return tuple((0 if s == state else FAR, 0) for s in range(4))


@lru_cache(maxsize=1 << 14)
def _forward(vector: Vector, table: Table) -> Vector:
    """Costs and ranks of the states after one more table."""
    found = []
    for after in range(4):
        ways = [(vector[p][0] + table[p][after][0], vector[p][1], table[p][after][1]) for p in range(4)]
        found.append(min(ways))
    order = sorted({way[1:] for way in found if way[0] < FAR})
    return tuple((way[0], order.index(way[1:])) if way[0] < FAR else (FAR, 0) for way in found)


@lru_cache(maxsize=1 << 14)
def _backward(costs: tuple[int, ...], table: Table) -> tuple[int, ...]:
    return tuple(min(FAR, *(table[p][q][0] + costs[q] for q in range(4))) for p in range(4))


@dataclass
class Item:
    """A row with its copies, or a chunk: a table that is applied ``times`` times."""

    table: Table
    times: int = 1

    def forward(self, vector: Vector) -> Vector:
        """Repeated deletions soon change costs by a constant only; the rest is added at once.

        Costs are counted from the least, so the few vectors that occur are computed once.
        """
        least = min(c for c, _ in vector)
        if self.times == 1:
            after = _forward(tuple((c - least if c < FAR else c, r) for c, r in vector), self.table)
            return tuple((c + least if c < FAR else c, r) for c, r in after)
        for done in range(self.times):
            after = _forward(vector, self.table)
            rise = {b[0] - a[0] for a, b in zip(vector, after) if b[0] < FAR}
            if len(rise) == 1 and [(a[0] < FAR, a[1]) for a in vector] == [(b[0] < FAR, b[1]) for b in after]:
                more = rise.pop() * (self.times - done)
                return tuple((c + more, r) if c < FAR else (c, r) for c, r in vector)
            vector = after
        return vector

    def backward(self, costs: tuple[int, ...]) -> tuple[int, ...]:
        least = min(costs)
        if self.times == 1:
            before = _backward(tuple(c - least if c < FAR else c for c in costs), self.table)
            return tuple(c + least if c < FAR else c for c in before)
        for done in range(self.times):
            before = _backward(costs, self.table)
            rise = {b - a for a, b in zip(costs, before) if b < FAR}
            if len(rise) == 1 and [a < FAR for a in costs] == [b < FAR for b in before]:
                more = rise.pop() * (self.times - done)
                return tuple(c + more if c < FAR else c for c in costs)
            costs = before
        return costs


def crossings(items: Sequence[Item], first: int, last: int) -> list[int]:
    """States before, between and after the items, on the cheapest way with the least audit."""
    if len(items) < 2:
        return [first, last]
    middle = len(items) // 2
    vector = _start(first)
    for item in items[:middle]:
        vector = item.forward(vector)
    costs = tuple(0 if s == last else FAR for s in range(4))
    for item in reversed(items[middle:]):
        costs = item.backward(costs)
    _, _, met = min((vector[s][0] + costs[s], vector[s][1], s) for s in range(4))
    return crossings(items[:middle], first, met) + crossings(items[middle:], met, last)[1:]


def total(items: Sequence[Item], first: int = NONE) -> Vector:
    vector = _start(first)
    for item in items:
        vector = item.forward(vector)
    return vector


@dataclass
class Chunk:
    """Consecutive rows of a conversation, copies as runs, and what is counted on the way."""

    codes: list[int] = field(default_factory=list)
    times: list[int] = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    bytes: int = 0
    #: blank, duplicate, truncated, illegal, distinct turns
    counts: list[int] = field(default_factory=lambda: [0] * 5)
    first_initial: str | None = None
    last_initial: str | None = None
    first_turn: int | None = None
    last_turn: int | None = None

    def add(self, turn: int | None, role: str, text: str | None, blank: bool, cut: bool, copies: int) -> None:
        """``copies`` rows that must go, or (with a text) the first row of its role and text."""
        initial = role[:1]
        if self.last_initial is None:
            self.first_initial = initial
        elif self.last_initial + initial not in LEGAL:
            self.counts[3] += 1
        self.counts[3] += copies - 1
        self.last_initial = initial
        if turn is not None and turn != self.last_turn:
            self.counts[4] += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if blank or text is None:
            self.counts[0 if blank else 1] += copies
            self.codes.append(MUST_GO)
        else:
            self.counts[2] += cut
            self.codes.append(2 * ("s", "u", "a", initial).index(initial) + cut)
        self.times.append(copies)
        self.roles.append(role)
        self.texts.append(text or "")
        self.bytes += len(role) + len(text or "")

    def items(self) -> list[Item]:
        return [Item(TABLES[code], times) for code, times in zip(self.codes, self.times)]

    def table(self) -> Table:
        return Table(total(self.items(), state) for state in range(4))

    def edits(self, first: int, last: int) -> tuple[str, list[tuple[str, str]]]:
        """Letters of the audit between two states, and the repaired (role, text) rows."""
        states = crossings(self.items(), first, last)
        audit, rows = [], []
        for code, times, role, text, before, after in zip(self.codes, self.times, self.roles, self.texts, states, states[1:]):
            letters = "D" * (times - 1) + MOVES[code][before, after][1]
            audit.append(letters)
            state = before
            for letter in letters[times - 1 :]:
                if letter == "I" or letter == "R":
                    state = NEXT[state]
                    rows.append((ROLES[state], "" if letter == "I" else text))
                elif letter == "K":
                    rows.append((role, text))
        return "".join(audit), rows


def _written(rows: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in rows)


def _ended(state: int) -> tuple[str, list[tuple[str, str]]]:
    letters, rows = ENDING[state, NONE][1], []
    for _ in letters:
        state = NEXT[state]
        rows.append((ROLES[state], ""))
    return letters, rows


def _counted(chunks: Sequence[dict]) -> dict:
    """Counts of a conversation from those of its chunks in order."""
    blank, duplicate, truncated, illegal, distinct = (sum(c["counts"][k] for c in chunks) for k in range(5))
    ends = [c for c in chunks if c["first_initial"] is not None]
    illegal += sum(a["last_initial"] + b["first_initial"] not in LEGAL for a, b in zip(ends, ends[1:]))
    turns = [c for c in chunks if c["first_turn"] is not None]
    distinct -= sum(a["last_turn"] == b["first_turn"] for a, b in zip(turns, turns[1:]))
    gaps = turns[-1]["last_turn"] - turns[0]["first_turn"] + 1 - distinct if turns else 0
    return {"gaps": gaps, "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal}


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = [("conv", pa.string()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())]
ENDS = [("first_initial", pa.string()), ("last_initial", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64())]
SUMMARY = [("conv", pa.string()), ("part", pa.int32()), ("chunk", pa.int64()), ("counts", pa.list_(pa.int64())), *ENDS,
           ("table", pa.list_(pa.int64()))]
ROWS = [("codes", pa.list_(pa.int32())), ("times", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string()))]
PIECE = [("conv", pa.string()), ("part", pa.int32()), ("chunk", pa.int64()), ("audit", pa.string()), ("text", pa.string())]
_DDL = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean",
        pa.list_(pa.int64()): "array<long>", pa.list_(pa.int32()): "array<int>", pa.list_(pa.string()): "array<string>"}


def _ddl(columns: list[tuple[str, pa.DataType]]) -> str:
    return ", ".join(f"{name} {_DDL[kind]}" for name, kind in columns)


def _batches(rows: Iterator[dict], columns: list[tuple[str, pa.DataType]], most_bytes: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size; what a row lacks is null."""
    held, size, schema = [], 0, pa.schema(columns)
    for row in rows:
        held.append(row)
        size += 200 + sum(map(len, row.get("texts") or ())) + len(row.get("text") or "") + len(row.get("audit") or "")
        if size > most_bytes:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, Chunk]]:
    """(conversation, number, whether its rows end here, chunk) of a sorted partition."""
    conv, chunk, number, first_of = None, None, 0, None
    names = ("conv", "kind", "turn", "role", "key", "text", "blank", "cut", "n")
    for batch in batches:
        for own, kind, turn, role, key, text, blank, cut, n in zip(*(batch.column(name).to_pylist() for name in names)):
            if chunk is not None and own != conv:
                yield conv, number, True, chunk
                chunk = None
            if chunk is None:
                conv, chunk, number, first_of = own, Chunk(), 0, None
            if chunk.bytes > CHUNK_BYTES or len(chunk.codes) > CHUNK_ROWS:
                yield conv, number, False, chunk
                chunk, number = Chunk(), number + 1
            if kind == 0:
                first_of = (turn, role, key)
                chunk.add(turn, role, text, blank, cut, 1)
            elif kind == 1:
                copies = n - (first_of == (turn, role, key))
                if copies:
                    chunk.add(turn, role, None, blank, False, copies)
    if chunk is not None:
        yield conv, number, True, chunk


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations that lie inside the partition, and chunks of those that may go on beyond it."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()

    def chunk_row(conv: str, number: int, chunk: Chunk) -> dict:
        table = [value for row in chunk.table() for pair in row for value in pair]
        return {"conv": conv, "part": part, "chunk": number, "table": table} | {
            name: getattr(chunk, name) for name in ("counts", "first_initial", "last_initial", "first_turn", "last_turn",
                                                    "codes", "times", "roles", "texts")}

    def rows() -> Iterator[dict]:
        waiting = None  # the last conversation seen: it may be the partition's last
        edge, many = True, False
        for conv, number, ended, chunk in _of_partition(batches):
            if waiting is not None:
                yield whole_row(*waiting)
                waiting = None
            many = number > 0 or not ended
            if edge or many:
                yield chunk_row(conv, number, chunk)
                edge = edge and not ended
            else:
                waiting = (conv, chunk)
        if waiting is not None:
            yield chunk_row(waiting[0], 0, waiting[1])

    def whole_row(conv: str, chunk: Chunk) -> dict:
        items = [*chunk.items(), Item(END_TABLE)]
        last = crossings(items, NONE, NONE)[-2]
        audit, repaired = chunk.edits(NONE, last)
        letters, added = _ended(last)
        own = {name: getattr(chunk, name) for name in ("counts", "first_initial", "last_initial", "first_turn", "last_turn")}
        digest = hashlib.sha256(_written(repaired + added).encode("utf-8", "surrogatepass")).hexdigest()
        return {"conv": conv, "cost": total(items)[NONE][0], "audit": audit + letters, "repaired_sha256": digest} | _counted([own])

    yield from _batches(rows(), RESULT + SUMMARY[1:] + ROWS)


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["conv"] != held[0]["conv"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of cut conversations: the states each chunk starts and ends in; its counts and cost go with the last chunk."""

    def rows() -> Iterator[dict]:
        for chunks in _by_conversation(batches):
            tables = [Table(tuple((c["table"][8 * p + 2 * q], c["table"][8 * p + 2 * q + 1]) for q in range(4)) for p in range(4))
                      for c in chunks]
            items = [*map(Item, tables), Item(END_TABLE)]
            states = crossings(items, NONE, NONE)
            for k, (chunk, before, after) in enumerate(zip(chunks, states, states[1:])):
                row = {"conv": chunk["conv"], "part": chunk["part"], "chunk": chunk["chunk"], "before": before, "after": after}
                if k == len(chunks) - 1:
                    row |= {"cost": total(items)[NONE][0]} | _counted(chunks)
                yield row

    yield from _batches(rows(), SUMMARY[:3] + [("before", pa.int32()), ("after", pa.int32())] + RESULT[1:7])


def _repair_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row["codes"], row["times"], row["roles"], row["texts"])
                audit, repaired = chunk.edits(row["before"], row["after"])
                if row["cost"] is not None:
                    letters, added = _ended(row["after"])
                    audit, repaired = audit + letters, repaired + added
                yield {name: row[name] for name in ("conv", "part", "chunk", *COUNTS)} | {"audit": audit, "text": _written(repaired)}

    yield from _batches(rows(), PIECE + RESULT[1:7])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of cut conversations from their sorted pieces; the text passes by, it is not gathered."""

    def rows() -> Iterator[dict]:
        conv, digest, audit, begun, counts = None, None, [], False, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["conv"] != conv:
                    if conv is not None:
                        yield {"conv": conv, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()} | counts
                    conv, digest, audit, begun = row["conv"], hashlib.sha256(), [], False
                audit.append(row["audit"])
                if row["text"]:
                    digest.update((("\n" if begun else "") + row["text"]).encode("utf-8", "surrogatepass"))
                    begun = True
                if row["cost"] is not None:
                    counts = {c: row[c] for c in COUNTS}
        if conv is not None:
            yield {"conv": conv, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()} | counts

    yield from _batches(rows(), RESULT)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with a fault by crc32 of ``conv_id:turn``: conv_id, turn, role, text and copies (0: the row is dropped)."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"),
                        text_of("text").alias("text"), fault.alias("fault"))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"),
        F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).alias("copies"))


def _sorted_rows(turns: DataFrame) -> DataFrame:
    """Every conversation's rows, sorted by range: first rows of a role and text with it, copies as counts.

    kind -1: the conversation itself, 0: first row of its role and text, 1: rows of a turn, role and text.
    """
    named = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
        F.col("turn").isNotNull().alias("timed"), "turn", "role", "text", F.sha2("text", 256).alias("key"),
        (~F.col("text").rlike(WORDLESS)).alias("blank"), F.col("copies").cast("long").alias("copies"))
    rows = named.filter("copies > 0")
    # texts move once, as part of the first row; the flag is a function of the text and makes no more groups
    first = rows.groupBy("conv", "role", "key", "blank", "text").agg(F.min(F.struct("timed", "turn")).alias("at"))
    first = first.select("conv", "at.timed", "at.turn", "role", "key", F.lit(0).alias("kind"), "blank", "text",
                         (~F.col("blank") & ~F.col("text").rlike(ENDED)).alias("cut"), F.lit(1).cast("long").alias("n"))
    counted = rows.groupBy("conv", "timed", "turn", "role", "key", "blank").agg(F.sum("copies").alias("n"))
    nothing: dict[str, Column] = {
        "timed": F.lit(False), "turn": F.lit(None).cast("long"), "role": F.lit(""), "key": F.lit(""), "kind": F.lit(-1),
        "blank": F.lit(False), "n": F.lit(0).cast("long")}
    for_all = named.select("conv").distinct().withColumns(nothing)
    for other in (counted.withColumn("kind", F.lit(1)), for_all):
        first = first.unionByName(other.withColumns({"text": F.lit(None).cast("string"), "cut": F.lit(False)}))
    order = ["conv", "timed", "turn", "role", "key"]  # a first row and its count stay together
    return first.repartitionByRange(*order).sortWithinPartitions(*order, "kind")


def repair(turns: DataFrame) -> DataFrame:
    """Counts of faults, cost, audit and digest of the repaired rows for every conversation.

    ``turns`` has conv_id, turn, role, text and copies (0: the conversation is known by this row, but lacks it).
    """
    spark, kind = turns.sparkSession, dict(turns.dtypes)["conv_id"]
    with arrow_batches(spark, BATCH_ROWS):
        solved = stored(_sorted_rows(turns).mapInArrow(_solve, _ddl(RESULT + SUMMARY[1:] + ROWS)), "conversations")
        chunks = solved.filter("table is not null")
        names = ["conv", "part", "chunk"]
        decided = chunks.select(*(name for name, _ in SUMMARY)).repartition("conv").sortWithinPartitions(*names).mapInArrow(
            _decide, _ddl(SUMMARY[:3] + [("before", pa.int32()), ("after", pa.int32())] + RESULT[1:7]))
        open_rows = chunks.select(*names, *(name for name, _ in ROWS))
        pieces = open_rows.join(decided, names).mapInArrow(_repair_chunks, _ddl(PIECE + RESULT[1:7]))
        cut = stored(pieces.repartition("conv").sortWithinPartitions(*names).mapInArrow(_digest, _ddl(RESULT)), "cut-conversations")
    results = solved.filter("table is null").select(*(name for name, _ in RESULT)).unionByName(cut)
    conv_id = F.when(F.col("conv") != "", F.substring("conv", 2, 1 << 30)).cast(kind).alias("conv_id")
    return results.select(conv_id, *COUNTS, "audit", "repaired_sha256")


def repaired_after_damage(turns: DataFrame) -> DataFrame:
    """``repair`` of the rows that ``damaged`` leaves, for every conversation of ``turns``."""
    return repair(damaged(turns))
