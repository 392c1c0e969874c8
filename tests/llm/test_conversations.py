"""Conversation repair against a plain search over all edits, on cut conversations and on edge cases."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from delayloom.llm import conversations
from delayloom.llm.queries import importable

SCHEMA = "conv_id long, turn long, role string, text string, cost long, audit string, conv string, kind int"
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.fixture(scope="module", autouse=True)
def _ready(spark):
    importable(spark)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", "y", 5) for r in rows], SCHEMA)


def plain(turns):
    """One conversation's result from its (conv_id, turn, role, text) rows, by keeping whole audits per state."""
    rows = []
    for conv_id, turn, role, text in turns:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turn_numbers = [t for t, _, _ in rows if t is not None]
    out = {"gaps": max(turn_numbers) - min(turn_numbers) + 1 - len(set(turn_numbers)) if turn_numbers else 0}
    out |= {f: faults.count(f) for f in ("blank", "duplicate", "truncated")}
    out["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    def written(state):  # initials the grammar takes next, with the state they lead to
        return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state]

    def inserts(best):
        for _ in range(3):
            for state, (cost, audit, text) in list(best.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    if initial in written(state):
                        way = (cost + 5, audit + "I", text + (role + ":",))
                        best[initial] = min(way, best.get(initial, way))
        return best

    best = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        after = {}

        def offer(state, way):
            after[state] = min(way, after.get(state, way))

        for state, (cost, audit, lines) in inserts(best).items():
            offer(state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if role[:1] in written(state):
                offer(role[:1], (cost + more, audit + "K", lines + (f"{role}:{text}",)))
            for initial, name in (("u", "user"), ("a", "assistant")):
                if initial in written(state):
                    offer(initial, (cost + 1 + more, audit + "R", lines + (f"{name}:{text}",)))
        best = after
    cost, audit, lines = min(way for state, way in inserts(best).items() if state in ("", "a"))
    return out | {"cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def wanted(rows):
    by_conv = {}
    for row in rows:
        by_conv.setdefault(row[0], []).append(row)
    return {conv: plain(own) for conv, own in by_conv.items()}


def result(spark, rows):
    found = conversations.repaired_after_damage(frame(spark, rows)).collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: {f: r[f] for f in FIELDS} for r in found}


def talk(count, longest, seed):
    draw = random.Random(seed)
    texts = ["Yes.", "No?", "cut off", " ", "", "Good!\n", "One. Two", "é."]
    rows = []
    for conv in range(count):
        for turn in range(draw.randrange(1, longest)):
            role = draw.choice(["user", "assistant"] * 4 + ["system", "tool", "", None])
            text = draw.choice([f"w{draw.randrange(10**6)}."] * 6 + texts + [None])
            rows.append((conv, draw.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows


def test_matches_a_search_over_all_edits(spark):
    rows = talk(300, 14, 1)
    assert result(spark, rows) == wanted(rows)


def test_cut_conversations_match(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK_ROWS", 5)
    rows = talk(6, 12, 2) + [(99, t, "user" if t % 2 else "assistant", f"t{t % 40}.") for t in range(400)]
    assert result(spark, rows) == wanted(rows)


def test_system_first_and_least_audit():
    code = lambda initial, cut=0: 2 * "sua?".index(initial) + cut
    items = [conversations.Item(conversations.TABLES[code(c)]) for c in "suuaa"]
    end = conversations.Item(conversations.END_TABLE)
    states = conversations.crossings([*items, end], 0, 0)
    audit = "".join(conversations.MOVES[code(c)][p, q][1] for c, p, q in zip("suuaa", states, states[1:]))
    assert audit == "KKRRK"


def test_edges(spark):
    rows = [(None, None, None, None), (None, 2, "user", "Hi."), (None, 2, "user", "Hi."), (1, None, "user", "z" * 50000),
            (2, -5, "assistant", "a."), (2, 2**40, "user", "b.")] + [(3, 1, "user", "same.")] * 500 + [(3, 2, "assistant", "x.")]
    assert result(spark, rows) == wanted(rows)
    assert result(spark, []) == {}


def test_every_conversation_comes_back(spark):
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    found = result(spark, [(gone, 0, "user", "Hi.")])
    assert found == {gone: {f: 0 for f in FIELDS[:6]} | {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}}


def test_damage(spark):
    rows = [(i, i, "assistant", "One. Two!") for i in range(200)]
    found = {r["conv_id"]: r for r in conversations.damaged(frame(spark, rows)).withColumn("x", F.lit(1)).collect()}
    for i in range(200):
        fault, row = zlib.crc32(f"{i}:{i}".encode()) % 20, found[i]
        assert row["copies"] == {0: 0, 3: 2}.get(fault, 1)
        assert row["role"] == ("user" if fault == 4 else "assistant")
        assert row["text"] == {1: "", 2: "One Two"}.get(fault, "One. Two!")
