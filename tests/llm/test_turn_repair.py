"""Conversation repair against plain Python."""

import hashlib
import random
import re
import zlib

import pytest
from cases import rows_of

from aisflow.llm import turn_repair
from aisflow.llm.turn_repair import Deduction, Row, lightest

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def plain_repair(rows):
    """(cost, audit, lines) of the lightest repair by dynamic programming; rows are (role, text, gone, truncated)."""
    held = {"": (0, "", ())}

    def offer(into, state, weight):
        if state not in into or weight[:2] < into[state][:2]:
            into[state] = weight

    def with_inserts(states):
        found = dict(states)
        for _ in range(4):
            for q, (cost, audit, lines) in list(found.items()):
                offer(found, NEXT[q], (cost + 2, audit + "I", (*lines, ("user:" if NEXT[q] == "u" else "assistant:"))))
        return found

    for role, text, gone, truncated in rows:
        after = {}
        for q, (cost, audit, lines) in with_inserts(held).items():
            offer(after, q, (cost + 3, audit + "D", lines))
            if gone:
                continue
            new = "user" if NEXT[q] == "u" else "assistant"
            offer(after, NEXT[q], (cost + 2 + truncated, audit + "R", (*lines, f"{new}:{text}")))
            if role[:1] == NEXT[q] or (role[:1] == "s" and q == ""):
                offer(after, role[:1], (cost + truncated, audit + "K", (*lines, f"{role}:{text}")))
        held = after
    held = with_inserts(held)
    return min((held[q] for q in ("", "a") if q in held), key=lambda w: w[:2])


def brute(rows):
    found = {}
    for conv_id, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        found.setdefault(conv_id, [])
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            role = "user" if fate == 4 else role
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            found[conv_id] += [(turn is not None, turn or 0, digest, role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv_id, own in found.items():
        own.sort()
        seen, counts, marked = set(), [0, 0, 0], []
        for _, _, _, role, text in own:
            said = text.strip(" \t\n\v\f\r")
            fault = 0 if not said else 1 if (role, text) in seen else 2 if said[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            marked.append((role, text, fault in (0, 1), fault == 2))
        turns = {t for known, t, *_ in own if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = plain_repair(marked)
        out.append((conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations():
    draw = random.Random(11)
    texts = ["Yes.", "No!  \n", "well", "", None, " \t", "Yes.", "what? no", "é 漢字 😀."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "User", "ua"]
    rows = []
    for c in range(60):
        for turn in range(draw.randrange(1, 9)):
            rows.append((c, turn * draw.choice([1, 1, 1, 3]), draw.choice(roles), draw.choice(texts)))
    for c, n in ((100, 150), (101, 300), (102, 90)):
        rows += [(c, k, ["user", "assistant"][(k + k // 17) % 2], f"turn {k % 70}.") for k in range(n)]
    rows += [(None, k, "user", f"t{k}.") for k in range(5)] + [(7, None, "system", "first."), (7, None, None, None), (8, 3, "user", "same."), (8, 3, "user", "same.")]
    rows += [(200, 5, "user", "equal.")] * 40 + [(201, k, "user", "equal.") for k in range(40)]
    rows += [(c, t, "user", "dropped.") for c in range(300, 400) for t in (0,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    return rows


@pytest.fixture(scope="module")
def expected():
    return brute(conversations())


@pytest.mark.parametrize("slice_rows", [10_000, 100, 7, 1])
def test_against_plain_version(spark, expected, slice_rows):
    found = turn_repair.repair_conversations(spark.createDataFrame(conversations(), SCHEMA), slice_rows)
    assert rows_of(found) == expected


def test_chunks_and_pieces(spark, expected, monkeypatch):
    monkeypatch.setattr(turn_repair, "CHUNK", 3)
    monkeypatch.setattr(turn_repair, "BATCH_BYTES", 40)
    for conv in {r[0] for r in conversations()}:
        rows = [r for r in conversations() if r[0] == conv]
        seen = turn_repair.Seen()
        for *_, turn, digest, role, text in sorted(_after_damage(rows)):
            seen.add(turn, role, text, digest)
        result = seen.result()
        (plain,) = [e for e in expected if e[0] == conv]
        assert (result["cost"], result["audit"], result["repaired_sha256"]) == plain[6:]


def _after_damage(rows):
    for conv_id, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if fate:
            role, text = "user" if fate == 4 else " " if role is None else role, " " if text is None else text
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            for _ in range(2 if fate == 3 else 1):
                yield (turn is not None, turn or 0, digest, turn, digest, role, text)


def test_other_columns_and_empty_tables(spark, expected):
    from pyspark.sql import functions as F

    names = "copies digest slice kind cost audit tag earlier state _place _fate"
    frame = spark.createDataFrame(conversations(), SCHEMA).withColumns({n: F.lit("clash") for n in names.split()})
    assert rows_of(turn_repair.repair_conversations(frame, 50)) == expected
    assert turn_repair.repair_conversations(frame.limit(0)).count() == 0


def test_very_long_text(spark):
    rows = [(1, 1, "user", "x" * 3_000_000 + "."), (1, 2, "assistant", "y. " * 500_000)]
    assert rows_of(turn_repair.repair_conversations(spark.createDataFrame(rows, SCHEMA), 1)) == brute(rows)


def test_agenda_with_several_premises():
    """A deduction is drawn when the last of its premises is final; the lightest of two ways wins, ties by letters."""
    rules = [
        Deduction((("a",), ("b",)), ("c",), 1, "X"),
        Deduction((("a",),), ("d",), 4, "Z"),
        Deduction((("c",),), ("d",), 1, "Y"),
        Deduction((("d",), ("missing",)), ("e",), 0, ""),
    ]
    final = lightest({("a",): (0, "A"), ("b",): (2, "B")}, rules)
    assert final == {("a",): (0, "A"), ("b",): (2, "B"), ("c",): (3, "ABX"), ("d",): (4, "ABXY")}
    assert ("d",) not in lightest({("a",): (0, "A"), ("b",): (2, "B")}, rules, ("c",))


def test_a_goal_is_found_without_the_rest():
    rows = [Row(r, "Yes.", False, False) for r in ("system", "user", "assistant")]
    assert turn_repair.repair(rows) == (0, "KKK")
    assert turn_repair.repair(rows[:1]) == (3, "D")
    assert turn_repair.repair([]) == (0, "")
