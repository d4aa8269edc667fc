from __future__ import annotations

import functools
import hashlib
import random
import zlib

import pytest

from trendloom.llm import alignment, conversations
from trendloom.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
AFTER = {"s": {"0": "s"}, "u": {"0": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        shown = text.rstrip(SPACE)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(initials, faults):
    """(cost, edits) over all edits, by their full strings."""

    @functools.cache
    def best(i, state, inserted):
        ways = [(0, "")] if i == len(initials) and state in "0a" else []
        follow = [c for c in "ua" if state in AFTER[c]]
        if i < len(initials):
            ways.append((lambda r: (r[0] + 2, "D" + r[1]))(best(i + 1, state, 0)))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                ways += [(lambda r: (r[0] + 1 + more, "R" + r[1]))(best(i + 1, c, 0)) for c in follow]
                if state in AFTER.get(initials[i], {}):
                    ways.append((lambda r: (r[0] + more, "K" + r[1]))(best(i + 1, initials[i], 0)))
        if inserted < 3:
            ways += [(lambda r: (r[0] + 5, "I" + r[1]))(best(i, c, inserted + 1)) for c in follow]
        return min(ways, default=(10**9, "~"))

    return best(0, "0", 0)


def plain_report(rows):
    """Per conversation what the drill returns, rows of one turn by role and digest."""
    out = []
    for conv in {r[0] for r in rows}:
        own = [r for r in plain_damage(rows) if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        faults, initials = plain_faults(own), [r[2][:1] for r in own]
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit = plain_repair(tuple(initials), tuple(faults))
        lines, at, state = [], 0, "0"
        for edit in audit:
            other = "a" if state == "u" else "u"
            role = {"u": "user", "a": "assistant"}[other]
            if edit == "K":
                state = initials[at]
                lines.append(f"{own[at][2]}:{own[at][3]}")
            elif edit != "D":
                state = other
                lines.append(f"{role}:{own[at][3] if edit == 'R' else ''}")
            at += edit != "I"
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


def check(spark, rows, extra=""):
    frame = spark.createDataFrame(rows, TURNS)
    for name in extra.split():
        frame = frame.selectExpr("*", f"7 AS {name}")
    got = conversations.drill(frame).collect()
    got = sorted(map(tuple, got), key=lambda r: (r[0] is None, r[0] or 0))
    assert got == plain_report(rows)
    return got


ROLES = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "sys", "Ünknown"]
TEXTS = ["Hello there.", "Yes!", "and so on", "What? \n", " \t", "", None, "é", "One. Two", "\x0b.", "wait. "]


def some_turns(r, n):
    rows = []
    for conv in [*range(n), None]:
        size, odd = r.choice([1, 2, 4, 5, 8, 12]), r.random() < 0.4
        for turn in range(size):
            role = r.choice(ROLES) if odd else ("assistant" if turn % 2 else "user")
            text = r.choice(TEXTS) if odd else f"Line {r.randrange(99)}" + r.choice([".", "!", "."])
            rows.append((conv, r.choice([turn, turn, turn + 3, None, -turn]) if odd else turn, role, text))
    return rows + rows[::9]


def test_against_all_edits(spark):
    check(spark, some_turns(random.Random(13), 150), "ROLE Segment text_ place cost")


def test_conversations_in_many_segments(spark, monkeypatch):
    monkeypatch.setattr(conversations, "SEGMENT", 3)
    monkeypatch.setattr(conversations, "BATCH_ROWS", 5)
    rows = some_turns(random.Random(3), 20) + [(77, t, "user" if t % 3 else "assistant", f"Text {t % 40}.") for t in range(300)]
    segments = conversations.Repair(conversations.damaged(spark.createDataFrame(rows, TURNS))).segments
    assert segments.where("conv_id = 77").count() > 50
    check(spark, rows)


def test_one_conversation_with_most_rows_and_a_long_text(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"Turn {t}.") for t in range(700)]
    rows += [(2, 0, "user", "word " * 300_000 + "."), (2, 1, "assistant", "same."), (3, 5, "user", "same.")] + [(4, 2, "user", "x.")] * 500
    check(spark, rows)


def test_nothing_left_and_nothing_given(spark):
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    assert check(spark, [(9, dropped, "user", "Gone.")]) == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert check(spark, []) == []


def test_ways_through_segments_are_the_best_ways():
    r = random.Random(1)
    names = {"": 0, "truncated": 1, "blank": 2}
    for _ in range(1500):
        n = r.choice([0, 1, 2, 3, 5, 8, 14])
        initials, faults = [r.choice("ssuuaax") for _ in range(n)], [r.choice(["", "", "", "truncated", "blank"]) for _ in range(n)]
        codes = [alignment.code(i, names[f]) for i, f in zip(initials, faults, strict=True)]
        cuts = sorted(r.sample(range(n + 1), min(n + 1, r.choice([0, 1, 3]))))
        parts = [p for p in (codes[a:b] for a, b in zip([0, *cuts], [*cuts, n], strict=True)) if p]
        steps = [alignment.segment_step(alignment.summary(p)) for p in parts]
        states = alignment.crossings([*steps, alignment.CLOSE], 0, 0, alignment.forward, alignment.backward)
        cost, audit, at = 0, "", 0
        for part, end in zip(parts, states, strict=False):
            found = alignment.edits(part, at, end)
            cost, audit, at = cost + sum(f[0] for f in found), audit + "".join(f[1] for f in found), end
        closing = alignment.CLOSING[at]
        assert (cost + 5 * closing, audit + "I" * closing) == plain_repair(tuple(initials), tuple(faults))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_the_plain_repair(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, QUERIES["op13_conversation_repair"](spark, folder).collect()))
    assert got == plain_report(rows)
