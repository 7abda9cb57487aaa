from __future__ import annotations

import hashlib
import re
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.llm import conversation_repair as op
from tests.llm.conftest import rows

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
PATTERN = re.compile(r"(s?(ua)+)?")
SPACE = r"\x20\x09-\x0D"


def cheapest(codes):
    """Cost and audit by working through the rows, keeping the best way to each state."""
    ways = {op.START: (0, "")}

    def settle(found):
        for _ in range(4):
            for s, (c, a) in list(found.items()):
                to = op.NEXT[s]
                if to not in found or (c + 2, a + "I") < found[to]:
                    found[to] = (c + 2, a + "I")
        return found

    ways = settle(ways)
    for code in codes:
        found = {}
        for s, (c, a) in ways.items():
            kind, must, extra = code & 3, code & op.MUST_GO, 1 if code & op.CUT_OFF else 0
            ways_on = [(s, c + 3, a + "D")]
            if not must:
                if kind == op.WANTED[s]:
                    ways_on.append((op.NEXT[s], c + extra, a + "K"))
                else:
                    ways_on.append((op.NEXT[s], c + 2 + extra, a + "R"))
                if kind == op.IS_SYSTEM and s == op.START:
                    ways_on.append((op.SYSTEM, c + extra, a + "K"))
            for to, cost, audit in ways_on:
                if to not in found or (cost, audit) < found[to]:
                    found[to] = (cost, audit)
        ways = settle(found)
    return min(ways[s] for s in (op.START, op.DONE) if s in ways)


def by_trying_all(roles, flags, most_inserts=2):
    """Every edit string up to a few inserts, checked by the pattern itself."""
    best = None
    n = len(roles)
    for edits in product("DKR", repeat=n):
        if any(f & op.MUST_GO and e != "D" for e, f in zip(edits, flags)):
            continue
        for inserts in product(range(most_inserts + 1), repeat=n + 1):
            audit, slots, cost = "", [], 0
            for i in range(n + 1):
                audit += "I" * inserts[i]
                slots += ["?"] * inserts[i]
                cost += 2 * inserts[i]
                if i < n:
                    audit += edits[i]
                    cost += {"D": 3, "K": 0, "R": 2}[edits[i]] + (1 if edits[i] != "D" and flags[i] & op.CUT_OFF else 0)
                    slots += {"D": [], "K": [roles[i]], "R": ["?"]}[edits[i]]
            if best and (cost, audit) >= best:
                continue
            if len(slots) > 6:
                continue
            for fill in product("ua", repeat=slots.count("?")):
                letters = iter(fill)
                if PATTERN.fullmatch("".join(next(letters) if x == "?" else x for x in slots)):
                    best = (cost, audit)
                    break
    return best


CLASS = {"s": op.IS_SYSTEM, "u": op.IS_USER, "a": op.IS_ASSISTANT}


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from([0, 0, 0, op.MUST_GO, op.CUT_OFF])), max_size=3))
def test_search_against_all_edits(given_rows):
    roles, flags = [r for r, _ in given_rows], [f for _, f in given_rows]
    codes = bytes(CLASS.get(r, 0) | f for r, f in given_rows)
    assert op.search(codes) == by_trying_all(roles, flags) == cheapest(codes)


CODES = st.lists(st.sampled_from([c | f for c in range(4) for f in (0, 0, 0, 4, 8)]), max_size=120).map(bytes)


@settings(max_examples=150, deadline=None)
@given(CODES)
def test_search(codes):
    assert op.search(codes) == cheapest(codes)


@settings(max_examples=100, deadline=None)
@given(CODES)
def test_bounds(codes):
    """No bound is above what the rest costs, so pruning loses nothing."""
    bounds = op.lower_bounds(codes, op.ACCEPTED)
    for at in range(0, len(codes) + 1, 7):
        for state in op.STATES:
            found = op.search(codes[at:], state)
            assert found is None or bounds[at][state] <= found[0]


@settings(max_examples=60, deadline=None)
@given(CODES, st.integers(1, 9))
def test_segments_compose(codes, size):
    """Segments searched apart from any state to any state give what one search gives."""
    ways = {op.START: (0, "")}
    for at in range(0, len(codes), size):
        parts = [(e, s, *found) for e in op.STATES for s in op.STATES if (found := op.search(codes[at : at + size], e, frozenset((s,))))]
        ways = op.joined(ways, parts)
    expected = op.search(codes)
    assert op.accepted(ways) == expected if codes else op.accepted(ways) == (0, "")


def test_hard_conversations():
    """Misplaced system rows, where the bounds are loose, and long runs of one role."""
    for codes in (bytes([1]) * 256, bytes([1, 2, 3] * 85), bytes([1, 1, 2, 10, 3] * 51), bytes([2]) * 256, bytes([0, 1, 11, 5] * 64)):
        assert op.search(codes) == cheapest(codes)


def contract(table):
    """The whole report by plain Python."""
    found = {}
    for conv, *_ in table:
        found.setdefault(conv, [])
    for conv, turn, role, text in table:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        found[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, lines in found.items():
        order = [(t is not None, t or 0, r, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()) for t, r, x in lines]
        lines = [line for _, line in sorted(zip(order, lines), key=lambda p: p[0])]
        seen, codes, faults = set(), [], {"b": 0, "d": 0, "t": 0}
        for _, role, text in lines:
            code = CLASS.get(role[:1], 0)
            marks = re.findall(f"[^{SPACE}]", text)
            if not marks:
                faults["b"] += 1
                code |= op.MUST_GO
            elif (role, text) in seen:
                faults["d"] += 1
                code |= op.MUST_GO
            elif marks[-1] not in ".!?":
                faults["t"] += 1
                code |= op.CUT_OFF
            seen.add((role, text))
            codes.append(code)
        cost, audit = cheapest(codes)
        turns = [t for t, _, _ in lines if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(lines, lines[1:]))
        kept, left, want = [], iter(lines), "u"
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)[1:]
            if edit == "D":
                continue
            if edit in "IR":
                role = {"u": "user", "a": "assistant"}[want]
            kept.append(f"{role}:{text}")
            want = "a" if role[:1] == "u" else "u"
        out.append((conv, gaps, faults["b"], faults["d"], faults["t"], illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def odd_conversations():
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    found = [(c, t, roles[(t + c * c) % len(roles)] if c % 3 else ("user", "assistant")[t % 2], f"Sentence {t % 5} of it{'.' if (c + t) % 4 else ''} \n\x0b") for c in range(60) for t in range(c % 9)]
    found += [(100, t, ("user", "assistant")[t % 2], "ok." if t % 3 else f"{t}!") for t in range(700)]  # long, most of it repeated
    found += [(101, None, "user", "a?"), (101, None, "assistant", "b."), (101, 3, "user", None), (101, 9, None, "c.")]
    found += [(None, 1, "user", "x."), (None, 2, "assistant", "y."), (None, None, None, None)]
    found += [(102, 4, "user", "same."), (102, 4, "user", "same."), (102, 4, "assistant", "tie."), (102, 4, "assistant", "another.")] * 3
    found += [(103, 0, "system", "\u0085"), (103, 1, "user", "x "), (103, 2, "assistant", "y.  "), (104, 0, "user", "long " * 100_000 + ".")]
    return found + [(105, 50, "user", "y."), (106, 8, "Üser", "z.")]


@pytest.mark.parametrize("segment", [256, 5])
def test_report(spark, monkeypatch, segment):
    monkeypatch.setattr(op, "SEGMENT", segment)
    table = odd_conversations()
    frame = spark.createDataFrame(table, SCHEMA).repartition(3)
    clashing = frame.withColumns({n: F.lit("clash") for n in ("kind", "same", "code", "n", "at", "edge", "cost", "audit", "blank", "place", "first", "of")})
    found = rows(op.report(op.damaged(clashing), clashing), *NAMES)
    assert found == contract(table)


def test_nothing_left(spark):
    """A conversation of which every row is dropped, one without a legal row, and empty tables."""
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(dropped, 0, "user", "x.")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert rows(op.report(op.damaged(frame), frame), *NAMES) == [(dropped, 0, 0, 0, 0, 0, 0, "", empty)]
    blank = spark.createDataFrame([(1, 0, "user", " "), (1, 5, "tool", None)], SCHEMA)
    assert rows(op.report(blank), *NAMES) == [(1, 4, 2, 0, 0, 1, 6, "DD", empty)]
    assert op.report(frame.where("false")).count() == op.repair(frame.where("false")).count() == 0


def test_repair(spark):
    """The repaired rows themselves, in order, with the edits that made them."""
    table = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hello?"), (1, 2, "user", "Are you there?"), (1, 3, "assistant", "Yes."), (1, 4, "tool", "42."), (1, 4, "tool", "42.")]
    found = op.repair(spark.createDataFrame(table, SCHEMA)).orderBy("place").collect()
    assert "".join(r.edit for r in found) == op.search(bytes([1, 2, 2, 3, 0, 4]))[1]
    kept = [r for r in found if r.edit != "D"]
    assert PATTERN.fullmatch("".join(r.role[0] for r in kept))
    assert [r.place for r in found] == list(range(len(found)))


def test_a_long_conversation_is_spread(spark):
    """Rows of one conversation are searched by several tasks, with the same outcome."""
    table = [(7, t, ("user", "assistant", "tool")[t % 3], f"Turn {t}.") for t in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        (found,) = op.audits(spark.createDataFrame(table, SCHEMA)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    codes = [(op.IS_USER, op.IS_ASSISTANT, 0)[t % 3] for t in range(4000)]
    assert (found.cost, found.audit) == cheapest(codes)
