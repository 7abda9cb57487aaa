"""Repair of conversation structure by depth-first branch-and-bound.

The rows of a conversation are edited until their role initials read `(s?(ua)+)?`: Keep
costs 0, Rerole (to user or assistant) 2, Delete 3 and Insert (of a user or assistant row
without text) 2; blank and duplicate rows must go, and a truncated row that stays costs 1.
Of the cheapest edits those whose initials come first in ASCII order are taken; their
string is the audit.

A node of the search is a number of rows used up and a state of that pattern. The search
keeps a stack of prefixes, the best complete edit so far (the incumbent), and per node the
best prefix seen. A prefix is dropped if its cost and a lower bound for the rest exceed
the incumbent, if they equal it and its audit comes later, or if its node has seen a
better one. The bounds are the costs of a relaxed problem, in which a system row may
stand before any pair.

Long conversations are cut into segments: the best edits from each state to each state
compose, so segments are searched apart, in whatever task their rows are.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain, groupby
from typing import Iterable, Iterator, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Batches, arrow_schema, map_rows, stored

START, SYSTEM, USER, DONE = range(4)  # nothing yet; a system row; a pair's user row; whole pairs
STATES = (START, SYSTEM, USER, DONE)
ACCEPTED = frozenset((START, DONE))
NEXT = (USER, USER, DONE, USER)  # where the row that is missing leads
# what a row's code holds: its initial's class, whether it must go, whether it is truncated
OTHER, IS_SYSTEM, IS_USER, IS_ASSISTANT = range(4)
MUST_GO, CUT_OFF = 4, 8
WANTED = (IS_USER, IS_USER, IS_ASSISTANT, IS_USER)  # the class of that row, by state
REROLE, DELETE, INSERT, KEEP_CUT_OFF = 2, 3, 2, 1
SEGMENT = 256  # rows that are searched at once
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
ROLES = {USER: "user", DONE: "assistant"}

Found = tuple[int, str]  # cost, audit


def kept_state(state: int, kind: int, relaxed: bool = False) -> int | None:
    """The state after a row of some class stays, if it may."""
    if kind == WANTED[state]:
        return NEXT[state]
    if kind == IS_SYSTEM and (state == START or relaxed and state == DONE):
        return SYSTEM
    return None


def moves(state: int, code: int | None, relaxed: bool = False) -> list[tuple[str, int, int, int]]:
    """Edit, rows used, next state and cost of each way on, in ASCII order of the edits."""
    found = []
    insert = ("I", 0, NEXT[state], INSERT)
    if code is None:
        return [insert]
    found.append(("D", 1, state, DELETE))
    found.append(insert)
    if not code & MUST_GO:
        extra = KEEP_CUT_OFF if code & CUT_OFF else 0
        after = kept_state(state, code & 3, relaxed)
        if after is not None:
            found.append(("K", 1, after, extra))
        if code & 3 != WANTED[state]:
            found.append(("R", 1, NEXT[state], REROLE + extra))
    return found


MOVES = {(s, c): moves(s, c) for s in STATES for c in (None, *range(16))}
RELAXED = {(s, c): moves(s, c, True) for s in STATES for c in (None, *range(16))}
NO_WAY = 1 << 60


def lower_bounds(codes: bytes, targets: frozenset[int]) -> list[list[int]]:
    """By rows used up and state: what the rest costs at least."""
    bounds: list[list[int]] = [[]] * (len(codes) + 1)
    for at in range(len(codes), -1, -1):
        code = codes[at] if at < len(codes) else None
        if code is None:
            here = [0 if s in targets else NO_WAY for s in STATES]
        else:
            after = bounds[at + 1]
            here = [min(cost + after[to] for _, used, to, cost in RELAXED[s, code] if used) for s in STATES]
        for _ in range(3):  # a run of inserts that is worth it passes no state twice
            here = [min(here[s], INSERT + here[NEXT[s]]) for s in STATES]
        bounds[at] = here
    return bounds


@lru_cache(maxsize=1 << 16)
def search(codes: bytes, entry: int = START, targets: frozenset[int] = ACCEPTED) -> Found | None:
    """The cheapest edits of the rows from a state to one of the targets: cost and audit."""
    bounds = lower_bounds(codes, targets)
    incumbent: Found | None = None
    best: dict[tuple[int, int], Found] = {}
    stack: list[tuple[int, str, int, int]] = [(0, "", 0, entry)]
    while stack:
        cost, audit, at, state = stack.pop()
        least = cost + bounds[at][state]
        if least >= NO_WAY:
            continue
        if incumbent and (least > incumbent[0] or least == incumbent[0] and audit > incumbent[1][: len(audit)]):
            continue
        seen = best.get((at, state))
        if seen and seen <= (cost, audit):
            continue
        best[at, state] = (cost, audit)
        if at == len(codes) and state in targets:
            if incumbent is None or (cost, audit) < incumbent:
                incumbent = (cost, audit)
            continue
        ways = MOVES[state, codes[at] if at < len(codes) else None]
        children = [(cost + c + bounds[at + used][to], audit + edit, cost + c, at + used, to) for edit, used, to, c in ways]
        for _, longer, paid, used, to in sorted(children, reverse=True):  # the most promising is taken first
            stack.append((paid, longer, used, to))
    return incumbent


Ways = dict[int, Found]  # by state


def extended(ways: Ways, codes: bytes) -> Ways:
    """The best edits to each state, with a further segment."""
    found: Ways = {}
    for target in STATES:
        for entry, (cost, audit) in ways.items():
            more = search(codes, entry, frozenset((target,)))
            if more and (target not in found or (cost + more[0], audit + more[1]) < found[target]):
                found[target] = (cost + more[0], audit + more[1])
    return found


def joined(ways: Ways, segment: Iterable[tuple[int, int, int, str]]) -> Ways:
    """The same with a segment's edits by entry and exit."""
    found: Ways = {}
    for entry, exit_, cost, audit in segment:
        if entry in ways:
            whole = (ways[entry][0] + cost, ways[entry][1] + audit)
            if exit_ not in found or whole < found[exit_]:
                found[exit_] = whole
    return found


def accepted(ways: Ways) -> Found:
    return min(way for state, way in ways.items() if state in ACCEPTED)


class Counts:
    """What a task knows of the rows of one conversation: faults, and edits by entry state."""

    def __init__(self, entries: Iterable[int]):
        self.ways: dict[int, Ways] = {s: {s: (0, "")} for s in entries}
        self.held = bytearray()
        self.cut = False
        self.blank = self.duplicate = self.truncated = 0

    def add(self, code: int, n: int) -> None:
        while n:
            if len(self.held) == SEGMENT:
                self.flush()
            more = min(n, SEGMENT - len(self.held))
            self.held += bytes((code,)) * more
            n -= more

    def flush(self) -> None:
        codes = bytes(self.held)
        self.ways = {entry: extended(ways, codes) for entry, ways in self.ways.items()}
        self.held.clear()
        self.cut = True

    def whole(self) -> list[dict]:
        """The best edit from the start to an accepted state."""
        if not self.cut:
            cost, audit = search(bytes(self.held))
        else:
            self.flush()
            cost, audit = accepted(self.ways[START])
        return [{"entry": START, "exit": DONE, "cost": cost, "audit": audit}]

    def part(self) -> list[dict]:
        """The best edits from each entry to each state."""
        self.flush()
        return [{"entry": e, "exit": s, "cost": c, "audit": a} for e, ways in self.ways.items() for s, (c, a) in ways.items()]


FAULTS = "blank long, duplicate long, truncated long"
EDITS = "ways array<struct<entry:int, exit:int, cost:long, audit:string>>"


def _segments(kind: str):
    """Rows in order, to a row per conversation and task. Only the first and the last
    conversation of a task can have rows elsewhere; they keep all entries and exits."""
    schema = f"conv_id {kind}, at long, edge boolean, {FAULTS}, {EDITS}"
    arrow = arrow_schema(schema)

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        keys = ("conv_id", "code", "n", "blank", "again")
        lines = chain.from_iterable(zip(*(b.column(k).to_pylist() for k in keys)) for b in batches)
        made: list[dict] = []
        last = None

        def row(conv, counts: Counts, edge: bool) -> dict:
            ways = counts.part() if edge else counts.whole()
            return {"conv_id": conv, "at": at, "edge": edge, "blank": counts.blank, "duplicate": counts.duplicate, "truncated": counts.truncated, "ways": ways}

        for number, (conv, group) in enumerate(groupby(lines, key=lambda x: x[0])):
            if last:
                made.append(row(*last))
            if len(made) >= 10_000:
                yield pa.RecordBatch.from_pylist(made, arrow)
                made = []
            counts = Counts(STATES if number == 0 else (START,))
            for _, code, n, blank, again in group:
                first = 0 if blank or again else 1
                counts.blank += n if blank else 0
                counts.duplicate += 0 if blank else n - first
                if first:
                    counts.truncated += 1 if code & CUT_OFF else 0
                    counts.add(code, 1)
                counts.add(code & 3 | MUST_GO, n - first)
            last = (conv, counts, number == 0)
        if last:
            made.append(row(last[0], last[1], True))
        yield pa.RecordBatch.from_pylist(made, arrow)

    return rows, schema


def _merged(kind: str):
    schema = f"conv_id {kind}, {FAULTS}, cost long, audit string"
    arrow = arrow_schema(schema)

    def merge(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda p: p["at"])
        ways: Ways = {START: (0, "")}
        for part in parts:
            ways = joined(ways, [(w["entry"], w["exit"], w["cost"], w["audit"]) for w in part["ways"]])
        cost, audit = accepted(ways)
        sums = {c: sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated")}
        return pa.Table.from_pylist([{"conv_id": parts[0]["conv_id"], **sums, "cost": cost, "audit": audit}], arrow)

    return merge, schema


def prepared(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text (NULL: one space), and `same`: a digest of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    same = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), same.alias("same"))


def audits(rows: DataFrame) -> DataFrame:
    """Columns conv_id, blank, duplicate, truncated, cost and audit: a row per conversation.

    Rows are taken by turn (NULL first), those of one turn by role and a digest of role
    and text; rows that repeat one another follow each other. NULL roles and texts are one
    space, and a NULL conv_id is a conversation like others. Other columns are ignored,
    whatever their names; an empty table gives an empty one.

    Texts are not moved. Equal rows are combined before the shuffle, and rows are ranged
    over tasks by conversation and place in it, so a conversation of any length is
    searched by many tasks; only their segments' edits, a letter a row, meet.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    base = prepared(rows)
    ended = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    of_role = F.when(initial == "s", IS_SYSTEM).when(initial == "u", IS_USER).when(initial == "a", IS_ASSISTANT).otherwise(OTHER)
    blank = ended == ""
    cut_off = ~blank & ~F.substring(ended, -1, 1).isin(".", "!", "?")
    code = of_role + F.when(cut_off, CUT_OFF).otherwise(0)
    marked = base.select("conv_id", "turn", "role", "same", code.alias("code"), blank.alias("blank"))
    grouped = marked.groupBy("conv_id", "turn", "role", "same", "code", "blank").agg(F.count(F.lit(1)).alias("n"))
    places = stored(grouped, "conversation_places")
    firsts = stored(
        places.groupBy("conv_id", "same").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1").select(F.col("conv_id").alias("of"), F.col("same").alias("as"), "first"),
        "conversation_repeats",
    )
    again = F.coalesce(~F.struct("turn").eqNullSafe(F.col("first")), F.lit(False)) & F.col("as").isNotNull()
    judged = places.join(firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("as")), "left")
    coded = stored(judged.select("conv_id", "turn", "role", "same", "code", "blank", "n", again.alias("again")), "conversation_codes")

    keys = ("conv_id", "turn", "role", "same")
    ordered = coded.repartitionByRange(*keys).sortWithinPartitions(*keys)
    run, schema = _segments(kind)
    segments = stored(map_rows(ordered.select("conv_id", "code", "n", "blank", "again"), run, schema), "conversation_segments")
    merge, schema = _merged(kind)
    across = segments.where("edge").groupBy("conv_id").applyInArrow(merge, schema)
    within = segments.where("NOT edge").select("conv_id", "blank", "duplicate", "truncated", F.col("ways")[0]["cost"].alias("cost"), F.col("ways")[0]["audit"].alias("audit"))
    return within.unionByName(across)


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str


def applied(rows: Iterable[Row], audit: str) -> Iterator[tuple[str, Row]]:
    """The edits of an audit, one by one, each with the row it leaves (or takes away)."""
    left, state = iter(rows), START
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            yield edit, Row(None, ROLES[state], "")
            continue
        row = next(left)
        if edit == "K":
            state = kept_state(state, {"s": IS_SYSTEM, "u": IS_USER, "a": IS_ASSISTANT}[row.role[:1]])
        elif edit == "R":
            state = NEXT[state]
            row = row._replace(role=ROLES[state])
        yield edit, row


def _in_order(rows: DataFrame, found: DataFrame, every: DataFrame | None) -> DataFrame:
    """Per conversation, in one task and one after the other: its audit, then its rows."""
    heads = found.withColumns({"kind": F.lit(0), "turn": F.lit(None).cast("long"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "same": F.lit(None).cast("binary")})
    lines = prepared(rows).withColumn("turn", F.col("turn").cast("long")).withColumn("kind", F.lit(1))
    whole = heads.unionByName(lines, allowMissingColumns=True)
    if every is not None:
        whole = whole.unionByName(every.select("conv_id").distinct().withColumn("kind", F.lit(2)), allowMissingColumns=True)
    return whole.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "same").drop("same")


def _conversations(batches: Batches) -> Iterator[tuple[object, dict, Iterator[Row]]]:
    """Conversation, its head and its rows, which are read as they are taken."""
    names = ("conv_id", "kind", "turn", "role", "text", "blank", "duplicate", "truncated", "cost", "audit")

    def lines() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(n).to_pylist() for n in names))

    for conv, group in groupby(lines(), key=lambda x: x[0]):
        head = next(group)
        if head[1] == 0:
            yield conv, dict(zip(names, head)), (Row(*line[2:5]) for line in group if line[1] == 1)
        else:  # no rows are left of it
            yield conv, {"blank": 0, "duplicate": 0, "truncated": 0, "cost": 0, "audit": ""}, iter(())


def repair(rows: DataFrame) -> DataFrame:
    """Columns conv_id, place (from 0), edit (K, R, D or I), turn, role and text: the edits
    of each conversation in order. The repaired conversation is all rows but those with D.

    Order, NULLs, repeated rows and other columns as in `audits`. A conversation's edits
    are applied by one task as its rows pass; what it holds is the audit, a letter a row.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, place long, edit string, turn long, role string, text string"
    arrow = arrow_schema(schema)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        made: list[dict] = []
        for conv, head, lines in _conversations(batches):
            for place, (edit, row) in enumerate(applied(lines, head["audit"])):
                made.append({"conv_id": conv, "place": place, "edit": edit, **row._asdict()})
                if len(made) >= 1000:
                    yield pa.RecordBatch.from_pylist(made, arrow)
                    made = []
        yield pa.RecordBatch.from_pylist(made, arrow)

    return map_rows(_in_order(rows, stored(audits(rows), "audits"), None), run, schema)


class Watch:
    """Gaps and illegal neighbours of rows that pass in order."""

    def __init__(self) -> None:
        self.least = self.turn = self.initial = None
        self.distinct = self.illegal = 0

    def over(self, rows: Iterable[Row]) -> Iterator[Row]:
        for row in rows:
            if row.turn is not None:
                self.least = row.turn if self.least is None else self.least
                self.distinct += row.turn != self.turn
                self.turn = row.turn
            if self.initial is not None and self.initial + row.role[:1] not in LEGAL:
                self.illegal += 1
            self.initial = row.role[:1]
            yield row

    def gaps(self) -> int:
        return 0 if self.least is None else self.turn - self.least + 1 - self.distinct


def report(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """A row per conversation: conv_id, gaps (turns missing between the first and the
    last), blank, duplicate, truncated, illegal (neighbours other than su, ua and au),
    cost, audit and repaired_sha256 (of the lines `role:text`, joined by newlines).

    `every` may name conversations without rows: zeros, an empty audit, the digest of
    nothing. Else as `repair`, of which these are figures; the digest is of a whole
    conversation, so one task reads its rows, as they pass.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = f"conv_id {kind}, {', '.join(f'{n} long' for n in names)}, audit string, repaired_sha256 string"
    arrow = arrow_schema(schema)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        made: list[dict] = []
        for conv, head, lines in _conversations(batches):
            watch, digest, first = Watch(), hashlib.sha256(), True
            for edit, row in applied(watch.over(lines), head["audit"]):
                if edit != "D":
                    digest.update(f"{'' if first else chr(10)}{row.role}:{row.text}".encode())
                    first = False
            figures = {**head, "gaps": watch.gaps(), "illegal": watch.illegal}
            made.append({"conv_id": conv, **{n: figures[n] for n in names}, "audit": head["audit"], "repaired_sha256": digest.hexdigest()})
            if len(made) >= 1000:
                yield pa.RecordBatch.from_pylist(made, arrow)
                made = []
        yield pa.RecordBatch.from_pylist(made, arrow)

    return map_rows(_in_order(rows, stored(audits(rows), "audits"), every), run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Columns conv_id, turn, role and text with known faults, chosen by crc32 of
    `conv_id:turn` (NULL: one space) modulo 20: 0 drops the row, 1 empties its text, 2
    takes away its `[.!?]`, 3 repeats it, 4 makes its role user."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    fault = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault"))
        .where("fault <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )
