"""Benchmark passages in documents, found with edits.

An item that occurs with at most k edits, cut into k + 1 pieces, has at least one piece
that occurs unchanged (pigeonhole). All pieces of all items are searched at once; around
each hit the item is aligned by Myers' bit-parallel edit distance. Short items are searched
in the same pass, without edits and as whole words.

Texts are compared in a normal form: lower case, white space runs as one space.
"""

from __future__ import annotations

import re
from collections import defaultdict
from typing import Iterator, NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Batches, map_rows

ERROR_RATE = 0.08  # edits a character of the item
LEAST_CHARS = 32  # shorter items are too common to be evidence if edits are allowed
BLOCK_BYTES = 1 << 20  # item text that is searched in one pass
WORD = re.compile(r"\S+")
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


class Match(NamedTuple):
    item: int
    distance: int
    start: int
    end: int


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def places(text: str, wanted: list[int]) -> list[int]:
    """Where characters of the normal form stand in the text."""
    at: list[int] = []
    for word in WORD.finditer(text):
        if at:
            at.append(word.start() - 1)
        for i, c in enumerate(word.group(), word.start()):
            at.extend([i] * len(c.lower()))
    return [at[min(i, len(at) - 1)] for i in wanted]


def masks_of(pattern: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for i, c in enumerate(pattern):
        found[c] = found.get(c, 0) | 1 << i
    return found


def align(masks: dict[str, int], size: int, text: str, anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of the pattern to a substring of the text (with `anchored`, to
    a prefix) and where the first such substring ends. Myers' algorithm: the column of
    vertical differences is two bit vectors, advanced by one character at a time."""
    ones, top = (1 << size) - 1, 1 << size - 1
    up, down, score = ones, 0, size
    best, end = size, 0
    for at, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        across = (((equal & up) + up) ^ up) | equal
        rise, fall = down | ~(across | up) & ones, up & across
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1 | anchored) & ones, fall << 1 & ones
        along = equal | down
        up, down = fall | ~(along | rise) & ones, rise & along
        if score < best:
            best, end = score, at
    return best, end


def joined(text: str, at: int) -> bool:
    """Whether a word goes on over a place; in scripts without spaces none does."""
    if not 0 < at < len(text):
        return False
    return all(c.isalnum() and not UNSPACED.match(c) for c in text[at - 1 : at + 1])


class Items:
    """Search structure over benchmark items (id, text). Items of fewer than `least_chars`
    characters are pieces with negative numbers, which need no verification."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float = ERROR_RATE, least_chars: int = LEAST_CHARS):
        self.text, self.budget, self.ids, self.short = [], [], [], []
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for key, text in items:
            form = normal(text)
            if not form:
                continue
            if len(form) < least_chars:
                self.short.append(key)
                pieces[form].append((-len(self.short), len(form)))
                continue
            budget = int(error_rate * len(form))
            cuts = [i * len(form) // (budget + 1) for i in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces[form[a:b]].append((len(self.ids), b))
            self.ids.append(key)
            self.text.append(form)
            self.budget.append(budget)
        self.masks = [masks_of(t) for t in self.text]
        self.backwards = [masks_of(t[::-1]) for t in self.text]
        self.pieces = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.pieces.add_word(piece, where)
        self.pieces.make_automaton()

    def matches(self, text: str | None) -> list[Match]:
        """The closest occurrence of every item in a text, the first if several are."""
        form = normal(text)
        if not form or not len(self.pieces):
            return []
        diagonals: dict[int, set[int]] = defaultdict(set)
        exact: dict[int, tuple[int, int]] = {}
        for end, where in self.pieces.iter(form):
            for item, offset in where:
                if item >= 0:
                    diagonals[item].add(end + 1 - offset)
                elif item not in exact and not joined(form, end + 1 - offset) and not joined(form, end + 1):
                    exact[item] = end + 1 - offset, end
        found = []
        for item, (first, last) in exact.items():
            start, end = places(text, [first, last])
            found.append(Match(self.short[-item - 1], 0, start, end + 1))
        for item, starts in diagonals.items():
            near = self._closest(item, sorted(starts), form)
            if near:
                start, end = places(text, [near[1], near[2] - 1])
                found.append(Match(self.ids[item], near[0], start, end + 1))
        return found

    def _closest(self, item: int, starts: list[int], form: str) -> tuple[int, int, int] | None:
        size, budget, best = len(self.text[item]), self.budget[item], None
        at = 0
        while at < len(starts):
            upto = at  # windows that overlap are one
            while upto + 1 < len(starts) and starts[upto + 1] - starts[upto] <= size:
                upto += 1
            low = max(0, starts[at] - budget)
            distance, end = align(self.masks[item], size, form[low : starts[upto] + size + budget])
            if distance <= budget and (best is None or distance < best[0]):
                stop = low + end
                back = form[max(0, stop - size - budget) : stop][::-1]
                length = align(self.backwards[item], size, back, anchored=True)[1]
                best = distance, stop - length, stop
            at = upto + 1
        return best


def item_blocks(items: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about `block_bytes`, by hash of the text; copies of a text
    come under their smallest key. Items without text are left out."""
    distinct = items.where(F.col(text).isNotNull()).groupBy(text).agg(F.min(key).alias("key"))
    size = distinct.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    blocks = 1 + size // block_bytes
    for block in range(blocks):
        part = distinct.where(F.pmod(F.xxhash64(text), F.lit(blocks)) == block)
        yield sorted(((r["key"], r[text]) for r in part.select("key", text).collect()), key=lambda r: (r[0] is None, r))


def leaks(
    docs: DataFrame,
    items: DataFrame,
    error_rate: float = ERROR_RATE,
    block_bytes: int = BLOCK_BYTES,
    key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """Columns doc_id, item_id, distance, start_char, end_char: for each document row and
    item that occurs in it, the closest occurrence, in code points of the text.

    The items are a query set; each block of them goes over all documents in one narrow
    pass, so a block's size bounds what is sent to the tasks. NULL and empty texts match
    nothing; items of fewer than `least_chars` characters have to occur unchanged (in the
    normal form) and as whole words. A text of any length is searched whole. Rows that
    repeat one another, of either table, are found each; empty tables give none. Other
    columns are ignored, whatever their names.
    """
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, distance long, start_char long, end_char long"
    found = None
    for block in item_blocks(items, item_key, text, block_bytes):
        pass_ = map_rows(docs.select(key, text), _leaks_of(block, error_rate, least_chars), schema)
        found = pass_ if found is None else found.union(pass_)
    return found


def _leaks_of(block: list[tuple[int, str]], error_rate: float, least_chars: int):
    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        search = Items(block, error_rate, least_chars)
        for batch in batches:
            found = [(i, m) for i, t in enumerate(batch.column(1)) for m in search.matches(t.as_py())]
            columns = [batch.column(0).take(pa.array([i for i, _ in found], pa.int64()))]
            columns += [pa.array([m[j] for _, m in found], pa.int64()) for j in range(4)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "distance", "start_char", "end_char"])

    return rows


def without_leaks(
    docs: DataFrame,
    items: DataFrame,
    error_rate: float = ERROR_RATE,
    block_bytes: int = BLOCK_BYTES,
    item_key: str = "item_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """The rows of `docs`, all columns, in which no item occurs. Narrow, a pass a block.

    Rules as in `leaks`. Rows with NULL and empty texts stay, repeated rows stay or go
    together, and without items all rows stay.
    """
    place = docs.columns.index(text)
    for block in item_blocks(items, item_key, text, block_bytes):

        def rows(batches: Batches, block=block) -> Iterator[pa.RecordBatch]:
            search = Items(block, error_rate, least_chars)
            for batch in batches:
                yield batch.filter(pa.array([not search.matches(t.as_py()) for t in batch.column(place)], pa.bool_()))

        docs = map_rows(docs, rows, docs.schema)
    return docs
