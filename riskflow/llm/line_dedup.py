"""Substring deduplication by lines, cut at sentence ends.

A unit's normal form has A-Z in lower case, no ASCII punctuation and single spaces. Of
the units with one normal form, over all documents, the earliest stays; the others are
repeats. Repeats that follow each other, without an earliest unit between them, are a
run, and a run that is long enough is removed. So a shared sentence of a few words stays,
while a passage goes that many short units make up.

A unit has to be found in both copies of a passage, whatever surrounds it. So the cuts
depend on the text around them alone: units end with a line, and with a sentence of some
words; longer ones are cut after words that their letters choose, and at some length.

Only digests and positions are moved for the search. The occurrences of a digest are
combined to the earliest before they are moved, and meet it in a join, which a skew can
split; so a line that most documents share gathers nowhere. Texts are moved once.
"""

from __future__ import annotations

import re
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Batches, map_rows, stored

LEAST_WORDS = 25  # of a run
SENTENCE, UNCUT, LONGEST, ONE_IN = 6, 16, 20, 10  # words of a sentence that ends a unit; of a unit that is not cut further; of a unit; words that end a unit
CHARS = 10  # code points that count as a word, for text without blanks
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LOWER = bytes(range(256)).lower()
LETTER, MARK, DOT, WIDE, SPACE, BLANK, NEWLINE = range(7)  # kinds of code points; from SPACE on white space
OF_KIND = {MARK: PUNCTUATION, DOT: b".!?", SPACE: b"\x0b\x0c\r", BLANK: b" \t", NEWLINE: b"\n"}
KINDS = bytes({c: kind for kind, found in OF_KIND.items() for c in found}.get(c, LETTER) for c in range(256))

Span = tuple[int, int]


def normal(unit: str) -> bytes:
    return b" ".join(unit.encode().translate(LOWER, PUNCTUATION).split())


def size_of(form: bytes) -> int:
    """Words of a normal form; text without blanks counts by its length."""
    return max(form.count(b" ") + 1, len(form.decode()) // CHARS) if form else 0


def digest_of(form: bytes) -> int:
    return xxhash.xxh64_intdigest(form) - (1 << 63)


def lines(text: str) -> list[Span]:
    return _between(text, (m.end() for m in re.finditer("\n", text)))


def paragraphs(text: str) -> list[Span]:
    return _between(text, (m.end() for m in re.finditer("\n\n+", text)))


def _between(text: str, ends) -> list[Span]:
    cuts = [0, *ends]
    if cuts[-1] < len(text):
        cuts.append(len(text))
    return list(zip(cuts, cuts[1:]))


def sentences(text: str) -> list[Span]:
    """Start and end of each unit; together they are the whole text.

    Worked out on arrays of code points: words by their starts, sentence ends among them.
    """
    n = len(text)
    if not n:
        return []
    plain = text.encode("ascii", "replace")
    kind = np.frombuffer(plain.translate(KINDS), np.int8)
    if text.isascii():
        point = np.frombuffer(plain, np.uint8)
    else:
        point, kind = np.frombuffer(text.encode("utf-32-le"), np.uint32), kind.copy()
        kind[point > 127] = LETTER
        kind[(point == 0x3002) | (point == 0xFF01) | (point == 0xFF1F)] = WIDE
    space = kind >= SPACE
    before = np.concatenate([[NEWLINE], kind[:-1]])

    # sentences end after blanks that follow a stop, after a newline, and after full-width stops
    edge = np.flatnonzero((kind != BLANK) & (before == BLANK))
    if kind[-1] == BLANK:
        edge = np.append(edge, n)
    starts = np.flatnonzero((kind == BLANK) & (before != BLANK))
    weak = edge[before[starts] == DOT]
    wide = np.flatnonzero((kind != WIDE) & (before == WIDE))
    if kind[-1] == WIDE:
        wide = np.append(wide, n)
    strong = np.concatenate([np.flatnonzero(kind == NEWLINE) + 1, wide])
    cut_word = np.zeros(n + 1, bool)
    cut_word[wide] = True
    first = np.flatnonzero(~space & ((before >= SPACE) | cut_word[:-1]))  # of each word
    bounds = np.concatenate([[0], weak, strong, [n]])
    firm = np.concatenate([[True], np.zeros(len(weak), bool), np.ones(len(strong) + 1, bool)])
    order = np.argsort(bounds, kind="stable")
    bounds, firm = bounds[order], firm[order]
    words = np.searchsorted(first, bounds)
    firm[1:] |= np.diff(words) >= SENTENCE
    bounds, words = bounds[firm], words[firm]

    long = np.diff(words) > UNCUT
    if long.any():
        last = np.flatnonzero(~space & np.concatenate([space[1:] | cut_word[1:-1], [True]]))
        number = np.arange(len(first))
        fresh = np.concatenate([[False], _chosen(point, kind, first, last)[:-1]])  # starts a unit, if the one it is in is long
        fresh[words[:-1][long]] = True
        since = number - np.maximum.accumulate(np.where(fresh, number, 0))
        inside = np.repeat(long, np.diff(words))
        opens = inside & (since % LONGEST == 0)
        opens[words[:-1][long]] = False  # where the long unit itself begins
        bounds = np.concatenate([bounds, first[opens]])
    bounds = np.unique(bounds).tolist()
    return list(zip(bounds, bounds[1:]))


def _chosen(point: np.ndarray, kind: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether a unit may end with a word: by its first and last character and its length,
    ASCII punctuation around it left out and A-Z taken as a-z."""
    on_from, up_to = first.copy(), last.copy()
    for end, step in ((on_from, 1), (up_to, -1)):
        loose = np.flatnonzero((kind[end] == MARK) | (kind[end] == DOT))
        while len(loose):  # one more mark at the end of these words
            loose = loose[on_from[loose] < up_to[loose]]
            end[loose] += step
            loose = loose[(kind[end[loose]] == MARK) | (kind[end[loose]] == DOT)]
    word = (kind[on_from] == LETTER) | (kind[on_from] == WIDE)
    a, b = (x + 32 * ((x >= 65) & (x <= 90)) for x in (point[on_from].astype(np.int64), point[up_to].astype(np.int64)))
    return word & ((131 * a + 31 * b + 7 * (up_to - on_from)) % ONE_IN == 0)


UNITS: dict[str, Callable[[str], list[Span]]] = {"sentence": sentences, "line": lines, "paragraph": paragraphs}


def removed_spans(text: str, units: list[Span], repeats: set[int] | None, least_words: int) -> list[Span]:
    """Runs of repeats (unit numbers; None: all) of so many words, as spans of the text.

    Units without a normal form neither end a run nor start or finish one.
    """
    found: list[Span] = []
    first = last = None
    words = 0

    def close() -> None:
        if first is not None and words >= least_words:
            found.append((units[first][0], units[last][1]))

    for number, (a, b) in enumerate(units):
        if repeats is None or number in repeats:
            size = size_of(normal(text[a:b]))
            if size:
                first = number if first is None else first
                last, words = number, words + size
        elif first is not None and normal(text[a:b]):
            close()
            first, words = None, 0
    close()
    return found


def _units(cut: Callable[[str], list[Span]]):
    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, places, digests = [], [], []
            for i, text in enumerate(batch.column(2)):
                whole = text.as_py() or ""
                for place, (a, b) in enumerate(cut(whole)):
                    form = normal(whole[a:b])
                    if form:
                        at.append(i)
                        places.append(place)
                        digests.append(digest_of(form))
            index = pa.array(at, pa.int64())
            columns = [batch.column(0).take(index), batch.column(1).take(index), pa.array(places, pa.int32()), pa.array(digests, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "hash", "place", "digest"])

    return rows


def _cut(cut: Callable[[str], list[Span]], least_words: int):
    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, texts, counts, gone, spans = [], [], [], [], []
            columns = zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for i, (text, repeats, copies) in enumerate(columns):
                whole = text.as_py()
                units = cut(whole or "")
                for copy in range(copies):  # a repeated row comes after its first copy: all of it is repeats
                    if copy < 2:
                        runs = removed_spans(whole or "", units, set(repeats or ()) if copy == 0 else None, least_words)
                        edges = [0, *(e for run in runs for e in run), len(whole or "")]
                        clean = whole and "".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2]))
                        removed = sum(1 for a, b in units if any(x <= a and b <= y for x, y in runs)) if runs else 0
                    at.append(i)
                    texts.append(clean)
                    counts.append(len(units))
                    gone.append(removed)
                    spans.append(",".join(f"{a}-{b}" for a, b in runs))
                    if len(at) >= 10_000:
                        yield batch_of(batch, at, texts, counts, gone, spans)
                        at, texts, counts, gone, spans = [], [], [], [], []
            yield batch_of(batch, at, texts, counts, gone, spans)

    def batch_of(batch: pa.RecordBatch, at, texts, counts, gone, spans) -> pa.RecordBatch:
        columns = [
            batch.column(0).take(pa.array(at, pa.int64())),
            pa.array(texts, pa.string()),
            pa.array(counts, pa.int64()),
            pa.array(gone, pa.int64()),
            pa.array(spans, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_units", "n_removed", "removed_spans"])

    return rows


def dedup(docs: DataFrame, unit: str = "sentence", least_words: int = LEAST_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id, text (what stays), n_units, n_removed and removed_spans
    (start-end in code points of the original, comma-joined), a row per row of `docs`.

    `unit` is what is compared: "sentence", "line" or "paragraph"; what follows a unit up
    to the next one belongs to it. A run of repeats goes if it has `least_words` words
    (of text without blanks, CHARS code points count as one).

    Documents rank by key (NULL last), then by a hash of their text; units by place. Of
    rows that repeat key and text, one is first and all units of the others are repeats.
    NULL texts stay NULL; empty ones have no unit. A text of any length is cut whole, by
    the task that reads it. An empty table gives an empty one. Other columns are ignored,
    whatever their names.

    Digests have 64 bits. Two units of other words that share one count as repeats of
    each other; as a run takes several units in a row, that removes nothing by itself.
    """
    cut = UNITS[unit]
    kind = docs.schema[key].dataType.simpleString()
    hashed = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.col(f"`{text}`").isNull())
    keyed = docs.select(F.col(f"`{key}`").alias("key"), hashed.alias("hash"), F.col(f"`{text}`").alias("text"))
    found = map_rows(keyed, _units(cut), f"key {kind}, hash long, place int, digest long")
    units = stored(found, "units")

    rank = F.struct(F.col("key").isNull().alias("last"), "key", "hash", "place")
    repeated = units.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # a table of its own: a join right above an aggregate could not be split where it is skewed
    earliest = stored(repeated.select("digest", "first"), "earliest_units")
    later = units.join(earliest, "digest").where(rank != F.col("first"))
    # key and text by their hashes, which are never NULL: one pair of columns joins and groups
    removed = later.groupBy(F.xxhash64("key").alias("name"), "hash").agg(F.collect_set("place").alias("removed"))

    named = keyed.withColumn("name", F.xxhash64("key"))
    distinct = named.groupBy("name", "hash").agg(F.first("key").alias("key"), F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    joined = distinct.join(removed, ["name", "hash"], "left").select("key", "text", "removed", "copies")
    schema = f"doc_id {kind}, text string, n_units long, n_removed long, removed_spans string"
    return map_rows(joined, _cut(cut, least_words), schema)
