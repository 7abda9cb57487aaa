"""Secrets in texts: fixed patterns, and strings that look random to a character model.

Two first-order Markov models over the characters of tokens, one of random strings and
one of ordinary words and identifiers, are compared by their log-likelihood ratio. They
are trained from samples that the patterns label: what a pattern finds is random, all
other tokens are ordinary.

All patterns are ASCII, so texts are searched as UTF-8, where A-Z can be lower-cased
without moving anything; offsets are reported in code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Batches, map_rows

# Kinds, their order, their patterns and the least length of a match.
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")  # lower-cased text
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")  # AKIA[A-Z0-9]+ of 20 or more characters
HEX = re.compile(rb"[0-9a-f]{24,}")
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "random")

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
N = len(ALPHABET)
OUTSIDE = START = N  # no token character; what comes before a token
SYMBOL = np.full(256, OUTSIDE, np.int64)
SYMBOL[np.frombuffer(ALPHABET, np.uint8)] = np.arange(N)
LEAST_SAMPLE = 8  # characters of a token that trains the model of ordinary ones
LEAST_TOKEN = 16  # characters of a token that is judged
THRESHOLD = 0.6  # nats a character; ordinary tokens of the tables reach 0.2, made-up names 0.4


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    value: int  # where the secret itself starts


def _base(raw: bytes) -> list[Span]:
    """Pattern matches in bytes offsets."""
    found = [
        Span("assign", m.start(), m.end(), m.start(1))
        for m in ASSIGN.finditer(raw.lower())
        if m.end(1) - m.start(1) >= LEAST_VALUE
    ]
    found += [Span("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(raw)]
    found += [Span("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(raw)]
    return found


@dataclass
class _Tokens:
    """Maximal runs of token characters, and a transition code per character in them."""

    start: np.ndarray
    length: np.ndarray
    codes: np.ndarray

    @classmethod
    def of(cls, raw: bytes) -> "_Tokens":
        symbol = SYMBOL[np.frombuffer(raw, np.uint8)]
        inside = symbol != OUTSIDE
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        before = np.concatenate([[START], symbol[:-1]])  # OUTSIDE is START
        return cls(edge[::2], edge[1::2] - edge[::2], (before * N + symbol)[inside])

    def free_of(self, spans: list[Span]) -> np.ndarray:
        """Which tokens touch none of the spans."""
        free = np.ones(len(self.start), bool)
        for s in spans:
            first = np.searchsorted(self.start + self.length, s.start, "right")
            free[first : np.searchsorted(self.start, s.end)] = False
        return free


def _transitions(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Transition counts of random (row 1) and ordinary (row 0) samples in the task."""
    counts = np.zeros((2, (N + 1) * N), np.int64)
    for batch in batches:
        for text in batch.column(0):
            raw = (text.as_py() or "").encode()
            if not raw:
                continue
            spans, tokens = _base(raw), _Tokens.of(raw)
            if len(tokens.start):
                used = (tokens.length >= LEAST_SAMPLE) & tokens.free_of(spans)
                counts[0] += np.bincount(tokens.codes[np.repeat(used, tokens.length)], minlength=(N + 1) * N)
            for s in {(s.value, s.end) for s in spans}:
                counts[1] += np.bincount(_Tokens.of(raw[s[0] : s[1]]).codes, minlength=(N + 1) * N)
    label, code = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(label == 1), pa.array(code), pa.array(counts[label, code])], ["random", "code", "n"])


@dataclass(frozen=True)
class RandomStrings:
    """Log-likelihood ratio (random against ordinary) of each transition; None: untrained."""

    ratio: np.ndarray | None
    threshold: float = THRESHOLD

    @classmethod
    def from_counts(cls, counts: np.ndarray, threshold: float = THRESHOLD) -> "RandomStrings":
        """`counts`: (ordinary, random) x transition, half a count added to each."""
        if not counts.sum(axis=1).all():
            return cls(None, threshold)
        grid = counts.reshape(2, N + 1, N) + 0.5
        logs = np.log(grid / grid.sum(axis=2, keepdims=True))
        return cls((logs[1] - logs[0]).ravel(), threshold)

    def spans(self, raw: bytes, known: list[Span]) -> list[Span]:
        if self.ratio is None or not raw:
            return []
        tokens = _Tokens.of(raw)
        long = np.flatnonzero((tokens.length >= LEAST_TOKEN) & tokens.free_of(known))
        if not len(long):
            return []
        at = np.cumsum(tokens.length) - tokens.length
        return [
            Span("random", int(start), int(start + n), int(start))
            for start, n, first in zip(tokens.start[long], tokens.length[long], at[long])
            if self.ratio[tokens.codes[first : first + n]].mean() > self.threshold
        ]


def train(texts: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> RandomStrings:
    """Both models from all texts; what comes to the driver is one count per transition.

    Without samples of either kind the model finds nothing.
    """
    partial = map_rows(texts.select(text), _transitions, "random boolean, code long, n long")
    counts = np.zeros((2, (N + 1) * N))
    for row in partial.groupBy("random", "code").agg(F.sum("n").alias("n")).collect():
        counts[int(row["random"]), row["code"]] = row["n"]
    return RandomStrings.from_counts(counts, threshold)


def find(text: str | None, model: RandomStrings) -> tuple[list[Span], list[Span]]:
    """Pattern spans and the model's spans, by start and then kind, in code points."""
    raw = (text or "").encode()
    base = _base(raw)
    added = model.spans(raw, base)
    if (base or added) and len(raw) != len(text):
        lead = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
        place = lambda spans: [Span(s.kind, *(int(lead[x]) for x in s[1:])) for s in spans]
        base, added = place(base), place(added)
    order = lambda s: (s.start, KINDS.index(s.kind))
    return sorted(base, key=order), sorted(added, key=order)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind))))


def scan(docs: DataFrame, model: RandomStrings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans, a row per
    row of `docs`, repeated rows included. NULL and empty texts have no spans. A text of
    any length is searched whole. An empty table gives an empty one; other columns are
    ignored, whatever their names. Tokens of fewer than LEAST_TOKEN characters are left to
    the patterns: so few characters say too little."""

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for t in batch.column(1):
                base, added = find(t.as_py(), model)
                kinds = [s.kind for s in base]
                values = (*(kinds.count(k) for k in KINDS[:3]), len(added), hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + added))
                for column, value in zip(out, values):
                    column.append(value)
            kinds_of = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds_of))],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"],
            )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return map_rows(docs.select(key, text), rows, schema)


def redacted(text: str | None, model: RandomStrings, mask: str = "[secret]") -> str | None:
    """The text with each found secret (the value alone of an assignment) masked."""
    if not text:
        return text
    base, added = find(text, model)
    out, at = [], 0
    for start, end in sorted((s.value, s.end) for s in base + added):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mask]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: RandomStrings, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """All rows and columns of `docs`, secrets in the text masked. Narrow."""
    place = docs.columns.index(text)

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = pa.array([redacted(t.as_py(), model, mask) for t in batch.column(place)], pa.string())
            columns = [clean if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_rows(docs, rows, docs.schema)
