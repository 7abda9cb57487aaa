"""Quality rules in a short-circuit cascade.

A document is kept if no rule rejects it, so a rule after the first that rejects need not
run. On a sample of the documents that get as far as the rules, each rule's cost and what
it rejects are measured; the rules are then ordered greedily by rejections per cost among
the documents that earlier rules let pass. A rule's cost is what it adds to the figures
that are worked out for every document anyway. The order changes the work, never the
verdict.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from dataclasses import dataclass
from functools import cached_property
from typing import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Batches, map_rows

# Symbols, white space, and the base's limits.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent

SAMPLE_FRACTION, SAMPLE_ROWS = 0.02, 20_000  # of all documents, but so many at most
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")  # of every document
SAMPLE_SEED = 7
WITH_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


class Document:
    """Figures of a text, each worked out when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    def reported(self) -> "Document":
        """The same with all figures worked out that every document needs."""
        for name in FIGURES:
            getattr(self, name)
        return self

    def again(self) -> "Document":
        """One that knows what this one has worked out so far, and keeps what it adds to itself."""
        other = Document.__new__(Document)
        other.__dict__.update(self.__dict__)
        return other

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, BLANKS))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a window of three words which occurs twice or more."""
        w = self.words
        counts = Counter(zip(w, w[1:], w[2:]))
        windows = max(0, len(w) - 2)
        if len(counts) == windows:
            return 0
        again = np.fromiter((counts[x] > 1 for x in zip(w, w[1:], w[2:])), bool, windows)
        covered = np.zeros(len(w), bool)
        for i in range(3):
            covered[i : i + windows] |= again
        return int(covered.sum())

    @cached_property
    def n_letter_words(self) -> int:
        return sum(map(bool, map(WITH_LETTER.search, self.words)))

    @cached_property
    def n_capitals(self) -> int:
        return sum(map(self.raw.count, [bytes([c]) for c in range(65, 91)]))

    @cached_property
    def n_small(self) -> int:
        return sum(map(self.raw.count, [bytes([c]) for c in range(97, 123)]))

    @property
    def base_failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED * self.n_words


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]


# Integers on both sides, so that the same rules in SQL agree to the last document.
RULES = (
    Rule("word_length", lambda d: d.word_chars < 2 * d.n_words or d.word_chars > 15 * d.n_words),
    Rule("symbols", lambda d: 10 * d.n_symbols > d.n_words),
    Rule("repeated_lines", lambda d: 10 * d.n_dup_lines > 3 * len(d.lines)),
    Rule("words_without_letter", lambda d: 10 * d.n_letter_words < 8 * d.n_words),
    Rule("capitals", lambda d: d.n_capitals > d.n_small),
    Rule("repeated_words", lambda d: 10 * d.n_repeat_words > 3 * d.n_words),
)


def _measured(rules: Sequence[Rule]):
    """Per set of rejecting rules: sampled documents and nanoseconds of each rule."""

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        count: Counter[int] = Counter()
        spent = np.zeros(len(rules), np.int64)
        for batch in batches:
            for text in batch.column(0):
                document, mask = Document(text.as_py()).reported(), 0
                if document.base_failed:
                    continue
                for i, rule in enumerate(rules):
                    own = document.again()
                    began = time.perf_counter_ns()
                    mask |= rule.rejects(own) << i
                    spent[i] += time.perf_counter_ns() - began
                count[mask] += 1
        first = True
        for mask, n in count.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([mask]), pa.array([n]), pa.array([(spent if first else 0 * spent).tolist()], pa.list_(pa.int64()))],
                ["mask", "n", "spent"],
            )
            first = False

    return rows


def ordered(rules: Sequence[Rule], counts: dict[int, int], spent: Sequence[float]) -> list[Rule]:
    """Greedy order: next the rule that rejects most of what is left per cost."""
    left, todo, order = dict(counts), list(range(len(rules))), []
    while todo:
        gain = lambda i: sum(n for mask, n in left.items() if mask >> i & 1) / max(spent[i], 1)
        best = max(todo, key=lambda i: (gain(i), -spent[i]))
        todo.remove(best)
        order.append(rules[best])
        left = {mask: n for mask, n in left.items() if not mask >> best & 1}
    return order


def plan(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    fraction: float = SAMPLE_FRACTION,
    seed: int = SAMPLE_SEED,
    text: str = "text",
    most_rows: int = SAMPLE_ROWS,
) -> list[Rule]:
    """The rules in the order to run them, from a random sample of the documents: a
    fraction of them, and about `most_rows` at most.

    Tasks combine what they measure: a row per set of rejecting rules comes back. An
    empty sample leaves the order as it is.
    """
    share = min(fraction, most_rows / max(docs.count(), 1))
    sample = docs.select(text).sample(share, seed)
    found = map_rows(sample, _measured(rules), "mask long, n long, spent array<long>")
    sums = [F.sum(F.col("spent")[i]).alias(f"s{i}") for i in range(len(rules))]
    table = found.groupBy("mask").agg(F.sum("n").alias("n"), *sums).collect()
    spent = [sum(r[f"s{i}"] for r in table) for i in range(len(rules))]
    return ordered(rules, {r["mask"]: r["n"] for r in table}, spent) if table else list(rules)


def passes(document: Document, rules: Sequence[Rule]) -> bool:
    return not any(rule.rejects(document) for rule in rules)


def judge(docs: DataFrame, rules: Sequence[Rule], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed and kept, a row per row of `docs`. `rules` run in the order given, and
    only for documents that the base lets pass. A NULL or empty text has no words and
    fails the base. A text of any length is judged whole. Rows that repeat one another are
    judged alike, an empty table gives an empty one, and other columns are ignored,
    whatever their names."""

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        names = list(FIGURES)
        for batch in batches:
            figures: list[list[int]] = [[] for _ in names]
            failed, kept = [], []
            for t in batch.column(1):
                document = Document(t.as_py())
                for column, name in zip(figures, names):
                    column.append(getattr(document, name))
                failed.append(document.base_failed)
                kept.append(not failed[-1] and passes(document, rules))
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in figures), pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names, "base_failed", "kept"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    return map_rows(docs.select(key, text), rows, schema)
