"""Language-model scores from all segmentations of a text into subword pieces.

A text is a sequence of pieces drawn independently until an end piece. Every word starts
with a space and no piece goes on past a word, so a text's probability, summed over all
segmentations, is the product of its words' sums, each one forward recursion over the
word's lattice in log space.

The pieces and their first weights come from an existing vocabulary. The weights are then
fitted to the corpus: each training word adds how often it is expected to use a piece (one
step of expectation maximisation), and the vocabulary's weights stand for `prior` further
pieces.

As a base, texts are also scored by word counts with one added to each.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Batches, map_rows, remainder, stored, words_of
from riskflow.llm.pieces import Lattice, Vocabulary, load, spelt_out

PRIOR = 10_000.0  # pieces that the vocabulary's own weights count for
COMMON = 200_000  # words whose counts every task gets: at most 200,000 x 64 bytes
COMMON_BYTES = 64
FLUSH = 1 << 18  # distinct words a task holds
TOGETHER = 1 << 18  # characters of the words whose lattices are built at once
COPIES = 10_000  # equal rows written out from one array
NAMES = ["id", "id2", "key", "word", "n", "n_tokens", "n_known", "base", "score"]


def _counted(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Counts of words in training texts (0: in others only), combined within the task
    up to FLUSH words at a time."""
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        batch = pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "c"])
        counts.clear()
        return batch

    for batch in batches:
        for text, learns in zip(batch.column(0), batch.column(1).to_pylist()):
            words = words_of(text.as_py())
            counts.update(words if learns else dict.fromkeys(words, 0))
            if len(counts) > FLUSH:
                yield out()
    if counts:
        yield out()


def word_counts(docs: DataFrame, learns: Column, text: str = "text") -> DataFrame:
    """Columns word, c: all words of all texts, counted where `learns`."""
    partial = map_rows(docs.select(F.col(text), learns.alias("learns")), _counted, "word string, c long")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose words have up to TOGETHER characters, or one word."""
    ends = np.cumsum(pc.utf8_length(batch.column(0)).to_numpy())
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + TOGETHER, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def _expected(vocabulary: Vocabulary):
    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        taken = np.zeros(len(vocabulary.raw))
        for batch in batches:
            for part in _portions(batch):
                lattice = Lattice(vocabulary, [f" {w}" for w in part.column(0).to_pylist()])
                copies = part.column(1).to_numpy().astype(float)
                weight = lattice.expected(lattice.forward(), copies)
                ids, size = spelt_out(lattice.piece, vocabulary)
                taken += np.bincount(ids, np.repeat(weight, size), len(taken))
        used = np.flatnonzero(taken)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(taken[used])], ["piece", "n"])

    return rows


@dataclass(frozen=True)
class Model:
    """Fitted piece weights, and the totals of the word counts that the base needs."""

    vocabulary: Vocabulary
    log_end: float
    tokens: int
    distinct: int
    ends: int

    def base_log(self, count: int) -> float:
        return math.log10((count + 1) / (self.tokens + self.distinct + 1))


def fit(counts: DataFrame, texts: int, vocabulary: Vocabulary, prior: float = PRIOR) -> Model:
    """The model of word counts over a number of texts; each text has one end.

    What comes to the driver is one number per piece.
    """
    known = counts.where("c > 0")
    total = known.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    expected = map_rows(known.select("word", "c"), _expected(vocabulary), "piece long, n double")
    taken = np.exp(vocabulary.logs) * prior
    for row in expected.groupBy("piece").agg(F.sum("n").alias("n")).collect():
        taken[row["piece"]] += row["n"]
    # without any training text an end is as likely as one piece in ten
    ends = texts + prior / 10
    whole = taken.sum() + ends
    with np.errstate(divide="ignore"):
        logs = np.log(taken) - math.log(whole)
    n, v = (total["n"] or 0) + texts, total["v"] + (texts > 0)
    return Model(vocabulary.weighted(logs), math.log(ends / whole), n, v, texts)


def _weighed(vocabulary: Vocabulary):
    """Words with their count and the log10 of the sum over their segmentations."""

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch):
                lattice = Lattice(vocabulary, [f" {w}" for w in part.column(0).to_pylist()])
                logs = lattice.forward()[lattice.last] / math.log(10)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(logs)], ["word", "c", "log"])

    return rows


def is_common(counts: DataFrame, most: int) -> Column:
    """Whether a word is one of the most frequent, at most `most` and of at most COMMON_BYTES.

    Words are counted by the logarithm of their count; what comes to the driver is that
    short table. The words are those from the count on at which they are few enough.
    """
    short = (F.col("c") > 0) & (F.octet_length("word") <= COMMON_BYTES)
    level = F.floor(F.log2("c") * 8)
    least = None
    for row in sorted(counts.where(short).groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        most -= row["count"]
        if most < 0:
            break
        least = row["level"]
    return F.lit(False) if least is None else short & (level >= least)


def _scored(model: Model, common: dict[bytes, tuple[float, float]]):
    """Per text a row with what the common words give, and a row per other word of it."""
    end = model.base_log(model.ends)

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        def texts_of(batch: pa.RecordBatch, lines: list[tuple]) -> pa.RecordBatch:
            # a word has no space, so these are no words; they spread the rows
            names = pa.array([f" {i}" for i in batch.column(0).to_pylist()], pa.string())
            tokens, known, base, score = zip(*lines)
            figures = [pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())]
            return pa.RecordBatch.from_arrays([*batch.columns[:3], names, pa.array(np.zeros(len(lines), np.int64)), *figures], NAMES)

        def words_of_texts(batch: pa.RecordBatch, rows_: list[int], words: list[bytes], counts: list[int]) -> pa.RecordBatch:
            n = len(words)
            zero, nothing = pa.array(np.zeros(n, np.int64)), pa.array(np.zeros(n))
            at = pa.array(rows_, pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.nulls(n, batch.column(2).type),
                    pa.array(words, pa.binary()).cast(pa.string()),
                    pa.array(counts, pa.int64()),
                    *(zero, zero, nothing, nothing),
                ],
                NAMES,
            )

        for batch in batches:
            lines: list[tuple] = []
            rare_row: list[int] = []
            rare_word: list[bytes] = []
            rare_count: list[int] = []
            for row, text in enumerate(batch.column(3)):
                words = Counter(words_of(text.as_py()))
                base, known, score = end, int(model.ends > 0), model.log_end / math.log(10)
                before = len(rare_word)
                for word, n in words.items():
                    found = common.get(word)
                    if found is None:
                        rare_word.append(word)
                        rare_count.append(n)
                    else:
                        base += n * found[0]
                        score += n * found[1]
                        known += n
                rare_row.extend([row] * (len(rare_word) - before))
                lines.append((words.total() + 1, known, base, score))
                if len(rare_word) > FLUSH:
                    yield words_of_texts(batch, rare_row, rare_word, rare_count)
                    rare_row, rare_word, rare_count = [], [], []
            if rare_word:
                yield words_of_texts(batch, rare_row, rare_word, rare_count)
            if lines:
                yield texts_of(batch, lines)

    return rows


def scores(
    docs: DataFrame,
    learns: Column | None = None,
    vocabulary: Vocabulary | None = None,
    prior: float = PRIOR,
    common_words: int = COMMON,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Columns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, a
    row per row of `docs`, learned from the rows where `learns` (by default
    crc32 of the key modulo 7 is not 2; a NULL key is learned from).

    Every distinct word is counted and weighed once. The most frequent ones go to every
    task, at most `common_words` words of up to 64 bytes; all other words of a text meet
    theirs in a join. So no word that many texts share is ever moved, and results do not
    depend on `common_words`.

    NULL texts are empty ones: one token, the end. Repeated rows count one by one; what
    equal rows have in all is divided among them, so rows are told apart by a hash of key
    and text, of 128 bits, which another run of a lost task gives again. Without training
    rows no token is known. Other columns are ignored.

    Only the word counts are written to the shared folder. The scores themselves are
    worked out whenever the result is read.
    """
    vocabulary = vocabulary or load()
    if learns is None:
        learns = F.coalesce(remainder(F.col(key), 7) != 2, F.lit(True))
    counts = stored(word_counts(docs, learns, text), "word_counts")
    model = fit(counts, docs.where(learns).count(), vocabulary, prior)
    weighed = lambda words: map_rows(words, _weighed(model.vocabulary), "word string, c long, log double")
    often = is_common(counts, common_words)
    common = {r["word"].encode(): (model.base_log(r["c"]), r["log"]) for r in weighed(counts.where(often)).collect()}

    kind = docs.schema[key].dataType.simpleString()
    schema = f"id long, id2 long, key {kind}, word string, n long, n_tokens long, n_known long, base double, score double"
    ids = [F.xxhash64(F.lit(i), F.col(key).isNull(), F.col(key), F.col(text)).alias(name) for i, name in enumerate(NAMES[:2])]
    parts = map_rows(docs.select(*ids, F.col(key).alias("key"), F.col(text).alias("text")), _scored(model, common), schema)
    joined = parts.join(weighed(counts.where(~often)), "word", "left")
    seen = F.log10((F.col("c") + 1) / F.lit(float(model.tokens + model.distinct + 1)))
    more = lambda value, nothing: F.when(F.col("n") > 0, F.col("n") * value).otherwise(nothing)
    copies = F.count_if(F.col("n") == 0)  # a text's own row; those of its words have counts
    summed = joined.groupBy("id", "id2").agg(
        F.max("key").alias("doc_id"),
        (F.sum("n_tokens") / copies).cast("long").alias("n_tokens"),
        (F.sum(F.col("n_known") + F.when(F.col("c") > 0, F.col("n")).otherwise(0)) / copies).cast("long").alias("n_known"),
        (F.sum(F.col("base") + more(seen, 0.0)) / copies).alias("base_score"),
        (F.sum(F.col("score") + more(F.col("log"), 0.0)) / copies).alias("score"),
        copies.alias("copies"),
    )
    summed = summed.withColumn("before", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(COPIES))))
    summed = summed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("copies") - F.col("before"), F.lit(COPIES)))))
    held_out = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    return summed.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
