"""Language identification by rank-order n-gram profiles.

A text is lower-cased, every run of other characters than letters becomes one space, and
its letters, letter pairs and letter triples (with the space at a word's ends) are ranked
by frequency. A language's profile is the same ranking over all its training texts. The
out-of-place distance adds, for each of the text's most frequent n-grams, how far its
rank is from the one in the profile; an n-gram the profile lacks costs the profile size.
"""

from __future__ import annotations

from functools import lru_cache
from typing import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.common import Batches, map_rows, remainder

TOP = 400  # n-grams in a profile
UNKNOWN = "und"
SALTS = 64
SPACE = 32
CHUNK = 1 << 20  # n-grams counted at once in training
FLUSH = 1 << 21  # distinct n-grams that a training task holds
PLACE = np.int64(21)  # bits of a code point; three fit a long


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str | None) -> np.ndarray:
    """Codes of all 1- to 3-grams of a text; empty if it has no letter."""
    if not text:
        return np.empty(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    padded = np.full(len(points) + 2, SPACE, np.int64)
    padded[1:-1] = np.where(_letters()[points], points, SPACE)
    gap = padded == SPACE
    keep = np.ones(len(padded), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    x = padded[keep]
    if len(x) < 3:
        return np.empty(0, np.int64)
    pairs = (x[:-1] << PLACE) | x[1:]
    triples = (pairs[:-1] << PLACE) | x[2:]
    return np.concatenate([x[x != SPACE], pairs, triples[x[1:-1] != SPACE]])


def ranked(codes: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent codes, most frequent first, equal counts by code."""
    distinct, counts = np.unique(codes, return_counts=True)
    return distinct[np.argsort(-counts, kind="stable")[:top]]


class Profiles:
    """Ranks of all languages' n-grams, looked up for all languages at once."""

    def __init__(self, ranking: Mapping[str, list[int]], top: int = TOP):
        self.top = top
        self.languages = sorted(ranking)
        self.codes = np.unique(np.concatenate([np.empty(0, np.int64), *(np.array(v, np.int64) for v in ranking.values())]))
        self.ranks = np.full((len(self.codes) + 1, len(self.languages)), top, np.int64)
        for i, name in enumerate(self.languages):
            self.ranks[np.searchsorted(self.codes, ranking[name]), i] = np.arange(len(ranking[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language (the first by name if several are) and 1 less the
        distance's share of the largest possible one."""
        mine = ranked(grams(text), self.top)
        if not len(mine) or not self.languages:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, mine)
        at[at == len(self.codes)] = 0
        at[self.codes[at] != mine] = len(self.codes)
        theirs = self.ranks[at]
        away = np.where(theirs == self.top, self.top, np.abs(theirs - np.arange(len(mine))[:, None]))
        distance = away.sum(axis=0)
        best = int(distance.argmin())
        return self.languages[best], 1.0 - float(distance[best]) / (self.top * len(mine))


def _counted(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, gram), combined within the task."""
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    open_: dict[str, list[np.ndarray]] = {}
    waiting: dict[str, int] = {}

    def settle(lang: str) -> None:
        codes, counts = np.unique(np.concatenate(open_.pop(lang)), return_counts=True)
        waiting.pop(lang)
        if lang in totals:
            both = np.concatenate([totals[lang][0], codes])
            codes, place = np.unique(both, return_inverse=True)
            counts = np.bincount(place, np.concatenate([totals[lang][1], counts]), len(codes)).astype(np.int64)
        totals[lang] = codes, counts

    def out() -> Iterator[pa.RecordBatch]:
        for lang in list(open_):
            settle(lang)
        for lang, (codes, counts) in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes), pa.array(counts)], ["lang", "gram", "n"])
        totals.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            codes = grams(text.as_py())
            if len(codes):
                open_.setdefault(lang, []).append(codes)
                waiting[lang] = waiting.get(lang, 0) + len(codes)
                if waiting[lang] > CHUNK:
                    settle(lang)
        if sum(len(c) for c, _ in totals.values()) > FLUSH:
            yield from out()
    yield from out()


def gram_counts(labelled: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """Columns lang, gram, n over all texts that have a language."""
    training = labelled.where(F.col(lang).isNotNull()).select(lang, text)
    partial = map_rows(training, _counted, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, lang: str = "lang", text: str = "text", top: int = TOP) -> Profiles:
    """Profiles of all languages of `labelled`.

    The most frequent n-grams are chosen within slices of a language's n-grams first, so
    that no task gets all of them. What comes to the driver is `top` codes a language.
    """
    order = [F.col("n").desc(), F.col("gram")]
    sliced = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(SALTS))).orderBy(*order)
    first = gram_counts(labelled, lang, text).withColumn("place", F.row_number().over(sliced)).where(F.col("place") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    best = first.withColumn("place", F.row_number().over(whole)).where(F.col("place") <= top)
    found: dict[str, list[int]] = {}
    for row in best.select("lang", "gram", "place").collect():
        found.setdefault(row["lang"], []).append((row["place"], row["gram"]))
    return Profiles({k: [g for _, g in sorted(v)] for k, v in found.items()}, top)


def predict(docs: DataFrame, profiles: Profiles, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows and columns of `docs` with lang_pred and score, from the text alone;
    columns that had these names are replaced.

    NULL texts and those without a letter get "und" with score 0, as all texts do when
    no language was learned. The profiles (a few kB a language) go to every task.
    """
    kept = [c for c in docs.columns if c not in (lang_pred, score)]
    plain, place = docs.select(*kept), kept.index(text)

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(t.as_py()) for t in batch.column(place)]
            added = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*kept, lang_pred, score])

    schema = T.StructType([*plain.schema.fields, T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())])
    return map_rows(plain, rows, schema)


def held_out(key: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether a key belongs to the held-out fold; a NULL key does not."""
    return F.coalesce(remainder(key, folds) == fold, F.lit(False))


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """All rows and columns with lang_pred and score: learned from the rows that are not
    held out and have a language, predicted for all rows.

    Rules as in `identify`; columns of those two names are replaced."""
    return predict(docs, train(docs.where(~held_out(F.col(key))), lang, text), text)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Columns doc_id, held_out, lang_pred, score, a row per row of `docs`. Repeated rows
    count and are predicted one by one; other columns are ignored, whatever their names.
    Texts of any length are read whole; NULL, empty ones and those without a letter are
    `und`. A NULL key is learned from. An empty table gives an empty one; without a row to
    learn from, all texts are `und`."""
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    profiles = train(plain.where(~held_out(F.col("doc_id"))))
    found = predict(plain.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
