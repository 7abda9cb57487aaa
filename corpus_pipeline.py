"""A corpus pipeline: each stage is written as Parquet and reread as the next one's input.

language ID drops documents in no known language, near-duplicate search keeps one
document of each group, decontamination drops those that hold a benchmark item, secrets
are masked, and what is left is cut into pieces.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.common import stored, table
from riskflow.llm.decontamination import without_leaks
from riskflow.llm.language_id import UNKNOWN, identified
from riskflow.llm.piece_sampling import encode
from riskflow.llm.secret_scan import redact, train
from riskflow.llm.simhash_dedup import one_of_each

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.25  # of a match with the nearest language profile; what scores less is no text in a learned language
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those far from every language's profile.

    NULL and empty texts have no letter and go. Texts are read whole, rows that repeat one
    another stay or go together, an empty table stays empty; other columns go.
    """
    found = identified(docs.select(*COLUMNS))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with nearly the same text keep the one with the smallest id.

    Texts under one id are documents of their own; of those in one group the smallest
    hash of the row stays, and of rows that repeat one another, one. Documents without an
    id stay. NULL and empty texts are one group; an empty table stays empty.
    """
    return one_of_each(docs.select(*COLUMNS))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a benchmark item occurs.

    Texts are searched whole; NULL and empty ones hold none and stay. Rows that repeat one
    another stay or go together, an empty table stays empty; other columns go.
    """
    return without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets; n_chars follows the text.

    Every row stays. NULL and empty texts stay as they are, n_chars with them; texts are
    searched whole; an empty table stays empty; other columns go.
    """
    masked = redact(docs.select(*COLUMNS), train(docs))
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return masked.withColumn("n_chars", size)


def in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and piece_ids, from which the text can be decoded without loss.

    A row per row. A NULL text has NULL, an empty one no ids; texts are cut whole, equal
    rows alike; an empty table stays empty; other columns go.
    """
    return encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", in_known_language),
    ("simhash_dedup", one_of_each_group),
    ("decontamination", without_benchmarks),
    ("secret_scan", without_secrets),
    ("piece_sampling", in_pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
