"""Exam records to scored records, the same for batches and micro-batches."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.bodies import expand_bodies, judged_bodies
from riskflow.operators.encode import positive, with_indicators, with_load_date, with_placeholders
from riskflow.operators.forest import score
from riskflow.operators.pymodel import SharedModel, score_from, score_with
from riskflow.schemas import EVENT_SCHEMA, FEATURES, KEY, conform

Scorer = Callable[[DataFrame], DataFrame]


def model_scorer(model: Model, signature: T.StructType | None = None) -> Scorer:
    """Score with a fitted pipeline; given its signature, inputs are checked and cast to it."""

    def run(features: DataFrame) -> DataFrame:
        return score(features if signature is None else conform(features, signature), model)

    return run


def python_scorer(
    model: object = None,
    features: Sequence[str] = FEATURES,
    load: Callable[[], object] | None = None,
) -> Scorer:
    """Score with any Python model. It is sent once, however many batches are scored;
    a large one is given as a function that loads it, from a shared path, in each task."""
    if load is not None:
        return lambda frame: score_from(frame, load, features)
    shared = model if isinstance(model, SharedModel) else SharedModel(model)
    return lambda frame: score_with(frame, shared, features)


def score_records(
    records: DataFrame,
    scorer: Scorer,
    as_of: str | None = None,
    on_missing: str = "default",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decoded exam records to result-table rows, plus the `keep` columns.

    One narrow plan: filter, indicators and scores are appended to the row that
    carries the id. Rows without an id or a positive age leave here.
    """
    usable = positive(records.where(F.col(KEY).isNotNull()))
    scored = scorer(with_indicators(with_placeholders(usable), on_missing))
    return with_load_date(scored, as_of).select(*EVENT_SCHEMA.names, *keep)


def judged(messages: DataFrame) -> DataFrame:
    """Messages (`body`, optional order columns) as exam records, with the reason `reject`
    of those that cannot be scored."""
    return judged_bodies(messages, EVENT_SCHEMA, KEY, "age")


def score_bodies(
    messages: DataFrame,
    scorer: Scorer,
    as_of: str | None = None,
    on_missing: str = "default",
) -> DataFrame:
    """Raw messages (`body`, optional order columns) to result-table rows."""
    keep = [c for c in messages.columns if c != "body"]
    return score_records(expand_bodies(messages, EVENT_SCHEMA), scorer, as_of, on_missing, keep)
