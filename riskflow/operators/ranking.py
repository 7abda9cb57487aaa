"""Fold summaries, candidate ranks and the best candidates."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators.ordering import MAX_RANGES, ROWS_PER_RANGE, cut_points, descending_rank


def fold_summary(df: DataFrame, by: Sequence[str] = ("candidate", "metric"), value: str = "value") -> DataFrame:
    """Mean and population standard deviation over folds."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def rank_candidates(
    summary: DataFrame,
    by: Sequence[str] = ("metric",),
    mean: str = "mean",
    rows_per_range: int = ROWS_PER_RANGE,
    max_ranges: int = MAX_RANGES,
) -> DataFrame:
    """Rank candidates per metric, highest mean first; ties share the lowest rank."""
    cuts = cut_points(summary, mean, rows_per_range, max_ranges)
    return descending_rank(summary, mean, "rank", by, cuts)


def best_candidate(
    summary: DataFrame,
    by: Sequence[str] = ("metric",),
    mean: str = "mean",
    candidate: str = "candidate",
) -> DataFrame:
    """The rank-1 candidate per metric, the lowest number among ties.

    An aggregate, combined map-side: finding the top needs no order.
    """
    order = F.struct(-F.col(mean), F.col(candidate))
    return (
        summary.where(F.col(mean).isNotNull())
        .groupBy(*by)
        .agg(F.min_by(F.struct(candidate, mean), order).alias("_best"))
        .select(*by, "_best.*")
    )


def top_candidates(ranked: DataFrame, metric: str, count: int = 5, candidate: str = "candidate") -> DataFrame:
    """The best `count` candidates of one metric."""
    return ranked.where(F.col("metric") == metric).orderBy("rank", candidate).limit(count)
