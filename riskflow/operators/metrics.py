"""Evaluation aggregates over (label, prediction, p1), overall or per group.

Every function takes an optional `weight` column of row counts, so that scores
already grouped by value give the same result as the rows they stand for. Rows
with a NULL label, prediction or score are not evaluated.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.operators.ordering import MAX_RANGES, ROWS_PER_RANGE, cut_points, descending_totals

# Fixed value: probabilities are kept this far from 0 and 1 in the log loss.
CLIP = 1e-15
POINT_METRICS = ("precision", "recall", "f1", "balanced_accuracy", "accuracy", "neg_log_loss", "neg_brier_score")
CURVE_METRICS = ("roc_auc", "average_precision")


def ratio(top: Column, bottom: Column) -> Column:
    """0 when the denominator is 0."""
    return F.coalesce(top / F.nullif(bottom.cast("double"), F.lit(0.0)), F.lit(0.0))


def confusion(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """tp, fp, fn, tn of class 1."""
    evaluated = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return evaluated.groupBy(*by).agg(*_counts(label, prediction, weight))


def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1, balanced accuracy and accuracy from confusion counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall, miss = ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(tn, tn + fp)
    classes = (tp + fn > 0).cast("int") + (tn + fp > 0).cast("int")
    return counts.withColumns(
        {
            "precision": precision,
            "recall": recall,
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
            "balanced_accuracy": ratio(recall + miss, classes),
            "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        }
    )


def losses(
    df: DataFrame,
    label: str = "label",
    score: str = "p1",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Log loss and Brier score."""
    evaluated = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    return evaluated.groupBy(*by).agg(*_losses(label, score, weight))


def point_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "p1",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """All metrics that need no order, in one pass; losses are negated, as scorers do."""
    evaluated = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull() & F.col(score).isNotNull())
    sums = evaluated.groupBy(*by).agg(*_counts(label, prediction, weight), *_losses(label, score, weight))
    rated = with_rates(sums)
    return rated.withColumns(
        {"neg_log_loss": -F.col("log_loss"), "neg_brier_score": -F.col("brier_score")}
    ).select(*by, "tp", "fp", "fn", "tn", *POINT_METRICS)


def curve_metrics(
    df: DataFrame,
    label: str = "label",
    score: str = "p1",
    by: Sequence[str] = (),
    weight: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
    max_ranges: int = MAX_RANGES,
) -> DataFrame:
    """ROC AUC, ties counting half, and average precision; NULL where undefined.

    Rows are first counted per distinct score, so a score that repeats, however
    often, is one row before anything is ordered. Both metrics are then sums over
    the running counts of positives and negatives from the highest score down.
    """
    evaluated = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    rows = _weight(weight)
    positive = F.col(label) == 1
    per_score = evaluated.groupBy(*by, score).agg(
        F.sum(F.when(positive, rows).otherwise(0)).alias("pos"),
        F.sum(F.when(positive, 0).otherwise(rows)).alias("neg"),
    )
    cuts = cut_points(evaluated, score, rows_per_range, max_ranges)
    running = descending_totals(per_score, score, {"tp": "pos", "fp": "neg"}, by, cuts)
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    sums = running.groupBy(*by).agg(
        F.sum(pos).alias("_pos"),
        F.sum(neg).alias("_neg"),
        F.sum(pos * fp).alias("_lost"),
        F.sum(pos * neg).alias("_tied"),
        F.sum(F.when(pos > 0, pos * tp / (tp + fp))).alias("_area"),
    )
    pairs = F.nullif(F.col("_pos") * F.col("_neg"), F.lit(0.0))
    return sums.select(
        *by,
        ((F.col("_pos") * F.col("_neg") - F.col("_lost") + F.col("_tied") / 2) / pairs).alias("roc_auc"),
        (F.col("_area") / F.nullif(F.col("_pos"), F.lit(0.0))).alias("average_precision"),
    )


def score_counts(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "p1",
    by: Sequence[str] = (),
    rows: str = "rows",
) -> DataFrame:
    """Rows per distinct (label, prediction, score): all that the metrics need.

    Write the result out when the score is costly, as a model's is: the metrics
    read their input more than once.
    """
    return df.groupBy(*by, label, prediction, score).agg(F.count(F.lit(1)).alias(rows))


def evaluate(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "p1",
    by: Sequence[str] = (),
    weight: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """All metrics as rows (group..., metric, value)."""
    points = point_metrics(df, label, prediction, score, by, weight)
    curves = curve_metrics(df, label, score, by, weight, rows_per_range)
    long_points = points.unpivot(list(by), list(POINT_METRICS), "metric", "value")
    return long_points.unionByName(curves.unpivot(list(by), list(CURVE_METRICS), "metric", "value"))


def confusion_matrix(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Rows per (actual class, predicted class)."""
    evaluated = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return evaluated.groupBy(
        *by,
        F.col(label).cast("string").alias("actual"),
        F.col(prediction).cast("string").alias("predicted"),
    ).agg(F.sum(_weight(weight)).alias("rows"))


def class_report(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Precision, recall, F1 and support per class, with their macro and weighted
    averages, and the accuracy, which stands in all three columns.

    The data is read once, down to the confusion matrix; each of its cells counts
    for its actual and for its predicted class, which needs no join.
    """
    cells = confusion_matrix(df, label, prediction, by, weight)
    sides = cells.select(
        *by,
        F.explode(
            F.array(
                F.struct(
                    F.col("actual").alias("class"),
                    F.col("rows").alias("actual_rows"),
                    F.lit(0).cast("long").alias("predicted_rows"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("rows")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("predicted").alias("class"),
                    F.lit(0).cast("long").alias("actual_rows"),
                    F.col("rows").alias("predicted_rows"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        ).alias("side"),
    ).select(*by, "side.*")
    per_class = (
        sides.groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("actual_rows", "predicted_rows", "hits")])
        .select(
            *by,
            "class",
            ratio(F.col("hits"), F.col("predicted_rows")).alias("precision"),
            ratio(F.col("hits"), F.col("actual_rows")).alias("recall"),
            ratio(2 * F.col("hits"), F.col("predicted_rows") + F.col("actual_rows")).alias("f1"),
            F.col("actual_rows").alias("support"),
        )
    )
    rates = ("precision", "recall", "f1")
    support = F.col("support")
    macro = per_class.groupBy(*by).agg(
        F.lit("macro avg").alias("class"),
        *[F.avg(c).alias(c) for c in rates],
        F.sum(support).alias("support"),
    )
    weighted = per_class.groupBy(*by).agg(
        F.lit("weighted avg").alias("class"),
        *[ratio(F.sum(F.col(c) * support), F.sum(support)).alias(c) for c in rates],
        F.sum(support).alias("support"),
    )
    accuracy = cells.groupBy(*by).agg(
        F.lit("accuracy").alias("class"),
        *[ratio(F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("rows")).otherwise(0)), F.sum("rows")).alias(c) for c in rates],
        F.sum("rows").alias("support"),
    )
    return per_class.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def training_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "p1",
    rows_per_range: int = ROWS_PER_RANGE,
    weight: str | None = None,
) -> DataFrame:
    """What a fit logs about its own training rows, as rows (metric, value).

    Precision, recall and F1 are averages over the classes, weighted by support.
    """
    averages = (
        class_report(df, label, prediction, weight=weight)
        .where(F.col("class") == "weighted avg")
        .select(
            F.col("precision").alias("training_precision_score"),
            F.col("recall").alias("training_recall_score"),
            F.col("f1").alias("training_f1_score"),
        )
    )
    points = point_metrics(df, label, prediction, score, weight=weight).select(
        F.col("accuracy").alias("training_accuracy_score"),
        (-F.col("neg_log_loss")).alias("training_log_loss"),
    )
    curves = curve_metrics(df, label, score, weight=weight, rows_per_range=rows_per_range).select(
        F.col("roc_auc").alias("training_roc_auc_score")
    )
    parts = [part.unpivot([], list(part.columns), "metric", "value") for part in (averages, points, curves)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _weight(weight: str | None) -> Column:
    return F.lit(1).cast("long") if weight is None else F.col(weight)


def _counts(label: str, prediction: str, weight: str | None) -> list[Column]:
    actual, predicted, rows = F.col(label) == 1, F.col(prediction) == 1, _weight(weight)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, rows).otherwise(0)), F.lit(0))

    return [
        total(actual & predicted).alias("tp"),
        total(~actual & predicted).alias("fp"),
        total(actual & ~predicted).alias("fn"),
        total(~actual & ~predicted).alias("tn"),
    ]


def _losses(label: str, score: str, weight: str | None) -> list[Column]:
    actual, p, rows = (F.col(label) == 1).cast("int"), F.col(score), _weight(weight)
    safe = F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP))
    log_term = F.when(actual == 1, F.ln(safe)).otherwise(F.ln(1 - safe))
    n = F.nullif(F.sum(rows).cast("double"), F.lit(0.0))
    return [
        (-F.sum(log_term * rows) / n).alias("log_loss"),
        (F.sum((p - actual) * (p - actual) * rows) / n).alias("brier_score"),
    ]
