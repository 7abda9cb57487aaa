from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from riskflow.operators import metrics
from riskflow.operators.ordering import cut_points
from riskflow.operators.ranking import best_candidate, fold_summary, rank_candidates, top_candidates


def scores(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int, p1 double")


def brute_auc(rows):
    pos = [p for label, _, p in rows if label == 1]
    neg = [p for label, _, p in rows if label == 0]
    if not pos or not neg:
        return None
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ap(rows):
    pos = sum(label for label, _, _ in rows)
    if not pos:
        return None
    total, before = 0.0, 0.0
    for cut in sorted({p for _, _, p in rows}, reverse=True):
        taken = [label for label, _, p in rows if p >= cut]
        recall, precision = sum(taken) / pos, sum(taken) / len(taken)
        total += (recall - before) * precision
        before = recall
    return total


def random_rows(seed, n=400, distinct=30):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        # A third of all rows share one score.
        p = 0.5 if rng.random() < 0.34 else rng.randrange(distinct) / distinct
        label = int(rng.random() < p)
        rows.append((label, int(p >= 0.5), p))
    return rows


@pytest.mark.parametrize("rows_per_range", [10_000, 40])
def test_curves_against_all_pairs(spark, rows_per_range):
    rows = random_rows(1)
    found = metrics.curve_metrics(scores(spark, rows), rows_per_range=rows_per_range, max_ranges=32).first()
    assert found["roc_auc"] == pytest.approx(brute_auc(rows))
    assert found["average_precision"] == pytest.approx(brute_ap(rows))


def test_curves_per_group_with_a_dominant_group(spark):
    parts = {"big": random_rows(2, 900, 200), "small": random_rows(3, 20), None: random_rows(4, 15)}
    rows = [(g, *r) for g, part in parts.items() for r in part]
    df = spark.createDataFrame(rows, "g string, label int, prediction int, p1 double")
    found = {r["g"]: r for r in metrics.curve_metrics(df, by=["g"], rows_per_range=50, max_ranges=64).collect()}
    for group, part in parts.items():
        assert found[group]["roc_auc"] == pytest.approx(brute_auc(part))
        assert found[group]["average_precision"] == pytest.approx(brute_ap(part))


def test_cut_points_spread_rows_that_crowd_in_value(spark):
    """Nearly all values lie close together; cuts follow the rows, not the value range."""
    df = spark.range(10_000).select((0.5 + F.col("id") / 1e9).alias("p1")).union(spark.createDataFrame([(1e9,)], "p1 double"))
    cuts = cut_points(df, "p1", rows_per_range=1000, max_ranges=64)
    assert 8 <= len(cuts) <= 11
    sizes = [df.where((F.col("p1") >= a) & (F.col("p1") < b)).count() for a, b in zip(cuts, cuts[1:])]
    assert max(sizes) < 2000


def test_one_class_has_no_auc(spark):
    found = metrics.curve_metrics(scores(spark, [(1, 1, 0.2), (1, 0, 0.7)])).first()
    assert found["roc_auc"] is None and found["average_precision"] == 1.0
    found = metrics.curve_metrics(scores(spark, [(0, 1, 0.2), (0, 0, 0.7)])).first()
    assert found["roc_auc"] is None and found["average_precision"] is None


def test_tied_scores_count_half(spark):
    assert metrics.curve_metrics(scores(spark, [(1, 1, 0.5), (0, 1, 0.5)])).first()["roc_auc"] == 0.5


def test_zero_denominators(spark):
    row = metrics.with_rates(metrics.confusion(scores(spark, [(1, 0, 0.1), (0, 0, 0.2)]))).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    assert row["balanced_accuracy"] == 0.5 and row["accuracy"] == 0.5


def test_balanced_accuracy_over_present_classes(spark):
    row = metrics.with_rates(metrics.confusion(scores(spark, [(1, 1, 0.9), (1, 0, 0.1)]))).first()
    assert row["balanced_accuracy"] == 0.5


def test_log_loss_is_clipped(spark):
    row = metrics.losses(scores(spark, [(1, 0, 0.0), (0, 0, 0.0)])).first()
    assert row["log_loss"] == pytest.approx(-math.log(1e-15) / 2)
    assert row["brier_score"] == 0.5


def test_empty_input(spark):
    empty = scores(spark, [])
    assert metrics.curve_metrics(empty).first()["roc_auc"] is None
    row = metrics.point_metrics(empty).first()
    assert row["tp"] == 0 and row["f1"] == 0.0 and row["neg_log_loss"] is None


def test_counts_stand_for_rows(spark):
    df = scores(spark, random_rows(5, 300))
    whole = {r["metric"]: r["value"] for r in metrics.evaluate(df).collect()}
    counted = {r["metric"]: r["value"] for r in metrics.evaluate(metrics.score_counts(df), weight="rows").collect()}
    assert set(whole) == set(metrics.POINT_METRICS + metrics.CURVE_METRICS)
    for name, value in whole.items():
        assert counted[name] == pytest.approx(value)


def test_class_report(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "label string, prediction string")
    found = {r["class"]: r for r in metrics.class_report(df).collect()}
    assert (found["a"]["precision"], found["a"]["recall"], found["a"]["support"]) == (0.5, 0.5, 2)
    assert (found["c"]["precision"], found["c"]["recall"], found["c"]["f1"]) == (0.0, 0.0, 0.0)
    assert found["macro avg"]["recall"] == pytest.approx(0.5)
    assert found["weighted avg"]["recall"] == pytest.approx(0.5)
    assert found["macro avg"]["support"] == 4
    assert {found["accuracy"][c] for c in ("precision", "recall", "f1")} == {0.5} and found["accuracy"]["support"] == 4


def test_training_metrics_of_a_perfect_fit(spark):
    found = {r["metric"]: r["value"] for r in metrics.training_metrics(scores(spark, [(1, 1, 0.9), (0, 0, 0.1)])).collect()}
    assert found["training_roc_auc_score"] == found["training_f1_score"] == found["training_accuracy_score"] == 1.0


def ranked(spark, means, **options):
    rows = [(i, "f1", float(m)) for i, m in enumerate(means)]
    return rank_candidates(spark.createDataFrame(rows, "candidate int, metric string, mean double"), **options)


@pytest.mark.parametrize("options", [{}, {"rows_per_range": 2, "max_ranges": 16}])
def test_ties_share_the_lowest_rank(spark, options):
    rows = ranked(spark, [0.90, 0.88, 0.87, 0.87, 0.87, 0.80], **options).collect()
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["candidate"])] == [1, 2, 3, 3, 3, 6]


def test_ranks_in_ranges_equal_ranks_in_one(spark):
    rng = random.Random(7)
    means = [rng.choice([0.1, 0.5, rng.random()]) for _ in range(300)]
    assert sorted(ranked(spark, means).collect()) == sorted(
        ranked(spark, means, rows_per_range=20, max_ranges=64).collect()
    )


def test_best_and_top(spark):
    ranks = ranked(spark, [0.5, 0.9, 0.9, 0.1, 0.7, 0.6, 0.2])
    assert [r["candidate"] for r in top_candidates(ranks, "f1").collect()] == [1, 2, 4, 5, 0]
    assert best_candidate(ranks).first()["candidate"] == 1


def test_fold_summary_is_population(spark):
    df = spark.createDataFrame([(0, "f1", 1.0), (0, "f1", 3.0)], "candidate int, metric string, value double")
    row = fold_summary(df).first()
    assert (row["mean"], row["std"]) == (2.0, 1.0)
