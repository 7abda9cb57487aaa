from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from riskflow.operators.split import class_counts, held_out, split, with_class_weights, with_folds


def test_split_ignores_partitioning(spark):
    ids = spark.range(5000)
    _, test = split(ids, "id")
    _, moved = split(ids.repartition(17).orderBy(F.desc("id")), "id")
    first, second = ({r[0] for r in t.collect()} for t in (test, moved))
    assert first == second and 900 < len(first) < 1100


def test_split_depends_on_the_seed(spark):
    ids = spark.range(1000)
    shares = [{r[0] for r in ids.where(held_out(F.col("id"), 20, s)).collect()} for s in (1, 2)]
    assert shares[0] != shares[1]


def test_split_is_narrow(spark):
    plan = split(spark.range(10), "id")[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def _labelled(spark):
    """One class holds nine of ten rows, one label is NULL."""
    return spark.range(2003).select(
        "id", F.when(F.col("id") == 0, None).when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("label")
    )


def test_folds_are_exact(spark):
    for ranges in (1, 16, 4096):
        folded = with_folds(_labelled(spark), "label", "id", folds=10, ranges=ranges)
        sizes = Counter((r["label"], r["fold"]) for r in folded.collect())
        for label in ("rare", "common"):
            counts = [sizes[label, f] for f in range(10)]
            assert max(counts) - min(counts) <= 1
        assert sum(sizes.values()) == 2003 and sizes[None, 0] == 1


def test_folds_do_not_depend_on_ranges_or_partitioning(spark):
    one = with_folds(_labelled(spark), "label", "id", ranges=1).collect()
    many = with_folds(_labelled(spark).repartition(13), "label", "id", ranges=64).collect()
    assert sorted(one, key=lambda r: r["id"]) == sorted(many, key=lambda r: r["id"])


def test_weights_balance_the_classes(spark):
    weighted = with_class_weights(_labelled(spark), "label")
    totals = {r["label"]: r["w"] for r in weighted.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert abs(totals["rare"] - totals["common"]) < 1e-6 and abs(totals["rare"] - 2002 / 2) < 1e-6


def test_many_classes_are_joined_instead(spark):
    labels = _labelled(spark)
    assert class_counts(labels, "label", max_classes=1) is None
    joined = with_class_weights(labels, "label", max_classes=1)
    literal = with_class_weights(labels, "label")
    assert sorted(joined.select("id", "weight").collect()) == sorted(literal.select("id", "weight").collect())


def _without_some_keys(spark):
    return _labelled(spark).withColumn("key", F.when(F.col("id") % 5 != 0, F.col("id")))


def test_rows_without_a_key_are_kept(spark):
    data = _without_some_keys(spark)
    train, test = split(data, "key")
    assert train.count() + test.count() == 2003
    assert train.where("key IS NULL").count() == 401 and test.where("key IS NULL").count() == 0
    folded = with_folds(data, "label", "key", folds=10)
    sizes = Counter((r["label"], r["fold"]) for r in folded.collect())
    assert sum(sizes.values()) == 2003
    for label in ("rare", "common"):
        counts = [sizes[label, f] for f in range(10)]
        assert max(counts) - min(counts) <= 1


def test_class_weights_are_equal_to_the_last_digit(spark):
    data = spark.range(1000).select("id", F.concat(F.lit("c"), (F.col("id") % 7 % 3).cast("string")).alias("label"))
    joined, literal = (with_class_weights(data, "label", max_classes=n).select("id", "weight").collect() for n in (1, 1000))
    assert sorted(joined) == sorted(literal)
