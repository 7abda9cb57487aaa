"""Hash split, class weights and stratified folds."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.functions.hashing import hash_range, key_hash


def held_out(key: Column, percent: int = 20, seed: int = 10) -> Column:
    """True for the test share of the keys, never NULL: rows without a key train.

    Narrow: depends on the key alone.
    """
    return F.coalesce(key_hash(key, seed) % 100 < percent, F.lit(False))


def split(df: DataFrame, key: str, percent: int = 20, seed: int = 10) -> tuple[DataFrame, DataFrame]:
    """Train and test frames, together all rows. Give the key column unique values."""
    test = held_out(F.col(key), percent, seed)
    return df.where(~test), df.where(test)


def class_counts(df: DataFrame, label: str, max_classes: int = 1000) -> dict[Any, int] | None:
    """Rows per class, or None when there are more classes than `max_classes`."""
    rows = df.where(F.col(label).isNotNull()).groupBy(label).count().limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        return None
    return {r[label]: r["count"] for r in rows}


def balanced_weight(label: Column, counts: dict[Any, int]) -> Column:
    """n / (classes * rows of the class), from known counts, as a map lookup."""
    total = sum(counts.values())
    entries = [F.lit(x) for c, n in counts.items() for x in (c, total / (len(counts) * n))]
    return F.create_map(*entries)[label]


def with_class_weights(df: DataFrame, label: str, weight: str = "weight", max_classes: int = 1000) -> DataFrame:
    """Append balanced class weights; a row without a label has none.

    With few classes the counts become literals and the rows are never moved, so
    a class holding most rows costs nothing. Beyond the bound the counts are
    joined on the label, with the same formula, and AQE chooses the strategy.
    """
    counts = class_counts(df, label, max_classes)
    if counts is not None:
        if not counts:
            return df.withColumn(weight, F.lit(None).cast("double"))
        return df.withColumn(weight, balanced_weight(F.col(label), counts))
    per_class = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_rows"))
    total = per_class.agg(F.sum("_rows").alias("n"), F.count(F.lit(1)).alias("k")).first()
    share = per_class.select(label, (F.lit(float(total["n"])) / (F.lit(total["k"]) * F.col("_rows"))).alias(weight))
    return df.join(share, [label], "left")


def with_folds(
    df: DataFrame,
    label: str,
    key: str,
    folds: int = 10,
    seed: int = 10,
    fold: str = "fold",
    ranges: int = 4096,
) -> DataFrame:
    """Append an exact stratified fold number.

    Rows of a class are ordered by key hash and dealt out in turn, so fold sizes
    differ by at most one row per class. The order is cut into `ranges` slices
    of the hash space, numbered in parallel within (label, slice) and shifted by
    the class's row count in earlier slices; a single dominant class is spread
    over all slices. The slice totals are at most classes * ranges rows. Rows
    without a key or a label are dealt out too: the hash of all their values
    stands for the key, and NULL is a class.
    """
    hash_ = F.coalesce(key_hash(F.col(key), seed), key_hash(F.xxhash64(*df.columns), seed))
    hashed = df.withColumns({"_hash": hash_, "_class": F.struct(label)})
    sliced = hashed.withColumn("_slice", hash_range(F.col("_hash"), ranges))
    within = Window.partitionBy("_class", "_slice").orderBy("_hash", key)
    numbered = sliced.withColumn("_number", F.row_number().over(within))
    totals = sliced.groupBy(F.col("_class").alias("_of_class"), F.col("_slice").alias("_of_slice")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    earlier = Window.partitionBy("_of_class").orderBy("_of_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        "_of_class",
        "_of_slice",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"),
    )
    joined = numbered.join(
        shifts,
        (numbered["_class"] == shifts["_of_class"]) & (numbered["_slice"] == shifts["_of_slice"]),
    )
    position = F.col("_shift") + F.col("_number") - 1
    return joined.select(*df.columns, (position % folds).cast("int").alias(fold))
