"""Running totals and ranks over a global order, without one task per order.

A window ordered over all rows, or over one big group, is a single task. Here the
order is cut at quantiles into ranges of bounded size, each range is handled by
its own task, and the totals of the ranges before it are added.
"""

from __future__ import annotations

import math
from typing import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.functions.hashing import hash_range

ROWS_PER_RANGE = 2_000_000
MAX_RANGES = 4096
_RANGE = "_range"
_GROUP = "_group"


def cut_points(
    df: DataFrame,
    value: str,
    rows_per_range: int = ROWS_PER_RANGE,
    max_ranges: int = MAX_RANGES,
) -> list[float]:
    """Values that cut the rows into ranges of about `rows_per_range` rows.

    One pass with a mergeable quantile sketch; at most `max_ranges` numbers come
    back (8e9 distinct values at the defaults; give more ranges beyond that). Empty when the rows fit in one range. Equal values never straddle a cut.
    """
    # One text literal cast to an array: thousands of literal nodes are slow to plan.
    steps = F.split(F.lit(",".join(str(i / max_ranges) for i in range(1, max_ranges))), ",")
    found = df.where(F.col(value).isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"),
        F.percentile_approx(F.col(value).cast("double"), steps.cast("array<double>"), 4 * max_ranges).alias("cuts"),
    ).first()
    ranges = min(max_ranges, -(-found["rows"] // rows_per_range))
    if ranges < 2:
        return []
    cuts = found["cuts"]
    chosen = {cuts[min(len(cuts), round(i * max_ranges / ranges)) - 1] for i in range(1, ranges)}
    return sorted(c for c in chosen if math.isfinite(c))


def in_ranges(df: DataFrame, value: str, cuts: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Append the range number of a value, and the group as one never-NULL struct.

    The search over the cuts runs in the JVM; a NULL value comes below all ranges.
    With keys that are never NULL, windows and joins on them share one exchange.
    """
    finder = Bucketizer(
        splits=[float("-inf"), *cuts, float("inf")],
        inputCol=value,
        outputCol="_found",
        handleInvalid="keep",
    )
    group = F.struct(*by) if by else F.lit(0)
    found = F.when(F.col(value).isNull(), -1).otherwise(F.coalesce(F.col("_found").cast("int"), F.lit(-1)))
    return finder.transform(df).withColumns({_RANGE: found, _GROUP: group}).drop("_found")


def descending_totals(
    df: DataFrame,
    value: str,
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    cuts: Sequence[float] = (),
) -> DataFrame:
    """Append running sums from the highest value down, own row included.

    `sums` maps new columns to the columns they add up; values are unique per group.
    """
    descending = F.col(value).desc_nulls_last()
    if not cuts:
        window = Window.partitionBy(*by).orderBy(descending).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({new: F.sum(c).over(window) for new, c in sums.items()})
    ranged = in_ranges(df, value, cuts, by)
    local = Window.partitionBy(_GROUP, _RANGE).orderBy(descending).rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.withColumns({new: F.sum(c).over(local) for new, c in sums.items()})
    higher = _totals_above(ranged, {new: F.sum(c) for new, c in sums.items()})
    joined = _join_above(running, higher)
    return joined.select(
        *df.columns,
        *[(running[new] + F.coalesce(higher[f"_above_{new}"], F.lit(0))).alias(new) for new in sums],
    )


def descending_rank(
    df: DataFrame,
    value: str,
    rank: str,
    by: Sequence[str] = (),
    cuts: Sequence[float] = (),
) -> DataFrame:
    """Append the rank of a value within its group, best first; ties share the lowest."""
    descending = F.col(value).desc_nulls_last()
    if not cuts:
        return df.withColumn(rank, F.rank().over(Window.partitionBy(*by).orderBy(descending)))
    ranged = in_ranges(df, value, cuts, by)
    local = Window.partitionBy(_GROUP, _RANGE).orderBy(descending)
    ranked = ranged.withColumn(rank, F.rank().over(local))
    higher = _totals_above(ranged, {rank: F.count(F.lit(1))})
    joined = _join_above(ranked, higher)
    shifted = ranked[rank] + F.coalesce(higher[f"_above_{rank}"], F.lit(0))
    return joined.select(*[ranked[c] for c in df.columns], shifted.cast("int").alias(rank))


def _totals_above(ranged: DataFrame, totals: Mapping[str, Column]) -> DataFrame:
    """Per group and range, the totals of all higher ranges: groups * ranges rows at most."""
    keys = [F.col(c).alias(f"_of{c}") for c in (_GROUP, _RANGE)]
    grouped = ranged.groupBy(*keys).agg(*[total.alias(f"_sum_{new}") for new, total in totals.items()])
    above = (
        Window.partitionBy(f"_of{_GROUP}")
        .orderBy(F.col(f"_of{_RANGE}").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return grouped.select(
        f"_of{_GROUP}",
        f"_of{_RANGE}",
        *[F.sum(f"_sum_{new}").over(above).alias(f"_above_{new}") for new in totals],
    )


def _join_above(local: DataFrame, higher: DataFrame) -> DataFrame:
    return local.join(
        higher,
        (local[_GROUP] == higher[f"_of{_GROUP}"]) & (local[_RANGE] == higher[f"_of{_RANGE}"]),
    )


def numbered(df: DataFrame, hashed: Column, ties: Sequence[str], number: str, ranges: int = 4096, by: str | None = None) -> DataFrame:
    """Append 0, 1, 2... in the order of a 32-bit hash, then of the `ties` columns; for
    each value of the column `by`, if given.

    Rows are numbered within slices of the hash space and shifted by the rows of the
    slices before; those totals are at most `ranges` rows.
    """
    group = F.lit("") if by is None else F.col(by)
    sliced = df.withColumns({"_hash": hashed, "_by": group}).withColumn("_slice", hash_range(F.col("_hash"), ranges))
    local = sliced.withColumn("_local", F.row_number().over(Window.partitionBy("_by", "_slice").orderBy("_hash", *ties)))
    totals = sliced.groupBy(F.col("_by").alias("_of_by"), F.col("_slice").alias("_of")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_of_by").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_of_by", "_of", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    joined = local.join(shifts, (local["_slice"] == shifts["_of"]) & (local["_by"] == shifts["_of_by"]))
    return joined.select(*df.columns, (F.col("_shift") + F.col("_local") - 1).alias(number))
