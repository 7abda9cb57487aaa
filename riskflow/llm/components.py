"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Stored
from riskflow.storage import Files


SALTS = 8  # tasks that share the links of a hub


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Links joined to the least neighbour of their node, which is there once per salt."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    copies = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, ["a", "salt"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node ties its larger neighbours to the smallest node it knows."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return _with_least(both.where("b > a"), least).select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = _with_least(down, least).where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b")))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """Columns a (node) and b (smallest node of its component), for every node that is
    linked to a smaller one.

    `edges` has columns a and b of one comparable type; direction, repeats and loops do
    not matter. A round is two star operations; a hub's links meet the one row of its least
    neighbour in several tasks, by salt. Rounds grow with the logarithm of the longest
    chain. Each round is a table in the shared folder and the one before is removed.
    """
    spark = edges.sparkSession
    current = Stored(edges.where("a <> b").distinct(), "links")
    before = None
    while (now := _state(current.frame)) != before:
        if not now[0]:
            break
        after = Stored(_small_star(_large_star(current.frame)).distinct(), "links")
        Files(spark, current.path).delete(current.path)
        current, before = after, now
    return current.frame
