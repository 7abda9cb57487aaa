"""Random-forest training and scoring on executors."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from typing import Any, Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.hashing import HASH_SPACE, key_hash
from riskflow.operators.encode import assembler
from riskflow.operators.split import with_class_weights
from riskflow.schemas import FEATURES, LABEL, OUTPUTS, quoted
from riskflow.storage import Files, scratch_dir, written

VECTOR = "features"
WEIGHT = "weight"
ROWS_PER_PARTITION = 10_000
FEW_PARTITIONS = 24  # beyond these a partition has more rows
MANY_ROWS = 100_000
MAX_PARTITIONS = 512


@dataclass(frozen=True)
class ForestParams:
    """Forest settings; the defaults are the fixed values of the production model."""

    trees: int = 125
    depth: int = 10
    min_leaf: int = 3
    seed: int = 7
    subset: str = "sqrt"
    bins: int = 32
    min_split: int = 2

    def as_row(self) -> dict[str, str]:
        return {k: str(v) for k, v in asdict(self).items()}


class ForestModel(RandomForestClassificationModel):
    """The library's model, with trees wrapped for Python only when asked for.

    The parent wraps every tree as soon as it is created, which on a small
    training set takes as long as the fit and holds the interpreter lock.
    """

    @property
    def trees(self) -> list[DecisionTreeClassificationModel]:
        return [DecisionTreeClassificationModel(tree) for tree in self._call_java("trees")]


class Forest(RandomForestClassifier):
    def _create_model(self, java_model: Any) -> ForestModel:
        return ForestModel(java_model)


def forest(
    params: ForestParams = ForestParams(),
    label: str = LABEL,
    weight: str | None = WEIGHT,
    cache_nodes: bool = True,
) -> Forest:
    """A gini forest with bootstrap samples and per-node feature subsets.

    Node ids are cached and checkpointed: on deep trees that replaces a walk from
    the root for every row and level, and is not worth its jobs on a few rows. 512 MB of split statistics per pass lets
    many nodes be split in each scan of the data.
    """
    estimator = Forest(
        featuresCol=VECTOR,
        labelCol=label,
        numTrees=params.trees,
        impurity="gini",
        maxDepth=params.depth,
        minInstancesPerNode=params.min_leaf,
        featureSubsetStrategy=params.subset,
        maxBins=params.bins,
        bootstrap=True,
        seed=params.seed,
        cacheNodeIds=cache_nodes,
        maxMemoryInMB=512,
    )
    return estimator.setWeightCol(weight) if weight else estimator


def partition_count(rows: int) -> int:
    """Partitions of 10,000 rows, up to 24; then as many rows in each, up to 100,000; then more of those."""
    few = min(FEW_PARTITIONS, 1 + rows // ROWS_PER_PARTITION)
    return min(MAX_PARTITIONS, max(few, 1 + rows // MANY_ROWS))


def fit_partitions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by the hash of their keys into a number of partitions that follows from
    their count, in key order.

    Bootstrap samples are drawn per partition, so this makes a forest depend on its rows
    and seed alone, not on the cluster. Every partition sets up and sends the split
    statistics of all nodes of a level, up to `maxMemoryInMB`, however few its rows are:
    beyond the first partitions, each has ten times the rows, and the number is bounded.
    """
    count = partition_count(df.count())
    names = [quoted(k) for k in keys]
    return df.repartition(count, *names).sortWithinPartitions(*names)


def bounded_sample(df: DataFrame, key: str, most_rows: int | None, seed: int = 10) -> DataFrame:
    """About `most_rows` rows, chosen by the hash of the key; all rows if None or fewer."""
    if most_rows is None:
        return df
    share = most_rows / max(df.count(), 1)
    if share >= 1:
        return df
    return df.where(F.coalesce(key_hash(F.col(quoted(key)), seed) < int(share * HASH_SPACE), F.lit(False)))


def fit_forest(
    train: DataFrame,
    params: ForestParams = ForestParams(),
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    handle_invalid: str = "error",
    key: str | None = None,
    most_rows: int | None = None,
) -> PipelineModel:
    """Assembler and forest, fitted with balanced class weights.

    The labelled vectors are written once, so that neither the encoding nor the deal
    is done again for class counts and passes over the trees. With a `key`, `most_rows`
    bounds the rows that are fitted (default: all).
    """
    chosen = bounded_sample(train, key, most_rows) if key else train
    order = F.col(quoted(key)) if key else F.xxhash64(*[quoted(c) for c in (*features, label)])
    vectors = assembler(features, VECTOR, handle_invalid)
    encoded = written(vectors.transform(chosen).select(quoted(label), VECTOR, order.alias("_order")), "fit")
    dealt = fit_partitions(encoded, ["_order"])
    model = fit_vectors(with_class_weights(dealt, label, WEIGHT), params, label)
    return PipelineModel([vectors, model])


def fit_vectors(weighted: DataFrame, params: ForestParams, label: str = LABEL) -> RandomForestClassificationModel:
    """A forest from vectors and weights; nodes below the minimum split size become leaves."""
    model = forest(params, label).fit(weighted)
    return pruned(model, params.min_split) if params.min_split > 2 else model


def pruned(model: RandomForestClassificationModel, min_split: int) -> RandomForestClassificationModel:
    """The forest that a greedy fit with a minimum split size would have grown.

    Trees are grown from the root and a split does not depend on what is below it, so
    a node with fewer rows (of its tree's sample) than the minimum is made a leaf. The
    saved node table has those rows; nodes that nothing leads to any more are ignored
    when it is loaded.
    """
    spark = SparkSession.active()
    whole, cut = scratch_dir(spark, "forest"), scratch_dir(spark, "forest")
    model.write().save(whole)
    files = Files(spark, whole)
    nodes = spark.read.parquet(f"{whole}/data")
    node = next(f.name for f in nodes.schema if isinstance(f.dataType, T.StructType))
    leaf = F.col(node).withField("leftChild", F.lit(-1)).withField("rightChild", F.lit(-1)).withField("gain", F.lit(-1.0))
    small = F.col(f"{node}.rawCount") < min_split
    nodes.withColumn(node, F.when(small, leaf).otherwise(F.col(node))).select(*nodes.columns).write.parquet(f"{cut}/data")
    for part in files.names(whole):
        if part != "data":
            files.copy(f"{whole}/{part}", f"{cut}/{part}")
    return RandomForestClassificationModel.load(cut)


def class_probability(index: int, column: str = "probability") -> Column:
    """P(class `index`) from a probability vector."""
    return vector_to_array(F.col(column))[index]


def score(df: DataFrame, model: Model) -> DataFrame:
    """Append class and both class probabilities to each row.

    A projection on the executors: rows keep their columns, so nothing has to be
    collected or aligned afterwards. Columns of the same names are replaced.
    """
    kept = [c for c in df.columns if c not in OUTPUTS]
    scored = model.transform(df.drop(*OUTPUTS))
    outcome, negative, positive = OUTPUTS
    return scored.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("prediction").cast("int").alias(outcome),
        class_probability(0).alias(negative),
        class_probability(1).alias(positive),
    )
