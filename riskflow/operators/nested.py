"""Scores of many forests from one: smaller forests that a large one holds.

A greedy tree is nested: it is grown from the root, and no split depends on what is below
it, so the tree of a smaller depth or a larger minimum split size is the same tree, cut.
And the first trees of a forest are a smaller forest. So one forest, fitted at the
largest depth and number of trees, holds those of every smaller setting, and one walk of
a row through its trees passes all their leaves.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.storage import Files, scratch_dir

MOST_NODES = 4_000_000  # of a forest that is sent to the tasks, about 200 MB
ROWS = 4096  # that are walked at once
SCORES = "candidate int, split string, label int, prediction int, p1 double, rows long"
TEST, TRAIN = "test", "train"


class Nodes(NamedTuple):
    """All nodes of a forest in flat arrays; children are places in them, -1 at leaves."""

    roots: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    rows: np.ndarray
    share: np.ndarray  # of each of the two classes


class Setting(NamedTuple):
    candidate: int
    trees: int
    depth: int
    min_split: int


def nodes_of(model: RandomForestClassificationModel, most: int = MOST_NODES) -> Nodes | None:
    """The forest's nodes, or None if they are more than `most`, of more than two classes,
    or split by categories."""
    if model.totalNumNodes > most or model.numClasses != 2:
        return None
    spark = SparkSession.active()
    place = scratch_dir(spark, "forest")
    model.write().save(place)
    saved = spark.read.parquet(f"{place}/data")
    node = next(f.name for f in saved.schema if isinstance(f.dataType, T.StructType))
    split = F.col(node)["split"]
    columns = {
        "tree": F.col("treeID"),
        "id": F.col(node)["id"],
        "left": F.col(node)["leftChild"],
        "right": F.col(node)["rightChild"],
        "feature": split["featureIndex"],
        "threshold": F.try_element_at(split["leftCategoriesOrThreshold"], F.lit(1)),
        "categories": split["numCategories"],
        "rows": F.col(node)["rawCount"],
        "first": F.col(node)["impurityStats"][0],
        "second": F.col(node)["impurityStats"][1],
    }
    found = saved.select(*[c.alias(n) for n, c in columns.items()]).toArrow().sort_by([("tree", "ascending"), ("id", "ascending")])
    Files(spark, place).delete(place)
    tree, ident, left, right, categories, rows = (np.asarray(found[c]).astype(np.int64) for c in ("tree", "id", "left", "right", "categories", "rows"))
    inner = left >= 0
    if (categories[inner] >= 0).any():
        return None
    start = np.searchsorted(tree, np.arange(tree[-1] + 1))
    assert (ident == np.arange(len(tree)) - start[tree]).all(), "ids of a tree's nodes count from its root"
    stats = np.stack([np.asarray(found[c]) for c in ("first", "second")], axis=1)
    return Nodes(
        start,
        np.where(inner, left + start[tree], -1).astype(np.int32),
        np.where(inner, right + start[tree], -1).astype(np.int32),
        np.where(inner, np.asarray(found["feature"]), 0).astype(np.int32),
        np.where(inner, np.asarray(found["threshold"]), 0.0),
        rows,
        stats / (stats[:, :1] + stats[:, 1:]),
    )


def stops(nodes: Nodes, least: int) -> np.ndarray:
    """For each node where a walk to it ends if nodes of fewer rows than `least` are leaves:
    the first such node on the way from its root, or itself."""
    ends = np.arange(len(nodes.left), dtype=np.int32)
    at = nodes.roots
    while len(at):
        at = at[nodes.left[at] >= 0]
        above = ends[at]
        cut = (above != at) | (nodes.rows[at] < least)
        for child in (nodes.left[at], nodes.right[at]):
            ends[child] = np.where(cut, above, child)
        at = np.concatenate([nodes.left[at], nodes.right[at]])
    return ends


class Walker:
    """What all walks through a forest share, worked out once: the next node by side, leaves
    leading to themselves, and for each split size the nodes that walks end at."""

    def __init__(self, nodes: Nodes, settings: Sequence[Setting]):
        self.nodes, inner, own = nodes, nodes.left >= 0, np.arange(len(nodes.left), dtype=np.int32)
        self.next = np.stack([np.where(inner, nodes.right, own), np.where(inner, nodes.left, own)], axis=1).reshape(-1)
        self.depths = sorted({s.depth for s in settings})
        self.sizes = sorted({s.min_split for s in settings})
        self.stops = [stops(nodes, least) for least in self.sizes]
        self.by_trees: dict[int, list[Setting]] = {}
        for s in settings:
            self.by_trees.setdefault(s.trees, []).append(s)

    def walk(self, inputs: np.ndarray) -> Iterator[tuple[Setting, np.ndarray]]:
        """For each setting the votes for both classes of each row: the class shares of the
        leaves, summed over its trees in their order."""
        nodes, flat = self.nodes, np.ascontiguousarray(inputs).reshape(-1)
        start = np.arange(len(inputs)) * inputs.shape[1]
        votes = np.zeros((len(self.depths), len(self.sizes), len(inputs), 2))
        for number, root in enumerate(nodes.roots[: max(self.by_trees)], start=1):
            at, level = np.full(len(inputs), root), 0
            for d, depth in enumerate(self.depths):
                while level < depth:
                    goes_left = flat.take(start + nodes.feature.take(at)) <= nodes.threshold.take(at)
                    below = self.next.take(2 * at + goes_left)
                    if (below == at).all():
                        level = depth
                        break
                    at, level = below.astype(np.int64), level + 1
                for i, ends in enumerate(self.stops):
                    votes[d, i] += nodes.share.take(ends.take(at), axis=0)
            for s in self.by_trees.get(number, ()):
                yield s, votes[self.depths.index(s.depth), self.sizes.index(s.min_split)].copy()


def walk(nodes: Nodes, inputs: np.ndarray, settings: Sequence[Setting]) -> Iterator[tuple[Setting, np.ndarray]]:
    return Walker(nodes, settings).walk(inputs)


def counted_scores(
    data: DataFrame,
    nodes: Nodes,
    settings: Sequence[Setting],
    vector: str,
    label: str,
    is_test: Column,
) -> DataFrame:
    """Rows per (candidate, split, label, prediction, p1), for every setting, in one pass.

    The forest is sent to the tasks once. Prediction and probability are what the
    library's model gives for the cut forest, to the last bit: sums in the trees' order,
    then one division.
    """
    sent = data.sparkSession.sparkContext.broadcast(nodes)

    def run(batches) -> Iterator[pa.RecordBatch]:
        walker = Walker(sent.value, settings)
        for batch in batches:
            width = len(batch.column(0).slice(0, 1).flatten()) if batch.num_rows else 0
            inputs = np.asarray(batch.column(0).flatten()).reshape(-1, width)
            labels = np.asarray(batch.column(1)).astype(np.int64)
            tested = np.asarray(batch.column(2).cast(pa.int8())).astype(np.int64)
            for start in range(0, batch.num_rows, ROWS):
                part = slice(start, start + ROWS)
                for setting, votes in walker.walk(inputs[part]):
                    p1 = votes[:, 1] / (votes[:, 0] + votes[:, 1])
                    prediction = votes.argmax(axis=1)
                    kind = tested[part] * 4 + labels[part] * 2 + prediction
                    yield _counts(setting.candidate, kind, p1)

    given = data.select(vector_to_array(vector).alias("v"), F.col(label).cast("int").alias("label"), is_test.alias("tested"))
    found = given.mapInArrow(run, SCORES)
    names = ("candidate", "split", "label", "prediction", "p1")
    return found.groupBy(*names).agg(F.sum("rows").alias("rows"))


def _counts(candidate: int, kind: np.ndarray, p1: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((p1, kind))
    kind, p1 = kind[order], p1[order]
    first = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | (p1[1:] != p1[:-1])]))
    rows = np.diff(np.concatenate([first, [len(kind)]]))
    kind, p1 = kind[first], p1[first]
    columns = [
        pa.array(np.full(len(kind), candidate, np.int32)),
        pa.array(np.where(kind >= 4, TEST, TRAIN).tolist(), pa.string()),
        pa.array((kind // 2 % 2).astype(np.int32)),
        pa.array((kind % 2).astype(np.int32)),
        pa.array(p1),
        pa.array(rows.astype(np.int64)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["candidate", "split", "label", "prediction", "p1", "rows"])
