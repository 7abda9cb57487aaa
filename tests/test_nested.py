"""Scores of forests that a larger one holds, against cut models that Spark scores."""

from __future__ import annotations

import json
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from riskflow.operators import nested, search
from riskflow.operators.encode import assembler
from riskflow.operators.forest import VECTOR, ForestParams, class_probability, fit_forest
from riskflow.operators.metrics import score_counts
from riskflow.schemas import FEATURES, KEY, LABEL
from tests.test_model import features, labelled  # noqa: F401  (fixtures)

LARGE = ForestParams(trees=9, depth=8, min_leaf=1)


def cut(spark, model, place: str, setting: nested.Setting) -> RandomForestClassificationModel:
    """The model's first trees, with nodes at the depth or below the split size made leaves."""
    model.write().overwrite().save(f"{place}/whole")
    saved = spark.read.parquet(f"{place}/whole/data")
    rows = [r.asDict(recursive=True) for r in saved.where(F.col("treeID") < setting.trees).collect()]
    nodes = {(r["treeID"], r["nodeData"]["id"]): r["nodeData"] for r in rows}
    depth = {(t, i): 0 for t, i in nodes if i == 0}
    for t, i in sorted(nodes):  # ids are in preorder: parents come first
        for child in ("leftChild", "rightChild"):
            if nodes[t, i][child] >= 0:
                depth[t, nodes[t, i][child]] = depth[t, i] + 1
    for key, node in nodes.items():
        if depth[key] >= setting.depth or node["rawCount"] < setting.min_split:
            node.update(leftChild=-1, rightChild=-1, gain=-1.0)
    spark.createDataFrame(rows, saved.schema).write.parquet(f"{place}/cut/data")
    spark.read.parquet(f"{place}/whole/treesMetadata").where(F.col("_1") < setting.trees).write.parquet(f"{place}/cut/treesMetadata")
    (part,) = Path(f"{place}/whole/metadata").glob("part*.txt")
    told = json.loads(part.read_text())
    told["numTrees"] = told["paramMap"]["numTrees"] = setting.trees
    spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.text(f"{place}/cut/metadata")
    return RandomForestClassificationModel.load(f"{place}/cut")


def test_every_part_scores_as_the_cut_model(spark, features, place):  # noqa: F811
    """Predictions and probabilities, to the last bit, at 24 points of a grid."""
    vectors = assembler(FEATURES, VECTOR).transform(features)
    model = fit_forest(features, LARGE).stages[-1]
    settings = [nested.Setting(i, *s) for i, s in enumerate((t, d, m) for t in (1, 4, 9) for d in (1, 3, 8, 25) for m in (2, 40))]
    assert len(settings) == 24
    is_test = F.col("age") > 50
    found = nested.counted_scores(vectors, nested.nodes_of(model), settings, VECTOR, LABEL, is_test).collect()
    by_candidate: dict[int, set] = {}
    for r in found:
        by_candidate.setdefault(r["candidate"], set()).add((r["split"], r["label"], r["prediction"], r["p1"], r["rows"]))
    for s in settings:
        scored = cut(spark, model, f"{place}/{s.candidate}", s).transform(vectors).select(
            F.when(is_test, "test").otherwise("train").alias("split"),
            F.col(LABEL).cast("int").alias("label"),
            F.col("prediction").cast("int").alias("prediction"),
            class_probability(1).alias("p1"),
        )
        assert by_candidate[s.candidate] == {tuple(r) for r in score_counts(scored, by=["split"]).collect()}, s
    assert len({frozenset(v) for v in by_candidate.values()}) > 12  # the settings do differ


def test_walk_by_hand():
    """Two trees of two levels, followed on paper."""
    nodes = nested.Nodes(
        np.array([0, 5]),
        np.array([1, -1, 3, -1, -1, -1]),
        np.array([2, -1, 4, -1, -1, -1]),
        np.array([0, 0, 1, 0, 0, 0]),
        np.array([0.5, 0, 2.0, 0, 0, 0]),
        np.array([10, 4, 6, 2, 4, 10]),
        np.array([[0.5, 0.5], [1, 0], [0.25, 0.75], [1, 0], [0, 1], [0.4, 0.6]]),
    )
    inputs = np.array([[0.0, 9.0], [1.0, 2.0], [1.0, 2.5]])
    settings = [nested.Setting(i, *s) for i, s in enumerate([(1, 0, 2), (1, 1, 2), (1, 2, 2), (1, 2, 7), (2, 2, 2)])]
    votes = {s.candidate: v[:, 1].tolist() for s, v in nested.walk(nodes, inputs, settings)}
    assert votes == {0: [0.5, 0.5, 0.5], 1: [0, 0.75, 0.75], 2: [0, 0, 1], 3: [0, 0.75, 0.75], 4: [0.6, 0.6, 1.6]}


def test_empty_batches(spark, features):  # noqa: F811
    vectors = assembler(FEATURES, VECTOR).transform(features)
    nodes = nested.nodes_of(fit_forest(features, replace(LARGE, trees=2)).stages[-1])
    none = nested.counted_scores(vectors.where("age < 0"), nodes, [nested.Setting(0, 2, 3, 2)], VECTOR, LABEL, F.lit(True))
    assert none.count() == 0


def test_one_fit_serves_depths_trees_and_split_sizes(spark, features, place, monkeypatch):  # noqa: F811
    """Fits are made per leaf size and fold alone; forests too large to send are fitted one by one."""
    fits = []
    real = search.forest
    monkeypatch.setattr(search, "forest", lambda *a: fits.append(a[0]) or real(*a))
    levels = {"n_estimators": (2, 4), "min_samples_split": (2, 50), "min_samples_leaf": (1, 3), "max_depth": (2, 6)}
    grid = search.forest_grid(levels)
    found = search.grid_search(features, grid, f"{place}/one", KEY, folds=2)
    assert sorted((p.min_leaf, p.trees, p.depth) for p in fits) == [(1, 4, 6)] * 2 + [(3, 4, 6)] * 2
    assert found.fold_metrics.select("candidate", "fold").distinct().count() == 16 * 2
    whole = {(r["candidate"], r["split"], r["metric"]): r["mean"] for r in found.summary.collect()}
    deepest = [i for i, p in enumerate(grid) if (p.trees, p.depth, p.min_split) == (4, 6, 2)]
    monkeypatch.setattr(search, "nodes_of", lambda model: None)
    each = search.grid_search(features, grid, f"{place}/each", KEY, folds=2)
    apart = {(r["candidate"], r["split"], r["metric"]): r["mean"] for r in each.summary.collect()}
    assert apart.keys() == whole.keys()
    for key in apart:  # the deepest forests are the same either way
        if key[0] in deepest and not key[2].endswith("_time"):
            assert apart[key] == pytest.approx(whole[key], abs=1e-9), key


def test_forests_that_are_not_sent(features):  # noqa: F811
    model = fit_forest(features, replace(LARGE, trees=2)).stages[-1]
    assert nested.nodes_of(model, most=3) is None and nested.nodes_of(model) is not None


def test_walk_is_worked_out_once(monkeypatch):
    """Where walks end by split size follows from the forest alone, not anew for each batch of rows."""
    leaf = -1
    nodes = nested.Nodes(
        np.array([0]),
        np.array([1, 2, leaf, leaf, leaf], np.int32),
        np.array([4, 3, leaf, leaf, leaf], np.int32),
        np.array([0, 1, 0, 0, 0], np.int32),
        np.array([0.5, 0.5, 0.0, 0.0, 0.0]),
        np.array([10, 6, 4, 2, 4]),
        np.array([[0.5, 0.5], [0.4, 0.6], [0.3, 0.7], [0.2, 0.8], [0.1, 0.9]]),
    )
    assert nested.stops(nodes, 2).tolist() == [0, 1, 2, 3, 4]
    assert nested.stops(nodes, 7).tolist() == [0, 1, 1, 1, 4]
    assert nested.stops(nodes, 11).tolist() == [0] * 5
    walker = nested.Walker(nodes, [nested.Setting(0, 1, 1, 2), nested.Setting(1, 1, 2, 2), nested.Setting(2, 1, 2, 7), nested.Setting(3, 1, 2, 11)])
    monkeypatch.setattr(nested, "stops", None)
    for _ in range(2):
        votes = {s.candidate: v[:, 1].tolist() for s, v in walker.walk(np.array([[0.0, 0.0], [0.0, 1.0], [1.0, 0.0]]))}
        assert votes == {0: [0.6, 0.6, 0.9], 1: [0.7, 0.8, 0.9], 2: [0.6, 0.6, 0.9], 3: [0.5] * 3}
