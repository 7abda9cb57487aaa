from __future__ import annotations

import os
import sys
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from riskflow.operators import search
from riskflow.operators.encode import with_indicators
from riskflow.operators.forest import ROWS_PER_PARTITION, ForestParams, bounded_sample, fit_forest, fit_partitions, partition_count, pruned, score
from riskflow.operators.metrics import curve_metrics
from riskflow.operators.pymodel import SharedModel, score_from, score_with
from riskflow.operators.registry import Registry, current_stages, newest_in_stage
from riskflow.plans.inputs import logistic_model
from riskflow.plans.scoring import model_scorer, python_scorer, score_records
from riskflow.plans.training import train_model, training_frame
from riskflow.schemas import CSV_SCHEMA, EVENT_SCHEMA, FEATURES, KEY, LABEL, OUTPUTS, signature_of
from riskflow.sources.runs import RunLog
from riskflow.sources.tables import read_csv
from tests.records import exam, frame

SMALL = ForestParams(trees=10, depth=4, min_leaf=1)


@pytest.fixture(scope="module")
def labelled(spark):
    """300 records whose class follows three columns, with one flipped in ten."""
    i = F.col("id")
    records = spark.range(300).select(
        F.concat(F.lit("k"), i.cast("string")).alias(KEY),
        (30 + i % 45).cast("int").alias("age"),
        (i % 2).cast("int").alias("sex"),
        (i % 4).cast("int").alias("chest_pain_type"),
        (100 + (i * 7) % 80).cast("int").alias("resting_blood_pressure"),
        (150 + (i * 13) % 200).cast("int").alias("cholesterol"),
        (i % 3 % 2).cast("int").alias("fasting_blood_sugar"),
        (i % 3).cast("int").alias("rest_ecg"),
        (90 + (i * 11) % 100).cast("int").alias("max_heart_rate_achieved"),
        (i % 5 % 2).cast("int").alias("exercise_induced_angina"),
        ((i * 3) % 60 / 10).alias("st_depression"),
        ((i * 5) % 3).cast("int").alias("st_slope"),
        (i % 5).cast("int").alias("num_major_vessels"),
        ((i * 3 + 1) % 4).cast("int").alias("thalassemia"),
    )
    risk = (F.col("chest_pain_type") >= 2).cast("int") + (F.col("sex") == 0).cast("int") + (F.col("st_depression") < 2).cast("int")
    target = F.when(F.xxhash64(KEY) % 10 == 0, F.lit(1) - (risk >= 2).cast("int")).otherwise((risk >= 2).cast("int"))
    data = records.withColumn(LABEL, target).cache()
    yield data
    data.unpersist()


@pytest.fixture(scope="module")
def features(labelled):
    return with_indicators(labelled)


@pytest.fixture(scope="module")
def model(features):
    return fit_forest(features, SMALL)


def test_forest_separates(features, model):
    scored = score(features, model)
    assert curve_metrics(scored, LABEL, "probabilidade_Sim").first()["roc_auc"] > 0.8


def test_scores_are_appended(features, model):
    scored = score(features, model)
    assert scored.columns == [*features.columns, *OUTPUTS]
    row = scored.first()
    assert row["probabilidade_Nao"] + row["probabilidade_Sim"] == pytest.approx(1.0)
    assert row["resultado"] == int(row["probabilidade_Sim"] > row["probabilidade_Nao"])
    assert dict(scored.dtypes)["resultado"] == "int"


def test_scoring_is_narrow(features, model):
    assert "Exchange" not in score(features, model)._jdf.queryExecution().executedPlan().toString()


def test_partitions_follow_from_the_rows(spark):
    few, many = (fit_partitions(spark.range(n, numPartitions=3), ["id"]) for n in (10, ROWS_PER_PARTITION * 3))
    assert few.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() == 4


def test_forest_does_not_depend_on_the_layout(features, model):
    """Rows in other partitions and another order: the same trees."""
    moved = features.repartition(13, "cholesterol").sortWithinPartitions(F.desc("age"))
    again = fit_forest(moved, SMALL)
    trees = lambda fitted: fitted.stages[-1].toDebugString.partition("\n")[2]  # noqa: E731  after the line with its name
    assert trees(again) == trees(model) != ""


def test_bounded_fit(features):
    assert bounded_sample(features, KEY, None) is features and bounded_sample(features, KEY, 10_000) is features
    assert 60 < bounded_sample(features, KEY, 100).count() < 140


def test_minimum_split_size(features):
    whole, least = (fit_forest(features, replace(SMALL, min_split=n)).stages[-1] for n in (2, 40))
    assert whole.numFeatures == least.numFeatures and whole.getNumTrees == least.getNumTrees
    assert least.totalNumNodes < whole.totalNumNodes
    assert score(features, fit_forest(features, replace(SMALL, min_split=40))).count() == 300


def test_pruned_equals_a_forest_cut_by_hand(spark, features, place):
    """No node below the minimum is split any more, and all other nodes are as they were."""
    model = fit_forest(features, SMALL).stages[-1]
    model.write().save(f"{place}/whole")
    pruned(model, 40).write().save(f"{place}/cut")
    node = next(f.name for f in spark.read.parquet(f"{place}/whole/data").schema if f.name.startswith("node"))
    nodes = {
        part: {(r["treeID"], r[node]["id"]): r[node] for r in spark.read.parquet(f"{place}/{part}/data").collect()}
        for part in ("whole", "cut")
    }
    assert all(n["rawCount"] >= 40 for n in nodes["cut"].values() if n["leftChild"] >= 0)
    splits = {t: [n["rawCount"] for (tree, _), n in nodes["whole"].items() if tree == t and n["leftChild"] >= 0] for t, _ in nodes["whole"]}
    for tree, counts in splits.items():
        kept = sum(1 for (t, _), n in nodes["cut"].items() if t == tree and n["leftChild"] >= 0)
        assert kept == sum(c >= 40 for c in counts)


def test_no_rows_give_no_scores(spark, model):
    empty = score_records(frame(spark, [exam(age=0)]), model_scorer(model), "2024-01-01")
    assert empty.columns == EVENT_SCHEMA.names and empty.count() == 0


def test_placeholders_and_payload_outputs_are_overwritten(spark, model):
    sent = frame(spark, [exam(resultado=77, probabilidade_Sim=5.0, data="1999-01-01")])
    row = score_records(sent, model_scorer(model), "2024-01-01").first()
    assert row["resultado"] in (0, 1) and 0 <= row["probabilidade_Sim"] <= 1 and row["data"] == "2024-01-01"


def test_load_date_defaults_to_today(spark, model):
    row = score_records(frame(spark, [exam()]), model_scorer(model)).first()
    assert row["data"] == str(spark.sql("select current_date()").first()[0])


def test_python_model_from_broadcast_and_from_path(spark, features):
    shared = score_with(features, logistic_model(), FEATURES)
    loaded = score_from(features, logistic_model, FEATURES)
    assert sorted(shared.collect()) == sorted(loaded.collect())
    with pytest.raises(ValueError, match="score_from"):
        score_with(features, logistic_model(), FEATURES, max_bytes=10)


def test_python_model_is_called_once_per_row(features):
    plan = score_with(features, logistic_model(), FEATURES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("run(") == 1 and "Exchange" not in plan


def test_python_model_values(spark, features):
    local = features.select(KEY, *[f"`{f}`" for f in FEATURES]).toPandas()
    expected = dict(zip(local[KEY], logistic_model().predict_proba(local[list(FEATURES)])[:, 1]))
    found = python_scorer(logistic_model())(features).select(KEY, "probabilidade_Sim").collect()
    assert all(np.isclose(r["probabilidade_Sim"], expected[r[KEY]]) for r in found) and len(found) == 300


def test_registry(spark, features, model, place):
    registry = Registry(spark, f"{place}/registry")
    with pytest.raises(LookupError):
        registry.resolve("models:/risk/Production")
    assert registry.register("risk", model, signature_of(features)) == 1
    assert registry.register("risk", model) == 2
    assert registry.register("log", model) == 1
    registry.transition("risk", 2, "Production")
    registry.transition("risk", 1, "Production")
    assert registry.resolve("models:/risk/Production")[0] == 2
    registry.transition("risk", 2, "Staging")
    assert registry.resolve("models:/risk/Production")[0] == 1
    assert registry.resolve("models:/risk/2")[0] == 2
    with pytest.raises(LookupError):
        registry.transition("risk", 9, "Production")
    with pytest.raises(ValueError):
        registry.transition("risk", 1, "Live")
    with pytest.raises(ValueError):
        registry.resolve("runs:/risk/1")
    again = registry.load("models:/risk/Production")
    assert sorted(score(features, again).select(KEY, *OUTPUTS).collect()) == sorted(
        score(features, model).select(KEY, *OUTPUTS).collect()
    )
    assert registry.signature("models:/risk/1").names == list(FEATURES)
    assert registry.signature("models:/risk/2") is None
    stages = {(r["name"], r["version"]): r["stage"] for r in current_stages(registry.log()).collect()}
    assert stages == {("risk", 1): "Production", ("risk", 2): "Staging", ("log", 1): "None"}
    assert newest_in_stage(registry.log(), "Archived").count() == 0


def test_file_to_promoted_model(spark, labelled, place):
    exams = labelled.drop(KEY).toDF(*CSV_SCHEMA.names)
    exams.repartition(2).write.option("header", True).csv(f"{place}/csv")
    training = training_frame(read_csv(spark, f"{place}/csv"))
    registry, runs = Registry(spark, f"{place}/registry"), RunLog(spark, f"{place}/runs")
    trained = train_model(training, params=SMALL, registry=registry, name="risk", runs=runs, run_id="r1")
    assert trained.auc > 0.6 and trained.version == 1
    assert trained.signature.names == list(FEATURES)
    logged = {r["metric"]: r["value"] for r in runs.metrics().collect()}
    assert logged == {**trained.training, "auc": trained.auc} and len(trained.training) == 6
    report = {r["class"]: r for r in trained.report.collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert registry.signature("models:/risk/1", "outputs").names == list(OUTPUTS)
    assert {r["param"]: r["value"] for r in runs.params().collect()}["trees"] == "10"
    scorer = model_scorer(registry.load("models:/risk/Production"), registry.signature("models:/risk/Production"))
    assert score_records(labelled.drop(LABEL), scorer, "2024-01-01").count() == 300


def test_grid():
    grid = search.param_grid()
    assert len(grid) == 600 and grid[1]["max_depth"] == 10 and grid[1]["n_estimators"] == 50
    assert len(search.forest_grid()) == len(set(search.forest_grid())) == 600
    levels = {"n_estimators": (3,), "min_samples_split": (2, 4)}
    assert search.forest_grid(levels) == [ForestParams(trees=3), ForestParams(trees=3, min_split=4)]
    with pytest.raises(ValueError, match="n_trees"):
        search.forest_grid({"n_trees": (3,)})


def test_search_resumes_and_refits(spark, features, place, monkeypatch):
    grid = search.forest_grid({"n_estimators": (3, 5), "max_depth": (1, 4)}, ForestParams(min_leaf=1))
    found = search.grid_search(features, grid, f"{place}/work", KEY, folds=3)
    assert found.fold_metrics.count() == 4 * 3 * (2 * 9 + 2)
    means = {r["candidate"]: r["mean"] for r in found.ranks.where("metric = 'f1'").collect()}
    assert means[found.best] == max(means.values()) == found.best_score
    assert found.best_params() == grid[found.best]
    assert found.top("f1", 2).count() == 2
    assert {r["split"] for r in found.summary.select("split").distinct().collect()} == {"train", "test"}
    runs = RunLog(spark, f"{place}/runs")
    search.log_search(found, runs, "s", children=2)
    params = {(r["run_id"], r["param"]): r["value"] for r in runs.params().collect()}
    assert params["s", "trees"] == str(found.best_params().trees)
    assert params[f"s/{found.best}", "parent"] == "s"
    logged = {(r["run_id"], r["metric"]): r["value"] for r in runs.metrics().collect()}
    assert logged["s", "best score"] == logged[f"s/{found.best}", "mean_test_f1"] == found.best_score
    assert logged[f"s/{found.best}", "rank_test_f1"] == 1.0
    assert len({run for run, _ in logged}) == 3
    assert {"std_train_roc_auc", "mean_fit_time", "rank_test_neg_log_loss"} <= {m for _, m in logged}
    assert all(r["metric"] in search.POINT_METRICS + search.CURVE_METRICS for r in found.ranks.collect())
    assert logged["s", "training_accuracy_score"] > 0.5
    # A second start on the same folder fits nothing but the refit.
    fits = []
    real = search.forest
    monkeypatch.setattr(search, "forest", lambda *a: fits.append(a) or real(*a))
    again = search.grid_search(features, grid, f"{place}/work", KEY, folds=3)
    assert fits == [] and again.best == found.best


def test_search_refuses_a_folder_of_another_search(spark, features, place):
    grid = search.forest_grid({"n_estimators": (2, 3)}, ForestParams(min_leaf=1, depth=2))
    start = lambda candidates=grid, rows=features, **changes: search.grid_search(
        rows, candidates, f"{place}/work", KEY, **{"folds": 2, **changes}
    )
    first = start()
    for changed in ({"folds": 3}, {"seed": 11}, {"candidates": grid[:1]}, {"candidates": grid[::-1]}, {"rows": features.where("age > 40")}):
        with pytest.raises(ValueError, match="other settings or data"):
            start(**changed)
    assert start().best == first.best
    with pytest.raises(ValueError, match="metric"):
        start(refit="fit_time")


def test_search_over_split_sizes(spark, features, place, monkeypatch):
    """Candidates that differ in the split size alone share a fit; rows without a label are left out."""
    fits = []
    real = search.forest
    monkeypatch.setattr(search, "forest", lambda *a: fits.append(a) or real(*a))
    grid = search.forest_grid({"n_estimators": (3,), "min_samples_split": (2, 60)}, ForestParams(min_leaf=1))
    unlabelled = features.limit(5).withColumn(LABEL, F.lit(None).cast("int"))
    found = search.grid_search(features.union(unlabelled), grid, f"{place}/work", KEY, folds=2, test=features)
    assert len(fits) == 2 and found.fold_metrics.select("candidate").distinct().count() == 2
    train = {r["candidate"]: r["mean"] for r in found.summary.where("split = 'train' AND metric = 'accuracy'").collect()}
    assert train[0] > train[1]
    assert {r["class"] for r in found.report.collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}


class Counting:
    """A model that leaves a line in a file each time it is unpickled."""

    def __init__(self, place):
        self.place = place

    def __setstate__(self, state):
        self.__dict__.update(state)
        with open(self.place, "a") as file:
            file.write("x\n")

    def predict(self, inputs):
        return [0] * len(inputs)

    def predict_proba(self, inputs):
        return np.full((len(inputs), 2), 0.5)


def test_a_model_is_unpickled_once_per_worker(spark, place):
    """Tasks of one worker share it: no more loads than workers, over many more tasks."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = spark.range(0, 4000, 1, 80).selectExpr("id", "double(id) AS x")
    model = SharedModel(Counting(f"{place}/loads"))
    for _ in range(2):
        assert len(score_with(rows, model, ["x"]).collect()) == 4000
    with open(f"{place}/loads") as file:
        assert 1 <= len(file.readlines()) <= 16
    assert len(score_with(rows, SharedModel(Counting(f"{place}/other")), ["x"]).collect()) == 4000 and os.path.exists(f"{place}/other")


class Saved:
    """As much of a model as the registry writes."""

    def write(self):
        return self

    def overwrite(self):
        return self

    def save(self, path):
        os.makedirs(path)


def test_two_writers_register_at_once(spark, place):
    """Every version is given once, whoever comes first."""
    def register(_):
        models = Registry(spark, f"{place}/registry")
        return [models.register("m", Saved()) for _ in range(8)]

    with ThreadPoolExecutor(2) as pool:
        found = [v for versions in pool.map(register, range(2)) for v in versions]
    assert sorted(found) == list(range(1, 17))
    models = Registry(spark, f"{place}/registry")
    assert sorted(r["version"] for r in models.log().collect()) == list(range(1, 17))
    models.transition("m", 5, "Production")
    assert models.resolve("models:/m/Production")[0] == 5


def test_partitions_grow_slower_than_small_ones_would():
    """As before on few rows; beyond, each sets up and sends a level's statistics for ten times the rows."""
    assert [partition_count(n) for n in (0, 9_999, 10_000, 80_000, 230_000)] == [1, 1, 2, 9, 24]
    assert partition_count(480_000) == partition_count(2_300_000) == 24
    assert partition_count(4_800_000) == 49 and partition_count(28_800_000) == 289
    assert partition_count(10**9) == 512
