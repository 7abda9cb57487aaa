"""Cross-validated grid search with all metrics, refit of the best candidate."""

from __future__ import annotations

import itertools
import json
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from typing import Any, Mapping, Sequence

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.encode import assembler
from riskflow.operators.forest import (
    ROWS_PER_PARTITION,
    VECTOR,
    WEIGHT,
    ForestParams,
    class_probability,
    fit_forest,
    fit_partitions,
    fit_vectors,
    forest,
    score,
)
from riskflow.operators.metrics import CURVE_METRICS, POINT_METRICS, class_report, evaluate, score_counts, training_metrics
from riskflow.operators.nested import TEST, TRAIN, Setting, counted_scores, nodes_of
from riskflow.operators.ranking import best_candidate, fold_summary, rank_candidates, top_candidates
from riskflow.operators.split import balanced_weight, with_folds
from riskflow.schemas import FEATURES, LABEL, OUTPUTS, quoted
from riskflow.sources.runs import RunLog
from riskflow.storage import Files, written

# The levels searched.
GRID = {
    "n_estimators": (50, 75, 100, 125, 150, 175),
    "min_samples_split": (2, 4, 6, 8, 10),
    "min_samples_leaf": (1, 2, 3, 4),
    "max_depth": (5, 10, 15, 20, 25),
}
FOREST_FIELDS = {
    "n_estimators": "trees",
    "min_samples_split": "min_split",
    "min_samples_leaf": "min_leaf",
    "max_depth": "depth",
}
TIMES = "candidate int, fit_time double, score_time double, fit int, fold int"


def param_grid(levels: Mapping[str, Sequence[Any]] = GRID) -> list[dict[str, Any]]:
    """Every combination of the levels, the last name varying fastest."""
    return [dict(zip(levels, values)) for values in itertools.product(*levels.values())]


def forest_grid(levels: Mapping[str, Sequence[Any]] = GRID, base: ForestParams = ForestParams()) -> list[ForestParams]:
    """The grid's combinations as forest settings; unknown names are refused."""
    unknown = set(levels) - set(FOREST_FIELDS)
    if unknown:
        raise ValueError(f"no such forest settings: {sorted(unknown)}")
    return [replace(base, **{FOREST_FIELDS[n]: v for n, v in c.items()}) for c in param_grid(levels)]


def grid_rows(spark: SparkSession, levels: Mapping[str, Sequence[Any]] = GRID) -> DataFrame:
    """The grid as a table (candidate, one column per parameter)."""
    rows = [(i, *c.values()) for i, c in enumerate(param_grid(levels))]
    return spark.createDataFrame(rows, ["candidate", *levels])


@dataclass(frozen=True)
class SearchResult:
    candidates: list[ForestParams]
    fold_metrics: DataFrame
    summary: DataFrame
    ranks: DataFrame
    best: int
    best_score: float
    model: PipelineModel
    training: DataFrame
    report: DataFrame | None

    def best_params(self) -> ForestParams:
        return self.candidates[self.best]

    def top(self, metric: str, count: int = 5) -> DataFrame:
        return top_candidates(self.ranks, metric, count)


def grid_search(
    train: DataFrame,
    candidates: Sequence[ForestParams],
    work_dir: str,
    key: str,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    folds: int = 10,
    seed: int = 10,
    refit: str = "f1",
    parallelism: int = 4,
    handle_invalid: str = "error",
    test: DataFrame | None = None,
) -> SearchResult:
    """Fit and score every (candidate, fold); rank on the test folds and refit the best.

    The folded vectors are written once and every fit reads them from there, so a
    lost executor costs a re-read of its files, not the encoding. A fit leaves
    behind its scores counted by (split, label, prediction, p1), from which all
    metrics follow exactly. Candidates that differ in depth, trees or minimum split size
    alone share one fit, of which each takes its part (see `nested`); their fit time is
    that fit's, their score time an equal share. A search started again on the same folder skips the fits that
    finished; one with other settings or other data is refused there. `parallelism`
    fits run side by side. Rows without a label are left out. The result has the
    metrics of the refitted model on its training rows and, given `test` rows, their
    class report.
    """
    spark = train.sparkSession
    if refit not in (*POINT_METRICS, *CURVE_METRICS):
        raise ValueError(f"no such metric: {refit}")
    files = Files(spark, work_dir)
    labelled = train.where(F.col(label).isNotNull())
    _check_settings(files, work_dir, labelled, candidates, key, features, label, folds, seed, handle_invalid)
    if not files.exists(f"{work_dir}/folds/_SUCCESS"):
        folded = with_folds(labelled, label, key, folds, seed)
        vectors = assembler(features, VECTOR, handle_invalid).transform(folded).select(key, label, "fold", VECTOR)
        vectors.write.mode("overwrite").parquet(f"{work_dir}/folds")
    # dealt once: every fit and every scan below has the same rows in the same partitions
    data = fit_partitions(spark.read.parquet(f"{work_dir}/folds"), [key]).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = data.groupBy("fold", label).count().collect()
    many = sum(row["count"] for row in sizes) > ROWS_PER_PARTITION
    grown: dict[ForestParams, list[int]] = {}
    for number, params in enumerate(candidates):
        grown.setdefault(replace(params, min_split=2, depth=0, trees=0), []).append(number)

    def run(job: tuple[int, list[int], int]) -> None:
        fit, members, fold = job
        place = f"fit={fit}/fold={fold}"
        if files.exists(f"{work_dir}/times/{place}/times.json"):
            return
        counts: dict[Any, int] = {}
        for row in sizes:
            if row["fold"] != fold:
                counts[row[label]] = counts.get(row[label], 0) + row["count"]
        part = data.where(F.col("fold") != fold).withColumn(WEIGHT, balanced_weight(F.col(label), counts))
        is_test = F.col("fold") == fold

        def fitted(params: ForestParams) -> tuple[RandomForestClassificationModel, float]:
            started = time.monotonic()
            return forest(params, label, WEIGHT, many).fit(part), time.monotonic() - started

        of = [candidates[c] for c in members]
        model, fit_time = fitted(replace(of[0], min_split=2, depth=max(p.depth for p in of), trees=max(p.trees for p in of)))
        started = time.monotonic()
        nodes = nodes_of(model)
        if nodes is not None:
            settings = [Setting(c, p.trees, p.depth, p.min_split) for c, p in zip(members, of)]
            counted_scores(data, nodes, settings, VECTOR, label, is_test).write.mode("overwrite").parquet(f"{work_dir}/scores/{place}")
        else:  # too large to send, or no such forest: each candidate is fitted by itself
            for number, (c, p) in enumerate(zip(members, of)):
                scores = fit_vectors(part, p, label).transform(data).select(
                    F.lit(c).alias("candidate"),
                    F.when(is_test, TEST).otherwise(TRAIN).alias("split"),
                    F.col(label).cast("int").alias("label"),
                    F.col("prediction").cast("int").alias("prediction"),
                    class_probability(1).alias("p1"),
                )
                mode = "append" if number else "overwrite"
                score_counts(scores, by=["candidate", "split"]).write.mode(mode).parquet(f"{work_dir}/scores/{place}")
        files.make_dir(f"{work_dir}/times/{place}")
        each = {"fit_time": fit_time, "score_time": (time.monotonic() - started) / len(members)}
        lines = "\n".join(json.dumps({"candidate": c, **each}) for c in members)
        files.write_text(f"{work_dir}/times/{place}/times.json", lines)

    jobs = [(fit, members, fold) for (fit, members), fold in itertools.product(enumerate(grown.values()), range(folds))]
    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            for _ in pool.map(inheritable_thread_target(spark)(run), jobs):
                pass
    finally:
        data.unpersist()

    fold_metrics = _fold_metrics(spark, work_dir)
    summary = fold_summary(fold_metrics, ("candidate", "split", "metric"))
    on_test = summary.where(F.col("split") == "test").drop("split")
    ranks = rank_candidates(on_test.where(~_is_time()))
    best = best_candidate(on_test.where(F.col("metric") == refit)).first()
    model = fit_forest(labelled, candidates[best["candidate"]], features, label, handle_invalid, key)
    outcome = (label, OUTPUTS[0], OUTPUTS[2])
    scored = written(score_counts(score(labelled, model), *outcome), "training_scores")
    training = training_metrics(scored, *outcome, weight="rows")
    report = None
    if test is not None:
        report = class_report(written(score_counts(score(test, model), *outcome), "test_scores"), *outcome[:2], weight="rows")
    return SearchResult(list(candidates), fold_metrics, summary, ranks, best["candidate"], best["mean"], model, training, report)


def _check_settings(files: Files, work_dir: str, train: DataFrame, candidates: Sequence[ForestParams], *settings: Any) -> None:
    """The folder belongs to one search: its settings, and the rows it was started on."""
    inputs = train.select(*[quoted(c) for c in dict.fromkeys((settings[0], *settings[1], settings[2]))])
    rows = inputs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*inputs.columns).cast("decimal(38,0)")).alias("h")).first()
    wanted = {"candidates": [asdict(c) for c in candidates], "settings": json.loads(json.dumps(settings)), "rows": [rows["n"], str(rows["h"])]}
    place = f"{work_dir}/_search.json"
    if files.exists(place):
        if json.loads(files.read_text(place)) != wanted:
            raise ValueError(f"{work_dir} holds a search with other settings or data: use another folder")
    else:
        files.make_dir(work_dir)
        files.write_text(place, json.dumps(wanted))


def _is_time() -> Column:
    return F.col("metric").endswith("_time")


def log_search(found: SearchResult, runs: RunLog, run_id: str, metric: str = "f1", children: int = 5) -> None:
    """Log the best parameters, score and training metrics, and the top candidates as
    child runs `<run_id>/<candidate>`. Logged again, a search replaces what it logged."""
    runs.log_params(run_id, found.best_params().as_row(), f"{run_id} params")
    fitted = {r["metric"]: r["value"] for r in found.training.collect() if r["value"] is not None}
    runs.log_metrics(run_id, {"best score": found.best_score, **fitted}, key=f"{run_id} metrics")
    top = [r["candidate"] for r in found.top(metric, children).collect()]
    for candidate in top:
        runs.log_params(f"{run_id}/{candidate}", {**found.candidates[candidate].as_row(), "parent": run_id}, f"{run_id}/{candidate} params")
    child = F.concat(F.lit(f"{run_id}/"), F.col("candidate").cast("string")).alias("run_id")
    name = F.when(_is_time(), F.col("metric")).otherwise(F.concat_ws("_", "split", "metric"))
    chosen = F.col("candidate").isin(top)
    values = found.summary.where(chosen).select(
        child,
        F.explode(
            F.create_map(
                F.concat(F.lit("mean_"), name), F.col("mean"), F.concat(F.lit("std_"), name), F.col("std")
            )
        ).alias("metric", "value"),
    )
    ranks = found.ranks.where(chosen).select(
        child, F.concat(F.lit("rank_test_"), "metric").alias("metric"), F.col("rank").cast("double").alias("value")
    )
    now = F.lit(int(time.time() * 1000))
    rows = values.unionByName(ranks).withColumns({"ts": now, "step": F.lit(0).cast("long")})
    runs.append_metrics(rows, f"{run_id} candidates")


def _fold_metrics(spark: SparkSession, work_dir: str) -> DataFrame:
    """Long table (candidate, fold, split, metric, value), written once."""
    by = ("candidate", "fold", "split")
    scores = spark.read.parquet(f"{work_dir}/scores").drop("fit")
    quality = evaluate(scores, by=by, weight="rows")
    times = spark.read.schema(TIMES).json(f"{work_dir}/times").drop("fit").withColumn("split", F.lit(TEST))
    long_times = times.unpivot(list(by), ["fit_time", "score_time"], "metric", "value")
    quality.unionByName(long_times).write.mode("overwrite").parquet(f"{work_dir}/metrics")
    return spark.read.parquet(f"{work_dir}/metrics")
