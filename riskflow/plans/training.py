"""Training file to registered, promoted model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.operators.encode import as_categories, decode_strict, one_hot_learned, rename_by_position
from riskflow.operators.forest import ForestParams, fit_forest, score
from riskflow.operators.metrics import class_report, curve_metrics, score_counts, training_metrics
from riskflow.operators.registry import Registry
from riskflow.operators.split import split
from riskflow.schemas import FEATURES, LABEL, TRAINING_CODES, TRAINING_NAMES, signature_of
from riskflow.sources.runs import RunLog
from riskflow.storage import written

ROW_KEY = "row_key"


def training_frame(raw: DataFrame) -> DataFrame:
    """The CSV's columns, renamed, decoded and one-hot encoded by the levels present.

    `row_key` is a hash of the row; equal rows share it and so fall on the same
    side of the split.
    """
    named = rename_by_position(raw, TRAINING_NAMES)
    keyed = named.withColumn(ROW_KEY, F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in named.columns])))
    coded = list(TRAINING_CODES)
    return one_hot_learned(as_categories(decode_strict(keyed, TRAINING_CODES), coded), coded)


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    signature: T.StructType
    auc: float
    version: int | None
    training: dict[str, float]
    report: DataFrame


def train_model(
    frame: DataFrame,
    key: str = ROW_KEY,
    params: ForestParams = ForestParams(),
    registry: Registry | None = None,
    name: str = "model",
    stage: str | None = "Production",
    runs: RunLog | None = None,
    run_id: str = "train",
    most_rows: int | None = None,
) -> Trained:
    """Split, fit, measure on both sides, log, register and promote.

    Logged are the settings, the metrics of the fit on its training rows and the
    held-out AUC; the class report is of the held-out rows.
    """
    train, test = split(frame, key)
    model = fit_forest(train, params, key=key, most_rows=most_rows)
    outcome = (LABEL, "resultado", "probabilidade_Sim")
    on_train, on_test = (written(score_counts(score(part, model), *outcome), "scores") for part in (train, test))
    fitted = training_metrics(on_train, *outcome, weight="rows").collect()
    training = {r["metric"]: r["value"] for r in fitted if r["value"] is not None}
    auc = curve_metrics(on_test, LABEL, "probabilidade_Sim", weight="rows").first()["roc_auc"]
    signature = signature_of(train, FEATURES)
    if runs is not None:
        runs.log_params(run_id, params.as_row())
        runs.log_metrics(run_id, {**training, **({} if auc is None else {"auc": auc})})
    version = None
    if registry is not None:
        version = registry.register(name, model, signature)
        if stage:
            registry.transition(name, version, stage)
    return Trained(model, signature, auc, version, training, class_report(on_test, *outcome[:2], weight="rows"))
