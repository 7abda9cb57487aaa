"""Inputs the registered queries derive from the given tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.schemas import EXAM_COLUMNS, KEY

# An exam record for each event, by integer arithmetic that Spark and DuckDB do
# alike: 0 and NULL ages, NULL and unlisted codes all occur.
CENTS = "CAST(round(value * 100) AS BIGINT)"
EXAM = {
    "age": "CASE WHEN event_id % 97 = 5 THEN 0 WHEN event_id % 89 = 7 THEN NULL ELSE 29 + (event_id * 31 + user_id) % 49 END",
    "sex": "CASE WHEN event_id % 61 = 3 THEN NULL ELSE (event_id + user_id) % 2 END",
    "chest_pain_type": "(event_id * 7 + user_id * 3) % 5",
    "resting_blood_pressure": "94 + (event_id * 17 + user_id) % 107",
    "cholesterol": f"126 + {CENTS} % 439",
    "fasting_blood_sugar": "CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END",
    "rest_ecg": "(event_id * 5 + user_id) % 3",
    "max_heart_rate_achieved": f"71 + (event_id * 13 + {CENTS}) % 132",
    "exercise_induced_angina": "CASE WHEN (event_id * 11 + user_id) % 3 = 0 THEN 1 ELSE 0 END",
    "st_depression": "(event_id * 3 + user_id * 7) % 63 / 10.0",
    "st_slope": "(event_id * 3 + user_id) % 4",
    "num_major_vessels": f"({CENTS} + user_id) % 5",
    "thalassemia": "(event_id + user_id * 2) % 4",
}
SQL_TYPES = {"integer": "INT", "double": "DOUBLE"}
BY_EVENT = "'e' || CAST(event_id AS STRING)"
BY_USER = "'u' || CAST(user_id AS STRING)"
BY_USER_TYPE = f"{BY_USER} || '-' || event_type"

# 1 for records with the codes and values that raise the risk, blurred by noise.
TARGET = f"""CASE WHEN
    (CASE WHEN (event_id * 7 + user_id * 3) % 5 IN (1, 2) THEN 3 ELSE 0 END)
    + (CASE WHEN (event_id + user_id * 2) % 4 = 2 THEN 3 ELSE 0 END)
    + (CASE WHEN (event_id * 3 + user_id * 7) % 63 < 20 THEN 2 ELSE 0 END)
    + {CENTS} % 4 >= 5 THEN 1 ELSE 0 END"""

# A stand-in for model scores: label, prediction and p1 from an event.
EVALUATED = {
    "label": "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END",
    "prediction": "CASE WHEN value >= 50 THEN 1 ELSE 0 END",
    "p1": "least(value / 500.0, 1.0)",
}

# Weights of the Python model used as a table function, in model order.
LOGIT_BIAS = -1.5
LOGIT_WEIGHTS = (
    0.02, -0.004, 0.001, -0.003, -0.25, -0.3, -0.6, 0.9, 1.1, 0.7,
    0.1, -0.2, 0.3, -0.5, -0.1, 0.4, 0.8, 0.2, -0.4,
)


def exam_columns() -> list[str]:
    """SQL select items of the 13 exam columns, typed."""
    return [f"CAST({EXAM[name]} AS {SQL_TYPES[kind]}) AS {name}" for name, kind in EXAM_COLUMNS]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exam_records(spark: SparkSession, sf_dir: str, key: str = BY_EVENT, *extra: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(f"{key} AS {KEY}", *exam_columns(), *extra)


def exam_messages(spark: SparkSession, sf_dir: str, key: str = BY_USER, *extra: str) -> DataFrame:
    """(event_id, body): every event as a binary JSON message, with further event columns."""
    records = exam_records(spark, sf_dir, key, "event_id", *extra)
    fields = F.struct(KEY, *[name for name, _ in EXAM_COLUMNS])
    return records.select("event_id", *extra, F.to_json(fields).cast("binary").alias("body"))


def evaluated_events(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    items = [f"{sql} AS {name}" for name, sql in EVALUATED.items()]
    return table(spark, sf_dir, "events").selectExpr(*items, *extra)


def logistic_model(weights: tuple[float, ...] = LOGIT_WEIGHTS, bias: float = LOGIT_BIAS) -> Any:
    """A logistic scorer; its class is local, so that it travels with the pickle."""
    import numpy as np

    class Logistic:
        def predict_proba(self, frame: Any) -> Any:
            # Column by column, so that a row's score does not depend on its batch.
            z = bias + np.zeros(len(frame))
            for column, weight in zip(frame.columns, weights):
                z = z + weight * frame[column].to_numpy(dtype=float)
            positive = 1.0 / (1.0 + np.exp(-z))
            return np.column_stack([1.0 - positive, positive])

        def predict(self, frame: Any) -> Any:
            return (self.predict_proba(frame)[:, 1] >= 0.5).astype("int32")

    return Logistic()

