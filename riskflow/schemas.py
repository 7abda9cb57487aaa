"""Record layouts, code tables and the model's input columns."""

from __future__ import annotations

from dataclasses import dataclass
from types import MappingProxyType
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "pacienteId"
LABEL = "target"
OUTPUTS = ("resultado", "probabilidade_Nao", "probabilidade_Sim")
LOAD_DATE = "data"

# Names, order and types of an exam record, as events and the
# result table carry them.
EXAM_COLUMNS = (
    ("age", "integer"),
    ("sex", "integer"),
    ("chest_pain_type", "integer"),
    ("resting_blood_pressure", "integer"),
    ("cholesterol", "integer"),
    ("fasting_blood_sugar", "integer"),
    ("rest_ecg", "integer"),
    ("max_heart_rate_achieved", "integer"),
    ("exercise_induced_angina", "integer"),
    ("st_depression", "double"),
    ("st_slope", "integer"),
    ("num_major_vessels", "integer"),
    ("thalassemia", "integer"),
)
RESULT_COLUMNS = (
    (KEY, "string"),
    *EXAM_COLUMNS,
    ("resultado", "integer"),
    ("probabilidade_Nao", "double"),
    ("probabilidade_Sim", "double"),
    (LOAD_DATE, "string"),
)

# Header of the training CSV, in file order.
CSV_COLUMNS = (
    ("age", "integer"),
    ("sex", "integer"),
    ("cp", "integer"),
    ("trestbps", "integer"),
    ("chol", "integer"),
    ("fbs", "integer"),
    ("restecg", "integer"),
    ("thalach", "integer"),
    ("exang", "integer"),
    ("oldpeak", "double"),
    ("slope", "integer"),
    ("ca", "integer"),
    ("thal", "integer"),
    ("target", "integer"),
)

# The model's 19 inputs, in model order.
FEATURES = (
    "age",
    "resting_blood_pressure",
    "cholesterol",
    "max_heart_rate_achieved",
    "st_depression",
    "num_major_vessels",
    "sex_male",
    "chest_pain_type_atypical angina",
    "chest_pain_type_non-anginal pain",
    "chest_pain_type_typical angina",
    "fasting_blood_sugar_lower than 120mg/ml",
    "rest_ecg_left ventricular hypertrophy",
    "rest_ecg_normal",
    "exercise_induced_angina_yes",
    "st_slope_flat",
    "st_slope_upsloping",
    "thalassemia_fixed defect",
    "thalassemia_normal",
    "thalassemia_reversable defect",
)


@dataclass(frozen=True)
class CodeTable:
    """Labels of a coded column; `default` covers NULL and unlisted codes."""

    labels: Mapping[int, str]
    default: str | None = None


def _tables(spec: dict[str, tuple[dict[int, str], str | None]]) -> Mapping[str, CodeTable]:
    return MappingProxyType({c: CodeTable(labels, default) for c, (labels, default) in spec.items()})


# Labels used when scoring.
SERVING_CODES = _tables(
    {
        "sex": ({0: "female"}, "male"),
        "chest_pain_type": (
            {1: "typical angina", 2: "atypical angina", 3: "non-anginal pain"},
            "asymptomatic",
        ),
        "fasting_blood_sugar": ({0: "lower than 120mg/ml"}, "greater than 120mg/ml"),
        "rest_ecg": (
            {0: "normal", 1: "ST-T wave abnormality"},
            "left ventricular hypertrophy",
        ),
        "exercise_induced_angina": ({0: "no"}, "yes"),
        "st_slope": ({1: "upsloping", 2: "flat"}, "downsloping"),
        "thalassemia": ({0: "fix", 1: "normal", 2: "fixed defect"}, "reversable defect"),
    }
)

# Labels used on training files; unlisted codes stay as they are.
TRAINING_CODES = _tables(
    {
        "sex": ({0: "female", 1: "male"}, None),
        "chest_pain_type": (
            {
                1: "typical angina",
                2: "atypical angina",
                3: "non-anginal pain",
                4: "asymptomatic",
            },
            None,
        ),
        "fasting_blood_sugar": (
            {0: "lower than 120mg/ml", 1: "greater than 120mg/ml"},
            None,
        ),
        "rest_ecg": (
            {0: "normal", 1: "ST-T wave abnormality", 2: "left ventricular hypertrophy"},
            None,
        ),
        "exercise_induced_angina": ({0: "no", 1: "yes"}, None),
        "st_slope": ({1: "upsloping", 2: "flat", 3: "downsloping"}, None),
        "thalassemia": ({1: "normal", 2: "fixed defect", 3: "reversable defect"}, None),
    }
)


def struct_of(columns: Sequence[tuple[str, str]]) -> T.StructType:
    schema = T.StructType()
    for name, kind in columns:
        schema.add(name, kind, nullable=True)
    return schema


EVENT_SCHEMA = struct_of(RESULT_COLUMNS)
RESULT_SCHEMA = EVENT_SCHEMA
CSV_SCHEMA = struct_of(CSV_COLUMNS)
TRAINING_NAMES = tuple(name for name, _ in EXAM_COLUMNS) + (LABEL,)


def indicators_from(features: Sequence[str], columns: Sequence[str]) -> dict[str, list[str]]:
    """Split `<column>_<label>` feature names back into column -> labels."""
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for feature in features:
        for column in columns:
            if feature.startswith(column + "_"):
                levels[column].append(feature[len(column) + 1 :])
    return levels


INDICATORS = MappingProxyType(indicators_from(FEATURES, tuple(SERVING_CODES)))


def signature_of(df: DataFrame, features: Sequence[str] = FEATURES) -> T.StructType:
    """The model's input schema, taken from its training frame."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.select(*_quoted(features)).schema])


NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
OUTPUT_SIGNATURE = struct_of([c for c in RESULT_COLUMNS if c[0] in OUTPUTS])


def _widens(have: T.DataType, want: T.DataType) -> bool:
    if have == want:
        return True
    return type(have) in NUMBERS and type(want) in NUMBERS and NUMBERS.index(type(have)) <= NUMBERS.index(type(want))


def check_signature(df: DataFrame, signature: T.StructType) -> None:
    """Fail before scoring when an input is missing or its type cannot be widened to the signature's.

    Order needs no check: columns are always taken by name, in signature order.
    """
    have = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in signature if f.name not in have]
    if missing:
        raise ValueError(f"model inputs missing from the frame: {missing}")
    wrong = [
        f"{f.name}: {have[f.name].simpleString()} for {f.dataType.simpleString()}"
        for f in signature
        if not _widens(have[f.name], f.dataType)
    ]
    if wrong:
        raise TypeError(f"model inputs with unusable types: {wrong}")


def conform(df: DataFrame, signature: T.StructType) -> DataFrame:
    """The frame with its model inputs checked and cast to the signature's types."""
    check_signature(df, signature)
    wanted = {f.name: f.dataType for f in signature}
    return df.select(*[F.col(quoted(c)).cast(wanted[c]).alias(c) if c in wanted else F.col(quoted(c)) for c in df.columns])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _quoted(names: Sequence[str]) -> list[str]:
    return [quoted(n) for n in names]
