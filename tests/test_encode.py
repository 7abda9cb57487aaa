from __future__ import annotations

import itertools

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.codes import indicator
from riskflow.operators import encode
from riskflow.plans.training import training_frame
from riskflow.schemas import (
    EVENT_SCHEMA,
    FEATURES,
    INDICATORS,
    KEY,
    SERVING_CODES,
    TRAINING_CODES,
    TRAINING_NAMES,
    check_signature,
    conform,
    signature_of,
)
from tests.records import as_dicts, exam, frame

CODED = tuple(SERVING_CODES)


def test_thirteen_indicators():
    assert sum(len(v) for v in INDICATORS.values()) == 13
    assert INDICATORS["rest_ecg"] == ["left ventricular hypertrophy", "normal"]


def test_null_codes_take_the_default(spark):
    nulls = {c: None for c in CODED}
    row = encode.decode(frame(spark, [exam(**nulls)])).first()
    assert [row[c] for c in CODED] == [SERVING_CODES[c].default for c in CODED]


def test_unknown_codes_take_the_default(spark):
    row = encode.decode(frame(spark, [exam(**{c: 99 for c in CODED})])).first()
    assert [row[c] for c in CODED] == [SERVING_CODES[c].default for c in CODED]


def test_missing_codes_kept_or_dropped(spark):
    rows = frame(spark, [exam(), exam(**{KEY: "b", "sex": None})])
    kept = as_dicts(encode.decode(rows, on_missing="null"))
    assert kept["b"]["sex"] is None and kept["a"]["sex"] == "male"
    assert set(as_dicts(encode.decode(rows, on_missing="drop"))) == {"a"}
    with pytest.raises(ValueError):
        encode.decode(rows, on_missing="other")


def test_strict_decode_keeps_other_codes(spark):
    rows = frame(spark, [exam(chest_pain_type=0), exam(**{KEY: "b", "chest_pain_type": None})])
    found = as_dicts(encode.decode_strict(rows, TRAINING_CODES))
    assert found["a"]["chest_pain_type"] == "0"
    assert found["b"]["chest_pain_type"] is None


def test_features_of_one_record(spark):
    row = encode.exam_features(frame(spark, [exam()])).first().asDict()
    assert list(row) == [KEY, *FEATURES]
    ones = {f for f in FEATURES[6:] if row[f] == 1}
    assert ones == {
        "sex_male",
        "chest_pain_type_atypical angina",
        "fasting_blood_sugar_lower than 120mg/ml",
        "st_slope_flat",
        "thalassemia_fixed defect",
    }


def test_age_must_be_positive(spark):
    rows = [exam(**{KEY: k, "age": a}) for k, a in (("a", 1), ("b", 0), ("c", -1), ("d", None))]
    assert set(as_dicts(encode.exam_features(frame(spark, rows)))) == {"a"}


def test_sentinel_padding_is_the_identity(spark):
    rows = frame(spark, [exam(**{KEY: str(i), "sex": i % 2, "thalassemia": i % 4, "age": 20 + i}) for i in range(20)])
    sentinels = encode.literal_rows(
        spark, [exam(**{KEY: str(i), "age": 0, "chest_pain_type": i + 1}) for i in range(4)], EVENT_SCHEMA
    )
    padded = encode.exam_features(encode.pad(rows, sentinels))
    assert sorted(padded.collect()) == sorted(encode.exam_features(rows).collect())


def test_literal_rows_fill_with_null(spark):
    row = encode.literal_rows(spark, [{KEY: "x", "age": 1}], EVENT_SCHEMA).first()
    assert row[KEY] == "x" and row["cholesterol"] is None


def _training(spark, codes):
    rows = [(50, *c) for c in codes]
    columns = ["age", "sex", "cp", "bp", "chol", "fbs", "ecg", "hr", "ang", "dep", "slope", "ca", "thal", "target"]
    return spark.createDataFrame(rows, columns)


def test_learned_levels_give_the_model_inputs(spark):
    """With codes from 0 the first level is the number 0, so the defaults have no column."""
    codes = [
        (s, cp, 120, 200, f, e, 150, a, 1.0, sl, 0, t, 1)
        for s, cp, f, e, a, sl, t in itertools.product((0, 1), range(4), (0, 1), range(3), (0, 1), range(3), range(4))
    ]
    learned = training_frame(_training(spark, codes))
    inputs = [c for c in learned.columns if c not in ("target", "row_key")]
    assert inputs == list(FEATURES)
    named = encode.rename_by_position(_training(spark, codes), TRAINING_NAMES).withColumn(KEY, F.lit("x"))
    fixed = encode.exam_features(named)
    assert sorted(learned.select(*[f"`{f}`" for f in FEATURES]).collect()) == sorted(
        fixed.select(*[f"`{f}`" for f in FEATURES]).collect()
    )


def test_levels_are_ordered_numbers_first(spark):
    df = spark.createDataFrame([("b",), ("10",), ("2",), ("B",), (None,), ("a",)], "c string")
    assert encode.learn_levels(df, ["c"]) == {"c": ["2", "10", "B", "a", "b"]}
    coded = encode.one_hot_learned(df, ["c"])
    assert coded.columns == ["c_10", "c_B", "c_a", "c_b"]
    assert [sum(column) for column in zip(*coded.collect())] == [1, 1, 1, 1]


def test_wide_columns_are_refused_and_served_long(spark):
    df = spark.range(200).select("id", F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        encode.learn_levels(df, ["c"], max_levels=100)
    assert encode.indicator_rows(df, "id", ["c"]).count() == 200


def test_indicator_of_null_is_zero(spark):
    assert spark.createDataFrame([(None,)], "c string").select(indicator(F.col("c"), "x")).first()[0] == 0


def test_vector_order(spark):
    vectors = encode.assembler().transform(encode.exam_features(frame(spark, [exam(age=61)])))
    values = vectors.select(vector_to_array("features")).first()[0]
    assert values[:6] == [61.0, 130.0, 240.0, 150.0, 1.5, 0.0] and len(values) == 19


def test_null_input_fails_or_is_kept(spark):
    features = encode.exam_features(frame(spark, [exam(cholesterol=None)]))
    with pytest.raises(Exception, match="VectorAssembler|NULL|null"):
        encode.assembler().transform(features).collect()
    assert encode.assembler(handle_invalid="keep").transform(features).count() == 1
    assert encode.assembler(handle_invalid="skip").transform(features).count() == 0


def test_signature(spark):
    features = encode.exam_features(frame(spark, [exam()]))
    signature = signature_of(features)
    assert signature.names == list(FEATURES)
    check_signature(features, signature)
    with pytest.raises(ValueError, match="sex_male"):
        check_signature(features.drop("sex_male"), signature)
    with pytest.raises(TypeError, match="age"):
        check_signature(features.withColumn("age", F.lit("x")), signature)


def test_inputs_are_cast_to_the_signature(spark):
    features = encode.exam_features(frame(spark, [exam()]))
    wide = T.StructType([T.StructField(f.name, T.DoubleType()) for f in signature_of(features)])
    cast = conform(features, wide)
    assert cast.columns == features.columns and {f.dataType for f in cast.schema if f.name in FEATURES} == {T.DoubleType()}
    with pytest.raises(TypeError, match="double for int"):
        conform(cast, signature_of(features))


def test_sparse_one_hot(spark):
    """A place for every level, NULL last; as many levels as there are rows."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 10 != 0, F.concat(F.lit("level "), "id")).alias("c"))
    found = encode.one_hot_sparse(df.repartition(7), "c", "v")
    assert found.columns == ["id", "c", "v"]
    vectors = {r["id"]: r["v"] for r in found.collect()}
    assert all(v.size == 2701 and list(v.values) == [1.0] for v in vectors.values())
    assert {vectors[i].indices[0] for i in range(0, 3000, 10)} == {2700}
    assert sorted(vectors[i].indices[0] for i in range(3000) if i % 10) == list(range(2700))
    again = {r["id"]: r["v"] for r in encode.one_hot_sparse(df, "c", "v").collect()}
    assert again == vectors


def test_several_wide_columns_at_once(spark):
    """As many exchanges for four columns as for two; rows that repeat stay as often as they were."""
    df = spark.range(400).selectExpr("id % 150 AS a", "concat('x', id % 7) AS b", "id % 2 AS c", "if(id % 5 = 0, NULL, id % 11) AS d").union(
        spark.createDataFrame([(None, None, 0, None)] * 3, "a long, b string, c long, d long")
    )
    found = encode.one_hot_sparse(df, ["a", "b", "d"], "v")
    assert found.columns == ["a", "b", "c", "d", "v"] and found.count() == 403
    rows = found.collect()
    assert {r["v"].size for r in rows} == {150 + 1 + 7 + 1 + 11 + 1}
    places = {}
    for r in rows:
        assert len(r["v"].indices) == 3 and r["v"].indices[0] <= 150 < r["v"].indices[1] <= 158 < r["v"].indices[2]
        for name, place in zip("abd", r["v"].indices):
            assert places.setdefault((name, r[name]), place) == place
    assert len(set(places.values())) == len(places) == 151 + 8 + 12
    assert sorted((tuple(r)[:4] for r in rows), key=repr) == sorted((tuple(r) for r in df.collect()), key=repr)

    def exchanges(*columns):
        plan = encode.one_hot_sparse(df, columns, "v")._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning")

    assert exchanges("a", "b") == exchanges("a", "b", "c", "d")


def test_features_are_one_projection(spark):
    """No shuffle, and the filter reaches the scan."""
    plan = encode.exam_features(frame(spark, [exam()]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_filter_reaches_the_files(spark, place):
    frame(spark, [exam()]).write.parquet(f"{place}/exams")
    features = encode.exam_features(spark.read.parquet(f"{place}/exams"))
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(age,0)" in plan and "resultado" not in plan
