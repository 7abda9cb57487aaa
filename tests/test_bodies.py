from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.functions.bodies import as_body, expand_bodies
from riskflow.schemas import EVENT_SCHEMA, KEY
from riskflow.sources.streams import publish
from tests.records import body, frame, messages


def parsed(spark, *bodies):
    return [r.asDict() for r in expand_bodies(messages(spark, bodies), EVENT_SCHEMA).orderBy("offset").collect()]


def test_unreadable_bodies_are_null(spark):
    rows = parsed(spark, "not json", "{}", '[{"pacienteId":"h","age":1}]', None, "")
    assert all(r[c] is None for r in rows for c in EVENT_SCHEMA.names)


def test_one_bad_field_leaves_the_others(spark):
    bodies = [body(age=a) for a in ("63", 63.0, 63.5, 99999999999)]
    for row in parsed(spark, *bodies):
        assert row["age"] is None and row["cholesterol"] == 240 and row[KEY] == "a"


def test_accepted_conversions(spark):
    row = parsed(spark, body(pacienteId=7, st_depression=3, other="x"))[0]
    assert row[KEY] == "7" and row["st_depression"] == 3.0 and "other" not in row


def test_messages_are_parsed_once(spark, place):
    messages(spark, [body()]).write.parquet(f"{place}/in")
    rows = expand_bodies(spark.read.parquet(f"{place}/in"), EVENT_SCHEMA)
    kept = rows.where((F.col("age") > 0) & F.col(KEY).isNotNull())
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_null_fields_are_left_out(spark):
    text = as_body(spark.createDataFrame([(1, None)], "a int, b string")).first()["body"]
    assert json.loads(text) == {"a": 1}


record = st.fixed_dictionaries(
    {
        KEY: st.text(max_size=12).filter(lambda s: s.isprintable()),
        "age": st.one_of(st.none(), st.integers(-5, 120)),
        "sex": st.one_of(st.none(), st.integers(0, 3)),
        "st_depression": st.one_of(st.none(), st.floats(-1e6, 1e6)),
    }
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=1, max_size=20))
def test_roundtrip(spark, rows):
    original = frame(spark, rows)
    bodies = as_body(original).select(F.col("body").cast("binary").alias("body"))
    again = expand_bodies(bodies, EVENT_SCHEMA)
    assert sorted(again.collect(), key=repr) == sorted(original.collect(), key=repr)


def test_publish_names_the_payload(spark, place):
    publish(spark.range(3), "json", {}, f"{place}/out", payload="value")
    values = {r["value"] for r in spark.read.json(f"{place}/out").collect()}
    assert values == {'{"id":0}', '{"id":1}', '{"id":2}'}


def test_messages_with_a_key(spark, place):
    """The key goes along as text, and stays a field of the message."""
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "id long, v string")
    publish(rows, "parquet", {}, f"{place}/sent", payload="value", key="id")
    found = sorted(spark.read.parquet(f"{place}/sent").collect(), key=str)
    assert [tuple(r) for r in found] == [("1", '{"id":1,"v":"a"}'), ("2", '{"id":2}'), (None, '{"v":"c"}')]
    publish(rows, "parquet", {}, f"{place}/plain")
    assert spark.read.parquet(f"{place}/plain").columns == ["body"]
