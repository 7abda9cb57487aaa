"""Small hand-made exam records."""

from __future__ import annotations

import json
from typing import Any

from riskflow.schemas import EVENT_SCHEMA, EXAM_COLUMNS, KEY, RESULT_COLUMNS

# a value for each column of an exam record, in the schema's order
VALUES = (50, 1, 2, 130, 240, 0, 1, 150, 0, 1.5, 2, 0, 2)
BASE: dict[str, Any] = {KEY: "a", **{name: value for (name, _), value in zip(EXAM_COLUMNS, VALUES, strict=True)}}


def exam(**changes: Any) -> dict[str, Any]:
    return {**BASE, **changes}


def frame(spark, rows):
    names = [name for name, _ in RESULT_COLUMNS]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], EVENT_SCHEMA)


def body(**changes: Any) -> str:
    return json.dumps(exam(**changes))


def messages(spark, bodies, start=0):
    rows = [(start + i, None if b is None else bytearray(b, "utf-8")) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "offset long, body binary")


def as_dicts(df, key=KEY):
    return {r[key]: r.asDict() for r in df.collect()}
