"""Code decoding and one-hot indicators as column expressions."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow.schemas import CodeTable, quoted


def label_or_default(column: str, table: CodeTable, keep_null: bool = False) -> Column:
    """Label of a code; NULL and unlisted codes take the default.

    With `keep_null` a NULL code stays NULL instead.
    """
    code = F.col(quoted(column))
    rest = F.lit(table.default)
    if keep_null:
        rest = F.when(code.isNotNull(), rest)
    return _branches(code, table.labels).otherwise(rest)


def label_or_code(column: str, table: CodeTable) -> Column:
    """Label of a listed code; any other code stays, written as text."""
    code = F.col(quoted(column))
    return _branches(code, table.labels).otherwise(code.cast("string"))


def indicator(value: Column, level: str) -> Column:
    """1 where `value` is `level`, else 0; NULL gives 0."""
    return F.coalesce((value == F.lit(level)).cast("int"), F.lit(0))


def _branches(code: Column, labels: Mapping[int, str]) -> Column:
    (first, label), *others = labels.items()
    chain = F.when(code == first, F.lit(label))
    for value, text in others:
        chain = chain.when(code == value, F.lit(text))
    return chain
