"""Message bodies: binary JSON to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def body_text(body: Column) -> Column:
    return body.cast("string")


def parse_body(body: Column, schema: T.StructType) -> Column:
    """Struct of the body's fields; what cannot be parsed is NULL."""
    return F.from_json(body_text(body), schema, {"mode": "PERMISSIVE"})


def expand_bodies(df: DataFrame, schema: T.StructType, body: str = "body") -> DataFrame:
    """Replace the body by its fields; other columns, such as offsets, stay.

    The struct is expanded by `inline`, not by `select("body.*")`: filters on the
    fields are not pushed below it, where each would parse the message again.
    """
    others = [c for c in df.columns if c != body]
    return df.select(*others, F.inline(F.array(parse_body(F.col(body), schema))))


CORRUPT = "_corrupt"
# why a message is not used, in the order in which it is judged
UNPARSABLE, NO_KEY, NOT_POSITIVE = REASONS = ("unparsable", "no_key", "not_positive")


def judged_bodies(df: DataFrame, schema: T.StructType, key: str, positive: str, body: str = "body") -> DataFrame:
    """As `expand_bodies`, with `reject`: why a message is not used, NULL if it is.

    Used are messages with a key and a positive value. One of which neither could be read
    is unparsable if it is NULL or is no JSON object of this layout.
    """
    others = [c for c in df.columns if c != body]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(body_text(F.col(body)), T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]), options)
    nothing = F.col(body).isNull().alias("_nothing")
    rows = df.select(*others, nothing, F.inline(F.array(parsed)))
    unread = F.col(key).isNull() & F.col(positive).isNull()
    reject = (
        F.when(unread & (F.col("_nothing") | F.col(CORRUPT).isNotNull()), UNPARSABLE)
        .when(F.col(key).isNull(), NO_KEY)
        .when(F.coalesce(F.col(positive) <= 0, F.lit(True)), NOT_POSITIVE)
    )
    return rows.select(*others, *schema.names, reject.alias("reject"))


def as_body(df: DataFrame, body: str = "body", key: str | None = None) -> DataFrame:
    """One JSON text per row; NULL fields are left out. With `key`, that column as text comes
    with it, as the message's key."""
    message = F.to_json(F.struct("*")).alias(body)
    return df.select(message) if key is None else df.select(F.col(key).cast("string").alias("key"), message)
