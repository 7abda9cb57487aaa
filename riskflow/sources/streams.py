"""Message streams in, message batches out."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.bodies import as_body


def open_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    path: str | None = None,
    payload: str = "body",
    keep: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Streaming frame with the message in `body`.

    `payload` names the source's message column ("value" for Kafka); `keep` lists
    further columns to carry, such as offset and timestamp, which then order
    several messages of one key. Connection options come from the caller only.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    loaded = reader.load(path) if path else reader.load()
    return loaded.select(F.col(payload).alias("body"), *keep)


def publish(
    df: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    path: str | None = None,
    payload: str = "body",
    key: str | None = None,
) -> None:
    """Send every row as one JSON message ("value" as `payload` for Kafka).

    `key` names a column that goes along as the message's key, so that a partitioned hub
    keeps the messages of one key in one partition and in order.
    """
    writer = as_body(df, payload, key).write.format(fmt).options(**options).mode("append")
    writer.save(path) if path else writer.save()
