"""What several operators of this subpackage share."""

from __future__ import annotations

from typing import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskflow.storage import scratch_dir

Batches = Iterable[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; NULL for a NULL key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8; none for NULL."""
    return text.encode().lower().split() if text else []


def map_rows(df: DataFrame, rows: Callable[[Batches], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """A narrow pass of Arrow batches through Python."""
    return df.mapInArrow(rows, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a schema; worked out on the driver and sent to the tasks."""
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores until no column has it, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Stored:
    """A frame written to the shared folder: computed once, safe from lost executors."""

    def __init__(self, df: DataFrame, label: str):
        self.path = scratch_dir(df.sparkSession, label)
        df.write.parquet(self.path)
        self.frame = df.sparkSession.read.schema(df.schema).parquet(self.path)


def stored(df: DataFrame, label: str) -> DataFrame:
    return Stored(df, label).frame
