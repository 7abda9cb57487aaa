"""Experiment runs: scan of one-value-per-file trees, and append-only run tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from dataclasses import dataclass
from typing import Any, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskflow.storage import Files

# Fixed value: the tree is <root>/<experiment>/<run>/<kind>/<name>.
PATH_PATTERN = r"([^/]+)/{kind}/([^/]+)$"
WRITE = "write"  # the folder level of a run table


def scan_metrics(
    spark: SparkSession,
    root: str,
    glob: str = "*/*/metrics/*",
    pattern: str = PATH_PATTERN.format(kind="metrics"),
) -> DataFrame:
    """(run_id, metric, ts, value, step) from files of `ts value step` lines.

    Run and metric are the two groups of `pattern` in the file path.
    """
    return _metric_lines(_scan(spark, root, glob, pattern, "metric"))


def _metric_lines(lines: DataFrame) -> DataFrame:
    words = F.split(F.trim("value"), r"\s+")
    return lines.select(
        "run_id",
        "metric",
        words[0].cast("long").alias("ts"),
        words[1].cast("double").alias("value"),
        F.coalesce(F.try_element_at(words, F.lit(3)).cast("long"), F.lit(0)).alias("step"),
    )


def scan_values(
    spark: SparkSession,
    root: str,
    kind: str = "params",
    name: str = "param",
    glob: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """(run_id, <name>, value) from files that each hold one value: params or tags."""
    return _scan(
        spark, root, glob or f"*/*/{kind}/*", pattern or PATH_PATTERN.format(kind=kind), name
    ).select("run_id", name, "value")


def _scan(spark: SparkSession, root: str, glob: str, pattern: str, name: str) -> DataFrame:
    return _named(spark.read.text(f"{root}/{glob}"), pattern, name)


def _named(text: DataFrame, pattern: str, name: str) -> DataFrame:
    path = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    lines = text.select("value", path.alias("_path"))

    def group(i: int) -> Column:
        return F.regexp_extract("_path", pattern, i)

    return lines.where(F.trim("value") != "").select("value", group(1).alias("run_id"), group(2).alias(name))


PARAMS_SCHEMA = T.StructType().add("run_id", "string").add("param", "string").add("value", "string")
METRICS_SCHEMA = (
    T.StructType()
    .add("run_id", "string")
    .add("metric", "string")
    .add("ts", "long")
    .add("value", "double")
    .add("step", "long")
)


@dataclass(frozen=True)
class RunLog:
    """Params and metrics of runs in two append-only Parquet tables.

    Every write has a key and a folder of that key. A write that is repeated under its key
    replaces what it wrote; without a key, each is a write of its own.
    """

    spark: SparkSession
    root: str

    def log_params(self, run_id: str, params: Mapping[str, Any], key: str | None = None) -> None:
        rows = [(run_id, name, str(value)) for name, value in params.items()]
        self.append_params(self.spark.createDataFrame(rows, PARAMS_SCHEMA).coalesce(1), key)

    def log_metrics(self, run_id: str, metrics: Mapping[str, float], step: int = 0, key: str | None = None) -> None:
        now = int(dt.datetime.now().timestamp() * 1000)
        rows = [(run_id, name, now, float(value), step) for name, value in metrics.items()]
        self.append_metrics(self.spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1), key)

    def append_params(self, rows: DataFrame, key: str | None = None) -> None:
        self._write(rows.select(*PARAMS_SCHEMA.names), "run_params", key)

    def append_metrics(self, rows: DataFrame, key: str | None = None) -> None:
        self._write(rows.select(*METRICS_SCHEMA.names), "run_metrics", key)

    def params(self) -> DataFrame:
        return self._read("run_params", PARAMS_SCHEMA)

    def metrics(self) -> DataFrame:
        return self._read("run_metrics", METRICS_SCHEMA)

    def _write(self, rows: DataFrame, table: str, key: str | None) -> None:
        name = hashlib.md5(key.encode()).hexdigest() if key is not None else uuid.uuid4().hex
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/{WRITE}={name}")

    def _read(self, table: str, schema: T.StructType) -> DataFrame:
        path = f"{self.root}/{table}"
        if not Files(self.spark, self.root).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)


def follow_metrics(
    spark: SparkSession,
    root: str,
    runs: RunLog,
    checkpoint: str,
    glob: str = "*/*/metrics/*",
    pattern: str = PATH_PATTERN.format(kind="metrics"),
    files_per_batch: int = 100_000,
) -> StreamingQuery:
    """Append to the run tables what has come to a metric tree since the last call.

    A file stream with a checkpoint: files that were read are not read again. A batch that
    is repeated after a crash replaces itself. Returns the query, which ends by itself.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(f"{root}/{glob}")
    found = _metric_lines(_named(lines, pattern, "metric"))

    def append(batch: DataFrame, batch_id: int) -> None:
        runs.append_metrics(batch, f"{checkpoint} {batch_id}")

    writer = found.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
