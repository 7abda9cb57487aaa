"""Model registry: an append-only log of versions and stage changes."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.schemas import OUTPUT_SIGNATURE
from riskflow.storage import Files

STAGES = ("None", "Staging", "Production", "Archived")
LOG_SCHEMA = (
    T.StructType()
    .add("name", "string")
    .add("version", "integer")
    .add("stage", "string")
    .add("path", "string")
    .add("ts", "timestamp")
)


def current_stages(log: DataFrame) -> DataFrame:
    """Latest stage and path of every (name, version); of entries of one instant, the
    greatest stage, then path."""
    return (
        log.groupBy("name", "version")
        .agg(F.max(F.struct("ts", "stage", "path")).alias("_last"))
        .select("name", "version", "_last.stage", "_last.path", "_last.ts")
    )


def newest_in_stage(log: DataFrame, stage: str) -> DataFrame:
    """Per name, the newest version that is in a stage now."""
    return (
        current_stages(log)
        .where(F.col("stage") == stage)
        .groupBy("name")
        .agg(F.max("version").alias("version"), F.max_by("path", "version").alias("path"))
    )


@dataclass(frozen=True)
class Registry:
    """Models saved under `root/models/<name>/<version>`, addressed as models:/<name>/<stage>.

    Any number of writers: a version belongs to the one that creates its claim, a file
    that only one can create; the others take the next. Every log entry is a folder of its
    own. A writer that dies leaves a number that is not used.
    """

    spark: SparkSession
    root: str

    def log(self) -> DataFrame:
        path = f"{self.root}/log"
        if not Files(self.spark, self.root).exists(path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(path).select(*LOG_SCHEMA.names)

    def register(
        self,
        name: str,
        model: PipelineModel,
        signature: T.StructType | None = None,
        outputs: T.StructType = OUTPUT_SIGNATURE,
    ) -> int:
        """Save a model with its input and output signature as a new version; returns the version."""
        version = self._claimed(name)
        path = f"{self.root}/models/{name}/{version}"
        model.write().overwrite().save(f"{path}/model")
        if signature is not None:
            both = {"inputs": signature.jsonValue(), "outputs": outputs.jsonValue()}
            Files(self.spark, self.root).write_text(f"{path}/signature.json", json.dumps(both))
        self._append(name, version, "None", path)
        return version

    def transition(self, name: str, version: int, stage: str) -> None:
        """Move one version to a stage; other versions in that stage stay there."""
        if stage not in STAGES:
            raise ValueError(f"stage must be one of {STAGES}")
        known = self.log().where((F.col("name") == name) & (F.col("version") == version)).select("path").first()
        if known is None:
            raise LookupError(f"no version {version} of model {name}")
        self._append(name, version, stage, known["path"])

    def resolve(self, uri: str) -> tuple[int, str]:
        """Version and path behind models:/<name>/<stage or version>."""
        scheme, _, rest = uri.partition(":/")
        name, _, wanted = rest.strip("/").rpartition("/")
        if scheme != "models" or not name:
            raise ValueError(f"not a model address: {uri}")
        log = self.log().where(F.col("name") == name)
        if wanted.isdigit():
            found = current_stages(log).where(F.col("version") == int(wanted)).first()
        else:
            found = newest_in_stage(log, wanted).first()
        if found is None:
            raise LookupError(f"no model for {uri}")
        return found["version"], found["path"]

    def load(self, uri: str) -> PipelineModel:
        return PipelineModel.load(f"{self.resolve(uri)[1]}/model")

    def signature(self, uri: str, side: str = "inputs") -> T.StructType | None:
        """What a model takes ("inputs") or gives ("outputs")."""
        path = f"{self.resolve(uri)[1]}/signature.json"
        files = Files(self.spark, self.root)
        if not files.exists(path):
            return None
        return T.StructType.fromJson(json.loads(files.read_text(path))[side])

    def _claimed(self, name: str) -> int:
        files, folder = Files(self.spark, self.root), f"{self.root}/claims/{name}"
        last = self.log().where(F.col("name") == name).agg(F.max("version")).first()[0] or 0
        version = 1 + max([last, *(int(n) for n in files.names(folder) if n.isdigit())])
        files.make_dir(folder)
        while not files.claim(f"{folder}/{version}"):
            version += 1
        return version

    def _append(self, name: str, version: int, stage: str, path: str) -> None:
        row = (name, version, stage, path, dt.datetime.now())
        entry = self.spark.createDataFrame([row], LOG_SCHEMA).coalesce(1)
        entry.write.parquet(f"{self.root}/log/entry={uuid.uuid4().hex}")
