"""Shared-folder paths and the few file operations the table writer needs."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster shares: `spark.checkpoint.dir`, or else, where it is
    not set, a folder in the warehouse.

    A warehouse on a machine's own disk serves a session that runs on that machine alone;
    on a cluster, executors and driver would not see each other's files, so it is refused.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not shared:
        shared = context.getCheckpointDir()
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
        if not context.master.startswith("local") and shared.startswith(("file:", "/")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share; {shared} is on each one's own disk")
    return shared.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path of its own under the shared folder, removed when the application ends."""
    folder = f"{scratch_root(spark)}/riskflow-{spark.sparkContext.applicationId}"
    files = Files(spark, folder)
    if not files.exists(folder):
        files.make_dir(folder)
        files.delete_on_exit(folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, safe from lost executors."""
    place = scratch_dir(df.sparkSession, label)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


class Files:
    """Hadoop file system calls, so that any storage Spark can write to works."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def make_dir(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def delete_on_exit(self, path: str) -> None:
        self._fs.deleteOnExit(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def copy(self, source: str, target: str) -> None:
        util, conf = self._spark._jvm.org.apache.hadoop.fs.FileUtil, self._fs.getConf()
        if not util.copy(self._fs, self._path(source), self._fs, self._path(target), False, conf):
            raise OSError(f"could not copy {source} to {target}")

    def write_text(self, path: str, text: str) -> None:
        """Write whole, then rename, so that the file is there entirely or not at all."""
        folder, _, _ = path.rpartition("/")
        draft = f"{folder}/_draft-{uuid.uuid4().hex}"  # readers skip names starting with "_"
        stream = self._fs.create(self._path(draft), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if self.exists(path):
            self.delete(path)
        self.move(draft, path)

    def claim(self, path: str) -> bool:
        """Create an empty file; False if it is there, whoever made it."""
        exists = self._spark._jvm.org.apache.hadoop.fs.FileAlreadyExistsException
        try:
            self._fs.create(self._path(path), False).close()
        except Py4JJavaError as failed:
            if self.exists(path) or failed.java_exception.getClass().getName() == exists._fqn:
                return False
            raise
        return True

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()
