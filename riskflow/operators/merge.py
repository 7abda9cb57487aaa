"""Keyed joins, de-duplication and the keyed upsert."""

from __future__ import annotations

import hashlib
import json
import math
import re
import uuid
from dataclasses import dataclass
from typing import Any, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.schemas import KEY, LOAD_DATE, OUTPUTS, RESULT_SCHEMA, quoted
from riskflow.storage import Files

REFRESHED = (*OUTPUTS, LOAD_DATE)
ON_DUPLICATE = ("latest", "error")
NULL_SALTS = 1024
ROWS_PER_BUCKET = 1_000_000
BASES = "riskflow_bases"  # the database of the bases' catalog entries
FOLDER = re.compile(r"(?P<kind>base|batch)-(?P<number>\d{12})(?:-(?P<batch>\d{12})-(?P<run>.+))?")


def join_scores(records: DataFrame, scores: DataFrame, key: str = KEY) -> DataFrame:
    """Scores back to their records: inner join, so unscored rows and NULL keys vanish."""
    return records.join(scores, [key], "inner")


def latest_per_key(
    df: DataFrame,
    key: str = KEY,
    order_by: Sequence[str] = (),
    on_duplicate: str = "latest",
) -> DataFrame:
    """One row per key: the greatest by `order_by`, then by the row's own values.

    A maximum over row structs, combined map-side, so that a key with very many
    rows in a batch is reduced before the shuffle. Rows without a key are left
    out, as the id join would. With "error" a repeated key fails the job.
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}")
    others = [c for c in df.columns if c != key and c not in order_by]
    row = F.max(F.struct(*order_by, *others))
    if on_duplicate == "error":
        message = F.concat(F.lit("more than one row for key "), F.col(key).cast("string"))
        row = F.when(F.count(F.lit(1)) > 1, F.raise_error(message)).otherwise(row)
    kept = df.where(F.col(key).isNotNull()).groupBy(key).agg(row.alias("_row"))
    return kept.select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in df.columns])


def merge(
    target: DataFrame,
    source: DataFrame,
    key: str = KEY,
    refreshed: Sequence[str] = REFRESHED,
) -> DataFrame:
    """MERGE as a frame: matched rows take only `refreshed` columns from the source,
    unmatched source rows are inserted whole, other target rows stay.

    Keys must be unique on both sides. A NULL key matches nothing, as in SQL: such rows
    of both sides stay. They are salted, since a full join cannot split them.
    """
    old = _salted(target, key).withColumn("_old", F.lit(True)).alias("t")
    new = _salted(source, key).withColumn("_new", F.lit(True)).alias("s")
    same = (F.col(f"t.{key}") == F.col(f"s.{key}")) & (F.col("t._salt") == F.col("s._salt"))
    joined = old.join(new, same, "full_outer")
    return joined.select(*[_merged(c, key, refreshed) for c in target.columns])


def _salted(df: DataFrame, key: str) -> DataFrame:
    """Column _salt: 0 for rows with a key; others are spread by their values."""
    return df.withColumn("_salt", F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(NULL_SALTS))).otherwise(0))


def _merged(column: str, key: str, refreshed: Sequence[str]) -> Column:
    old, new = F.col(f"t.`{column}`"), F.col(f"s.`{column}`")
    if column == key:
        return F.coalesce(old, new).alias(column)
    if column in refreshed:
        return F.when(F.col("s._new"), new).otherwise(old).alias(column)
    return F.when(F.col("t._old"), old).otherwise(new).alias(column)


class Part(NamedTuple):
    """A folder of the table: a base or a batch, with its place in the order of writes."""

    kind: str
    number: int
    name: str
    done: bool
    run: str | None
    batch: int


@dataclass(frozen=True)
class KeyedTable:
    """Parquet table with one row per key: a base, and a folder per batch since.

    An upsert writes its own rows only, in a folder of its own; nothing stored is
    rewritten or moved. A folder counts from the moment its marker exists (a file of its
    name in `_done`), so a reader sees all of a batch or nothing of it, whatever happens
    to the writer. A key's stored columns are those of its first row, the refreshed ones
    those of its last.

    `compact` writes what a reader sees as a new base, in buckets by key, each one sorted
    file. A reader takes the base from its buckets and joins to it the rows of the batches
    since, one per key: batches are shuffled, the base neither shuffled nor sorted. So run
    it now and then; a stream does (`compact_every`). Writers must not overlap.

    A catalog view (`publish`) is made anew by every writer before it returns.
    """

    spark: SparkSession
    path: str
    schema: T.StructType = RESULT_SCHEMA
    key: str = KEY
    refreshed: tuple[str, ...] = REFRESHED
    rows_per_bucket: int = ROWS_PER_BUCKET

    def create(self) -> "KeyedTable":
        """Make the folder, or check that an existing table has the same layout."""
        files, layout = self._files(), f"{self.path}/_layout.json"
        wanted = {"key": self.key, "refreshed": list(self.refreshed), "schema": self.schema.simpleString()}
        if files.exists(layout):
            found = json.loads(files.read_text(layout))
            if found != wanted:
                raise ValueError(f"table at {self.path} has layout {found}, not {wanted}")
        else:
            files.make_dir(f"{self.path}/_done")
            files.write_text(layout, json.dumps(wanted))
        return self

    def read(self) -> DataFrame:
        """All rows as they are now, in table column order."""
        return self._rows(self._current(self._parts()))

    def applied(self, batch_id: int, run_id: str) -> bool:
        """Whether a batch of a run is in the table."""
        return self._applied(self._parts()).get(run_id, -1) >= batch_id

    def upsert(
        self,
        source: DataFrame,
        batch_id: int = 0,
        run_id: str | None = None,
        order_by: Sequence[str] = (),
        on_duplicate: str = "latest",
        compact_every: int | None = None,
    ) -> int:
        """Append a batch, one row per key; returns its rows.

        A streaming batch passes its (run_id, batch_id), numbered upwards: a pair that
        was written is not written again. Without `run_id` every call is a change of
        its own. With `compact_every`, what an earlier base left is deleted first, and a
        new base is written when there are so many batches since the last; so there are
        never more than that many folders and two.
        """
        files, run, parts = self._files(), run_id or uuid.uuid4().hex, self._parts()
        if compact_every is not None:
            parts = self._without_old(parts)
        if self._applied(parts).get(run, -1) < batch_id:
            rows, parts = self._append(parts, source, batch_id, run, order_by, on_duplicate)
        else:
            rows = 0
        if compact_every is not None and len([p for p in self._current(parts) if p.kind == "batch"]) >= compact_every:
            self._write_base(parts)
        elif rows:
            self._make_view(parts)
        return rows

    def _append(
        self, parts: list[Part], source: DataFrame, batch_id: int, run: str, order_by: Sequence[str], on_duplicate: str
    ) -> tuple[int, list[Part]]:
        files = self._files()
        number = max((p.number for p in parts), default=0) + 1
        for p in parts:  # what a crashed attempt left
            if not p.done:
                files.delete(f"{self.path}/{p.name}")
        parts = [p for p in parts if p.done]
        batch = latest_per_key(source, self.key, order_by, on_duplicate)
        typed = batch.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in self.schema])
        part = Part("batch", number, f"batch-{number:012d}-{batch_id:012d}-{run}", True, run, batch_id)
        typed.write.mode("overwrite").parquet(f"{self.path}/{part.name}")
        rows = self._scan(part).count()
        if not rows:
            files.delete(f"{self.path}/{part.name}")
            return 0, parts
        files.write_text(f"{self.path}/_done/{part.name}", "{}")
        return rows, [*parts, part]

    def compact(self) -> str:
        """Write the table as a new base, seen by readers once it is complete; returns its folder."""
        parts = self._parts()
        current = self._current(parts)
        if len(current) == 1 and current[0].kind == "base":
            return f"{self.path}/{current[0].name}"
        return f"{self.path}/{self._write_base(parts).name}"

    def _write_base(self, parts: list[Part]) -> Part:
        current = self._current(parts)
        number = max((p.number for p in parts), default=0) + 1
        part = Part("base", number, f"base-{number:012d}", True, None, -1)
        most = sum(self._scan(p).count() for p in current)  # from the files' footers
        buckets = max(1, math.ceil(most / self.rows_per_bucket))
        name = self._entry(part, buckets)
        self._rows(current).repartition(buckets, quoted(self.key)).write.insertInto(name)
        marker = {"applied": self._applied(parts), "buckets": buckets}
        self._files().write_text(f"{self.path}/_done/{part.name}", json.dumps(marker))
        self._make_view([*parts, part])
        return part

    def clean(self) -> None:
        """Delete what no new reader needs: all before the newest base. Readers that
        started before that base was complete must have ended."""
        self._without_old(self._parts())

    def _without_old(self, parts: list[Part]) -> list[Part]:
        files, current = self._files(), self._current(parts)
        start = min((p.number for p in current), default=0)
        old = [p for p in parts if p.number < start]
        if old:
            self._make_view(parts)  # a writer may have died before it did
        for p in old:
            if p.kind == "base":
                self.spark.sql(f"DROP TABLE IF EXISTS {self._name(p)}")
            files.delete(f"{self.path}/_done/{p.name}")
            files.delete(f"{self.path}/{p.name}")
        return [p for p in parts if p.number >= start]

    def publish(self, database: str, view: str) -> str:
        """Make a catalog view of the table, which upserts and compactions keep up to date."""
        name = f"{quoted(database)}.{quoted(view)}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
        self._files().write_text(f"{self.path}/_view.json", json.dumps(name))
        self._make_view(self._parts())
        return name

    def _make_view(self, parts: list[Part]) -> None:
        files, told = self._files(), f"{self.path}/_view.json"
        if files.exists(told):
            self.spark.sql(f"CREATE OR REPLACE VIEW {json.loads(files.read_text(told))} AS {self.sql(parts)}")

    def sql(self, parts: list[Part] | None = None) -> str:
        """A query of the rows as they are now; see `publish` for one that stays so."""
        current = self._current(self._parts() if parts is None else parts)
        base, batches = self._base(current), [p for p in current if p.kind == "batch"]
        names, key = [quoted(f.name) for f in self.schema], quoted(self.key)
        if not current:
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in self.schema)
            return f"SELECT {nothing} WHERE false"
        if not batches:
            return f"SELECT {', '.join(names)} FROM {self._entry(base)}"
        pick = {True: "max_by", False: "min_by"}
        columns = [key, *(f"{pick[f.name in self.refreshed]}({quoted(f.name)}, _number) AS {quoted(f.name)}" for f in self.schema if f.name != self.key)]
        rows = " UNION ALL ".join(f"SELECT {', '.join(names)}, {p.number} AS _number FROM parquet.`{self.path}/{p.name}`" for p in batches)
        per_key = f"SELECT {', '.join(columns)} FROM ({rows}) GROUP BY {key}"
        if base is None:
            return f"SELECT {', '.join(names)} FROM ({per_key})"
        chosen = [
            f"coalesce(b.{c}, n.{c}) AS {c}" if f.name == self.key else f"if({'n' if f.name in self.refreshed else 'b'}.{key} IS NOT NULL, "
            f"{'n' if f.name in self.refreshed else 'b'}.{c}, {'b' if f.name in self.refreshed else 'n'}.{c}) AS {c}"
            for f, c in zip(self.schema, names)
        ]
        return f"SELECT {', '.join(chosen)} FROM {self._entry(base)} AS b FULL OUTER JOIN ({per_key}) AS n ON b.{key} = n.{key}"

    def _rows(self, current: Sequence[Part]) -> DataFrame:
        if not current:
            return self.spark.createDataFrame([], self.schema)
        base, batches = self._base(current), [p for p in current if p.kind == "batch"]
        if not batches:
            return self.spark.table(self._entry(base))
        since = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{p.name}" for p in batches])
        if base is None and len(batches) == 1:
            return since
        number = F.regexp_extract("_metadata.file_path", r"/batch-(\d{12})[^/]*/[^/]*$", 1).cast("long")
        since = since.withColumn("_number", number)
        if base is not None:  # dealt as the base is, so that the join below moves nothing
            since = since.repartition(self._buckets(base), quoted(self.key))
        stored = [quoted(f.name) for f in self.schema if f.name not in (self.key, *self.refreshed)]
        latest = [quoted(f.name) for f in self.schema if f.name in self.refreshed]
        sides = [F.min_by(F.struct(*stored), "_number").alias("_stored")] if stored else []
        sides += [F.max_by(F.struct(*latest), "_number").alias("_latest")] if latest else []
        grouped = since.groupBy(quoted(self.key)).agg(*sides)
        per_key = grouped.select(quoted(self.key), *(["_stored.*"] if stored else []), *(["_latest.*"] if latest else []))
        if base is None:
            return per_key.select(*[quoted(f.name) for f in self.schema])
        # buckets are sorted files: Spark uses that order if told to look
        self.spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        old, new = self.spark.table(self._entry(base)).alias("b"), per_key.hint("merge").alias("n")
        joined = old.join(new, F.col(f"b.{quoted(self.key)}") == F.col(f"n.{quoted(self.key)}"), "full_outer")
        return joined.select(*[self._joined(f.name) for f in self.schema])

    def _joined(self, name: str) -> Column:
        old, new = (F.col(f"{side}.{quoted(name)}") for side in "bn")
        in_old, in_new = (F.col(f"{side}.{quoted(self.key)}").isNotNull() for side in "bn")
        if name == self.key:
            return F.coalesce(old, new).alias(name)
        if name in self.refreshed:
            return F.when(in_new, new).otherwise(old).alias(name)
        return F.when(in_old, old).otherwise(new).alias(name)

    def _scan(self, part: Part) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{part.name}")

    def _name(self, base: Part) -> str:
        return f"{quoted(BASES)}.{quoted('base_' + hashlib.md5(f'{self.path}/{base.name}'.encode()).hexdigest())}"

    def _entry(self, base: Part, buckets: int | None = None) -> str:
        """The catalog entry through which a base is written and read in buckets; made where it is missing."""
        name = self._name(base)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in self.schema)
            key, place = quoted(self.key), f"{self.path}/{base.name}".replace("'", "\\'")
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(BASES)}")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                f"INTO {buckets or self._buckets(base)} BUCKETS LOCATION '{place}'"
            )
        return name

    def _buckets(self, base: Part) -> int:
        return self._marker(base)["buckets"]

    def _parts(self) -> list[Part]:
        """All folders, from one listing of them and one of the markers."""
        files = self._files()
        done, found = set(files.names(f"{self.path}/_done")), []
        for name in files.names(self.path):
            match = FOLDER.fullmatch(name)
            if match:
                found.append(Part(match["kind"], int(match["number"]), name, name in done, match["run"], int(match["batch"] or -1)))
        return sorted(found, key=lambda p: p.number)

    def _current(self, parts: Sequence[Part]) -> list[Part]:
        """The newest complete base and the complete batches after it."""
        done = [p for p in parts if p.done]
        start = max((p.number for p in done if p.kind == "base"), default=0)
        return [p for p in done if p.number >= start]

    def _base(self, current: Sequence[Part]) -> Part | None:
        return next((p for p in current if p.kind == "base"), None)

    def _applied(self, parts: Sequence[Part]) -> dict[str, int]:
        """The highest batch of each run that is in the table."""
        applied: dict[str, int] = {}
        for p in self._current(parts):
            if p.kind == "base":
                applied |= self._marker(p)["applied"]
            else:
                applied[p.run] = max(applied.get(p.run, -1), p.batch)
        return applied

    def _marker(self, part: Part) -> dict[str, Any]:
        return json.loads(self._files().read_text(f"{self.path}/_done/{part.name}"))

    def _files(self) -> Files:
        return Files(self.spark, self.path)
