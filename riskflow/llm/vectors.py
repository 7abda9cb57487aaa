"""Whole-number vectors in packs, and cells in which packs of queries meet packs of rows.

A pack is a row that holds the vectors of up to PACK rows as one matrix, so that tasks
work on matrices and Spark moves few, larger rows. Every pair of a query pack and a
group of row packs is a cell. A cell's size is bounded, whatever the tables' sizes, and
the best rows that its queries find are merged over cells in rounds of FAN lists.
"""

from __future__ import annotations

import math
from typing import Callable, Iterator, NamedTuple, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import Batches, arrow_schema, map_rows, stored

PACK = 2048  # rows of a pack
PACK_BYTES = 8 << 20  # of a pack's matrix as doubles
QUERIES = 1 << 15  # queries of a cell
PACKS = 32  # expected row packs of a cell, at most
FAN = 16  # lists that a round of merging makes one
SMALL, EXACT_SINGLE, EXACT_DOUBLE = 1 << 15, 1 << 24, 1 << 53
PACKED = "pack long, dims int, kind string, ids binary, labels binary, vectors binary"


class Pack(NamedTuple):
    """Rows of one length, in the order of their ids unless packed otherwise."""

    number: int
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


def whole_vectors(column: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vector: row numbers, and floor(scale * x) of their components
    as doubles. Vectors that are NULL or hold NULL or a non-finite component are left out."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    there = np.asarray(column.is_valid())
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0), dtype=np.int64)
    values = column.flatten()  # without what lies under NULL rows
    numbers = np.asarray(pc.fill_null(values.cast(pa.float64()), math.nan), dtype=np.float64)
    start = np.concatenate([[0], np.cumsum(lengths)])
    for length in np.unique(lengths[there]):
        rows = np.flatnonzero(there & (lengths == length))
        matrix = numbers[start[rows][:, None] + np.arange(length)]
        fine = np.isfinite(matrix).all(axis=1)
        yield rows[fine], np.floor(scale * matrix[fine])


def _kind(vectors: np.ndarray) -> str:
    return "int16" if np.abs(vectors).max(initial=0) < SMALL else "float64"


def as_row(number: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> dict:
    kind = _kind(vectors)
    return {
        "pack": number,
        "dims": vectors.shape[1],
        "kind": kind,
        "ids": ids.astype(np.int64).tobytes(),
        "labels": labels.astype(np.int32).tobytes(),
        "vectors": vectors.astype(kind).tobytes(),
    }


def from_row(row: dict) -> Pack:
    ids = np.frombuffer(row["ids"], np.int64)
    vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(len(ids), row["dims"])
    return Pack(row["pack"], ids, np.frombuffer(row["labels"], np.int32), vectors.astype(np.float64))


def packed(rows: DataFrame, scale: int, label: str, schema: str = PACKED, finish: Callable[[dict, Pack], dict] | None = None) -> DataFrame:
    """Packs of `rows` (columns: id, vector, label), a narrow pass.

    `finish` may add columns to a pack, and reorder it. A pack's number holds the number
    of its partition in the upper 32 bits.
    """

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        number, kept = TaskContext.get().partitionId() << 32, {}
        names = [c.split()[0] for c in schema.split(",")]

        def made(length: int, most: int, leave: int) -> Iterator[pa.RecordBatch]:
            nonlocal number
            parts = [np.concatenate(p) for p in zip(*kept.pop(length))]
            ids, labels, vectors = parts
            at = 0
            while len(ids) - at > leave:
                order = at + np.argsort(ids[at : at + most], kind="stable")
                row = as_row(number, ids[order], labels[order], vectors[order])
                if finish:
                    row = finish(row, Pack(number, ids[order], labels[order], vectors[order]))
                yield pa.RecordBatch.from_pylist([{n: row[n] for n in names}], pack_schema)
                number, at = number + 1, at + most
            if at < len(ids):
                kept[length] = [(ids[at:], labels[at:], vectors[at:])]

        for batch in batches:
            ids = np.asarray(batch.column(0), dtype=np.int64)
            labels = np.asarray(batch.column(2), dtype=np.int32)
            for found, vectors in whole_vectors(batch.column(1), scale):
                length = vectors.shape[1]
                kept.setdefault(length, []).append((ids[found], labels[found], vectors))
                most = max(1, min(PACK, PACK_BYTES // (8 * max(1, length))))
                if sum(len(p[0]) for p in kept[length]) >= most:
                    yield from made(length, most, most - 1)
        for length in sorted(kept):
            yield from made(length, max(1, min(PACK, PACK_BYTES // (8 * max(1, length)))), 0)

    pack_schema = arrow_schema(schema)
    whole = rows.select(F.col("id").cast("long"), "vector", F.col(label).cast("int").alias("label"))
    return map_rows(whole.where("id IS NOT NULL AND vector IS NOT NULL AND label IS NOT NULL"), run, schema)


def query_packs(rows: DataFrame, scale: int, label: str) -> DataFrame:
    """Packs of queries, dealt evenly to tasks of at most QUERIES rows; column `b` numbers the task.

    Rows that repeat id, vector and label are one query.
    """
    distinct = rows.select("id", "vector", label).dropDuplicates()
    tasks = max(1, math.ceil(rows.count() / QUERIES))
    packs = packed(distinct.repartition(tasks), scale, label)
    return stored(packs.withColumn("b", F.shiftright("pack", 32).cast("int")), "query_packs")


class Cells(NamedTuple):
    """Row packs in `groups` groups, and query packs in `tasks` tasks."""

    rows: DataFrame
    queries: DataFrame
    groups: int
    tasks: int

    def search(self, find: Callable, schema: str, queries: DataFrame | None = None) -> DataFrame:
        """`find(row packs, query packs)` on every cell: tables in, table out."""
        of_rows = self.rows.withColumn("g", F.pmod(F.xxhash64("pack"), F.lit(self.groups)).cast("int"))
        left = of_rows.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(self.tasks - 1))))
        asked = self.queries if queries is None else queries
        right = asked.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(self.groups - 1))))
        return left.groupBy("b", "g").cogroup(right.groupBy("b", "g")).applyInArrow(find, schema)


def cells(rows: DataFrame, queries: DataFrame) -> Cells:
    """Cells of stored packs: a group has PACKS packs on average, fewer where that leaves cores idle."""
    n = max(1, rows.count())
    cores = rows.sparkSession.sparkContext.defaultParallelism
    groups = max(math.ceil(n / PACKS), min(n, 2 * cores))
    tasks = 1 + (queries.agg(F.max("b")).first()[0] or 0)
    return Cells(rows, queries, groups, tasks)


def comparable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices over the positions that both have, in a kind of number that holds every
    sum of products of their rows exactly: single or double precision, or Python's integers."""
    common = min(a.shape[1], b.shape[1])
    a, b = a[:, :common], b[:, :common]
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * common
    if bound < EXACT_DOUBLE:
        kind = np.float32 if bound < EXACT_SINGLE else np.float64
        return a.astype(kind), b.astype(kind)
    whole = [np.array([int(x) for x in m.flat], object).reshape(m.shape) for m in (a, b)]
    return whole[0], whole[1]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of comparable matrices; one beyond 64 bits is an error."""
    found = a @ b.T
    if found.dtype == object and any(abs(x) >= 1 << 63 for x in found.flat):
        raise OverflowError("an inner product does not fit into 64 bits")
    return found.astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of `a` and rows of `b`, over the positions that both have; exact."""
    return product(*comparable(a, b))


def merged_top(lists: DataFrame, by: Sequence[str], order: Sequence[Column], most: int, groups: int) -> DataFrame:
    """The first `most` rows per key as column `rank`, merged over groups (column g) in rounds."""
    while True:
        groups = math.ceil(groups / FAN)
        lists = lists.withColumn("g", F.floor(F.col("g") / FAN).cast("int"))
        window = Window.partitionBy(*by, "g").orderBy(*order)
        lists = lists.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= most)
        if groups == 1:
            return lists.drop("g")
        lists = lists.drop("rank")
