"""Exact top-k search by inner product: tiled matrix products and merged lists.

A task holds a cell: some packs of rows and some of queries. The products of a block of
queries and a pack are one tile; of each tile the best rows per query are selected
without sorting it, and a query's lists are merged over the cell's tiles. The lists of
all cells are then merged in a tree, FAN lists at a time.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import stored
from riskflow.llm.vectors import Pack, cells, from_row, merged_top, packed, products, query_packs

SCALE, MOST, EVERY = 64, 20, 20
BLOCK = 512  # queries of a tile
LEAST = np.iinfo(np.int64).min  # no row
LISTS = "pack long, row int, query_id long, g int, vec_id long, score long"


def first_of(row: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most` entries of each row number: higher scores, then smaller ids."""
    order = np.lexsort((ids, -score, row))
    sorted_rows = row[order]
    start = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]])) if len(order) else np.empty(0, np.int64)
    size = np.diff(np.concatenate([start, [len(order)]]))
    nth = np.arange(len(order)) - np.repeat(start, size)
    return order[nth < most]


def tile(queries: np.ndarray, query_ids: np.ndarray, pack: Pack, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query numbers, scores and ids of the best rows of a pack for each query.

    The k-th score is found by partial selection; rows that tie with it are sorted out by id.
    """
    scores = products(queries, pack.vectors)
    left, right = (np.searchsorted(pack.ids, query_ids, side) for side in ("left", "right"))
    for q in np.flatnonzero(right > left):
        scores[q, left[q] : right[q]] = LEAST
    if scores.shape[1] > most:
        kth = np.partition(scores, scores.shape[1] - most, axis=1)[:, -most]
        row, at = np.nonzero((scores >= kth[:, None]) & (scores > LEAST))
    else:
        row, at = np.nonzero(scores > LEAST)
    score, ids = scores[row, at], pack.ids[at]
    best = first_of(row, score, ids, most)
    return row[best], score[best], ids[best]


def _search(most: int):
    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        packs = [from_row(r) for r in left.to_pylist()]
        parts: list[dict[str, np.ndarray]] = []
        for asked in right.to_pylist():
            queries = from_row(asked)
            for at in range(0, len(queries.ids), BLOCK):
                ids = queries.ids[at : at + BLOCK]
                found = [tile(queries.vectors[at : at + BLOCK], ids, p, most) for p in packs]
                if not found:
                    continue
                row, score, vec = (np.concatenate(x) for x in zip(*found))
                best = first_of(row, score, vec, most)
                row, score, vec = row[best], score[best], vec[best]
                n = len(row)
                parts.append({"pack": np.full(n, queries.number), "row": row + at, "query_id": ids[row], "g": np.full(n, asked["g"]), "vec_id": vec, "score": score})
        joined = {c: np.concatenate([p[c] for p in parts] or [np.empty(0, np.int64)]) for c in ("pack", "row", "query_id", "g", "vec_id", "score")}
        kinds = {"row": pa.int32(), "g": pa.int32()}
        return pa.table({c: pa.array(v).cast(kinds.get(c, pa.int64())) for c, v in joined.items()})

    return find


def search(
    rows: DataFrame,
    is_query: Column | None = None,
    most: int = MOST,
    scale: int = SCALE,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Columns query_id, rank (from 1), vec_id and score: for each query row its `most`
    highest inner products with other rows, ties to the smaller id; all, if fewer.

    Components are floor(scale * x). Rows whose id or vector is NULL, or whose vector
    holds NULL or a non-finite component, take no part. `is_query` chooses the queries
    (default: ids divisible by 20). A query's own rows are those with its id. Rows that
    repeat id and vector are one query, but a candidate each; rows of one id with other
    vectors are queries of their own, each with ranks from 1. Vectors of other lengths
    are compared over the positions that both have, so an empty vector scores 0. Scores
    beyond 64 bits fail the job. An empty table gives an empty result. Other columns are
    ignored, whatever their names.

    Work is queries times rows, as the result is exact. A cell is at most QUERIES queries
    and PACKS packs on average, whatever the tables' sizes; a pack of rows moves once per
    QUERIES queries, and a query once per group of packs.
    """
    chosen = (F.col(f"`{key}`") % EVERY == 0) if is_query is None else is_query
    named = rows.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("vector"), F.lit(0).alias("label"), chosen.alias("asked"))
    packs = stored(packed(named, scale, "label"), "row_packs")
    where = cells(packs, query_packs(named.where("asked AND id IS NOT NULL AND vector IS NOT NULL"), scale, "label"))
    lists = where.search(_search(most), LISTS)
    best = merged_top(lists, ["pack", "row"], [F.desc("score"), F.asc("vec_id")], most, where.groups)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
