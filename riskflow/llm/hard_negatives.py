"""Hard-negative mining through STR-packed R-trees.

Rows are packed by label and first coordinate, and each pack is an R-tree: the rows of a
label are sorted and tiled by one coordinate after the other (the widest first) into
leaves of LEAF rows, and every FANOUT nodes get a parent. A node keeps the bounding box
of its vectors; with an anchor, a box gives an interval of inner products, as each
coordinate gives one. An anchor's boxes wait in a queue, highest upper end first. A box
is not opened if its interval misses the anchor's score windows or if all in it come
after the k-th row found so far.
"""

from __future__ import annotations

import heapq
import math
from typing import NamedTuple, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import stored
from riskflow.llm.vectors import PACK, PACKED, Pack, cells, comparable, from_row, merged_top, packed, product, products, query_packs

SCALE, EVERY = 256, 100
POSITIVES, NEGATIVES = 5, 10
WINDOW = (30, 90)  # percent of the positive's score
LEAF, FANOUT = 64, 8
NEVER = np.iinfo(np.int64).max
TREES = PACKED + ", lo binary, hi binary, node_label binary, least_id binary, first binary, size binary"
FOUND = "pack long, row int, anchor_id long, g int, vec_id long, score long"
MINED = "pack long, row int, nth int, anchor_id long, positive_id long, positive_score long, g int, vec_id long, score long"


class Tree(NamedTuple):
    """Nodes 0 to n_leaves - 1 are leaves: `size` rows from row `first`; the others have
    `size` children from node `first`. Roots have no parent."""

    pack: Pack
    lo: np.ndarray
    hi: np.ndarray
    label: np.ndarray
    least: np.ndarray
    first: np.ndarray
    size: np.ndarray
    n_leaves: int
    roots: np.ndarray


def str_order(vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Row numbers of each leaf by sort-tile-recursive packing."""
    widest = np.argsort(-np.ptp(vectors, axis=0), kind="stable") if len(vectors) and vectors.shape[1] else np.empty(0, np.int64)

    def tiles(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        pages = math.ceil(len(rows) / leaf)
        if pages <= 1:
            return [rows]
        left = len(widest) - depth
        if left <= 0:  # no coordinate is left: cut by id
            return [rows[i : i + leaf] for i in range(0, len(rows), leaf)]
        ordered = rows[np.lexsort((ids[rows], vectors[rows, widest[depth]]))]
        slabs = max(2, math.ceil(pages ** (1 / left)))
        step = leaf * math.ceil(pages / slabs)
        return [page for i in range(0, len(ordered), step) for page in tiles(ordered[i : i + step], depth + 1)]

    return tiles(np.lexsort((ids,)), 0) if len(ids) else []


def planted(row: dict, pack: Pack) -> dict:
    """A pack's columns with its tree; rows are reordered leaf by leaf."""
    leaves, of_label = [], []
    for label in np.unique(pack.labels):
        rows = np.flatnonzero(pack.labels == label)
        found = [rows[page] for page in str_order(pack.vectors[rows], pack.ids[rows])]
        leaves += found
        of_label += [label] * len(found)
    order = np.concatenate(leaves)
    vectors, ids = pack.vectors[order], pack.ids[order]
    size = [len(page) for page in leaves]
    first = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64).tolist()
    lo = [vectors[f : f + s].min(axis=0) for f, s in zip(first, size)]
    hi = [vectors[f : f + s].max(axis=0) for f, s in zip(first, size)]
    least = [int(ids[f : f + s].min()) for f, s in zip(first, size)]
    below = list(range(len(leaves)))
    while below:
        above = []
        for label in dict.fromkeys(of_label[n] for n in below):
            level = [n for n in below if of_label[n] == label]
            if len(level) == 1:
                continue
            for at in range(0, len(level), FANOUT):
                nodes = level[at : at + FANOUT]  # neighbours, so numbered in a row
                above.append(len(size))
                lo.append(np.min([lo[n] for n in nodes], axis=0))
                hi.append(np.max([hi[n] for n in nodes], axis=0))
                least.append(min(least[n] for n in nodes))
                first.append(nodes[0])
                size.append(len(nodes))
                of_label.append(label)
        below = above
    kind = row["kind"]
    return row | {
        "ids": ids.tobytes(),
        "labels": pack.labels[order].tobytes(),
        "vectors": vectors.astype(kind).tobytes(),
        "lo": np.array(lo).astype(kind).tobytes(),
        "hi": np.array(hi).astype(kind).tobytes(),
        "node_label": np.array(of_label, np.int32).tobytes(),
        "least_id": np.array(least, np.int64).tobytes(),
        "first": np.array(first, np.int64).tobytes(),
        "size": np.array(size, np.int64).tobytes(),
    }


def tree_of(row: dict) -> Tree:
    label = np.frombuffer(row["node_label"], np.int32)
    first, size = np.frombuffer(row["first"], np.int64), np.frombuffer(row["size"], np.int64)
    lo, hi = (np.frombuffer(row[c], row["kind"]).reshape(len(label), row["dims"]).astype(np.float64) for c in ("lo", "hi"))
    pack = from_row(row)
    covered = np.cumsum(size)
    n_leaves = int(np.searchsorted(covered, len(pack.ids))) + 1
    root = np.ones(len(label), bool)
    for f, s in zip(first[n_leaves:], size[n_leaves:]):
        root[f : f + s] = False
    return Tree(pack, lo, hi, label, np.frombuffer(row["least_id"], np.int64), first, size, n_leaves, np.flatnonzero(root))


def intervals(queries: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of the inner products of each query with each node's box."""
    common = min(queries.shape[1], tree.lo.shape[1])
    q, lo, hi = queries[:, :common], tree.lo[:, :common], tree.hi[:, :common]
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    both = np.hstack([up, down])
    return products(both, np.hstack([lo, hi])), products(both, np.hstack([hi, lo]))


class Wanted:
    """The first rows of one score window: a heap whose top is the last of them."""

    def __init__(self, low: int, high: int, most: int):
        self.low, self.high, self.most = low, high, most
        self.heap: list[tuple[int, int]] = []  # score, -id

    def opens(self, lower: int, upper: int, least_id: int) -> bool:
        """Whether a box can hold a row that belongs to them."""
        if upper < self.low or lower > self.high:
            return False
        return len(self.heap) < self.most or (upper, -least_id) >= self.heap[0]

    @property
    def bar(self) -> int:
        return max(self.low, self.heap[0][0]) if len(self.heap) == self.most else self.low

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for at in np.flatnonzero((scores >= self.bar) & (scores <= self.high)):
            entry = (int(scores[at]), -int(ids[at]))
            if len(self.heap) < self.most:
                heapq.heappush(self.heap, entry)
            else:
                heapq.heappushpop(self.heap, entry)


class Forest:
    """Trees made ready for the anchors of a pack: boxes' intervals, comparable vectors."""

    def __init__(self, anchors: Pack, trees: Sequence[Tree]):
        self.anchors, self.trees = anchors, trees
        self.ends = [intervals(anchors.vectors, t) for t in trees]
        self.pairs = [comparable(anchors.vectors, t.pack.vectors) for t in trees]


def best_first(forest: Forest, row: int, same: bool, windows: Sequence[Wanted]) -> int:
    """Fill the windows from the trees' rows of the anchor's label (without those of its
    id), or of other labels; returns the leaves read."""
    trees, ends = forest.trees, [(lower[row], upper[row]) for lower, upper in forest.ends]
    anchor_id, label = forest.anchors.ids[row], forest.anchors.labels[row]
    queue: list[tuple[int, int, int, int]] = []
    read = 0

    def consider(t: int, nodes: Sequence[int]) -> None:
        tree, (lower, upper) = trees[t], ends[t]
        for node in nodes:
            low, high, least = int(lower[node]), int(upper[node]), int(tree.least[node])
            if any(w.opens(low, high, least) for w in windows):
                heapq.heappush(queue, (-high, least, t, node))

    for t, tree in enumerate(trees):
        consider(t, tree.roots[(tree.label[tree.roots] == label) == same].tolist())
    while queue:
        high, least, t, node = heapq.heappop(queue)
        tree, low = trees[t], int(ends[t][0][node])
        open_to = [w for w in windows if w.opens(low, -high, least)]
        if not open_to:
            continue
        first, size = int(tree.first[node]), int(tree.size[node])
        if node >= tree.n_leaves:
            consider(t, range(first, first + size))
            continue
        read += 1
        anchors, vectors = forest.pairs[t]
        scores = product(anchors[row : row + 1], vectors[first : first + size])[0]
        ids = tree.pack.ids[first : first + size]
        if same:
            other = ids != anchor_id
            scores, ids = scores[other], ids[other]
        if len(scores):
            top = int(scores.max())
            for w in open_to:
                if top >= w.bar:
                    w.take(scores, ids)
    return read


def _columns(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64()}
    fields = [c.split() for c in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.table({name: pa.array(list(c), kinds[kind]) for (name, kind), c in zip(fields, columns)})


def _positives(most: int):
    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        trees, rows = [tree_of(r) for r in left.to_pylist()], []
        for asked in right.to_pylist():
            anchors = from_row(asked)
            forest = Forest(anchors, trees)
            for row, vec_id in enumerate(anchors.ids.tolist()):
                wanted = Wanted(-NEVER, NEVER, most)
                best_first(forest, row, True, [wanted])
                rows += [(anchors.number, row, vec_id, asked["g"], -negated, score) for score, negated in wanted.heap]
        return _columns(rows, FOUND)

    return find


def _negatives(most: int, window: tuple[int, int]):
    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        trees, rows = [tree_of(r) for r in left.to_pylist()], []
        for asked in right.to_pylist():
            anchors, of_row = from_row(asked), {}
            for p in asked["positives"] or ():
                of_row.setdefault(p["row"], []).append(p)
            forest = Forest(anchors, trees)
            for row, positives in of_row.items():
                # 100 * score between these percentages of the positive's: whole numbers from up to down
                windows = [Wanted(-(-window[0] * p["score"] // 100), window[1] * p["score"] // 100, most) for p in positives]
                vec_id = int(anchors.ids[row])
                best_first(forest, row, False, windows)
                rows += [
                    (anchors.number, row, p["nth"], vec_id, p["vec_id"], p["score"], asked["g"], -negated, score)
                    for p, w in zip(positives, windows)
                    for score, negated in w.heap
                ]
        return _columns(rows, MINED)

    return find


def shifted_label(key: str = "vec_id", label: str = "label") -> Column:
    """(label + 1) % 10 where the id is divisible by 7, else the label."""
    shifted = (F.col(f"`{label}`") + 1) % 10
    return F.when(F.col(f"`{key}`") % 7 == 0, shifted).otherwise(F.col(f"`{label}`")).cast("int")


def mine(
    rows: DataFrame,
    label: Column | None = None,
    is_anchor: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Columns anchor_id, positive_id, rank (from 1), negative_id, positive_score and
    negative_score: for each anchor and each of its positives (the `positives` best other
    rows of its label) the `negatives` best rows of other labels whose score lies within
    `window` percent of the positive's.

    Components are floor(scale * x), scores are inner products, ties go to the smaller
    id. Rows whose id, label or vector is NULL, or whose vector holds NULL or a non-finite
    component, take no part. `is_anchor` chooses the anchors (default: ids divisible by
    100), `label` the classes (default: column `label`). A positive with a negative score
    has an empty window. Anchors and positives without a negative give no row. Rows that
    repeat id, vector and label are one anchor, but a positive or negative each. Vectors
    of other lengths are compared over the positions that both have. Scores beyond 64
    bits fail the job. An empty table gives an empty result. Other columns are ignored,
    whatever their names.

    Trees are written once; both searches read them. A cell holds at most QUERIES anchors
    and PACKS trees on average; an anchor moves once per group of trees, with the
    positives found (`positives` at most) in the second search.
    """
    classes = F.col("label") if label is None else label
    chosen = (F.col(f"`{key}`") % EVERY == 0) if is_anchor is None else is_anchor
    named = rows.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("vector"), classes.cast("int").alias("label"), chosen.alias("asked")
    ).where("id IS NOT NULL AND vector IS NOT NULL AND label IS NOT NULL")
    slabs = max(1, math.ceil(named.count() / PACK))
    first = F.try_element_at("vector", F.lit(1))
    ranged = named.repartitionByRange(slabs, "label", first, "id")
    trees = stored(packed(ranged, scale, "label", TREES, planted), "trees")
    where = cells(trees, query_packs(named.where("asked"), scale, "label"))

    order = [F.desc("score"), F.asc("vec_id")]
    near = merged_top(where.search(_positives(positives), FOUND), ["pack", "row"], order, positives, where.groups)
    nearest = near.select("pack", F.struct("row", F.col("rank").cast("int").alias("nth"), "vec_id", "score").alias("positive"))
    of_pack = nearest.groupBy("pack").agg(F.collect_list("positive").alias("positives"))
    anchors = stored(where.queries.join(of_pack, "pack"), "anchors")
    mined = where.search(_negatives(negatives, window), MINED, anchors)
    best = merged_top(mined, ["pack", "row", "nth"], order, negatives, where.groups)
    return best.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
