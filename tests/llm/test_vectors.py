"""Exact search and hard negatives against brute force, over every odd kind of row."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.llm import exact_topk, hard_negatives
from riskflow.llm import vectors as shared
from riskflow.llm.vectors import Pack, as_row, merged_top, products
from tests.llm.conftest import rows

SCHEMA = "vec_id long, embedding array<float>, label int"
CLASHES = ("id", "vector", "asked", "pack", "row", "g", "b", "rank", "score", "query_id", "anchor_id", "nth", "dims", "kind")


def odd_vectors(n: int = 400) -> list[tuple]:
    """Random vectors with ties, copies, other lengths, and rows that take no part."""
    rng = np.random.default_rng(3)
    found = [(i, [float(x) for x in rng.normal(0, 0.3, 8).round(1)], int(i % 4)) for i in range(n)]
    copied = found[17][1]
    found += [(n + i, copied, 2) for i in range(n // 2)]  # a very common vector
    found += [(100, found[100][1], found[100][2]), (120, found[120][1], found[120][2])]  # repeated rows
    found += [(5, [0.5] * 8, 1), (5, [0.25] * 8, 3)]  # one id, other vectors
    found += [(1001, [], 0), (1002, [1.0] * 3, 1), (1003, [0.5] * 20, 2), (1100, [0.75] * 12, 2), (1200, [], 1)]
    found += [(1004, None, 1), (1005, [1.0, None] * 4, 1), (1006, [math.nan] * 8, 1), (1007, [math.inf] * 8, 0), (None, [1.0] * 8, 1)]
    return [*found, (1008, [1.0] * 8, None), (None, None, None), (1300, None, 0), (-140, [-0.4] * 8, 3)]


def usable(given_rows, scale):
    return [
        (i, [math.floor(scale * np.float64(np.float32(x))) for x in v], label)
        for i, v, label in given_rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]


def inner(a, b):
    return sum(x * y for x, y in zip(a, b))


def best_rows(given_rows, most, scale=64, every=20):
    kept = usable(given_rows, scale)
    queries = {(i, tuple(v)) for i, v, _ in kept if i % every == 0}
    found = []
    for q, v in queries:
        scored = sorted((-inner(v, w), i) for i, w, _ in kept if i != q)
        found += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:most])]
    return sorted(found)


def shifted(i, label):
    return (label + 1) % 10 if i % 7 == 0 else label


def negatives(given_rows, every=100):
    kept = [(i, v, shifted(i, label)) for i, v, label in usable(given_rows, 256) if label is not None]
    found = []
    for a, v, label in {(i, tuple(v), label) for i, v, label in kept if i % every == 0}:
        scored = sorted((-inner(v, w), i, other) for i, w, other in kept)
        for s, p in [(-s, i) for s, i, other in scored if other == label and i != a][:5]:
            fits = [(i, -t) for t, i, other in scored if other != label and 30 * s <= -100 * t <= 90 * s]
            found += [(a, p, rank + 1, i, s, t) for rank, (i, t) in enumerate(fits[:10])]
    return sorted(found)


@pytest.fixture(scope="module")
def odd_table(spark):
    frame = spark.createDataFrame(odd_vectors(), SCHEMA).repartition(5)
    return frame.withColumns({name: F.lit("clash") for name in CLASHES})


@pytest.mark.parametrize("pack, fan, packs", [(2048, 16, 32), (16, 2, 1)])
def test_search(spark, odd_table, monkeypatch, pack, fan, packs):
    """The same whether all is one cell or many, merged over several rounds."""
    monkeypatch.setattr(shared, "FAN", fan)
    monkeypatch.setattr(shared, "PACKS", packs)
    monkeypatch.setattr(shared, "PACK", pack)
    found = rows(exact_topk.search(odd_table), "query_id", "rank", "vec_id", "score")
    assert found == best_rows(odd_vectors(), 20)


def test_search_of_few(spark):
    """Fewer rows than asked for: all; a query never finds its own id."""
    frame = spark.createDataFrame([(20, [1.0], 0), (20, [1.0], 0), (3, [-1.0], 0)], SCHEMA)
    assert rows(exact_topk.search(frame)) == [(20, 1, 3, -4096)]
    assert exact_topk.search(spark.createDataFrame([], SCHEMA)).count() == 0
    assert exact_topk.search(frame.where("vec_id = 3")).count() == 0


def test_mine(spark, odd_table):
    found = rows(hard_negatives.mine(odd_table, hard_negatives.shifted_label()), "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    expected = negatives(odd_vectors())
    assert found == expected and len(expected) > 100
    assert hard_negatives.mine(odd_table.where("vec_id IS NULL")).count() == 0


def test_products():
    """Exact in each kind of number; beyond 64 bits refused."""
    for size in (1, 1e3, 1e6, 3e8):
        a, b = (np.floor(size * np.random.default_rng(i).normal(size=(5, 7))) for i in (1, 2))
        assert products(a, b).tolist() == [[inner([int(x) for x in r], [int(x) for x in s]) for s in b] for r in a]
    with pytest.raises(OverflowError):
        products(np.full((1, 2), 2.0**40), np.full((1, 2), 2.0**40))
    assert products(np.ones((2, 0)), np.ones((3, 4))).tolist() == [[0, 0, 0], [0, 0, 0]]


def a_tree(seed: int, n: int, dims: int = 6) -> hard_negatives.Tree:
    rng = np.random.default_rng(seed)
    vectors, ids = np.floor(rng.normal(0, 20, (n, dims))), np.sort(rng.choice(10 * n, n, replace=False))
    labels = rng.integers(0, 3, n).astype(np.int32)
    return hard_negatives.tree_of(hard_negatives.planted(as_row(0, ids, labels, vectors), Pack(0, ids, labels, vectors)))


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([1, 63, 64, 65, 700, 3000]))
def test_tree(seed, n):
    """Leaves hold all rows once and one label each; boxes and intervals hold what is below."""
    tree = a_tree(seed, n)
    leaves = [range(f, f + s) for f, s in zip(tree.first[: tree.n_leaves], tree.size[: tree.n_leaves])]
    assert [i for leaf in leaves for i in leaf] == list(range(n)) and max(map(len, leaves)) <= hard_negatives.LEAF
    assert all(set(tree.pack.labels[list(leaf)]) == {label} for leaf, label in zip(leaves, tree.label))
    query = np.floor(np.random.default_rng(seed + 1).normal(0, 20, (1, 6)))
    lower, upper = hard_negatives.intervals(query, tree)
    scores = products(query, tree.pack.vectors)[0]

    def under(node):
        first, size = tree.first[node], tree.size[node]
        return list(range(first, first + size)) if node < tree.n_leaves else [r for c in range(first, first + size) for r in under(c)]

    seen = []
    for root in tree.roots:
        seen += under(root)
    assert sorted(seen) == list(range(n))
    for node in range(len(tree.size)):
        below = under(node)
        assert lower[0, node] <= scores[below].min() and scores[below].max() <= upper[0, node]
        assert tree.least[node] == tree.pack.ids[below].min()


def test_queue_prunes():
    """Boxes outside the window or behind the k-th row are not opened, and nothing is lost by it."""
    tree = a_tree(7, 6000, dims=2)
    anchor = Pack(0, np.array([-1]), np.array([0], np.int32), np.array([[30.0, -20.0]]))
    forest = hard_negatives.Forest(anchor, [tree])
    scores = products(anchor.vectors, tree.pack.vectors)[0]
    for low, high in ((-(10**9), 10**9), (200, 700), (10**8, 10**9)):
        wanted = hard_negatives.Wanted(low, high, 10)
        read = hard_negatives.best_first(forest, 0, False, [wanted])
        fits = sorted((int(s), -int(i)) for s, i, label in zip(scores, tree.pack.ids, tree.pack.labels) if label != 0 and low <= s <= high)
        assert sorted(wanted.heap) == fits[-10:]
        assert read < tree.n_leaves / 3


def test_merged_top(spark):
    lists = spark.range(1000).selectExpr("id % 3 AS k", "CAST(id % 40 AS INT) AS g", "id * 7919 % 500 AS score", "id AS vec_id")
    found = rows(merged_top(lists, ["k"], [F.desc("score"), F.asc("vec_id")], 7, 40), "k", "rank", "score", "vec_id")
    expected = []
    for k in range(3):
        ordered = sorted((-(i * 7919 % 500), i) for i in range(1000) if i % 3 == k)
        expected += [(k, rank + 1, -s, i) for rank, (s, i) in enumerate(ordered[:7])]
    assert found == expected
