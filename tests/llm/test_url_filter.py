from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.llm import url_filter as op
from tests.llm.conftest import rows

PAGES = "page_id long, url string, html string, host string, listed string, key string"


def plain_parts(url: str | None) -> tuple[str, str]:
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abcdef", max_size=6), max_size=120), st.randoms(use_true_random=False))
def test_cascade_is_exact(keys, rng):
    listed = [k for k in keys if rng.random() < 0.3]
    others = [k for k in keys if k not in set(listed)]
    cascade = op.Cascade.unpacked(op.Cascade.build(listed, others).packed())
    assert all(k in cascade for k in listed) and not any(k in cascade for k in others)


def test_cascade_with_equal_hashes(monkeypatch):
    import numpy as np

    monkeypatch.setattr(op, "_hash", lambda keys: np.array([len(k) for k in keys], np.uint64))
    cascade = op.Cascade.unpacked(op.Cascade.build(["ab", "abcd"], ["cd", "x"]).packed())
    assert [k in cascade for k in ("ab", "abcd", "cd", "x")] == [True, True, False, False]


def test_levels_shrink():
    rng = random.Random(1)
    keys = [f"host{rng.random()}" for _ in range(20_000)]
    cascade = op.Cascade.build(keys[:5000], keys[5000:])
    assert len(cascade.levels) > 2
    assert all(a[0] > b[0] for a, b in zip(cascade.levels, cascade.levels[2:]) if b[0] > 64)
    assert cascade.listed(keys).tolist() == [i < 5000 for i in range(20_000)]


def test_lists_sent_and_joined_agree(spark):
    keys = [(f"k{i}",) for i in range(3000)]
    universe = spark.createDataFrame(keys * 2 + [(None,)], "key string")
    listed = spark.createDataFrame([k for k in keys if k[0].endswith("7")] + [("outside",), (None,)], "key string")
    filter_ = op.UrlList.build(universe, listed, shard_keys=500)
    assert filter_.shards > 3
    hot = universe.union(spark.createDataFrame([("k7",)] * 500 + [("outside",)], "key string"))
    sent, joined = (rows(filter_.mark(hot, "key", broadcast_bytes=size)) for size in (1 << 20, -1))
    assert sent == joined and len(sent) == hot.count()
    assert all(flag == (k is not None and (k.endswith("7") or k == "outside")) for k, flag in sent)


def test_rules(spark):
    urls = [
        "https://A.Example.ORG/en/1x?q", "http://example.org/es/", "http://notexample.org/es/a", "http://x.com/fr/1", "ftp://com/de/#a",
        "http://xcom/de/", "http://spam-farm.net/a", "http://ok.net/a", "nothing", "", None, "http://x.org", "http://é.COM/de/\nx", "a://b://c.org/d",
        "http://spam-farm.org/a", "http://h?://other.com/fr/",
    ]
    pages = spark.createDataFrame([(i, u, None, "clash", "clash", "clash") for i, u in enumerate(urls)], PAGES)
    found = {r.page_id: r for r in op.judge(pages, op.keys_of_names(pages)).collect()}
    assert [(found[i].host, found[i].path) for i in range(len(urls))] == [plain_parts(u) for u in urls]
    assert [found[i].rule for i in range(len(urls))] == [
        "example.org/en/1", "example.org/es/", "org/", "com/fr/", "com/de/", None, None, None, None, None, None, None, "com/de/", None, "org/", None,
    ]
    blocked = {i for i in found if found[i].verdict == "block"}
    assert blocked == {0, 1, 4, 6, 12} and {r.verdict for r in found.values()} == {"allow", "block"}


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, None, None, None, None), (None, "http://adult-x.net/", None, None, None, None), (None, "http://adult-x.net/", None, None, None, None), (2, "http://a.net/" + "x" * 50_000, "", "", "", "")], PAGES)
    found = rows(op.judge(pages, op.keys_of_names(pages)), "page_id", "verdict")
    assert found == [(None, "block"), (None, "block"), (1, "allow"), (2, "allow")]
    assert op.judge(pages.limit(0), op.keys_of_names(pages.limit(0))).count() == 0


@pytest.mark.parametrize("size", [1 << 20, -1])
def test_names_and_hot_keys_of_marked_frames(spark, size):
    """Columns may have any names, and a key that most rows have is dealt to several groups."""
    listed = [f"bad{i}.com/" for i in range(20)]
    frame = spark.range(300).select(
        F.when(F.col("id") % 3 > 0, "bad7.com/").otherwise(F.concat(F.lit("good"), "id", F.lit(".com/"))).alias("key"),
        F.col("id").alias("_shard"), F.lit("x").alias("_salt"), F.lit("y").alias("groups"), F.lit("z").alias("shard"),
    )
    keys = spark.createDataFrame([(k,) for k in listed], "key string")
    filter_ = op.UrlList.build(frame.select("key").union(keys), keys)
    found = filter_.mark(frame, "key", broadcast_bytes=size, group_rows=50)
    assert found.columns == [*frame.columns, "listed"]
    assert sorted((r["_shard"], r["listed"]) for r in found.collect()) == [(i, i % 3 > 0) for i in range(300)]
