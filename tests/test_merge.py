from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from riskflow.operators.merge import KeyedTable, join_scores, latest_per_key, merge
from riskflow.schemas import EVENT_SCHEMA, KEY
from riskflow.storage import Files
from tests.records import as_dicts, exam, frame


def rows(spark, *changes):
    return frame(spark, [exam(**c) for c in changes])


def keyed(spark, place):
    return KeyedTable(spark, f"{place}/table").create()


TARGET = (
    {KEY: "a", "age": 50, "resultado": 0, "data": "2024-01-01"},
    {KEY: "c", "age": 60, "resultado": 1, "data": "2024-01-01"},
)
SOURCE = (
    {KEY: "a", "age": 51, "resultado": 1, "data": "2024-01-02"},
    {KEY: "b", "age": 40, "resultado": 0, "data": "2024-01-02"},
)


def check_merged(found):
    assert set(found) == {"a", "b", "c"}
    assert (found["a"]["age"], found["a"]["resultado"], found["a"]["data"]) == (50, 1, "2024-01-02")
    assert (found["b"]["age"], found["b"]["resultado"], found["b"]["data"]) == (40, 0, "2024-01-02")
    assert (found["c"]["age"], found["c"]["resultado"], found["c"]["data"]) == (60, 1, "2024-01-01")


def test_merge_frames(spark):
    check_merged(as_dicts(merge(rows(spark, *TARGET), rows(spark, *SOURCE))))


def test_merge_keeps_stored_nulls(spark):
    """A matched row keeps a NULL feature; a refreshed column may become NULL."""
    target = rows(spark, {"age": None, "resultado": 1})
    found = as_dicts(merge(target, rows(spark, {"age": 9, "resultado": None})))
    assert found["a"]["age"] is None and found["a"]["resultado"] is None


def test_upsert_table(spark, place):
    table = keyed(spark, place)
    assert table.read().count() == 0
    table.upsert(rows(spark, *TARGET))
    table.upsert(rows(spark, *SOURCE))
    check_merged(as_dicts(table.read()))
    assert table.read().columns == EVENT_SCHEMA.names


def test_upsert_is_idempotent(spark, place):
    table = keyed(spark, place)
    table.upsert(rows(spark, *TARGET))
    for _ in range(3):
        table.upsert(rows(spark, *SOURCE))
    check_merged(as_dicts(table.read()))


@pytest.mark.parametrize("compacted", [(), (1,), (0, 2)])
def test_upserts_equal_frame_merges(spark, place, compacted):
    rng = random.Random(3)
    table = keyed(spark, place)
    expected = frame(spark, [])
    for step in range(4):
        batch = rows(
            spark,
            *[
                {KEY: f"p{rng.randrange(60)}", "age": rng.randrange(1, 90), "resultado": step, "data": str(step)}
                for _ in range(25)
            ],
        )
        table.upsert(batch)
        if step in compacted:
            table.compact()
            table.clean()
        expected = frame(spark, [r.asDict() for r in merge(expected, latest_per_key(batch)).collect()])
        assert sorted(table.read().collect(), key=repr) == sorted(expected.collect(), key=repr)
        assert sorted(spark.sql(table.sql()).collect(), key=repr) == sorted(expected.collect(), key=repr)


def folders(table):
    return [p.name.split("-")[0] for p in table._parts()]


def stored_bytes(table):
    size = 0
    for folder, _, names in os.walk(table.path):
        size += sum(os.path.getsize(f"{folder}/{n}") for n in names if n.endswith(".parquet"))
    return size


def test_a_batch_writes_itself_only(spark, place):
    """Two per cent of the rows are about two per cent of the bytes, and no file changes."""
    table = keyed(spark, place)
    many = spark.range(50_000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias(KEY),
        *[(F.xxhash64("id", F.lit(i)) % 2_000_000_000).cast(f.dataType).alias(f.name) for i, f in enumerate(EVENT_SCHEMA[1:])],
    )
    table.upsert(many)
    before, files = stored_bytes(table), {p.name for p in table._parts()}
    table.upsert(many.where("substr(pacienteId, 2) % 50 = 0"))
    assert (stored_bytes(table) - before) / before < 0.03
    assert files < {p.name for p in table._parts()} and table.read().count() == 50_000


def test_compaction(spark, place):
    table = keyed(spark, place)
    for i in range(3):
        table.upsert(rows(spark, {KEY: str(i)}, {KEY: "x", "resultado": i}))
    expected = sorted(table.read().collect())
    reader = table.read()
    table.compact()
    assert folders(table) == ["batch"] * 3 + ["base"]
    assert sorted(reader.collect()) == expected == sorted(table.read().collect())
    assert "Aggregate" not in table.read()._jdf.queryExecution().executedPlan().toString()
    table.clean()
    assert folders(table) == ["base"] and sorted(table.read().collect()) == expected
    assert table.compact().endswith(table._parts()[0].name)  # nothing new: nothing written


def test_empty_batch_changes_nothing(spark, place):
    table = keyed(spark, place)
    assert table.upsert(frame(spark, [])) == 0 and folders(table) == [] and table.read().count() == 0
    assert spark.sql(table.sql()).collect() == [] and table.compact() and table.read().count() == 0


def test_null_keys_stay_on_both_sides(spark):
    target = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "pacienteId string, resultado int")
    found = sorted(merge(target, target, refreshed=("resultado",)).collect(), key=repr)
    assert [r["resultado"] for r in found if r[KEY] is None] == [1, 1, 2, 2] and len(found) == 5


def test_a_hot_key_becomes_one_row(spark, place):
    batch = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 100).cast("string"))).alias(KEY),
        F.col("id").alias("order"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA[1:-1]],
        F.col("id").cast("string").alias("data"),
    )
    table = keyed(spark, place)
    table.upsert(batch, order_by=["order"])
    found = as_dicts(table.read())
    assert len(found) == 101 and found["hot"]["data"] == "29997"


def test_latest_by_order_then_by_content(spark):
    batch = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "m"), ("a", 2, "n"), (None, 9, "z"), ("b", None, "y")], "pacienteId string, at int, v string"
    )
    found = as_dicts(latest_per_key(batch.repartition(4), order_by=["at"]))
    assert {k: r["v"] for k, r in found.items()} == {"a": "n", "b": "y"}
    assert list(found["a"]) == [KEY, "at", "v"]


def test_dedup_combines_before_the_shuffle(spark):
    plan = latest_per_key(spark.range(9).select(F.col("id").cast("string").alias(KEY), "id"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in text


def test_duplicates_can_be_an_error(spark):
    batch = rows(spark, {"age": 1}, {"age": 2})
    with pytest.raises(Exception, match="more than one row for key a"):
        latest_per_key(batch, on_duplicate="error").collect()
    assert latest_per_key(rows(spark, {}, {KEY: "b"}), on_duplicate="error").count() == 2


def test_join_scores_loses_null_keys_and_multiplies(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "pacienteId string, v int")
    right = spark.createDataFrame([("a", 0.1), ("a", 0.2), (None, 0.3)], "pacienteId string, p double")
    assert join_scores(left, right).count() == 4


def test_layout_is_checked(spark, place):
    keyed(spark, place)
    keyed(spark, place)
    with pytest.raises(ValueError, match="layout"):
        KeyedTable(spark, f"{place}/table", key="age").create()


class Crash(Exception):
    pass


def crash(monkeypatch, place, act):
    """Run until a file whose path contains `place` would be written."""
    real = Files.write_text

    def write_text(self, path, text):
        if place in path:
            raise Crash
        real(self, path, text)

    monkeypatch.setattr(Files, "write_text", write_text)
    with pytest.raises(Crash):
        act()
    monkeypatch.undo()


FIRST = [{KEY: f"k{i}", "age": i + 1, "data": "1"} for i in range(20)]
SECOND = [{KEY: f"k{i}", "age": 99, "resultado": 5, "data": "2"} for i in range(10, 30)]


def test_readers_see_all_of_a_batch_or_nothing(spark, place, monkeypatch):
    """At every point of an upsert and of a compaction at which the writer may die."""
    table = keyed(spark, place)
    table.upsert(rows(spark, *FIRST))
    old = sorted(table.read().collect())
    crash(monkeypatch, "/batch-", lambda: table.upsert(rows(spark, *SECOND), 7, "run"))  # files are there, the marker is not
    assert sorted(table.read().collect()) == old == sorted(spark.sql(table.sql()).collect())
    broken = table._parts()[-1]
    for name in os.listdir(f"{table.path}/{broken.name}")[::2]:  # some of the files only
        os.remove(f"{table.path}/{broken.name}/{name}")
    assert not broken.done and sorted(table.read().collect()) == old
    table.upsert(rows(spark, *SECOND), 7, "run")
    new = sorted(table.read().collect())
    assert new == sorted(merge(rows(spark, *FIRST), rows(spark, *SECOND)).collect()) and folders(table) == ["batch"] * 2
    crash(monkeypatch, "/base-", table.compact)
    assert sorted(table.read().collect()) == new
    table.compact()
    assert sorted(table.read().collect()) == new
    table.clean()
    assert folders(table) == ["base"] and sorted(table.read().collect()) == new


@pytest.mark.parametrize("compacted", [False, True])
def test_a_replayed_batch_is_applied_once(spark, place, compacted):
    table = keyed(spark, place)
    table.upsert(rows(spark, *FIRST), 3, "run")
    table.upsert(rows(spark, *SECOND), 4, "run")
    table.upsert(rows(spark, {KEY: "other"}), 0, "another")
    if compacted:
        table.compact()
        table.clean()
    expected = sorted(table.read().collect())
    for batch in (3, 4):
        assert table.upsert(rows(spark, {KEY: "z"}), batch, "run") == 0
    assert sorted(table.read().collect()) == expected
    assert table.upsert(rows(spark, {KEY: "z"}), 5, "run") == 1


def test_a_crashed_batch_comes_after_those_written_since(spark, place, monkeypatch):
    table = keyed(spark, place)
    crash(monkeypatch, "/batch-", lambda: table.upsert(rows(spark, {KEY: "a", "resultado": 2}), 0, "run"))
    table.upsert(rows(spark, {KEY: "a", "resultado": 1}))
    table.upsert(rows(spark, {KEY: "a", "resultado": 2}), 0, "run")
    assert as_dicts(table.read())["a"]["resultado"] == 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_base_is_neither_shuffled_nor_sorted(spark, place):
    """Above the scan of the base stands the join, in buckets; only batches are moved."""
    table = KeyedTable(spark, f"{place}/table", rows_per_bucket=10).create()
    table.upsert(rows(spark, *FIRST, *[{KEY: f"x{i}"} for i in range(40)]))
    table.compact()
    table.upsert(rows(spark, *SECOND))
    lines = plan_of(table.read()).split("\n")
    scan = next(i for i, line in enumerate(lines) if "SelectedBucketsCount" in line or "Bucketed: true" in line)
    depth = lines[scan].index("Scan") if "Scan" in lines[scan] else 0
    assert "FileScan" in lines[scan] and "SelectedBucketsCount: 6 out of 6" in lines[scan]
    above = []  # the operators on the way up from the scan
    for line in lines[scan::-1]:
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            above.append(line.strip(" :+-"))
            depth = at
    assert any("SortMergeJoin" in line for line in above)
    assert not any(line.startswith(("Exchange", "Sort ", "Sort[")) or "Sort [" in line or "Aggregate" in line for line in above), above
    assert len([line for line in lines if "Exchange" in line]) == 1
    expected = merge(rows(spark, *FIRST, *[{KEY: f"x{i}"} for i in range(40)]), rows(spark, *SECOND))
    assert sorted(table.read().collect(), key=repr) == sorted(expected.collect(), key=repr)


def test_a_base_is_read_by_a_session_that_did_not_write_it(spark, place):
    """The catalog entry of a base is made anew where it is missing."""
    table = KeyedTable(spark, f"{place}/table", rows_per_bucket=5).create()
    table.upsert(rows(spark, *FIRST))
    table.compact()
    expected = sorted(table.read().collect())
    (base,) = [p for p in table._parts() if p.kind == "base"]
    spark.sql(f"DROP TABLE {table._name(base)}")
    again = KeyedTable(spark, f"{place}/table").create()
    assert sorted(again.read().collect()) == expected and again._buckets(base) == 4


def test_a_view_follows_upserts_and_compactions(spark, place):
    table = KeyedTable(spark, f"{place}/table").create()
    name = table.publish("checks", "followed")
    assert spark.table(name).count() == 0
    for step, act in enumerate((lambda: table.upsert(rows(spark, *FIRST)), table.compact, lambda: table.upsert(rows(spark, *SECOND)), table.compact, table.clean)):
        act()
        assert sorted(spark.table(name).collect(), key=repr) == sorted(table.read().collect(), key=repr), step
    spark.sql(f"DROP VIEW {name}")


def test_batches_without_end_leave_few_folders(spark, place, monkeypatch):
    """Many small batches: as many folders as allowed, and a constant number of file system calls."""
    table, most, n = keyed(spark, place), 20, 70
    calls = []
    for name in ("exists", "names", "read_text", "write_text", "delete", "make_dir"):
        real = getattr(Files, name)
        monkeypatch.setattr(Files, name, lambda self, *a, real=real: calls.append(1) or real(self, *a))
    per_batch, folders_seen = [], 0
    for i in range(n):
        calls.clear()
        table.upsert(rows(spark, {KEY: f"k{i % 7}", "age": i + 1, "resultado": i}), i, "run", compact_every=most)
        per_batch.append(len(calls))
        folders_seen = max(folders_seen, len(table._parts()))
    assert folders_seen <= most + 2
    plain = [calls for i, calls in enumerate(per_batch) if (i + 1) % most and i % most]
    assert max(plain) <= min(plain) + 1 and max(per_batch) <= min(plain) + 2 * most + 12
    found = as_dicts(table.read())
    assert {k: (r["age"], r["resultado"]) for k, r in found.items()} == {f"k{j}": (j + 1, max(i for i in range(n) if i % 7 == j)) for j in range(7)}


@pytest.mark.parametrize("point", ["/_done/batch-", "/_done/base-"])
def test_a_crash_at_any_point_of_a_compacting_writer(spark, place, monkeypatch, point):
    table = keyed(spark, place)
    expected = frame(spark, [])
    for i in range(6):
        batch = rows(spark, {KEY: f"k{i % 3}", "age": i + 1, "resultado": i}, {KEY: f"n{i}", "age": 9})
        if i in (2, 3):
            try:
                crash(monkeypatch, point, lambda: table.upsert(batch, i, "run", compact_every=3))
            except BaseException as failed:  # noqa: BLE001  no such file was to be written by this batch
                assert "DID NOT RAISE" in str(failed)
                monkeypatch.undo()
        table.upsert(batch, i, "run", compact_every=3)
        expected = frame(spark, [r.asDict() for r in merge(expected, latest_per_key(batch)).collect()])
        assert sorted(table.read().collect(), key=repr) == sorted(expected.collect(), key=repr)
        assert len(table._parts()) <= 6
