from __future__ import annotations

import os

import pytest

from riskflow.operators.merge import KeyedTable
from riskflow.schemas import CSV_SCHEMA, EVENT_SCHEMA, KEY
from riskflow.sources.runs import RunLog, follow_metrics, scan_metrics, scan_values
from riskflow.sources.tables import create_table, create_view, read_csv, read_table
from tests.records import exam, frame

HEADER = ",".join(CSV_SCHEMA.names)


def test_csv_with_bom_and_crlf(spark, place):
    with open(f"{place}/a.csv", "w", encoding="utf-8-sig", newline="") as file:
        file.write(f"{HEADER}\r\n61,1,3,140,210,0,1,150,0,1.5,2,0,2,1\r\n44,0,0,120,190,1,0,170,1,0.0,1,4,3,0\r\n")
    for schema in (CSV_SCHEMA, None):
        df = read_csv(spark, f"{place}/a.csv", schema)
        assert df.columns == CSV_SCHEMA.names
        assert sorted(r["age"] for r in df.collect()) == [44, 61]
        assert sorted(r["target"] for r in df.collect()) == [0, 1]


def test_table_and_view_over_upserts(spark, place):
    stored = KeyedTable(spark, f"{place}/t").create()
    stored.upsert(frame(spark, [exam(**{KEY: f"k{i}"}) for i in range(9)]))
    name = create_table(spark, "checks", "scored", stored.compact())
    assert read_table(spark, name).columns == EVENT_SCHEMA.names and spark.sql(f"select * from {name}").count() == 9
    stored.upsert(frame(spark, [exam(**{KEY: f"k{i}"}) for i in range(5, 20)]))
    view = create_view(spark, "checks", "scored_now", stored.sql())
    assert sorted(read_table(spark, view).collect()) == sorted(stored.read().collect()) and read_table(spark, view).count() == 20
    # Creating the table anew over the next base drops the entry, not the files.
    create_table(spark, "checks", "scored", stored.compact())
    assert read_table(spark, name).count() == 20
    spark.sql("DROP DATABASE checks CASCADE")


def test_csv_header_is_checked(spark, place):
    """Columns in another order than the schema's are refused instead of read wrongly."""
    names = [*CSV_SCHEMA.names[1:], CSV_SCHEMA.names[0]]
    write(f"{place}/b.csv", ",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, f"{place}/b.csv").collect()


def test_plain_table(spark, place):
    name = create_table(spark, "checks", "plain", f"{place}/p")
    assert read_table(spark, name).schema.names == EVENT_SCHEMA.names and read_table(spark, name).count() == 0


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write(text)


def test_run_tree(spark, place):
    write(f"{place}/0/r1/metrics/mean_test_f1", "1640000000000 0.875 0\n1640000000001 0.9 1\n")
    write(f"{place}/0/r1/metrics/best score", "1640000000000 0.5\n")
    write(f"{place}/0/r2/metrics/a+b%", "1640000000002 -1.5e-3 0\n")
    write(f"{place}/0/r1/params/max_depth", "10")
    write(f"{place}/0/r1/tags/parent", "r0\n")
    found = {(r["run_id"], r["metric"], r["step"]): (r["ts"], r["value"]) for r in scan_metrics(spark, place).collect()}
    assert found == {
        ("r1", "mean_test_f1", 0): (1640000000000, 0.875),
        ("r1", "mean_test_f1", 1): (1640000000001, 0.9),
        ("r1", "best score", 0): (1640000000000, 0.5),
        ("r2", "a+b%", 0): (1640000000002, -0.0015),
    }
    assert [tuple(r) for r in scan_values(spark, place).collect()] == [("r1", "max_depth", "10")]
    assert [tuple(r) for r in scan_values(spark, place, "tags", "tag").collect()] == [("r1", "parent", "r0")]


def test_run_log(spark, place):
    log = RunLog(spark, f"{place}/runs")
    assert log.params().count() == 0 and log.metrics().count() == 0
    log.log_params("r1", {"trees": 125, "depth": 10})
    log.log_metrics("r1", {"auc": 0.9})
    log.log_metrics("r2", {"auc": 0.8}, step=3)
    assert {tuple(r) for r in log.params().collect()} == {("r1", "trees", "125"), ("r1", "depth", "10")}
    assert {(r["run_id"], r["value"], r["step"]) for r in log.metrics().collect()} == {("r1", 0.9, 0), ("r2", 0.8, 3)}


def test_followed_files_are_read_once(spark, place):
    """A second scan reads new files alone: the old ones may be gone."""
    runs, tree = RunLog(spark, f"{place}/log"), f"{place}/tree"

    def put(run, metric, text):
        os.makedirs(f"{tree}/0/{run}/metrics", exist_ok=True)
        with open(f"{tree}/0/{run}/metrics/{metric}", "w") as f:
            f.write(text)

    put("a", "f1", "5 0.5 0\n6 0.6 1\n")
    first = follow_metrics(spark, tree, runs, f"{place}/checkpoint")
    first.awaitTermination()
    assert sorted(runs.metrics().collect()) == [("a", "f1", 5, 0.5, 0), ("a", "f1", 6, 0.6, 1)]
    os.remove(f"{tree}/0/a/metrics/f1")
    put("b", "auc", "7 0.7\n")
    second = follow_metrics(spark, tree, runs, f"{place}/checkpoint")
    second.awaitTermination()
    assert second.recentProgress[-1]["numInputRows"] == 1
    assert sorted(runs.metrics().collect()) == [("a", "f1", 5, 0.5, 0), ("a", "f1", 6, 0.6, 1), ("b", "auc", 7, 0.7, 0)]
    follow_metrics(spark, tree, runs, f"{place}/checkpoint").awaitTermination()
    assert runs.metrics().count() == 3


def test_a_write_under_its_key_is_written_once(spark, place):
    runs = RunLog(spark, f"{place}/log")
    for value in (1, 2):
        runs.log_metrics("r", {"m": value}, key="same")
        runs.log_params("r", {"p": value}, key="same / other?")
    assert [r["value"] for r in runs.metrics().collect()] == [2.0] and [r["value"] for r in runs.params().collect()] == ["2"]
    runs.log_metrics("r", {"m": 3})
    runs.log_metrics("r", {"m": 3})
    assert runs.metrics().count() == 3
