"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from riskflow.plans import queries
from riskflow.plans.oracles import ORACLES
from riskflow.plans.queries import REGISTERED
from tests.checks import connect, differences

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
ROWS_ONLY = {"forest_score", "grid_search"}


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTERED) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(REGISTERED)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, oracle, name):
    assert differences(REGISTERED[name](spark, SF_DIR), oracle, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, name):
    assert REGISTERED[name](spark, SF_DIR).count() > 0


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_rounded_means_do_not_depend_on_order(spark, oracle, monkeypatch, partitions):
    """Ties of rounding fall the same way however the rows are dealt."""
    given = queries.table
    monkeypatch.setattr(queries, "table", lambda *of: given(*of).repartition(partitions + 2, F.rand(partitions)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        for name in ("metric_scan", "rank_users", "rank_runs", "best_run", "top5_runs", "run_log", "grid_scores", "fold_summary"):
            assert differences(REGISTERED[name](spark, SF_DIR), oracle, ORACLES[name]) == [], name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
