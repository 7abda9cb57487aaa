from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from riskflow.llm.queries import ORACLES, REGISTERED
from tests.checks import connect, differences

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
# sampled, trained or found by hashing; each is tested against a brute-force version
WITHOUT_SQL = {"op1_decontamination", "op3_language_id", "op5_secret_scan", "op7_lattice_lm", "op8_piece_sampling", "op9_simhash"}


def test_registered():
    assert {int(name[2:].split("_")[0]) for name in REGISTERED} == set(range(1, 14))
    assert set(REGISTERED) - set(ORACLES) == WITHOUT_SQL
    assert {*REGISTERED, "pipeline"} <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert differences(REGISTERED[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == []
