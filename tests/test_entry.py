from __future__ import annotations

import os
import subprocess
import sys

import pytest

import __spark_entry__ as driver
from riskflow.plans.oracles import ORACLES
from riskflow.plans.queries import REGISTERED
from riskflow.schemas import EVENT_SCHEMA
from riskflow.storage import scratch_root


def test_entry(spark):
    found = driver.entry(spark)
    assert found.schema.names == EVENT_SCHEMA.names
    rows = found.collect()
    assert len(rows) > 10
    assert all(r["resultado"] in (0, 1) and 0 <= r["probabilidade_Sim"] <= 1 and r["age"] > 0 for r in rows)


def test_contract():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_a_cluster_needs_a_shared_folder():
    """Without a checkpoint folder, a warehouse on each machine's own disk is refused."""

    class Conf:
        def __init__(self, **known):
            self.known = known

        def get(self, name, default=None):
            return self.known.get(name.replace(".", "_"), default)

    class Context:
        def __init__(self, master, folder=None):
            self.master, self.folder = master, folder

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return self.folder

    class Session:
        def __init__(self, context, **known):
            self.sparkContext, self.conf = context, Conf(**known)

    own = {"spark_sql_warehouse_dir": "file:/home/x/spark-warehouse"}
    assert scratch_root(Session(Context("local[4]"), **own)) == "file:/home/x/spark-warehouse/scratch"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session(Context("yarn"), **own))
    assert scratch_root(Session(Context("yarn"), spark_sql_warehouse_dir="hdfs://n/w")) == "hdfs://n/w/scratch"
    assert scratch_root(Session(Context("yarn", "hdfs://n/c"), **own)) == "hdfs://n/c"
    assert scratch_root(Session(Context("yarn"), spark_checkpoint_dir="file:///shared/", **own)) == "file:///shared"


def test_library_queries_stay_without_what_the_subpackage_needs():
    """Whatever import of the training-data subpackage fails, the other queries are there."""
    code = (
        "import sys; sys.modules['ahocorasick'] = None; sys.modules['xxhash'] = None\n"
        "import __spark_entry__ as d; print(len(d.queries()), any(n.startswith('op') for n in d.queries()), len(d.oracle_sql()))"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(driver.__file__)).stdout.split()
    assert int(out[0]) == len(REGISTERED) and out[1] == "False" and int(out[2]) == len(ORACLES)
