from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from riskflow.operators.merge import KeyedTable
from riskflow.plans.inputs import logistic_model
from riskflow.plans.scoring import python_scorer, score_bodies
from riskflow.schemas import EVENT_SCHEMA, KEY
from riskflow.sources.streams import open_stream
from riskflow.storage import Files
from riskflow.streaming.scoring import RejectLog, batch_processor, start_scoring
from tests.records import as_dicts, body, messages

AS_OF = "2024-01-02"
SCHEMA = "offset long, body binary"


class Stream:
    def __init__(self, spark, place):
        self.spark, self.place = spark, place
        self.table = KeyedTable(spark, f"{place}/table").create()
        self.sent = 0

    def send(self, *bodies):
        messages(self.spark, bodies, self.sent).coalesce(1).write.mode("append").parquet(f"{self.place}/in")
        self.sent += len(bodies)

    def run(self, **options):
        source = open_stream(
            self.spark,
            "parquet",
            {"maxFilesPerTrigger": "1"},
            f"{self.place}/in",
            keep=["offset"],
            schema=messages(self.spark, []).schema,
        )
        query = start_scoring(
            source,
            self.table,
            python_scorer(logistic_model()),
            f"{self.place}/checkpoint",
            AS_OF,
            availableNow=True,
            **options,
        )
        query.awaitTermination()
        return query

    def rows(self):
        return sorted(self.table.read().collect())


@pytest.fixture
def stream(spark, place):
    return Stream(spark, place)


BODIES = [body(pacienteId=f"k{i}", age=30 + i, sex=i % 2) for i in range(8)]


def test_stream_equals_batch(spark, stream):
    stream.send(*BODIES[:5])
    stream.send(*BODIES[5:])
    stream.run()
    batch = score_bodies(messages(spark, BODIES), python_scorer(logistic_model()), AS_OF)
    assert stream.rows() == sorted(batch.drop("offset").collect())


def test_restart_continues(spark, stream):
    stream.send(*BODIES[:3])
    stream.run()
    stream.send(*BODIES[3:], body(pacienteId="k0", age=90))
    stream.run()
    stream.run()
    found = as_dicts(stream.table.read())
    assert len(found) == 8 and found["k0"]["age"] == 30


def test_dirty_messages(spark, stream):
    stream.send(
        body(pacienteId="ok"),
        "not json",
        "{}",
        None,
        '[{"pacienteId":"h","age":1}]',
        body(pacienteId="text", age="63"),
        body(pacienteId="zero", age=0),
        body(pacienteId=None),
        body(pacienteId=7),
        body(pacienteId="codes", sex=None, thalassemia=99),
    )
    stream.run()
    assert set(as_dicts(stream.table.read())) == {"ok", "7", "codes"}


def test_last_of_a_batch_wins(stream):
    stream.send(body(pacienteId="a", age=20), body(pacienteId="a", age=30), body(pacienteId="a", age=25))
    stream.run()
    assert as_dicts(stream.table.read())["a"]["age"] == 25


def test_batches_without_usable_rows(stream):
    stream.send(body(age=0), "x")
    stream.run()
    assert stream.rows() == []


def test_empty_batch_returns_before_any_work(spark, place):
    table = KeyedTable(spark, f"{place}/t").create()
    process = batch_processor(table, lambda df: 1 / 0, lambda: 1 / 0)
    process(messages(spark, []), 0)
    assert table.read().count() == 0


def test_duplicates_can_stop_the_stream(stream):
    stream.send(body(pacienteId="a", age=20), body(pacienteId="a", age=30))
    with pytest.raises(Exception, match="more than one row for key a"):
        stream.run(on_duplicate="error")


@pytest.mark.parametrize("before_marker", [True, False])
def test_replayed_batch_after_a_crash(stream, monkeypatch, before_marker):
    """The batch dies just before or just after it counts; the restarted query runs it again."""
    stream.send(*BODIES)
    real = Files.write_text

    def write_text(self, path, text):
        marker = "/_done/" in path
        if marker and before_marker:
            raise OSError("lost")
        real(self, path, text)
        if marker:
            raise OSError("lost")

    monkeypatch.setattr(Files, "write_text", write_text)
    with pytest.raises(Exception, match="lost"):
        stream.run()
    monkeypatch.undo()
    assert len(stream.rows()) == (0 if before_marker else 8)
    stream.run()
    assert len(stream.rows()) == 8 and len(stream.table._parts()) == 1


def test_empty_batch_in_the_middle(stream):
    stream.send(*BODIES[:4])
    stream.send()
    stream.send(*BODIES[4:])
    stream.run()
    assert len(stream.rows()) == 8


def test_model_is_sent_once(spark, stream, monkeypatch):
    from pyspark import SparkContext

    sent = []
    real = SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sent.append(value) or real(self, value))
    stream.send(*BODIES[:4])
    stream.send(*BODIES[4:])
    stream.run()
    assert len(sent) == 1 and len(stream.rows()) == 8


def test_new_checkpoint_applies_its_own_batches(stream):
    """Batch numbers restart with a new checkpoint at the same path."""
    stream.send(*BODIES[:2])
    stream.run()
    shutil.rmtree(f"{stream.place}/checkpoint")
    for name in os.listdir(f"{stream.place}/in"):
        os.remove(f"{stream.place}/in/{name}")
    stream.send(*BODIES[2:])
    stream.run()
    assert len(stream.rows()) == 8


def test_payload_column_is_renamed(spark, place):
    messages(spark, BODIES).withColumnRenamed("body", "value").write.parquet(f"{place}/in")
    source = open_stream(
        spark, "parquet", {}, f"{place}/in", payload="value", keep=["offset"], schema=spark.read.parquet(f"{place}/in").schema
    )
    assert source.isStreaming and source.columns == ["body", "offset"]


def test_scores_match_the_columns(spark):
    scored = score_bodies(messages(spark, BODIES), python_scorer(logistic_model()), AS_OF)
    assert scored.columns == [*EVENT_SCHEMA.names, "offset"]
    assert scored.select(KEY, F.col("data")).distinct().count() == 8


DIRTY = (body(pacienteId="ok"), "not json", "{}", None, body(pacienteId="zero", age=0), body(pacienteId=None), body(pacienteId="text", age="x"))
REASONED = {"messages": 7, "kept": 1, "unparsable": 2, "no_key": 2, "not_positive": 2}


def test_rejects_are_counted_per_batch(spark, stream, place):
    """What is not scored is counted by reason, in the pass that scores the rest."""
    log = RejectLog(spark, f"{place}/rejects", batches_per_file=2)
    assert log.read().count() == 0
    for _ in range(3):
        stream.send(*DIRTY)
    stream.send(*BODIES)
    stream.run(rejects=log)
    found = {}
    for r in log.read().collect():
        found.setdefault(r["batch"], {})[r["reason"]] = r["messages"]
    assert sorted(map(str, found.values())) == sorted(map(str, [REASONED] * 3 + [{"messages": 8, "kept": 8, "unparsable": 0, "no_key": 0, "not_positive": 0}]))
    assert len(os.listdir(log.path)) >= 2 and len(stream.rows()) == 9


def test_counts_of_a_replayed_batch(spark, place):
    """A batch that was applied before its counts were written is counted when it is run again."""
    table, log = KeyedTable(spark, f"{place}/t").create(), RejectLog(spark, f"{place}/rejects")
    batch, scorer = messages(spark, DIRTY), python_scorer(logistic_model())
    batch_processor(table, scorer, lambda: "run", AS_OF)(batch, 0)
    for _ in range(2):
        batch_processor(table, scorer, lambda: "run", AS_OF, rejects=log)(batch, 0)
        assert {r["reason"]: r["messages"] for r in log.read().collect()} == REASONED


def test_the_stream_compacts(spark, stream):
    """Folders stay few, and rows as they are without compaction."""
    for i in range(7):
        stream.send(body(pacienteId="a", age=20 + i), body(pacienteId=f"n{i}", age=30))
    stream.run(compact_every=3)
    assert len(stream.table._parts()) <= 5 and any(p.kind == "base" for p in stream.table._parts())
    assert len(stream.rows()) == 8 and as_dicts(stream.table.read())["a"]["age"] in range(20, 27)
