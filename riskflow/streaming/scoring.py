"""Stream of exam messages into the keyed result table."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskflow.functions.bodies import REASONS
from riskflow.operators.merge import KeyedTable
from riskflow.plans.scoring import Scorer, judged, score_records
from riskflow.storage import Files

Batch = Callable[[DataFrame, int], None]
COMPACT_EVERY = 50  # batches
MESSAGES, KEPT = "messages", "kept"
COUNTS = "run string, batch long, reason string, messages long"


def reject_counts() -> list[Column]:
    """Messages, those that are kept, and the others by reason, of judged records."""
    by_reason = [F.count_if(F.col("reject") == r).alias(r) for r in REASONS]
    return [F.count(F.lit(1)).alias(MESSAGES), F.count_if(F.col("reject").isNull()).alias(KEPT), *by_reason]


@dataclass(frozen=True)
class RejectLog:
    """Counts per batch in small JSON files, one for every thousand batches of a run.

    A batch that is run again replaces its own counts.
    """

    spark: SparkSession
    path: str
    batches_per_file: int = 1000

    def put(self, run: str, batch: int, counts: dict[str, int]) -> None:
        files, place = Files(self.spark, self.path), f"{self.path}/{run}-{batch // self.batches_per_file:09d}.json"
        lines = files.read_text(place).splitlines() if files.exists(place) else []
        others = [line for line in lines if json.loads(line)["batch"] != batch]
        rows = [json.dumps({"run": run, "batch": batch, "reason": reason, "messages": n}) for reason, n in counts.items()]
        if not lines:
            files.make_dir(self.path)
        files.write_text(place, "\n".join([*others, *rows]))

    def read(self) -> DataFrame:
        """Columns run, batch, reason (also "messages" for all and "kept") and messages."""
        if not Files(self.spark, self.path).names(self.path):
            return self.spark.createDataFrame([], COUNTS)
        return self.spark.read.schema(COUNTS).json(self.path)


def batch_processor(
    table: KeyedTable,
    scorer: Scorer,
    run_id: Callable[[], str],
    as_of: str | None = None,
    on_missing: str = "default",
    on_duplicate: str = "latest",
    compact_every: int | None = COMPACT_EVERY,
    rejects: RejectLog | None = None,
) -> Batch:
    """The per-batch function: guard, decode, encode, score, upsert.

    Columns next to `body` order several messages of one key. Works on any batch
    frame; nothing but counts comes to the driver. Given `rejects`, what is not scored is
    counted by reason in the pass that scores the others.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        order: Sequence[str] = [c for c in batch.columns if c != "body"]
        records, run = judged(batch), run_id()
        seen = Observation()
        new = rejects is not None and not table.applied(batch_id, run)
        observed = records.observe(seen, *reject_counts()) if new else records
        usable = observed.where(F.col("reject").isNull()).drop("reject")
        scored = score_records(usable, scorer, as_of, on_missing, order)
        table.upsert(scored, batch_id, run, order, on_duplicate, compact_every)
        if rejects is not None:  # a batch that died after it was applied is not scored again, but counted
            counts = seen.get if new else records.agg(*reject_counts()).first().asDict()
            rejects.put(run, batch_id, counts)

    return process


def start_scoring(
    messages: DataFrame,
    table: KeyedTable,
    scorer: Scorer,
    checkpoint: str,
    as_of: str | None = None,
    on_missing: str = "default",
    on_duplicate: str = "latest",
    compact_every: int | None = COMPACT_EVERY,
    rejects: RejectLog | None = None,
    **trigger: object,
) -> StreamingQuery:
    """Start the query; `trigger` takes the keywords of `DataStreamWriter.trigger`.

    The checkpoint makes it restartable. A batch replayed after a crash finds its
    own folder by query id and batch number, so it is applied once in effect. After every
    `compact_every` batches they become part of the table's base, and their folders are
    deleted with the next batch (None: never).
    """

    def run_id() -> str:
        # The id lives as long as the checkpoint, as batch numbers do.
        return json.loads(Files(table.spark, checkpoint).read_text(f"{checkpoint}/metadata"))["id"]

    writer = (
        messages.writeStream.foreachBatch(
            batch_processor(table, scorer, run_id, as_of, on_missing, on_duplicate, compact_every, rejects)
        )
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
