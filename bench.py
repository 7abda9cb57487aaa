"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. A query's time is the
better of two runs to a no-op sink (training and streaming run once). The extra
`per_fit_242_rows` is the wall time per (candidate, fold) of a cross-validated
search with the production forest on 242 records, scoring included.
"""

from __future__ import annotations

import json
import os
import time
from typing import Callable

from pyspark.sql import DataFrame

from riskflow.operators import encode
from riskflow.operators.search import forest_grid, grid_search
from riskflow.plans.inputs import BY_EVENT, TARGET, exam_records
from riskflow.plans.queries import REGISTERED
from riskflow.schemas import KEY, LABEL
from riskflow.session import build_session
from riskflow.storage import scratch_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
TWICE = (
    "json_roundtrip",
    "json_documents",
    "exam_features",
    "training_features",
    "onehot_learned",
    "join_scores",
    "merge_upsert",
    "merge_dedup",
    "table_upsert",
    "onehot_sparse",
    "hash_split",
    "class_weights",
    "strat_folds_events",
    "confusion_prf",
    "logloss_brier",
    "roc_auc",
    "curves_by_fold",
    "class_report",
    "fold_summary",
    "rank_users",
    "registry_resolve",
    "udf_score",
    "score_messages",
    "score_upsert",
)
ONCE = ("stream_upsert", "forest_score")
SEARCH_RECORDS, SEARCH_FOLDS = 242, 10


def seconds(action: Callable[[], object]) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "20g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in TWICE:
        times[name] = min(seconds(lambda: drain(REGISTERED[name](spark, SF_DIR))) for _ in range(2))
    for name in ONCE:
        times[name] = seconds(lambda: drain(REGISTERED[name](spark, SF_DIR)))

    records = exam_records(spark, SF_DIR, BY_EVENT, f"{TARGET} AS {LABEL}", "event_id").where("age > 0")
    train = encode.with_indicators(records.orderBy("event_id").limit(SEARCH_RECORDS).drop("event_id"))
    grid = forest_grid()
    took = seconds(
        lambda: grid_search(
            train, grid, scratch_dir(spark, "bench"), KEY, folds=SEARCH_FOLDS, parallelism=2 * int(CPUS)
        )
    )
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "per_fit_242_rows": round(took / (len(grid) * SEARCH_FOLDS), 4),
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
