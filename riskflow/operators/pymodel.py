"""Any Python model with `predict` and `predict_proba` as a table function."""

from __future__ import annotations

import pickle
import uuid
from typing import Any, Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.schemas import OUTPUTS, quoted

MAX_BROADCAST = 512 << 20
SCORES = T.StructType([T.StructField(name, kind) for name, kind in zip(OUTPUTS, (T.IntegerType(), T.DoubleType(), T.DoubleType()))])


_loaded: dict[str, Any] = {}  # of a Python worker, which outlives its tasks


def loaded(name: str, pickled: bytes) -> Any:
    """The model of that name, unpickled once per worker; one model is held at a time."""
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = pickle.loads(pickled)
    return _loaded[name]


class SharedModel:
    """A model that is pickled and sent to the executors once, when it is first used.

    Its size is checked; larger ones go through `score_from`.
    """

    def __init__(self, model: Any, max_bytes: int = MAX_BROADCAST):
        self.model, self.max_bytes, self.name = model, max_bytes, uuid.uuid4().hex
        self._sent: Broadcast | None = None

    def sent(self, spark: SparkSession) -> Broadcast:
        if self._sent is None:
            pickled = cloudpickle.dumps(self.model)
            if len(pickled) > self.max_bytes:
                raise ValueError(f"model of {len(pickled)} bytes is too large to broadcast: use score_from")
            self._sent = spark.sparkContext.broadcast(pickled)
        return self._sent

    def destroy(self) -> None:
        """Remove it from the executors and the driver's disk; it can be sent again."""
        if self._sent is not None:
            self._sent.destroy()
            self._sent = None


def score_with(df: DataFrame, model: Any, features: Sequence[str], max_bytes: int = MAX_BROADCAST) -> DataFrame:
    """Append class and probabilities of a model, or of a `SharedModel` that many frames use."""
    shared = model if isinstance(model, SharedModel) else SharedModel(model, max_bytes)
    sent, name = shared.sent(df.sparkSession), shared.name
    # called by its name in the module, so that the worker's own table of models is meant
    return _score(df, lambda: loaded(name, sent.value), features)


def score_from(df: DataFrame, load: Callable[[], Any], features: Sequence[str]) -> DataFrame:
    """Append class and probabilities of a model each task loads once, from a shared path."""
    return _score(df, load, features)


def _score(df: DataFrame, get: Callable[[], Any], features: Sequence[str]) -> DataFrame:
    """Only the inputs go to Python, in Arrow batches; all other columns stay in the JVM."""
    outcome, negative, positive = OUTPUTS
    kept = [quoted(c) for c in df.columns if c not in OUTPUTS]

    @F.pandas_udf(SCORES)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = get()
        for inputs in batches:
            both = model.predict_proba(inputs)
            yield pd.DataFrame(
                {outcome: model.predict(inputs), negative: both[:, 0], positive: both[:, 1]}
            )

    inputs = F.struct(*[quoted(c) for c in features])
    return df.select(*kept, run(inputs).alias("_scores")).select(*kept, "_scores.*")
