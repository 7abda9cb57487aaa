"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from dataclasses import replace
from typing import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.bodies import as_body, expand_bodies, parse_body
from riskflow.operators import encode, merge, metrics, ranking, registry, search, split
from riskflow.operators.forest import ForestParams, class_probability, fit_forest, score
from riskflow.operators.pymodel import score_with
from riskflow.plans.inputs import (
    BY_EVENT,
    BY_USER,
    BY_USER_TYPE,
    TARGET,
    evaluated_events,
    exam_messages,
    exam_records,
    logistic_model,
    table,
)
from riskflow.plans.scoring import judged, model_scorer, python_scorer, score_bodies, score_records
from riskflow.plans.training import training_frame
from riskflow.schemas import (
    CSV_SCHEMA,
    EVENT_SCHEMA,
    EXAM_COLUMNS,
    FEATURES,
    KEY,
    LABEL,
    OUTPUTS,
    TRAINING_NAMES,
    CodeTable,
    quoted,
    signature_of,
)
from riskflow.sources.runs import RunLog, follow_metrics, scan_metrics, scan_values
from riskflow.sources.streams import open_stream, publish
from riskflow.sources.tables import create_table, read_csv, read_table
from riskflow.storage import scratch_dir, written
from riskflow.streaming.scoring import start_scoring

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = "2024-01-02"
DIGITS = 6
REGISTERED: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTERED[run.__name__] = run
    return run


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(quoted(c), DIGITS) for c in columns})


def whole_mean(digits: int) -> Column:
    """The mean value of events in units of 10^-digits, half up, as a whole number.

    Values have whole cents, so sums of cents and an integer division give the same
    whatever the order of the rows; a rounded mean of doubles does not where it is a tie.
    """
    total, rows = "sum(cast(round(value * 100) AS bigint))", "count(value)"
    return F.expr(f"(2 * {10**digits} * {total} + 100 * {rows}) div nullif(200 * {rows}, 0)")


# JSON messages


@query
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exam records to binary JSON messages and back to columns."""
    return expand_bodies(exam_messages(spark, sf_dir, BY_EVENT), EVENT_SCHEMA).select(
        KEY, *TRAINING_NAMES[:-1], *[c for c in EVENT_SCHEMA.names[-4:]]
    )


@query
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field out of a JSON text column."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("props").cast("binary").alias("body"))
    return expand_bodies(events, T.StructType().add("k", "long")).select("event_id", "k")


@query
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as JSON texts."""
    return as_body(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"))


@query
def json_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages written through a sink, then read back and parsed."""
    place = scratch_dir(spark, "publish")
    publish(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "parquet", {}, place)
    schema = T.StructType().add("c_custkey", "long").add("c_nationkey", "integer").add("c_mktsegment", "string")
    return expand_bodies(spark.read.parquet(place), schema)


@query
def json_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed, empty, mistyped and NULL messages: what parses, what is kept."""
    kind = F.col("event_id") % 6
    number = F.col("event_id").cast("string")
    body = (
        F.when(kind == 0, F.concat(F.lit('{"pacienteId":"p'), number, F.lit('","age":40,"st_depression":3,"x":1}')))
        .when(kind == 1, F.concat(F.lit('{"pacienteId":'), number, F.lit(',"age":"63"}')))
        .when(kind == 2, F.concat(F.lit("not json "), number))
        .when(kind == 3, F.lit("{}"))
        .when(kind == 4, F.concat(F.lit('[{"pacienteId":"'), number, F.lit('","age":1}]')))
    )
    bodies = table(spark, sf_dir, "events").select("event_id", body.cast("binary").alias("body"))
    parsed = expand_bodies(bodies, EVENT_SCHEMA)
    kept = F.coalesce(F.col("age") > 0, F.lit(False))
    return parsed.select("event_id", KEY, "age", "st_depression", kept.cast("int").alias("kept"))


def _dirty_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 8
    number = F.col("event_id").cast("string")
    body = (
        F.when(kind == 0, F.concat(F.lit('{"pacienteId":"p'), number, F.lit('","age":40,"sex":"odd"}')))
        .when(kind == 1, F.concat(F.lit('{"pacienteId":'), number, F.lit(',"age":"63"}')))
        .when(kind == 2, F.concat(F.lit("not json "), number))
        .when(kind == 3, F.lit("{}"))
        .when(kind == 4, F.lit('{"age":7}'))
        .when(kind == 5, F.concat(F.lit('{"pacienteId":"q'), number, F.lit('","age":'), F.floor("value").cast("string"), F.lit("}")))
        .when(kind == 6, F.concat(F.lit('{"pacienteId":"r'), number, F.lit('"')))
    )
    return table(spark, sf_dir, "events").select("event_id", body.cast("binary").alias("body"))


@query
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by the reason for which they are not scored; together they are all messages."""
    found = judged(_dirty_bodies(spark, sf_dir)).groupBy(F.coalesce("reject", F.lit("kept")).alias("reason"))
    return found.agg(F.count(F.lit(1)).alias("messages"), F.sum("event_id").alias("event_ids"))


@query
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole prose texts taken for messages: every document parses to NULLs."""
    parsed = table(spark, sf_dir, "documents").select(
        "lang", parse_body(F.col("text").cast("binary"), EVENT_SCHEMA).alias("record")
    )
    return parsed.groupBy("lang").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("record.age") > 0).alias("kept"),
    )


# Projections and filters


@query
def rename_select_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    renamed = encode.rename_by_position(customers, ["id", "name", "nation", "balance", "segment"])
    return encode.select_features(renamed, "id", ["balance", "nation", "segment", "name"]).drop("name")


@query
def placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.with_placeholders(table(spark, sf_dir, "orders").select("o_orderkey"))


@query
def load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.with_load_date(table(spark, sf_dir, "orders").select("o_orderkey"), AS_OF)


@query
def positive_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.positive(exam_records(spark, sf_dir)).select(KEY, "age")


@query
def probability_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both class probabilities out of a probability vector."""
    vectors = evaluated_events(spark, sf_dir, "event_id").select(
        "event_id", array_to_vector(F.array(1 - F.col("p1"), "p1")).alias("probability")
    )
    return rounded(
        vectors.select(
            "event_id",
            class_probability(0).alias("probabilidade_Nao"),
            class_probability(1).alias("probabilidade_Sim"),
        ),
        "probabilidade_Nao",
        "probabilidade_Sim",
    )


# Feature encoding

SIZES = {"p_size": CodeTable({1: "tiny", 2: "small", 3: "medium"}, "large")}
SEGMENTS = ("c_mktsegment",)


@query
def decode_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.decode(table(spark, sf_dir, "part").select("p_partkey", "p_size"), SIZES)


@query
def decode_exams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven coded columns, NULL and unlisted codes included."""
    return encode.decode(exam_records(spark, sf_dir)).select(
        KEY,
        "sex",
        "chest_pain_type",
        "fasting_blood_sugar",
        "rest_ecg",
        "exercise_induced_angina",
        "st_slope",
        "thalassemia",
    )


@query
def decode_keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL codes stay NULL instead of taking the default."""
    return encode.decode(exam_records(spark, sf_dir), on_missing="null").select(KEY, "sex")


@query
def decode_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.decode_strict(table(spark, sf_dir, "part").select("p_partkey", "p_size"), SIZES)


@query
def onehot_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = encode.positive(table(spark, sf_dir, "lineitem"), "l_discount")
    flags = lines.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return encode.one_hot(flags, {"l_returnflag": ["A", "N"], "l_linestatus": ["O"]})


@query
def onehot_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return encode.one_hot_learned(customers, SEGMENTS)


@query
def onehot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicators as rows, for columns with more levels than a table can be wide."""
    return encode.indicator_rows(table(spark, sf_dir, "part"), "p_partkey", ["p_brand", "p_size"])


@query
def onehot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sparse vector with places for every name, brand and size, unpacked: its size, the places, the values."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    encoded = encode.one_hot_sparse(parts, ["p_name", "p_brand", "p_size"], "levels").select("p_partkey", F.unwrap_udt("levels").alias("v"))
    return encoded.select(
        "p_partkey",
        F.col("v.size").alias("size"),
        F.explode(F.arrays_zip("v.indices", "v.values")).alias("entry"),
    ).select("p_partkey", "size", F.col("entry.indices").alias("position"), F.col("entry.values").alias("value"))


@query
def exam_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id and the 19 model inputs."""
    return encode.exam_features(exam_records(spark, sf_dir))


@query
def training_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training encoding with levels learned from the data, codes 0 left as numbers."""
    records = exam_records(spark, sf_dir, BY_EVENT, f"{TARGET} AS {LABEL}").drop(KEY)
    frame = training_frame(records)
    inputs = [c for c in frame.columns if c not in (LABEL, "row_key")]
    indicators = inputs[6:]
    return frame.groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("records"),
        *[F.sum(quoted(c)).alias(c) for c in indicators],
    )


@query
def sentinel_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padding with rows that the filter removes again leaves the data as it was."""
    records = exam_records(spark, sf_dir)
    extra = [{KEY: str(i), **{name: i for name, _ in EXAM_COLUMNS}, "st_depression": 0.0, "age": 0} for i in range(4)]
    sentinels = encode.literal_rows(spark, extra, records.schema)
    padded = encode.pad(records, sentinels)
    return encode.positive(encode.append_by_position(padded, sentinels))


@query
def assembled_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vector, unpacked to (key, position, value)."""
    vectors = encode.assembler(handle_invalid="error").transform(encode.exam_features(exam_records(spark, sf_dir)))
    return vectors.select(KEY, F.posexplode(vector_to_array("features")).alias("position", "value"))


# Joins, merge and upsert

ORDER_SCHEMA = (
    T.StructType()
    .add("o_orderkey", "long")
    .add("o_custkey", "long")
    .add("o_orderstatus", "string")
    .add("o_totalprice", "double")
)


def _order_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders, and changes to them whose keys lie 1000 higher: most match, the top ones are new."""
    target = table(spark, sf_dir, "orders").select(*ORDER_SCHEMA.names)
    source = target.withColumns(
        {
            "o_orderkey": F.col("o_orderkey") + 1000,
            "o_totalprice": F.col("o_totalprice") + 1000,
            "o_orderstatus": F.lit("X"),
        }
    )
    return target, source


@query
def join_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return merge.join_scores(orders, customers, "o_custkey")


@query
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _order_sides(spark, sf_dir)
    return merge.merge(target, source, "o_orderkey", ["o_totalprice"])


@query
def merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return merge.latest_per_key(events, "user_id", ["ts", "event_id"])


@query
def table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two upserts into a keyed table: a first load, compacted, then changes and new rows."""
    target, source = _order_sides(spark, sf_dir)
    stored = merge.KeyedTable(spark, scratch_dir(spark, "orders"), ORDER_SCHEMA, "o_orderkey", ("o_totalprice",)).create()
    stored.upsert(target)
    stored.compact()
    stored.upsert(source)
    return stored.read()


@query
def table_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a catalog table over a compacted location, scan it and drop the entry."""
    stored = merge.KeyedTable(spark, scratch_dir(spark, "ddl"), ORDER_SCHEMA, "o_orderkey", ("o_totalprice",)).create()
    stored.upsert(table(spark, sf_dir, "orders").select(*ORDER_SCHEMA.names))
    place = stored.compact()
    name = create_table(spark, "riskflow_checks", f"orders_{uuid.uuid4().hex}", place, ORDER_SCHEMA)
    found = read_table(spark, name)
    spark.sql(f"DROP TABLE {name}")  # external: the rows stay, and so does the scan of them
    return found


@query
def table_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, compacted, and a later upsert, seen through a catalog view made before it."""
    target, source = _order_sides(spark, sf_dir)
    stored = merge.KeyedTable(spark, scratch_dir(spark, "view"), ORDER_SCHEMA, "o_orderkey", ("o_totalprice",)).create()
    stored.upsert(target)
    stored.compact()
    name = stored.publish("riskflow_checks", f"orders_{uuid.uuid4().hex}")
    stored.upsert(source)
    found = read_table(spark, name)
    spark.sql(f"DROP VIEW {name}")
    return found


@query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exam rows written as CSV with a header, read back and renamed by position."""
    place = scratch_dir(spark, "csv")
    exams = exam_records(spark, sf_dir, BY_EVENT, f"{TARGET} AS target").drop(KEY)
    encode.rename_by_position(exams, CSV_SCHEMA.names).write.option("header", True).csv(place)
    return encode.rename_by_position(read_csv(spark, place), TRAINING_NAMES)


# Split, weights, folds


@query
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", split.held_out(F.col("event_id")).cast("int").alias("is_test"))


@query
def hash_split_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two frames of the split, counted."""
    train, test = split.split(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides.groupBy("side", "lang").agg(F.count(F.lit(1)).alias("docs"))


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return rounded(split.with_class_weights(labels, "toxic"), "weight")


@query
def strat_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.with_folds(table(spark, sf_dir, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query
def strat_folds_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return split.with_folds(events, "event_type", "event_id")


def _some_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return events.withColumn("key", F.when(F.col("event_id") % 7 != 0, F.col("event_id")))


@query
def hash_split_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two sides of a split in which one key in seven is NULL: together all rows."""
    train, test = split.split(_some_without_key(spark, sf_dir), "key")
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("key").isNull()).alias("without_key"))


@query
def strat_folds_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold sizes per class when one key in seven is NULL: exact, and together all rows."""
    folded = split.with_folds(_some_without_key(spark, sf_dir), "event_type", "key")
    return folded.groupBy("event_type", "fold").agg(F.count(F.lit(1)).alias("events"))


# Metrics


@query
def confusion_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = metrics.confusion(evaluated_events(spark, sf_dir, "event_id % 10 AS fold"), by=["fold"])
    return rounded(metrics.with_rates(counts), "precision", "recall", "f1", "balanced_accuracy", "accuracy")


@query
def confusion_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity predicted from document length, against the labels."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    judged = table(spark, sf_dir, "labels").join(documents, "doc_id")
    rated = judged.withColumn("guess", (F.col("n_chars") > 1000).cast("int"))
    counts = metrics.confusion(rated, "toxic", "guess", ["lang"])
    return rounded(metrics.with_rates(counts), "precision", "recall", "f1", "balanced_accuracy", "accuracy")


@query
def logloss_brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.losses(evaluated_events(spark, sf_dir)), "log_loss", "brier_score")


@query
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.curve_metrics(evaluated_events(spark, sf_dir)).select("roc_auc"), "roc_auc")


@query
def avg_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        metrics.curve_metrics(evaluated_events(spark, sf_dir)).select("average_precision"), "average_precision"
    )


@query
def curves_by_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both curve metrics per group, with the order cut into many ranges."""
    events = evaluated_events(spark, sf_dir, "event_id % 10 AS fold")
    curves = metrics.curve_metrics(events, by=["fold"], rows_per_range=500, max_ranges=64)
    return rounded(curves, "roc_auc", "average_precision")


@query
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five event types, predicted from a JSON field."""
    k = F.get_json_object("props", "$.k").cast("int") % 5
    names = F.array(*[F.lit(n) for n in ("view", "click", "error", "signup", "purchase")])
    guessed = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("label"), F.element_at(names, k + 1).alias("prediction")
    )
    return rounded(metrics.class_report(guessed), "precision", "recall", "f1")


@query
def training_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.training_metrics(evaluated_events(spark, sf_dir)), "value")


def _run_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold scores of runs: the mean event value per (run, fold, metric), in whole cents."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            (F.col("user_id") % 20).alias("candidate"),
            F.col("event_type").alias("metric"),
            (F.col("event_id") % 10).alias("fold"),
        )
        .agg(whole_mean(2).cast("double").alias("value"))
    )


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rounded to whole units, so that ties occur.
    summary = ranking.fold_summary(_run_scores(spark, sf_dir))
    return summary.select("candidate", "metric", F.round("mean", 0).alias("mean"), "std")


@query
def fold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking.fold_summary(_run_scores(spark, sf_dir)), "mean", "std")


@query
def rank_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking.rank_candidates(_summary(spark, sf_dir)), "mean", "std")


@query
def rank_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks over many candidates, with the order cut into ranges."""
    means = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("candidate"), F.col("event_type").alias("metric"))
        .agg(whole_mean(0).cast("double").alias("mean"))
    )
    return ranking.rank_candidates(means, rows_per_range=50, max_ranges=64)


@query
def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking.best_candidate(_summary(spark, sf_dir)), "mean")


@query
def top5_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranking.rank_candidates(_summary(spark, sf_dir))
    return rounded(ranking.top_candidates(ranked, "purchase"), "mean", "std")


@query
def grid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 600 parameter combinations, each with the scores of its events."""
    scores = (
        table(spark, sf_dir, "events")
        .groupBy((F.col("event_id") % 600).alias("candidate"))
        .agg((whole_mean(DIGITS) / 10**DIGITS).alias("mean"), F.count(F.lit(1)).alias("events"))
    )
    return scores.join(search.grid_rows(spark), "candidate")


# Runs and registry


@query
def metric_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores written as one text file per run and metric, then scanned by path."""
    place = scratch_dir(spark, "runs")
    _metric_files(spark, sf_dir, place, F.lit(True))
    return scan_metrics(spark, place, *METRIC_TREE)


@query
def metric_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in two parts: the second scan reads what has come since the first."""
    place, log = scratch_dir(spark, "tree"), RunLog(spark, scratch_dir(spark, "followed"))
    checkpoint, small = scratch_dir(spark, "follow"), F.col("candidate") % 3 == 0
    for part in (small, ~small):
        _metric_files(spark, sf_dir, place, part)
        follow_metrics(spark, place, log, checkpoint, *METRIC_TREE).awaitTermination()
    return log.metrics()


METRIC_TREE = ("*/*/*", r"run=([^/]+)/metric=([^/]+)/[^/]+$")


def _metric_files(spark: SparkSession, sf_dir: str, place: str, part: Column) -> None:
    lines = (
        _run_scores(spark, sf_dir)
        .where(part)
        .groupBy("candidate", "metric")
        .agg(F.round(F.avg("value"), 4).alias("value"))
        .select(
            F.concat(F.lit("run"), "candidate").alias("run"),
            "metric",
            F.format_string("1700000000000 %.4f 0", "value").alias("text"),
        )
    )
    lines.repartition("run", "metric").write.mode("append").partitionBy("run", "metric").text(place)


@query
def value_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parameter per run and name, each in a text file of its own, scanned by path."""
    place = scratch_dir(spark, "values")
    values = table(spark, sf_dir, "events").groupBy(
        F.concat(F.lit("run"), (F.col("user_id") % 20).cast("string")).alias("run"), F.col("event_type").alias("param")
    )
    lines = values.agg(F.count(F.lit(1)).cast("string").alias("text"))
    lines.repartition("run", "param").write.partitionBy("run", "param").text(place)
    return scan_values(spark, place, glob="*/*/*", pattern=r"run=([^/]+)/param=([^/]+)/[^/]+$")


@query
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Params and metrics appended to the run tables in two batches, one of them twice, read back joined."""
    log = RunLog(spark, scratch_dir(spark, "runlog"))
    events = table(spark, sf_dir, "events")
    run = F.concat(F.lit("run"), F.col("user_id").cast("string"))
    measured = events.groupBy(run.alias("run_id"), F.col("event_type").alias("metric")).agg(
        F.min("event_id").alias("ts"), (whole_mean(DIGITS) / 10**DIGITS).alias("value")
    )
    clicks = F.coalesce(F.col("metric") == "click", F.lit(False))
    for key, part in (("clicks", clicks), ("others", ~clicks), ("clicks", clicks)):
        log.append_metrics(measured.where(part).withColumn("step", F.lit(0).cast("long")), key)
    log.append_params(
        events.groupBy(run.alias("run_id")).agg(F.count(F.lit(1)).cast("string").alias("value")).withColumn(
            "param", F.lit("events")
        )
    )
    params = log.params().select("run_id", F.col("value").alias("events"))
    return log.metrics().join(params, "run_id").drop("step")


def _registry_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as stage changes: the model is the event type, versions are users."""
    stage = F.element_at(F.array(*[F.lit(s) for s in registry.STAGES]), (F.col("event_id") % 4 + 1).cast("int"))
    version = (F.col("user_id") % 50).cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"),
        version.alias("version"),
        stage.alias("stage"),
        F.concat_ws("/", F.lit("models"), "event_type", version.cast("string")).alias("path"),
        F.col("ts"),
    )


@query
def registry_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.current_stages(_registry_log(spark, sf_dir)).drop("ts")


@query
def registry_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.newest_in_stage(_registry_log(spark, sf_dir), "Production")


# Scoring


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = exam_records(spark, sf_dir, BY_EVENT, f"{TARGET} AS {LABEL}")
    return encode.with_indicators(encode.positive(records))


@query
def udf_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Python model as a table function."""
    features = encode.exam_features(exam_records(spark, sf_dir))
    scored = score_with(features, logistic_model(), FEATURES).select(KEY, *OUTPUTS)
    return rounded(scored, "probabilidade_Nao", "probabilidade_Sim")


@query
def score_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to result rows in one narrow plan."""
    scored = score_bodies(exam_messages(spark, sf_dir, BY_EVENT), python_scorer(logistic_model()), AS_OF)
    return rounded(scored, "probabilidade_Nao", "probabilidade_Sim").drop("event_id")


@query
def forest_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit the production forest on the train share, score and evaluate the test share."""
    train, test = split.split(_labelled(spark, sf_dir), KEY)
    model = fit_forest(train, key=KEY)
    scorer = model_scorer(model, signature_of(train))
    outcome = (LABEL, "resultado", "probabilidade_Sim")
    scores = written(metrics.score_counts(scorer(test), *outcome), "scores")
    return metrics.evaluate(scores, *outcome, weight="rows")


@query
def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small cross-validated search with all metrics; ranks of the candidates."""
    grid = search.forest_grid({"n_estimators": (5, 10), "min_samples_split": (2, 200), "max_depth": (3, 5)})
    found = search.grid_search(
        _labelled(spark, sf_dir), grid, scratch_dir(spark, "search"), KEY, folds=3, parallelism=4
    )
    return found.ranks


def _streamed(spark: SparkSession, sf_dir: str, empty_between: bool) -> DataFrame:
    """Messages streamed into the result table: small events, then, after a restart, large ones."""
    place = scratch_dir(spark, "stream")
    messages = exam_messages(spark, sf_dir, BY_USER, "value")
    stored = merge.KeyedTable(spark, f"{place}/table").create()
    scorer = python_scorer(logistic_model())
    large = F.coalesce(F.col("value") >= 50, F.lit(False))  # total: no value is not large
    for part in (~large, F.lit(False), large) if empty_between else (~large, large):
        messages.where(part).drop("value").write.mode("append").parquet(f"{place}/in")
        stream = open_stream(
            spark, "parquet", {}, f"{place}/in", keep=["event_id"], schema=messages.drop("value").schema
        )
        running = start_scoring(stream, stored, scorer, f"{place}/checkpoint", AS_OF, availableNow=True)
        running.awaitTermination()
    return rounded(stored.read(), "probabilidade_Nao", "probabilidade_Sim")


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches with a restart between them."""
    return _streamed(spark, sf_dir, empty_between=False)


@query
def stream_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a batch without messages between them."""
    return _streamed(spark, sf_dir, empty_between=True)


@query
def score_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch form: small events scored first, large ones merged in later, by patient and type."""
    records = exam_records(spark, sf_dir, BY_USER_TYPE, "event_id", "value")
    scorer = python_scorer(logistic_model())

    def scored(part: Column, as_of: str) -> DataFrame:
        rows = score_records(records.where(part), scorer, as_of, keep=["event_id"])
        return merge.latest_per_key(rows, KEY, ["event_id"]).drop("event_id")

    large = F.coalesce(F.col("value") >= 150, F.lit(False))
    return rounded(
        merge.merge(scored(~large, "2024-01-01"), scored(large, AS_OF)), "probabilidade_Nao", "probabilidade_Sim"
    )


# Every tree must split on the column that the label is, whatever its sample: so all is known beforehand.
FORCED = ForestParams(trees=5, depth=3, min_leaf=1, subset="all")


def _forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.with_indicators(encode.positive(exam_records(spark, sf_dir))).withColumn(LABEL, F.col("sex_male"))


@query
def forest_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, register with signature, promote, load by stage, check the signature, score."""
    train, _ = split.split(_forced(spark, sf_dir), KEY)
    models = registry.Registry(spark, scratch_dir(spark, "registry"))
    version = models.register("sex", fit_forest(train, FORCED, key=KEY), signature_of(train))
    models.transition("sex", version, "Production")
    scorer = model_scorer(models.load("models:/sex/Production"), models.signature("models:/sex/Production"))
    return scorer(_forced(spark, sf_dir)).select(KEY, *OUTPUTS)


@query
def search_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means and ranks of a search whose every fit is right, with the rows of its test folds."""
    grid = [replace(FORCED, trees=2), replace(FORCED, trees=3), replace(FORCED, trees=3, min_split=4)]
    rows = _forced(spark, sf_dir)
    found = search.grid_search(rows, grid, scratch_dir(spark, "search"), KEY, folds=3, parallelism=4)
    ranks = found.ranks.withColumns({c: F.round(c, DIGITS) + F.lit(0.0) for c in ("mean", "std")})  # no negative zero
    return ranks.withColumns({"best": F.lit(found.best), "records": F.lit(rows.count()).cast("long")})


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages decoded, encoded, scored by a forest and upserted by patient."""
    train, _ = split.split(_labelled(spark, sf_dir), KEY)
    model = fit_forest(train, ForestParams(trees=25, depth=6), key=KEY)
    stored = merge.KeyedTable(spark, scratch_dir(spark, "flagship")).create()
    scored = score_bodies(exam_messages(spark, sf_dir), model_scorer(model, signature_of(train)), AS_OF)
    stored.upsert(scored, order_by=["event_id"])
    return stored.read()
