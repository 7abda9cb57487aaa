"""Coded columns to labels, labels to 0/1 indicators, indicators to a vector."""

from __future__ import annotations

import re
from typing import Any, Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.hashing import key_hash
from riskflow.operators.ordering import numbered
from riskflow.functions.codes import indicator, label_or_code, label_or_default
from riskflow.schemas import FEATURES, INDICATORS, KEY, SERVING_CODES, CodeTable, quoted

ON_MISSING = ("default", "null", "drop")


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def select_features(df: DataFrame, key: str = KEY, features: Sequence[str] = FEATURES) -> DataFrame:
    """The key and the model inputs, in model order."""
    return df.select(quoted(key), *[quoted(f) for f in features])


def with_placeholders(df: DataFrame) -> DataFrame:
    """Unscored values in the output columns, whatever the producer sent."""
    return df.withColumns(
        {
            "resultado": F.lit(-1),
            "probabilidade_Nao": F.lit(-1.0),
            "probabilidade_Sim": F.lit(-1.0),
        }
    )


def with_load_date(df: DataFrame, as_of: str | None = None, column: str = "data") -> DataFrame:
    """Stamp the load date as text; `as_of` pins it so that a rerun agrees."""
    stamp = F.current_date().cast("string") if as_of is None else F.lit(as_of)
    return df.withColumn(column, stamp)


def positive(df: DataFrame, column: str = "age") -> DataFrame:
    """Rows with a value above zero; NULL is not above zero."""
    return df.where(F.col(column) > 0)


def decode(
    df: DataFrame,
    tables: Mapping[str, CodeTable] = SERVING_CODES,
    on_missing: str = "default",
) -> DataFrame:
    """Replace codes by labels, unknown codes by the column's default label.

    `on_missing` rules NULL codes: take the default label, stay NULL, or drop the row.
    """
    if on_missing not in ON_MISSING:
        raise ValueError(f"on_missing must be one of {ON_MISSING}")
    if on_missing == "drop":
        df = df.dropna(subset=list(tables))
    keep_null = on_missing == "null"
    return df.withColumns({c: label_or_default(c, t, keep_null) for c, t in tables.items()})


def decode_strict(df: DataFrame, tables: Mapping[str, CodeTable]) -> DataFrame:
    """Replace listed codes by labels; other codes stay, as text."""
    return df.withColumns({c: label_or_code(c, t) for c, t in tables.items()})


def as_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(quoted(c)).cast("string") for c in columns})


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Append `<column>_<level>` indicators for the given levels.

    Levels that differ only in case give two columns; naming one of them then
    needs `spark.sql.caseSensitive`.
    """
    return df.select(
        "*",
        *[
            indicator(F.col(quoted(c)), level).alias(f"{c}_{level}")
            for c, known in levels.items()
            for level in known
        ],
    )


def learn_levels(df: DataFrame, columns: Sequence[str], max_levels: int = 1000) -> dict[str, list[str]]:
    """Distinct non-NULL levels of each column, integers first, then text.

    The distinct runs on whole combinations first, combined map-side, so that only
    those are taken apart into (column, level) pairs. Only a bounded list reaches the
    driver; wider columns are refused here and served by `one_hot_sparse`.
    """
    combined = df.select(*[quoted(c) for c in columns]).distinct()
    pairs = combined.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("level"))
                    for c in columns
                ]
            )
        ).alias("pair")
    ).select("pair.*")
    limit = max_levels * len(columns)
    found = pairs.where(F.col("level").isNotNull()).distinct().limit(limit + 1).collect()
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in found:
        levels[row["column"]].append(row["level"])
    wide = [c for c, known in levels.items() if len(known) > max_levels]
    if wide or len(found) > limit:
        raise ValueError(f"more than {max_levels} levels in {wide or list(columns)}: use one_hot_sparse")
    return {c: sorted(known, key=_level_order) for c, known in levels.items()}


def level_index(df: DataFrame, columns: Sequence[str], seed: int = 10) -> DataFrame:
    """(column, level, index): every non-NULL level of the columns, numbered from 0 in each column.

    Numbers follow the levels' hashes, so that they are dealt in parallel; the dictionary
    is one table for all columns and may be as large as it likes.
    """
    levels = _cells(df, columns).where(F.col("level").isNotNull()).distinct()
    return numbered(levels, key_hash(F.col("level"), seed), ["level"], "index", by="column")


def _cells(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """A row per row and column: `keep`, column and level (as text)."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("level")) for c in columns]
    return df.select(*keep, F.explode(F.array(*cells)).alias("cell")).select(*keep, "cell.column", "cell.level")


def one_hot_sparse(df: DataFrame, columns: str | Sequence[str], vector: str) -> DataFrame:
    """Append one sparse 0/1 vector with a place for every level of each column, however many.

    The columns' places follow one another; in each, NULL has the last. Rows are taken
    apart to (row, column, level) once and meet the dictionary in one join, which a skew
    can split; what they find is gathered by row. So the number of columns changes neither
    the number of joins nor that of exchanges. Rows that repeat one another are worked on
    once. Nothing but the dictionary's sizes reaches the driver.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    index = level_index(df, names)
    found = {r["column"]: r["count"] for r in index.groupBy("column").count().collect()}
    sizes = [found.get(c, 0) for c in names]
    # a row is known by two hashes of all its columns
    every = [x for c in df.columns for x in (F.col(quoted(c)), F.col(quoted(c)).isNull())]
    marked = df.withColumns({"_one": F.xxhash64(*every), "_two": F.xxhash64(*reversed(every))})
    rows = marked.groupBy("_one", "_two").agg(
        *[F.first(F.col(quoted(c))).alias(c) for c in df.columns], F.count(F.lit(1)).alias("_copies")
    )
    cells = _cells(marked.select("_one", "_two", *[quoted(c) for c in names]).distinct(), names, "_one", "_two")
    placed = cells.join(index.hint("merge"), ["column", "level"])
    places = [F.max(F.when(F.col("column") == c, F.col("index"))).alias(f"_place{i}") for i, c in enumerate(names)]
    gathered = placed.groupBy("_one", "_two").agg(*places)
    joined = rows.join(gathered, ["_one", "_two"], "left").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    for i, size in enumerate(sizes):
        # the encoder takes its size from the column's metadata instead of a pass over the rows
        values = {"ml_attr": {"type": "nominal", "num_vals": size + 1}}
        place = F.coalesce(F.col(f"_place{i}"), F.lit(size)).cast("double")
        joined = joined.withColumn(f"_place{i}", place).withColumn(f"_place{i}", F.col(f"_place{i}").alias(f"_place{i}", metadata=values))
    inputs, parts = [f"_place{i}" for i in range(len(names))], [f"_part{i}" for i in range(len(names))]
    encoder = OneHotEncoder(inputCols=inputs, outputCols=parts, dropLast=False)
    encoded = encoder.fit(joined).transform(joined)
    whole = VectorAssembler(inputCols=parts, outputCol=vector).transform(encoded)
    return whole.select(*[quoted(c) for c in df.columns], quoted(vector))


def one_hot_learned(df: DataFrame, columns: Sequence[str], drop_first: bool = True, max_levels: int = 1000) -> DataFrame:
    """One-hot by the levels present, without each column's first level.

    Encoded columns are replaced; indicators follow the untouched columns.
    """
    levels = learn_levels(df, columns, max_levels)
    kept = {c: known[1:] if drop_first else known for c, known in levels.items()}
    return one_hot(df, kept).drop(*columns)


def indicator_rows(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The non-zero indicators as rows (key, column, level), for any number of levels."""
    return (
        df.select(
            quoted(key),
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("level"))
                        for c in columns
                    ]
                )
            ).alias("pair"),
        )
        .select(quoted(key), "pair.*")
        .where(F.col("level").isNotNull())
    )


def literal_rows(spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: T.StructType) -> DataFrame:
    """Rows from dicts; keys a dict lacks become NULL."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def pad(df: DataFrame, rows: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return df.unionByName(rows)


def append_by_position(df: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by column position."""
    for other in others:
        df = df.union(other)
    return df


def with_indicators(df: DataFrame, on_missing: str = "default") -> DataFrame:
    """Append the model's 13 indicators to exam records, keeping the raw codes.

    A single projection: labels exist only inside the expressions.
    """
    if on_missing not in ON_MISSING:
        raise ValueError(f"on_missing must be one of {ON_MISSING}")
    if on_missing == "drop":
        df = df.dropna(subset=list(INDICATORS))
    columns = {}
    for name, known in INDICATORS.items():
        label = label_or_default(name, SERVING_CODES[name], on_missing == "null")
        for level in known:
            columns[f"{name}_{level}"] = indicator(label, level)
    return df.withColumns(columns)


def exam_features(df: DataFrame, on_missing: str = "default") -> DataFrame:
    """Exam records to key and model inputs, for rows with a positive age."""
    return select_features(with_indicators(positive(df), on_missing))


def assembler(
    features: Sequence[str] = FEATURES,
    output: str = "features",
    handle_invalid: str = "error",
) -> VectorAssembler:
    """Vector stage; a NULL input fails unless `handle_invalid` is "keep" or "skip"."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=handle_invalid)


def _level_order(level: str) -> tuple[int, int, str]:
    if re.fullmatch(r"-?\d+", level):
        return (0, int(level), "")
    return (1, 0, level)
