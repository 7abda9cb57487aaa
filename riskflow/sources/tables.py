"""Files with a header, catalog tables and their DDL."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskflow.schemas import CSV_SCHEMA, RESULT_SCHEMA, quoted


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = CSV_SCHEMA) -> DataFrame:
    """CSV with a header; a schema saves the inference pass over the file.

    The header must have the schema's names in its order, else reading fails.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def create_table(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    schema: T.StructType = RESULT_SCHEMA,
    partitioned_by: Sequence[tuple[str, str]] = (),
) -> str:
    """Create the database if needed, then the table anew over a location.

    The table is external: dropping it leaves the files.
    """
    name = f"{quoted(database)}.{quoted(table)}"
    columns = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema]
    columns += [f"{quoted(c)} {kind}" for c, kind in partitioned_by]
    layout = f" PARTITIONED BY ({', '.join(quoted(c) for c, _ in partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    place = location.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet{layout} LOCATION '{place}'")
    return name


def create_view(spark: SparkSession, database: str, view: str, query: str) -> str:
    """Create the database if needed, then the view anew."""
    name = f"{quoted(database)}.{quoted(view)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return name


def refresh_table(spark: SparkSession, name: str, partitioned: bool = True) -> None:
    """Make files written by path visible through the catalog."""
    if partitioned:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")
