"""Catalog tables: definition, loading, write dispositions and schema checks."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class SchemaMismatch(ValueError):
    """The target table exists with another schema than the declared one."""


def as_struct(schema: str | StructType) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def create_table(spark: SparkSession, name: str, schema: str, location: str | None = None) -> None:
    """Drop a table of that name, if any, and create it empty."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet{place}")


def table_names(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES").select("tableName")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}").select("col_name", "data_type")


def load_append(df: DataFrame, name: str) -> None:
    """Add rows to a table, matching columns by name."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.insertInto(name, overwrite=False)


def insert_overwrite(spark: SparkSession, name: str, query: str, **frames: DataFrame) -> None:
    """Replace the rows of a table by the result of a query over the given frames."""
    spark.sql(query, **frames).select(*spark.table(name).columns).write.insertInto(name, overwrite=True)


def save_table(df: DataFrame, name: str, disposition: str = "if_empty", location: str | None = None) -> None:
    """Write a table, creating it when needed.

    ``truncate`` replaces what is there, ``append`` adds to it, ``if_empty`` refuses a table that has rows.
    """
    spark = df.sparkSession
    modes = {"truncate": "overwrite", "append": "append", "if_empty": "append"}
    if disposition not in modes:
        raise ValueError(f"unknown disposition {disposition}")
    if disposition == "if_empty" and spark.catalog.tableExists(name) and not spark.table(name).isEmpty():
        raise FileExistsError(f"table {name} already has rows")
    writer = df.write.mode(modes[disposition]).format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def guard_schema(spark: SparkSession, name: str, schema: str | StructType, location: str | None = None) -> None:
    """Create the table when missing, else fail when its columns or types differ from the declared ones."""
    wanted = [(f.name, f.dataType.simpleString()) for f in as_struct(schema).fields]
    if not spark.catalog.tableExists(name):
        create_table(spark, name, ", ".join(f"`{n}` {t}" for n, t in wanted), location)
        return
    found = [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields]
    if found != wanted:
        raise SchemaMismatch(f"table {name} has {found}, declared {wanted}")


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def run_bound(spark: SparkSession, query: str, binds: list[Any] | dict[str, Any], **frames: DataFrame) -> DataFrame:
    """A query with ``?`` or ``:name`` placeholders bound to values, never spliced into its text."""
    return spark.sql(query, args=binds, **frames)


def without_name(df: DataFrame, name: str) -> DataFrame:
    """A frame over an external table once its name is dropped: the frame is bound to the files, which stay."""
    df.sparkSession.sql(f"DROP TABLE {name}")
    return df
