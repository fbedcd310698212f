"""Shared expressions of the text operators and their registry of queries."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space and words, as fixed by the contracts of the queries (regular expression classes).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


class Query(NamedTuple):
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated ``(spark, folder) -> DataFrame`` under ``name``."""

    def register(build):
        QUERIES[name] = Query(build, sql)
        return build

    return register


def read(spark: SparkSession, folder: str, table: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")
    return frame.select(*columns) if columns else frame


def filled(text: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text), F.lit(""))


def stripped(text: Column) -> Column:
    """The text without the contracts' white space at its ends. (A pattern's ``$`` would also stop before U+0085.)"""
    return F.trim(text, F.lit(SPACE_CHARS))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]
