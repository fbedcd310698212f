"""Named queries: each pairs a Spark plan over the given tables with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from millrace.session import spread


class Tables:
    """The given Parquet tables of one folder, read on first use of their name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def texts(self, *columns: str) -> DataFrame:
        """Columns of ``documents``, on all cores even when the file has few splits."""
        return spread(self.documents.select(*columns))

    def __getattr__(self, name: str) -> DataFrame:
        frame = self.spark.read.parquet(self.path(name))
        self.__dict__[name] = frame  # the footer is read once per query
        return frame


class Plan(NamedTuple):
    build: Callable[[Tables], DataFrame]
    sql: str | None


PLANS: dict[str, Plan] = {}


def plan(sql: str | None = None):
    """Register the decorated function under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        if build.__name__ in PLANS:
            raise ValueError(f"duplicate query {build.__name__}")
        PLANS[build.__name__] = Plan(build, sql)
        return build

    return register
