"""Keyed tables: newest row per key, and a stored table that an upsert rewrites only where it has to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from millrace.session import freeze


def newest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row with the highest version of each key.

    Of equal versions the row whose other columns sort last stays; a NULL version is the lowest one. So all
    columns must have an order, which maps have not. The maximum keeps one row per key and task before the
    shuffle, so a key written very often costs no more than any other. A window over the key would gather
    all its versions.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max(F.struct(version, *[c for c in rest if c != version])).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_newest.{c}").alias(c) for c in rest])


def upsert(base: DataFrame, delta: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Insert by primary key, the last write wins."""
    return newest_per_key(base.unionByName(delta), keys, version).select(*base.columns)


class KeyedTable:
    """Rows with one primary key, stored in a fixed number of hash partitions of the key.

    A key is always in the same partition, so an upsert reads and rewrites the partitions that its keys fall into and
    leaves the files of all others as they are; a lookup of some keys reads their partitions alone. The number of
    partitions is fixed when the table is created: take it so that one holds some hundred MB. An upsert replaces whole
    partitions when its job ends. One that failed is run again: it gives the same rows, however far the first came.
    """

    BUCKET = "_bucket"

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], version: str, buckets: int):
        self.spark, self.path, self.keys, self.version, self.buckets = spark, path, list(keys), version, buckets
        self.schema = schema

    @classmethod
    def create(cls, base: DataFrame, path: str, keys: Sequence[str], version: str, buckets: int = 64) -> KeyedTable:
        """Store the newest row of each key of ``base`` below ``path``."""
        table = cls(base.sparkSession, path, base.schema, keys, version, buckets)
        table._write(newest_per_key(base, keys, version).select(*base.columns), "errorifexists")
        return table

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(self.BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame, mode: str) -> None:
        # one task and so one file per partition; keys are unique by now, so no partition is hot
        (self._bucketed(rows).repartition(self.buckets, self.BUCKET).write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.BUCKET).parquet(self.path))

    def _stored(self) -> DataFrame:
        schema = StructType([*self.schema.fields]).add(self.BUCKET, IntegerType())
        return self.spark.read.schema(schema).parquet(self.path)

    def rows(self) -> DataFrame:
        return self._stored().drop(self.BUCKET)

    def find(self, wanted: DataFrame) -> DataFrame:
        """The rows whose keys are in ``wanted``, from the partitions of those keys."""
        touched = self._touched(wanted)
        return self._stored().filter(F.col(self.BUCKET).isin(touched)).drop(self.BUCKET).join(
            wanted.select(*self.keys).distinct(), self.keys, "left_semi")

    def _touched(self, rows: DataFrame) -> list[int]:
        return [r[0] for r in self._bucketed(rows.select(*self.keys)).select(self.BUCKET).distinct().collect()]  # at most ``buckets``

    def upsert(self, delta: DataFrame) -> list[int]:
        """Insert or replace by key, the last write wins; returns the partitions that were rewritten."""
        newest = freeze(newest_per_key(delta.select(*self.schema.names), self.keys, self.version))
        touched = self._touched(newest)
        if touched:
            base = self._stored().filter(F.col(self.BUCKET).isin(touched)).drop(self.BUCKET)
            # frozen, because the files it reads are the ones to be replaced
            self._write(freeze(upsert(base, newest, self.keys, self.version)), "overwrite")
        return sorted(touched)
