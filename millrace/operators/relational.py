"""Aggregates and filters that need more than one built-in call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import kib, nonempty, valid_length
from millrace.operators.ordered import rank_top, running_sum


def top_groups(df: DataFrame, key: str, total: Column, k: int = 10) -> DataFrame:
    """The k groups with the largest total, ties by key; ``total`` must be aliased ``total``."""
    return rank_top(df.groupBy(key).agg(total), [F.desc("total"), F.asc(key)], k)


def two_level_counts(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Rows per (inner, outer), then the largest, smallest and mean count per outer."""
    per_pair = df.groupBy(inner, outer).agg(F.count(F.lit(1)).alias("n"))
    return per_pair.groupBy(outer).agg(F.max("n").alias("max_n"), F.min("n").alias("min_n"), F.avg("n").alias("avg_n"))


def posting_blocks(df: DataFrame, key: str, item: str, block: int = 4096) -> DataFrame:
    """``key, block, n, items``: the items of each key in ascending order, cut into numbered blocks of ``block`` items.

    Repeated pairs stay repeated. A block is the most that a task builds, however many items a key has. Equal pairs
    are combined before the shuffle and spread again here.
    """
    counts = df.groupBy(key, item).agg(F.count(F.lit(1)).alias("n"))
    placed = running_sum(counts, [key], [item], "n", "upto").withColumn("start", F.col("upto") - F.col("n"))
    size = F.lit(block)

    def block_of(position: Column) -> Column:
        return F.floor(position / size)

    spread = placed.withColumn("block", F.explode(F.sequence(block_of(F.col("start")), block_of(F.col("upto") - 1))))
    copies = (
        F.least(F.col("upto"), (F.col("block") + 1) * size) - F.greatest(F.col("start"), F.col("block") * size)
    ).cast("int")
    parts = spread.select(key, "block", F.struct(F.col(item).alias("item"), copies.alias("copies")).alias("part"))
    collected = parts.groupBy(key, "block").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    items = F.flatten(F.transform("parts", lambda p: F.array_repeat(p["item"], p["copies"])))
    return collected.select(key, "block", items.alias("items")).select(key, "block", F.size("items").alias("n"), "items")


def posting_directory(blocks: DataFrame, key: str) -> DataFrame:
    """One row per key over its posting blocks: ``n`` items, ``blocks``, the first and the last item."""
    return blocks.groupBy(key).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("blocks"),
                                   F.min(F.element_at("items", 1)).alias("first"), F.max(F.element_at("items", -1)).alias("last"))


def posting_lists(blocks: DataFrame, key: str) -> DataFrame:
    """One row per key with its whole list, comma-separated, put together from its blocks in order.

    A list that is too large for one cell is read by its blocks, which the directory counts.
    """
    parts = F.array_sort(F.collect_list(F.struct("block", F.array_join(F.col("items").cast("array<string>"), ",").alias("said"))))
    return blocks.groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p["said"]), ",").alias("items"))


def count_elements(df: DataFrame, element: str, name: str = "number") -> DataFrame:
    """Occurrences of each value that is neither NULL nor ''."""
    return df.filter(nonempty(F.col(element))).groupBy(element).agg(F.count(F.lit(1)).alias(name))


def with_valid_length(df: DataFrame, text: str, name: str = "length", required: Sequence[str] = ()) -> DataFrame:
    """Parse a content length, dropping rejected cells and rows where a required column is NULL or ''."""
    for column in required:
        df = df.filter(nonempty(F.col(column)))
    return df.withColumn(name, valid_length(F.col(text))).filter(F.col(name).isNotNull())


def mean_length_kib(df: DataFrame, key: str, length: str) -> DataFrame:
    return df.groupBy(key).agg(kib(F.avg(length)).alias("avg_content_length"))


def above_global_mean(df: DataFrame, value: str, keep: Column) -> DataFrame:
    """Rows passing ``keep`` whose value exceeds the mean over all rows.

    The mean is a scalar subquery: one row, computed once and inlined in the filter.
    """
    mean = df.agg(F.avg(value).alias("mean")).scalar()
    return df.filter(keep & (F.col(value) > mean))
