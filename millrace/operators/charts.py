"""Datasets behind the charts: pie slices, bar domains, bubbles, stacks and hierarchies."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import linear_scale, log_scale, sqrt_scale
from millrace.operators.ordered import running_sum
from millrace.session import freeze


def pie_angles(slices: DataFrame, value: str, order: Sequence[Column]) -> DataFrame:
    """Add the start and end angle of each slice, in radians, the slices laid out in ``order``."""
    turned = running_sum(slices, [], order, value, "_upto", total="_total")
    per_unit = F.lit(2 * math.pi) / F.col("_total")
    return turned.select(*slices.columns, ((F.col("_upto") - F.col(value)) * per_unit).alias("start_angle"),
                         (F.col("_upto") * per_unit).alias("end_angle"))


def bar_domain(df: DataFrame, category: str, value: str) -> DataFrame:
    """Each category with its value and the common axis limits [0, max]."""
    top = df.agg(F.max(value).alias("top")).scalar()
    return df.select(category, value, F.lit(0.0).alias("domain_low"), top.cast("double").alias("domain_high"))


def bubbles(df: DataFrame, x: str, y: str, size: str, keep: Sequence[str], width: float = 870.5,
            height: float = 461.0) -> DataFrame:
    """Positions and radii of a bubble chart: log x, linear y, square-root radius."""
    return df.select(*keep, log_scale(F.col(x), (300, 1e5), width).alias("cx"),
                     linear_scale(F.col(y), (10, 85), (height, 0)).alias("cy"),
                     sqrt_scale(F.col(size), 5e8, 40).alias("r"))


def fitted_line(df: DataFrame, keep: Sequence[str], x: str, y: str, slope: Column) -> DataFrame:
    """Observed and fitted value per point."""
    return df.select(*keep, x, F.col(y).alias("original"), (F.col(x) * slope).alias("predicted"))


def stack_offsets(cells: DataFrame, x: str, series: str, y: str) -> DataFrame:
    """Add the baseline ``y0`` of each cell: the sum of the series before it at the same x."""
    stacked = running_sum(cells, [x], [series], y, "_upto")
    return stacked.withColumn("y0", F.col("_upto") - F.col(y)).drop("_upto")


def rollup_rows(df: DataFrame, keys: Sequence[str], rollup: Column) -> DataFrame:
    """One row per combination of keys with the rolled-up value, the levels as columns."""
    return df.groupBy(*keys).agg(rollup)


def nest_rollup(df: DataFrame, keys: Sequence[str], rollup: Column) -> DataFrame:
    """Nested groups: rows ``key, values`` of the first key, ``values`` a list of the same for the next one, and so on.

    The lists are sorted by key, and the innermost ``values`` is the rolled-up value. It is made from the bottom up,
    one aggregate a level, so a level gathers the entries of the one below and never rows; only the first level is
    left as rows. An entry holds its whole subtree: where that is too large for a row, take ``rollup_rows``.
    """
    nested = df.groupBy(*keys).agg(rollup.alias("values"))
    for level in range(len(keys) - 1, 0, -1):
        entry = F.struct(F.col(keys[level]).alias("key"), "values")
        nested = nested.groupBy(*keys[:level]).agg(F.sort_array(F.collect_list(entry)).alias("values"))
    return nested.select(F.col(keys[0]).alias("key"), "values")


def hierarchy_values(df: DataFrame, levels: Sequence[str], value: str) -> DataFrame:
    """Total and depth of each node of a tree given as one column per level; depth 0 is the root."""
    totals = df.rollup(*levels).agg(F.sum(value).alias("value"), F.grouping_id().alias("_gid"))
    depth = F.lit(len(levels)) - F.bit_count("_gid")
    return totals.select(*levels, depth.cast("int").alias("depth"), "value")


def hierarchy_from_links(nodes: DataFrame, id: str, parent: str, value: str) -> DataFrame:
    """``id, parent, depth, value``: the depth of each node and the total of its subtree, from parent links.

    Pointer doubling: after round k a node knows its ancestor 2**k steps up, and its total covers the nodes less than
    2**k steps below. A round adds to each node the totals of those whose pointer is on it, and moves each pointer to
    the pointer of its target, so a tree of depth d takes log2(d) rounds, whatever its shape. A parent that is no node
    counts as none. Nodes whose chain of parents never ends, on a cycle or below one, have NULL depth and total.
    """
    known = nodes.select(F.col(id).alias("id"), F.col(parent).alias("parent"), F.coalesce(F.col(value), F.lit(0)).alias("total"))
    ids = known.select(F.col("id").alias("up"))
    state = freeze(known.join(ids, known.parent == ids.up, "left").withColumn("depth", F.col("up").isNotNull().cast("int")))
    open_before, still_open = None, state.filter("up IS NOT NULL").count()
    # A round that ends no chain has met the cycles: a longer chain that ends would hold nodes that end in this round.
    while still_open and still_open != open_before:
        below = state.filter("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(F.sum("total").alias("more"))
        above = state.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("steps"))
        state = freeze(state.join(below, "id", "left").join(above, "up", "left").select(
            "id", "parent", (F.col("total") + F.coalesce("more", F.lit(0))).alias("total"), F.col("next").alias("up"),
            (F.col("depth") + F.coalesce("steps", F.lit(0))).alias("depth")))
        open_before, still_open = still_open, state.filter("up IS NOT NULL").count()
    ended = F.col("up").isNull()
    return state.select(F.col("id").alias(id), F.col("parent").alias(parent), F.when(ended, F.col("depth")).alias("depth"),
                        F.when(ended, F.col("total")).alias("value"))
