"""Order-dependent operators that never put a whole group, or the whole table, into one task.

The rows are range-sorted once and frozen together with the number of the sorted partition (the run)
they landed in. Totals per run are tiny, so the prefix over runs is cheap, and inside a run each row
needs only its own neighbours. A group with a third of all rows is simply spread over many runs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import freeze

_SLOT_BITS = (1 << 33) - 1


def same_keys(keys: Sequence[str], left: str = "a", right: str = "b") -> Column:
    """Equality of the keys of two aliased frames, in which NULL equals NULL."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def in_sorted_runs(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows in total order, frozen, with their run ``_run`` and place in it ``_slot`` (from 0)."""
    placed = df.orderBy(*order).select(
        "*",
        F.spark_partition_id().alias("_run"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_SLOT_BITS)).alias("_slot"),
    )
    return freeze(placed)


def _run_offsets(placed: DataFrame, by: Sequence[str], amount: Column, total: str | None) -> DataFrame:
    """Per run and group, the amount in all earlier runs. One row per run that holds rows of the group."""
    runs = placed.groupBy("_run", *by).agg(F.sum(amount).alias("_amount"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    columns = ["_run", *by, "_amount", F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias("_offset")]
    if total:
        columns.append(F.sum("_amount").over(group).alias(total))
    return runs.select(*columns)


def _with_offsets(placed: DataFrame, offsets: DataFrame, by: Sequence[str]) -> DataFrame:
    a, b = placed.alias("a"), offsets.alias("b")
    condition = (F.col("a._run") == F.col("b._run")) & same_keys(by)
    extra = [c for c in offsets.columns if c not in ("_run", *by)]
    return a.join(b, condition).select("a.*", *[F.col(f"b.{c}") for c in extra])


def running_sum(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: str, name: str,
                total: str | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` up to and including the row, within ``by``, in ``order``.

    ``order`` must order the rows of a group uniquely. ``total`` optionally names the group's sum.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = in_sorted_runs(df, [F.col(c) for c in by] + order)
    offsets = _run_offsets(placed, by, F.col(value), total)
    inside = Window.partitionBy("_run", *by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    summed = _with_offsets(placed, offsets.drop("_amount"), by)
    summed = summed.withColumn(name, F.sum(value).over(inside) + F.col("_offset"))
    return summed.drop("_run", "_slot", "_offset")


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add the 1-based position of each row in a total order, without a one-task window."""
    placed = in_sorted_runs(df, order)
    offsets = _run_offsets(placed, [], F.lit(1), None).drop("_amount")
    ranked = placed.join(F.broadcast(offsets), "_run")  # one row per sorted partition
    return ranked.withColumn(name, F.col("_offset") + F.col("_slot") + 1).drop("_run", "_slot", "_offset")


def rank_top(df: DataFrame, order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows of a total order with their position; only k rows reach the last task."""
    top = df.orderBy(*order).limit(k)
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


#: Rank error of the sketch as a share of the rows, and the most cells that one window per group numbers.
ACCURACY = 10_000
FEW_CELLS = 1_000_000


def _brackets(known: DataFrame, by: Sequence[str], value: str, probs: dict[str, float], margin: float,
              extra: Sequence[Column]) -> DataFrame:
    """Per group its rows ``_total``, and edges around each quantile from one sketch of all values."""
    n = len(probs)
    shares = [max(p - margin, 0.0) for p in probs.values()] + [min(p + margin, 1.0) for p in probs.values()]
    made = known.groupBy(*by).agg(F.percentile_approx(value, shares, ACCURACY).alias("_edges"), F.min(value).alias("_min"),
                                  F.max(value).alias("_max"), F.count(F.lit(1)).alias("_total"), *extra)
    # In a small group a rank is wider than the margin; all of its values are looked at.
    whole = F.col("_total") < math.ceil(4 / margin)
    return freeze(made.withColumns({
        "_low": F.transform(F.slice("_edges", 1, n), lambda x: F.when(whole, F.col("_min")).otherwise(x)),
        "_high": F.transform(F.slice("_edges", n + 1, n), lambda x: F.when(whole, F.col("_max")).otherwise(x))}).drop("_edges", "_min", "_max"))


def _cells(known: DataFrame, by: Sequence[str], value: str, brackets: DataFrame, n: int) -> DataFrame:
    """The rows counted in order: one cell per value inside a bracket, one per stretch between brackets.

    ``_zone`` counts the edges that a value has passed. It grows with the value and is the same for all values of a
    stretch, so zone and value order the cells, and equal values never pile up in a task.
    """
    edges = brackets.select(*by, "_low", "_high", "_total")
    if by:
        a, b = known.alias("a"), edges.alias("b")
        met = a.join(b, same_keys(by)).select("a.*", "b._low", "b._high", "b._total")
    else:
        met = known.withColumn("_b", edges.select(F.struct("_low", "_high", "_total")).scalar()).select(
            value, "_b._low", "_b._high", "_b._total")
    zone, inside = F.lit(0), F.lit(False)
    for k in range(n):
        low, high = F.col("_low")[k], F.col("_high")[k]
        zone = zone + (F.col(value) >= low).cast("int") + (F.col(value) > high).cast("int")
        inside = inside | ((F.col(value) >= low) & (F.col(value) <= high))
    cells = met.groupBy(*by, zone.alias("_zone"), F.when(inside, F.col(value)).alias(value))
    return freeze(cells.agg(F.count(F.lit(1)).alias("n"), F.max("_total").alias("_total")))


def quantiles(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float],
              extra: Sequence[Column] = (), margin: float = 2 / ACCURACY) -> DataFrame:
    """Exact linear-interpolation quantiles per group (position ``(n-1)p`` between the two nearest values).

    By selection, not by sorting: a sketch brackets each wanted position, a second pass counts the rows between the
    brackets and keeps only the values inside them. Should a position lie outside its bracket, the brackets are
    widened and the counts made again. ``extra`` are further aggregates over the columns ``value`` and ``n`` (1).
    """
    known = df.filter(F.col(value).isNotNull()).select(*by, value)
    brackets = _brackets(known.withColumn("n", F.lit(1)), by, value, probs, margin, extra)
    cells = _cells(known, by, value, brackets, len(probs))
    few = cells.count() <= FEW_CELLS
    if few:
        before = Window.partitionBy(*by).orderBy("_zone", value).rowsBetween(Window.unboundedPreceding, -1)
        placed = cells.withColumn("_start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    else:
        placed = running_sum(cells, by, ["_zone", value], "n", "_start").withColumn("_start", F.col("_start") - F.col("n"))

    def value_at(at: Column) -> Column:
        return F.max(F.when((F.col("_start") <= at) & (at < F.col("_start") + F.col("n")), F.struct(F.col(value).alias("v"))))["v"]

    ends, columns, missed = [], [], F.lit(False)
    for name, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(float(p))
        ends += [value_at(F.floor(at)).alias(f"_{name}_lo"), value_at(F.ceil(at)).alias(f"_{name}_hi")]
        at = (F.col("_rows") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        columns.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
        missed = missed | lo.isNull() | hi.isNull()
    found = placed.groupBy(*by).agg(F.max("_total").alias("_rows"), *ends)
    found = found if few else freeze(found)  # read twice
    if margin < 1 and not found.filter(missed).isEmpty():
        return quantiles(df, by, value, probs, extra, margin * 64)
    found = found.select(*by, *columns)
    if not extra:
        return found
    a, b = brackets.drop("_low", "_high", "_total").alias("a"), found.alias("b")
    return a.join(b, same_keys(by)).select("a.*", *[F.col(f"b.{name}") for name in probs])


def next_in_group(df: DataFrame, by: Sequence[str], position: str, value: str, name: str,
                  block: int = 4096) -> DataFrame:
    """Add the value at the next position (dense integers) of the group, NULL for the last one.

    A group is cut into blocks of positions. The first row of a block is also sent to the block before
    it, so each block finds all its successors alone and one long group fills many tasks.
    """
    own = F.floor(F.col(position) / block)
    homes = F.when((F.col(position) % block == 0) & (F.col(position) > 0), F.array(own, own - 1)).otherwise(F.array(own))
    placed = df.withColumn("_block", F.explode(homes))
    w = Window.partitionBy(*by, "_block").orderBy(position)
    return (
        placed.withColumn(name, F.lead(value).over(w))
        .filter(F.col("_block") == F.floor(F.col(position) / block))
        .drop("_block")
    )
