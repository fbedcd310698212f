"""Windowed counts. Each is one DataFrame function for bounded and unbounded input.

Windows are over event time. On a stream a watermark bounds the state; rows later than it are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _watermarked(df: DataFrame, time: str, lateness: str | None) -> DataFrame:
    df = df.withColumn(time, F.col(time).cast("timestamp"))
    return df.withWatermark(time, lateness) if lateness and df.isStreaming else df


def tumbling_count(df: DataFrame, time: str, key: str, size: str = "20 minutes", lateness: str | None = None) -> DataFrame:
    """Rows per key and fixed window, with the window's start and the earliest time seen in it."""
    counted = _watermarked(df, time, lateness).groupBy(F.window(time, size), key).agg(
        F.count(F.lit(1)).alias("count"), F.min(time).alias("window_timestamp"))
    return counted.select(F.col("window.start").alias("window_start"), key, "count", "window_timestamp")


def sliding_count(df: DataFrame, time: str, key: str, size: str = "30 seconds", slide: str = "5 seconds",
                  lateness: str | None = None, total: str | None = None) -> DataFrame:
    """Rows per key over the last ``size``, every ``slide``; ``total`` names a pseudo-key that counts all rows."""
    rows = _watermarked(df, time, lateness)
    if total:
        rows = rows.withColumn(key, F.explode(F.array(F.col(key), F.lit(total))))
    counted = rows.groupBy(F.window(time, size, slide), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), key, "n")


def pane_counts(df: DataFrame, time: str, key: str, slide: str, lateness: str | None = None) -> DataFrame:
    """``pane, key, n``: rows per key and fixed window of one ``slide``, the state of the incremental count."""
    return _watermarked(df, time, lateness).groupBy(F.window(time, slide).alias("pane"), key).agg(F.count(F.lit(1)).alias("n"))


def sliding_incremental(df: DataFrame, time: str, key: str, size: str = "30 seconds", slide: str = "5 seconds",
                        lateness: str | None = None, total: str | None = None) -> DataFrame:
    """``sliding_count`` in two chained states, where each row is counted once, in its pane.

    A pane is one ``slide`` long, and ``size`` is a multiple of it. When the watermark closes a pane, its count alone
    goes on to the windows that hold it, so what the windows add up is one row per key and pane, however many rows
    came. ``total`` names a pseudo-key that counts all rows; it too is made from panes. On a stream it is for append
    mode: a window is written once, when no row can reach it any more.
    """
    panes = pane_counts(df, time, key, slide, lateness).select(F.window_time("pane").alias(time), key, "n")
    if total:
        panes = panes.withColumn(key, F.explode(F.array(F.col(key), F.lit(total))))
    summed = panes.groupBy(F.window(time, size, slide), key).agg(F.sum("n").alias("n"))
    return summed.select(F.col("window.start").alias("window_start"), key, "n")


def sliding_from_panes(df: DataFrame, time: str, key: str, panes: int, slide: str) -> DataFrame:
    """The bounded form of ``sliding_count`` for a window of ``panes`` slides.

    Rows are counted once per slide, and only those counts are copied to the windows that hold them.
    """
    counted = tumbling_count(df, time, key, slide)
    starts = F.transform(F.sequence(F.lit(0), F.lit(panes - 1)),
                         lambda k: F.col("window_start") - k * F.expr(f"INTERVAL {slide}"))
    return (counted.select(F.explode(starts).alias("window_start"), key, "count")
            .groupBy("window_start", key).agg(F.sum("count").alias("n")))


def with_zero_keys(counts: DataFrame, key: str, slide: str) -> DataFrame:
    """Keep a key in every later window once it was seen, with count 0 where it is absent."""
    last = counts.agg(F.max("window_start").alias("last")).scalar()
    seen = counts.groupBy(key).agg(F.min("window_start").alias("first"))
    every = seen.select(key, F.explode(F.sequence(F.col("first"), last, F.expr(f"INTERVAL {slide}"))).alias("window_start"))
    return every.join(counts, ["window_start", key], "left").select("window_start", key, F.coalesce("n", F.lit(0)).alias("n"))


def assign_event_time(df: DataFrame, key: Column, base: Column, name: str = "event_time", span: int = 3600) -> DataFrame:
    """Place each row at a second of the ``span`` before ``base``, fixed by its key."""
    return df.withColumn(name, base - F.make_dt_interval(secs=F.pmod(key, F.lit(span))))
