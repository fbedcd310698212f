"""Distribution statistics: summaries, boxes, bins, covariances, errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import salted_join
from millrace.operators.ordered import quantiles, same_keys
from millrace.session import freeze

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, quartiles, mean and maximum of each column, exact, one row per column, of NULLs where it has no value."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = long.unpivot([], list(columns), "column", "value")
    found = quantiles(long, ["column"], "value", QUARTILES, extra=[
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean")])
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    return names.join(found, "column", "left")


def fences(df: DataFrame, by: Sequence[str], value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles per group with the limits beyond which a value is an outlier."""
    spread = (F.col("q3") - F.col("q1")) * F.lit(reach)
    return quantiles(df, by, value, QUARTILES, extra=[F.sum("n").alias("n")]).select(
        *by, "n", "q1", "median", "q3", (F.col("q1") - spread).alias("low_fence"),
        (F.col("q3") + spread).alias("high_fence"))


def _with_fences(df: DataFrame, box: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    limits = box.select(*by, "low_fence", "high_fence")
    return salted_join(df, limits, by, "inner", F.col(value))


def boxplot_stats(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Quartiles, the extreme values inside the fences, and the number of values outside.

    Quartiles are the linear quantiles. The whiskers are extremes, which each task combines before the shuffle.
    """
    box = freeze(fences(df, by, value))
    placed = _with_fences(df.filter(F.col(value).isNotNull()).select(*by, value), box, by, value)
    inside = F.col(value).between(F.col("low_fence"), F.col("high_fence"))
    whiskers = placed.groupBy(*by).agg(
        F.min(F.when(inside, F.col(value))).alias("low_whisker"),
        F.max(F.when(inside, F.col(value))).alias("high_whisker"),
        F.count_if(~inside).alias("outliers"))
    a, b = box.alias("a"), whiskers.alias("b")
    return a.join(b, same_keys(by)).select("a.*", "b.low_whisker", "b.high_whisker", "b.outliers").drop(
        "low_fence", "high_fence")


def outliers(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The rows outside the fences of their group.

    The fences are frozen, so their size is known and a few of them do not make the rows move.
    """
    placed = _with_fences(df, freeze(fences(df, by, value)), by, value)
    return placed.filter(~F.col(value).between(F.col("low_fence"), F.col("high_fence"))).drop("low_fence", "high_fence")


def _at_break(x: Column, low: Column, width: Column) -> Column:
    """Index of the last break ``low + i * width`` at or below x, exact where the division rounds."""
    near = F.floor((x - low) / width)
    return (near + F.when(x >= low + (near + 1) * width, 1).otherwise(0)
            - F.when(x < low + near * width, 1).otherwise(0))


def fixed_bin(x: Column, low: float, width: float, bins: int) -> Column:
    """Bin number from 0 of a left-closed bin, NULL outside the breaks."""
    at = _at_break(x, F.lit(float(low)), F.lit(float(width)))
    return F.when((at >= 0) & (at < bins), at)


def binned_stats(df: DataFrame, x: str, y: str, low: float = 1.0, width: float = 1.86, bins: int = 50) -> DataFrame:
    """Per bin of x: largest, smallest and mean y and the median x. Empty bins stay, with NULL cells."""
    binned = df.select(fixed_bin(F.col(x), low, width, bins).alias("bin"), F.col(x).alias("x"), F.col(y).alias("y"))
    binned = binned.filter(F.col("bin").isNotNull())
    of_y = binned.groupBy("bin").agg(F.max("y").alias("max_y"), F.min("y").alias("min_y"), F.avg("y").alias("mean_y"))
    of_x = quantiles(binned, ["bin"], "x", {"mid_x": 0.5})
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(of_y, "bin", "left").join(of_x, "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("from_x"), "mid_x", "max_y", "min_y", "mean_y")


def covariance_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample covariance of each pair of columns, in (a, b, cov) form; all cells come from one pass."""
    cells = [F.covar_samp(a, b).alias(f"{i}_{k}") for i, a in enumerate(columns) for k, b in enumerate(columns)]
    one_row = df.agg(*cells)
    triples = F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{i}_{k}").alias("cov"))
        for i, a in enumerate(columns) for k, b in enumerate(columns)])
    return one_row.select(F.inline(triples))


def regression_errors(pairs: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean squared error, mean absolute error and root mean squared log error.

    A value below -1 has no logarithm and makes the last one NaN; at -1 it is infinite.
    """
    def log1p(name):
        x = F.col(name)
        return F.when(x < -1, float("nan")).when(x == -1, float("-inf")).otherwise(F.log1p(x))

    gap = F.col(predicted) - F.col(actual)
    log_gap = log1p(predicted) - log1p(actual)
    return pairs.agg(F.avg(gap * gap).alias("mse"), F.avg(F.abs(gap)).alias("mae"),
                     F.sqrt(F.avg(log_gap * log_gap)).alias("rmsle"))


def array_stats(df: DataFrame, value: str) -> DataFrame:
    """Minimum, maximum, sum and mean of a column without NULL and NaN."""
    number = F.when(~F.isnan(value), F.col(value))
    return df.agg(F.min(number).alias("min"), F.max(number).alias("max"), F.coalesce(F.sum(number), F.lit(0.0)).alias("sum"),
                  F.avg(number).alias("mean"))


def histogram(df: DataFrame, value: str, bins: int | None = None) -> DataFrame:
    """Counts over equal bins of [min, max], the last bin closed; by default ceil(log2 n + 1) bins.

    NULL and NaN are in no bin.
    """
    number = df.select(F.col(value).cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    count = F.lit(bins) if bins else F.ceil(F.log2(F.count("v").cast("double")) + 1)
    shape = number.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), count.cast("bigint").alias("bins"))
    shape = shape.withColumn("width", (F.col("hi") - F.col("lo")) / F.col("bins"))
    limited = number.withColumn("s", shape.select(F.struct("lo", "width", "bins")).scalar())
    at = F.when(F.col("s.width") > 0, _at_break(F.col("v"), F.col("s.lo"), F.col("s.width"))).otherwise(0)
    counted = limited.groupBy(F.least(at, F.col("s.bins") - 1).alias("bin")).agg(F.count(F.lit(1)).alias("y"))
    every = shape.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bins") - 1)).alias("bin"), "lo", "width")
    return every.join(counted, "bin", "left").select(
        "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("x"), F.col("width").alias("dx"),
        F.coalesce("y", F.lit(0)).cast("bigint").alias("y"))


def quantile_bins(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Add ``bin``: how many of the k/bins quantiles are at or below the value."""
    probs = {f"t{k}": k / bins for k in range(1, bins)}
    limited = df.withColumn("_cuts", quantiles(df, [], value, probs).select(F.struct(*probs)).scalar())
    passed = F.lit(0)
    for name in probs:
        passed = passed + F.when(F.col(value) >= F.col(f"_cuts.{name}"), 1).otherwise(0)
    return limited.withColumn("bin", F.when(F.col(value).isNotNull(), passed)).drop("_cuts")


def quantize(x: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin of [low, high], values outside go to the first or last bin."""
    at = F.floor((x - F.lit(float(low))) * F.lit(bins / (high - low)))
    return F.when(x.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(bins - 1), at)).cast("int"))


def threshold(x: Column, cuts: Sequence[float]) -> Column:
    """Number of cuts at or below x, that is, right-open bins by given cuts."""
    passed = F.lit(0)
    for cut in sorted(cuts):
        passed = passed + F.when(x >= F.lit(float(cut)), 1).otherwise(0)
    return F.when(x.isNotNull(), passed)
