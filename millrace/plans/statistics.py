"""Statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import stats
from millrace.operators.ordered import quantiles
from millrace.plans.registry import plan


def rounded(df, digits: int, *columns: str):
    return df.withColumns({c: F.round(c, digits) for c in columns})


BINNED = """b AS (SELECT CAST(floor((l_quantity - 1) / CAST(1.86 AS DOUBLE)) AS BIGINT) AS bin, l_quantity AS x,
             l_extendedprice AS y FROM lineitem),
      g AS (SELECT bin, quantile_cont(x, 0.5) AS mid_x, max(y) AS max_y, min(y) AS min_y, avg(y) AS mean_y
            FROM b WHERE bin >= 0 AND bin < 50 GROUP BY bin)"""


def _binned(t):
    return stats.binned_stats(t.lineitem, "l_quantity", "l_extendedprice")


@plan(f"""WITH {BINNED} SELECT r.bin AS bin, round(1 + r.bin * CAST(1.86 AS DOUBLE), 6) AS from_x, mid_x, max_y, min_y,
      round(mean_y, 4) AS mean_y FROM range(0, 50) r(bin) LEFT JOIN g ON g.bin = r.bin""")
def binned_stats(t):
    return _binned(t).withColumns({"from_x": F.round("from_x", 6), "mean_y": F.round("mean_y", 4)})


@plan(f"""WITH {BINNED} SELECT round(covar_samp(mid_x, max_y), 3) AS cov_max, round(covar_samp(mid_x, min_y), 3) AS cov_min,
      round(covar_samp(mid_x, mean_y), 3) AS cov_mean FROM g""")
def covariance_pair(t):
    pair = _binned(t).agg(F.covar_samp("mid_x", "max_y").alias("cov_max"), F.covar_samp("mid_x", "min_y").alias("cov_min"),
                          F.covar_samp("mid_x", "mean_y").alias("cov_mean"))
    return rounded(pair, 3, "cov_max", "cov_min", "cov_mean")


COVARIANCES = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(covar_samp({a}, {b}), 2) AS cov FROM g"
    for a in ("mid_x", "max_y", "min_y", "mean_y") for b in ("mid_x", "max_y", "min_y", "mean_y"))


@plan(f"WITH {BINNED} {COVARIANCES}")
def covariance_matrix(t):
    return rounded(stats.covariance_matrix(_binned(t), ["mid_x", "max_y", "min_y", "mean_y"]), 2, "cov")


BOX = """q AS (SELECT hour(ts) AS hour, count(value) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
      f AS (SELECT *, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lo, q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS hi FROM q)"""


def _hourly(t):
    return t.events.select("event_id", F.hour("ts").alias("hour"), "value")


@plan(f"""WITH {BOX} SELECT f.hour AS hour, any_value(n) AS n, round(any_value(q1), 9) AS q1, round(any_value(median), 9) AS median,
      round(any_value(q3), 9) AS q3, min(value) FILTER (value BETWEEN lo AND hi) AS low_whisker,
      max(value) FILTER (value BETWEEN lo AND hi) AS high_whisker,
      count(*) FILTER (value NOT BETWEEN lo AND hi) AS outliers
      FROM events JOIN f ON hour(ts) = f.hour GROUP BY f.hour""")
def boxplot_stats(t):
    return rounded(stats.boxplot_stats(_hourly(t), ["hour"], "value"), 9, "q1", "median", "q3")


@plan(f"WITH {BOX} SELECT event_id, f.hour AS hour, value FROM events JOIN f ON hour(ts) = f.hour WHERE value NOT BETWEEN lo AND hi")
def boxplot_outliers(t):
    return stats.outliers(_hourly(t), ["hour"], "value")


SUMMARY = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", min({c}) AS min, max({c}) AS max, round(avg({c}), 5) AS mean,
        round(quantile_cont({c}, 0.25), 9) AS q1, round(quantile_cont({c}, 0.5), 9) AS median,
        round(quantile_cont({c}, 0.75), 9) AS q3 FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))


@plan(SUMMARY)
def numeric_summary(t):
    summary = stats.numeric_summary(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return rounded(rounded(summary, 5, "mean"), 9, "q1", "median", "q3")


@plan("""SELECT round(avg((p - a) * (p - a)), 2) AS mse, round(avg(abs(p - a)), 6) AS mae,
             round(sqrt(avg((ln(p + 1) - ln(a + 1)) * (ln(p + 1) - ln(a + 1)))), 9) AS rmsle
      FROM (SELECT l_extendedprice AS a, 2000 * l_quantity AS p FROM lineitem)""")
def regression_errors(t):
    pairs = t.lineitem.select(F.col("l_extendedprice").alias("actual"), (F.col("l_quantity") * 2000).alias("predicted"))
    return rounded(rounded(rounded(stats.regression_errors(pairs, "actual", "predicted"), 2, "mse"), 6, "mae"), 9, "rmsle")


@plan("SELECT min(value) AS min, max(value) AS max, round(sum(value), 4) AS sum, round(avg(value), 9) AS mean FROM events")
def array_stats(t):
    return rounded(rounded(stats.array_stats(t.events, "value"), 4, "sum"), 9, "mean")


@plan("""SELECT event_type, round(quantile_cont(value, 0.1), 9) AS p10, round(quantile_cont(value, 0.5), 9) AS median,
             round(quantile_cont(value, 0.99), 9) AS p99 FROM events GROUP BY event_type""")
def quantile_linear(t):
    probs = {"p10": 0.1, "median": 0.5, "p99": 0.99}
    return rounded(quantiles(t.events, ["event_type"], "value", probs), 9, *probs)


@plan("""WITH s AS (SELECT min(value) AS lo, max(value) AS hi, CAST(ceil(log2(count(value)) + 1) AS BIGINT) AS bins FROM events),
      w AS (SELECT *, (hi - lo) / bins AS width FROM s),
      c AS (SELECT least(CAST(floor((value - lo) / width) AS BIGINT), bins - 1) AS bin, count(*) AS y FROM events, w GROUP BY 1)
      SELECT r.bin AS bin, round(lo + r.bin * width, 9) AS x, round(width, 9) AS dx, coalesce(y, 0) AS y
      FROM (SELECT unnest(range(0, bins)) AS bin, lo, width FROM w) r LEFT JOIN c ON c.bin = r.bin""")
def histogram_fixed(t):
    return rounded(stats.histogram(t.events, "value"), 9, "x", "dx")


@plan("""WITH q AS (SELECT [quantile_cont(value, 0.2), quantile_cont(value, 0.4), quantile_cont(value, 0.6),
             quantile_cont(value, 0.8)] AS cuts FROM events)
      SELECT event_id, CAST(len(list_filter(cuts, lambda c: c <= value)) AS INTEGER) AS bin FROM events, q""")
def bin_quantile(t):
    return stats.quantile_bins(t.events.select("event_id", "value"), "value", 5).select("event_id", "bin")


@plan("""SELECT bin, count(*) AS n, min(value) AS lo, max(value) AS hi FROM (
        SELECT value, CAST(greatest(0, least(9, floor(value * CAST(0.1 AS DOUBLE)))) AS INTEGER) AS bin FROM events) GROUP BY bin""")
def bin_quantize(t):
    binned = t.events.select("value", stats.quantize(F.col("value"), 0, 100, 10).alias("bin"))
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))


@plan("""SELECT CAST(CASE WHEN value >= 100 THEN 3 WHEN value >= 50 THEN 2 WHEN value >= 10 THEN 1 ELSE 0 END AS INTEGER) AS bin,
             count(*) AS n FROM events GROUP BY 1""")
def bin_threshold(t):
    binned = t.events.select(stats.threshold(F.col("value"), [10, 50, 100]).alias("bin"))
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
