"""Encoders, splits and regression models."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    LinearRegression,
    LinearRegressionModel,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import hash_fraction
from millrace.operators.ordered import global_rank, same_keys
from millrace.session import freeze


def category_index(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in ascending order with their index from 0; NULL is a level of its own, the last.

    The index stays a table, so the number of categories is not limited by the driver.
    """
    values = df.select(column).distinct()
    return global_rank(values, [F.asc_nulls_last(column)], "_rank").select(column, (F.col("_rank") - 1).alias(f"{column}_index"))


#: Most levels of a category whose index is a broadcast list. This decides how a row meets its index, not the index.
FEW_LEVELS = 10_000


def with_indices(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_index`` for each categorical column; every row stays.

    One pass estimates the levels of all columns, one lists those of the columns with few. Only a column with more
    than ``FEW_LEVELS`` is ranked as a table of its own.
    """
    about = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    few = [c for c in columns if about[c] <= FEW_LEVELS]
    listed = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in few]).first() if few else None
    for column in columns:
        index = f"{column}_index"
        if column in few:
            levels = df.sparkSession.createDataFrame([(listed[column],)], df.select(F.array(column).alias("levels")).schema)
            table = F.broadcast(levels.select(F.posexplode("levels").alias(index, column)).withColumn(index, F.col(index).cast("bigint")))
            a, b = df.alias("a"), table.alias("b")
            missing = F.lit(len(listed[column])).cast("bigint")  # NULL comes last
            df = a.join(b, F.col(f"a.{column}") == F.col(f"b.{column}"), "left").select(
                "a.*", F.coalesce(F.col(f"b.{index}"), missing).alias(index))
        else:
            a, b = df.alias("a"), category_index(df, column).alias("b")
            df = a.join(b, same_keys([column])).select("a.*", f"b.{index}")
    return df


def one_hot(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, PipelineModel]:
    """Add a sparse 0/1 vector ``<column>_vec`` per category; no level is dropped."""
    encoder = OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_vec" for c in columns],
                            dropLast=False)
    indexed = with_indices(df, columns)
    model = encoder.fit(indexed)
    return model.transform(indexed), model


def assemble(df: DataFrame, inputs: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(inputs), outputCol=output).transform(df)


def split_label(key: Column, train: float = 0.9, seed: int = 42) -> Column:
    """'train' or 'test' by a hash of the row's key: the same rows on every run and partitioning."""
    return F.when(hash_fraction(key, seed) < train, "train").otherwise("test")


def _descend(xx: np.ndarray, xy: np.ndarray, n: int, step: float, iterations: int, tolerance: float
             ) -> tuple[list[float], int]:
    """Gradient descent on the sums of x·x and x·y; the step shrinks with the root of the iteration."""
    weights = np.zeros(len(xy))
    for i in range(1, iterations + 1):
        moved = weights - step / math.sqrt(i) * (xx @ weights - xy) / n
        settled = i > 1 and np.linalg.norm(moved - weights) < tolerance * max(np.linalg.norm(moved), 1.0)
        weights = moved
        if settled:
            break
    return [float(w) for w in weights], i


def linear_sgd(df: DataFrame, features: Sequence[str], label: str, step: float, iterations: int = 100,
               tolerance: float = 0.001) -> tuple[list[float], int]:
    """Full-batch gradient descent without intercept: weights and the number of iterations run.

    The gradient of the squared error needs only the sums of x·x and x·y, so one pass over the data
    serves all iterations. Descent stops once the weights move less than the tolerance.
    """
    x = [F.col(c).cast("double") for c in features]
    y = F.col(label).cast("double")
    d = len(features)
    sums = [F.sum(x[i] * x[k]) for i in range(d) for k in range(d)] + [F.sum(xi * y) for xi in x]
    row = df.dropna(subset=[*features, label]).agg(F.count(F.lit(1)), *sums).first()
    n, rest = row[0], np.array([v or 0.0 for v in row[1:]])
    if not n:
        raise ValueError("no rows to fit")
    return _descend(rest[: d * d].reshape(d, d), rest[d * d:], n, step, iterations, tolerance)


class Coded(NamedTuple):
    """Rows with their model columns as a sparse list ``x`` of (i, x): one 1 per category, then the numbers."""

    rows: DataFrame
    categories: list[tuple[str, int, int]]  # index column, its first model column, levels
    numbers: list[tuple[str, int]]  # column, its model column
    width: int


def code_columns(df: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> Coded:
    """Index the categories and lay all columns side by side; a category may have any number of levels.

    A row with a NULL number has a NULL ``x`` and takes no part in a fit. The rows are frozen, since fits read them again.
    """
    rows = freeze(with_indices(df, categories)) if categories else df
    levels = rows.agg(*[F.max(f"{c}_index").alias(c) for c in categories]).first() if categories else {}
    at, coded, plain = 0, [], []
    for c in categories:
        coded.append((f"{c}_index", at, (levels[c] if levels[c] is not None else -1) + 1))
        at += coded[-1][2]
    for c in numbers:
        plain.append((c, at))
        at += 1
    cells = [F.struct((F.col(c) + first).cast("bigint").alias("i"), F.lit(1.0).alias("x")) for c, first, _ in coded]
    cells += [F.struct(F.lit(i).cast("bigint").alias("i"), F.col(c).cast("double").alias("x")) for c, i in plain]
    known = F.lit(True)
    for c in numbers:
        known = known & F.col(c).isNotNull()
    return Coded(rows.withColumn("x", F.when(known, F.array(*cells))), coded, plain, at)


def gram_cells(rows: DataFrame, x: str) -> DataFrame:
    """``i, j, v`` with i <= j: the sums of x_i * x_j over sparse lists of (i, x), only where they meet.

    Each task adds up its own cells first, so a task sends each cell once however many rows it read.
    """
    cells = F.filter(x, lambda c: c["x"] != 0)
    pairs = F.flatten(F.transform(cells, lambda a: F.transform(
        F.filter(cells, lambda b: b["i"] >= a["i"]),
        lambda b: F.struct(a["i"].alias("i"), b["i"].alias("j"), (a["x"] * b["x"]).alias("v")))))
    return rows.select(F.explode(pairs).alias("p")).groupBy("p.i", "p.j").agg(F.sum("p.v").alias("v"))


def linear_sgd_coded(coded: Coded, rows: DataFrame, label: str, step: float, iterations: int = 100, tolerance: float = 0.001,
                     widest: int = 512, block: int = 512) -> tuple[DataFrame, int]:
    """``linear_sgd`` over coded columns of any number: the weights as a table ``i, w``, and the iterations run.

    The sums of x·x and x·y are sparse cells, made in one pass over ``rows`` (some rows of ``coded.rows``). Up to
    ``widest`` columns the cells, at most ``widest`` squared, are descended on in the driver. Wider models keep cells
    and weights in blocks of ``block`` columns: an iteration multiplies each block of cells with the weights' block
    that it meets and sums the results per block, and only the moved distance comes to the driver.
    """
    fitted = rows.filter(F.col("x").isNotNull() & F.col(label).isNotNull())
    y = F.struct(F.lit(coded.width).cast("bigint").alias("i"), F.col(label).cast("double").alias("x"))
    cells = freeze(gram_cells(fitted.select(F.array_append("x", y).alias("x")), "x"))
    n = fitted.count()
    if not n:
        raise ValueError("no rows to fit")
    if coded.width <= widest:
        sums = np.zeros((coded.width + 1, coded.width + 1))
        for i, j, v in cells.collect():
            sums[i, j] = sums[j, i] = v
        weights, used = _descend(sums[:-1, :-1], sums[:-1, -1], n, step, iterations, tolerance)
        return rows.sparkSession.createDataFrame(list(enumerate(weights)), "i bigint, w double"), used
    return _descend_in_blocks(cells, coded.width, n, step, iterations, tolerance, block)


def _descend_in_blocks(cells: DataFrame, width: int, n: int, step: float, iterations: int, tolerance: float, block: int
                       ) -> tuple[DataFrame, int]:
    inside = cells.filter(F.col("j") < width)
    both = inside.unionByName(inside.filter("i != j").select(F.col("j").alias("i"), F.col("i").alias("j"), "v"))
    row, col = F.floor(F.col("i") / block), F.floor(F.col("j") / block)
    blocks = freeze(both.groupBy(row.alias("bi"), col.alias("bj")).agg(F.collect_list(F.struct(
        (F.col("i") % block).cast("int").alias("i"), (F.col("j") % block).cast("int").alias("j"), "v")).alias("cells")))
    zeros = F.array_repeat(F.lit(0.0), block)
    wanted = cells.filter((F.col("j") == width) & (F.col("i") < width)).groupBy(row.alias("b")).agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("i") % block).cast("int"), "v"))).alias("at"))
    every = cells.sparkSession.range(-(-width // block)).withColumnRenamed("id", "b").join(wanted, "b", "left")
    xy = F.transform(zeros, lambda _, i: F.coalesce(F.try_element_at("at", i), F.lit(0.0)))
    state = freeze(every.select("b", zeros.alias("w"), F.when(F.col("at").isNull(), zeros).otherwise(xy).alias("xy")))

    def multiply(batches):
        for batch in batches:
            found = []
            for part, w in zip(batch.column("cells"), batch.column("w")):
                flat = part.values
                i, j, v = (flat.field(k).to_numpy() for k in ("i", "j", "v"))
                found.append(np.bincount(i, v * w.values.to_numpy()[j], block))
            yield pa.RecordBatch.from_arrays([batch.column("b"), pa.array(found, pa.list_(pa.float64()))], ["b", "g"])

    for i in range(1, iterations + 1):
        met = blocks.join(state.select(F.col("b").alias("bj"), "w"), "bj").select(F.col("bi").alias("b"), "cells", "w")
        parts = met.mapInArrow(multiply, "b bigint, g array<double>").groupBy("b").agg(F.collect_list("g").alias("parts"))
        sums = F.aggregate("parts", zeros, lambda total, g: F.zip_with(total, g, lambda x, y: x + y))
        slope = F.zip_with(sums, "xy", lambda g, y: g - y)
        pace = step / math.sqrt(i) / n
        moved = F.zip_with("w", slope, lambda w, g: w - g * pace)
        after = state.join(parts, "b", "left").withColumn("parts", F.coalesce("parts", F.array().cast("array<array<double>>")))
        after = freeze(after.select("b", F.col("w").alias("old"), moved.alias("w"), "xy"))
        squares = [F.sum(F.aggregate(a, F.lit(0.0), lambda total, d: total + d * d)) for a in (
            F.zip_with("w", "old", lambda x, y: x - y), F.col("w"))]
        distance, length = (math.sqrt(v) for v in after.agg(*squares).first())
        state = after.drop("old")
        if i > 1 and distance < tolerance * max(length, 1.0):
            break
    flat = state.select("b", F.posexplode("w").alias("at", "w"))
    return flat.select((F.col("b") * block + F.col("at")).alias("i"), "w").filter(F.col("i") < width), i


def predict_coded(coded: Coded, rows: DataFrame, weights: DataFrame, name: str = "predicted") -> DataFrame:
    """Add the prediction to some rows of ``coded.rows``: each category's weights are joined on its index.

    A join has one row per level on its right side, which Spark broadcasts where it is small.
    """
    total = F.lit(0.0)
    for k, (index, first, levels) in enumerate(coded.categories):
        own = weights.filter((F.col("i") >= first) & (F.col("i") < first + levels)).select(
            (F.col("i") - first).alias(index), F.col("w").alias(f"_w{k}"))
        rows = rows.join(own, index, "left")
        total = total + F.col(f"_w{k}")
    at = [i for _, i in coded.numbers]
    of_numbers = dict(map(tuple, weights.filter(F.col("i").isin(at)).collect())) if at else {}  # one row per number
    for c, i in coded.numbers:
        total = total + F.col(c).cast("double") * F.lit(of_numbers[i])
    return rows.withColumn(name, total).drop(*[f"_w{k}" for k in range(len(coded.categories))])


def linear_fit_vectors(df: DataFrame, features: str, label: str) -> LinearRegressionModel:
    """Least squares without intercept over a vector column, on the executors."""
    return LinearRegression(featuresCol=features, labelCol=label, fitIntercept=False).fit(df)


def linear_fit(df: DataFrame, features: Sequence[str], label: str) -> list[float]:
    """Least squares without intercept."""
    return [float(w) for w in linear_fit_vectors(assemble(df, features), "features", label).coefficients]


def predict_linear(features: Sequence[str], weights: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for name, weight in zip(features, weights):
        total = total + F.col(name) * F.lit(weight)
    return total


def tree_fit(rows: DataFrame, label: str, features: str = "features", depth: int = 5, bins: int = 32) -> DecisionTreeRegressionModel:
    """A variance tree over assembled features that are all treated as numbers.

    Fitting reads its rows several times: pass frozen rows.
    """
    return DecisionTreeRegressor(featuresCol=features, labelCol=label, maxDepth=depth, maxBins=bins, seed=42).fit(rows)
