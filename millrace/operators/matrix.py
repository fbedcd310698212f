"""Matrices in coordinate form: rows (i, j, v), both indices from 0."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def from_vectors(df: DataFrame, row: str, vector: str) -> DataFrame:
    return df.select(F.col(row).alias("i"), F.posexplode(vector).alias("j", "v")).select(
        "i", F.col("j").cast("bigint").alias("j"), F.col("v").cast("double").alias("v"))


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def dims(a: DataFrame) -> DataFrame:
    return a.agg((F.max("i") + 1).alias("rows"), (F.max("j") + 1).alias("cols"))


def to_blocks(a: DataFrame, block: int) -> DataFrame:
    """Square blocks ``bi, bj`` with their cells packed, places counted inside the block: at most ``block`` squared."""
    inside = F.struct((F.col("i") % block).cast("int").alias("i"), (F.col("j") % block).cast("int").alias("j"), "v")
    return a.groupBy(F.floor(F.col("i") / block).alias("bi"), F.floor(F.col("j") / block).alias("bj")).agg(
        F.collect_list(inside).alias("cells"))


_PACKED = pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32()), ("v", pa.float64())]))


def _arrays(cells: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = cells.values
    return tuple(flat.field(name).to_numpy(zero_copy_only=False) for name in ("i", "j", "v"))


class _Sums:
    """The sum of one block of the product, and which of its cells were ever added to."""

    def __init__(self, block: int):
        self.v, self.there = np.zeros((block, block)), np.zeros((block, block), bool)

    def add_product(self, left: tuple, right: tuple) -> None:
        """Add the product of two packed blocks: each cell of the left meets the right's cells of its inner index."""
        order = np.argsort(right[0], kind="stable")
        rows, columns, values = (part[order] for part in right)
        start, end = np.searchsorted(rows, left[1], "left"), np.searchsorted(rows, left[1], "right")
        met = end - start
        if met.sum() > len(self.v) ** 2:  # mostly filled: dense products
            block = len(self.v)
            a, b = np.zeros((block, block)), np.zeros((block, block))
            np.add.at(a, left[:2], left[2])
            np.add.at(b, right[:2], right[2])
            in_a, in_b = np.zeros((block, block), np.float32), np.zeros((block, block), np.float32)
            in_a[left[:2]] = in_b[right[:2]] = 1
            self.v += a @ b
            self.there |= (in_a @ in_b) > 0
            return
        at = np.repeat(start - np.cumsum(met) + met, met) + np.arange(met.sum())
        i, j = np.repeat(left[0], met), columns[at]
        np.add.at(self.v, (i, j), np.repeat(left[2], met) * values[at])
        self.there[i, j] = True

    def add_cells(self, cells: tuple) -> None:
        np.add.at(self.v, cells[:2], cells[2])
        self.there[cells[:2]] = True

    def cells(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, j = np.nonzero(self.there)
        return i, j, self.v[i, j]


#: Blocks of the product that a task adds up before it sends them on.
HELD = 16


def multiply(a: DataFrame, b: DataFrame, block: int = 512) -> DataFrame:
    """A·B by blocks: what is shuffled are blocks of A, of B and of the product, never single products.

    Blocks meet on the inner index. Where there are fewer inner indices than tasks, as for a long matrix with few
    columns, the rows of A and the columns of B are dealt into strips as well, and a block goes to each strip it
    meets. A task adds up the blocks it makes; the partial sums of a block are then added in order, one at a time.
    """
    spark = a.sparkSession
    inner, down, across = (((top or 0) // block) + 1 for top in (
        a.agg(F.max("j")).first()[0], a.agg(F.max("i")).first()[0], b.agg(F.max("j")).first()[0]))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    strips = max(math.isqrt(max(tasks // inner, 1)), 1)
    rows, columns = min(strips, down), min(strips, across)
    left, right = to_blocks(a, block), to_blocks(b, block)
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (columns, rows)]
    left = left.select("bi", F.col("bj").alias("k"), F.col("cells").alias("left"), (F.col("bi") % rows).cast("int").alias("row"),
                       every[0].alias("column"))
    right = right.select(F.col("bi").alias("k"), "bj", F.col("cells").alias("right"), (F.col("bj") % columns).cast("int").alias("column"),
                         every[1].alias("row"))

    def packed(sums: dict) -> pa.RecordBatch:
        cells = [[{"i": i, "j": j, "v": v} for i, j, v in zip(*map(np.ndarray.tolist, s.cells()))] for s in sums.values()]
        keys = list(zip(*sums)) or [(), ()]
        return pa.RecordBatch.from_arrays([*[pa.array(k, pa.int64()) for k in keys], pa.array(cells, _PACKED)], ["bi", "bj", "cells"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, _Sums] = {}
        for batch in batches:
            for n, key in enumerate(zip(batch.column("bi").to_pylist(), batch.column("bj").to_pylist())):
                if key not in held and len(held) >= HELD:
                    yield packed(held)
                    held = {}
                held.setdefault(key, _Sums(block)).add_product(_arrays(batch.column("left")[n]), _arrays(batch.column("right")[n]))
        yield packed(held)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums = None, None

        def flat():
            i, j, v = sums.cells()
            return pa.RecordBatch.from_arrays([pa.array(key[0] * block + i), pa.array(key[1] * block + j), pa.array(v)], ["i", "j", "v"])

        for batch in batches:
            for n, here in enumerate(zip(batch.column("bi").to_pylist(), batch.column("bj").to_pylist())):
                if here != key:
                    if sums:
                        yield flat()
                    key, sums = here, _Sums(block)
                sums.add_cells(_arrays(batch.column("cells")[n]))
        if sums:
            yield flat()

    cells = "array<struct<i:int,j:int,v:double>>"
    met = left.join(right, ["k", "row", "column"]).select("bi", "bj", "left", "right")
    parts = met.mapInArrow(partial, f"bi bigint, bj bigint, cells {cells}")
    return parts.repartition("bi", "bj").sortWithinPartitions("bi", "bj").mapInArrow(total, "i bigint, j bigint, v double")


def gram(df: DataFrame, vector: str) -> DataFrame:
    """AᵀA of the matrix whose rows are the vectors.

    Each task adds up the products of its own rows with one BLAS call per Arrow batch, so a task sends
    columns² cells to the shuffle however many rows it read.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                rows = np.vstack(batch[vector].to_numpy()).astype(np.float64)
                product = rows.T @ rows
                total = product if total is None else total + product
        if total is not None:
            i, j = np.indices(total.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    parts = df.filter(F.col(vector).isNotNull()).select(vector).mapInPandas(partial, "i bigint, j bigint, v double")
    return parts.groupBy("i", "j").agg(F.sum("v").alias("v"))
