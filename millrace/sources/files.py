"""File sources and sinks. Every reader takes a declared schema; nothing is inferred."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import access_log_fields, access_log_parts
from millrace.session import freeze


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """One row ``value`` per line of all the files."""
    return spark.read.option("lineSep", "\n").text(list(paths))


def read_documents(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per file with its whole text, and the file it came from."""
    return spark.read.text(list(paths), wholetext=True).select(F.input_file_name().alias("path"), "value")


#: What a split tells of a sentence: how the part before its first end goes on, one that is whole, what follows its last end.
HEAD, WHOLE, TAIL = 0, 1, 2


def read_sentences(spark: SparkSession, *paths: str, ends: str = ".?!") -> DataFrame:
    """``path, sentence``: the text of each file cut at the ``ends``, its lines joined by blanks.

    No file is read whole. A task reads splits of files line by line and cuts out the sentences inside; of each split
    only the part before its first end and the part after its last one are left over. These fragments, two at most
    for a split, are put in order by file and offset, and those of one sentence are joined. So a sentence may go over
    any number of lines and splits, and a file may have any size.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    found = lines.mapInArrow(functools.partial(_cut_splits, re.compile(f"[{re.escape(ends)}]")),
                             "path string, block long, kind int, sentence string")
    # two rows a split: a file of a terabyte has some ten thousand
    pieces = freeze(found)
    left = pieces.filter(F.col("kind") != WHOLE)
    order = Window.partitionBy("path").orderBy("block", "kind")
    number = F.sum((F.col("kind") == TAIL).cast("int")).over(order)
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "sentence")))
    joined = left.withColumn("nth", number).groupBy("path", "nth").agg(
        F.array_join(F.transform(parts, lambda p: p["sentence"]), "").alias("sentence"))
    return pieces.filter(F.col("kind") == WHOLE).select("path", "sentence").unionByName(joined.select("path", "sentence"))


def _cut_splits(end: re.Pattern, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fragments and whole sentences of each split; the rows of a split come in the order of its lines."""
    split, kind, open_parts = None, HEAD, []
    out: list[tuple] = []

    def close():
        out.append((*split, kind, "".join(open_parts)))

    for batch in batches:
        for path, block, line in zip(*[c.to_pylist() for c in batch.columns]):
            if (path, block) != split:
                if split:
                    close()
                split, kind, open_parts = (path, block), HEAD, []
                if block:
                    line = " " + line  # in the place of the line end before the split
            else:
                line = " " + line
            first, *more = end.split(line)
            open_parts.append(first)
            for part in more:
                kind = HEAD if kind == HEAD else WHOLE
                close()
                kind, open_parts = TAIL, [part]
        yield _pieces(out)
        out.clear()
    if split:
        close()
        yield _pieces(out)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    types = (pa.string(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["path", "block", "kind", "sentence"])


def joined_lines(text: Column) -> Column:
    """A whole document on one line, so that sentences may span line ends."""
    return F.replace(text, F.lit("\n"), F.lit(" "))


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    """Delimited text with a declared schema; a cell that does not parse is NULL."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").csv(path, sep=sep)


def read_csv_header(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with a header and quoted cells; all cells are strings, the caller converts."""
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    return spark.read.schema(schema).csv(path, header=True, quote='"', escape='"')


def read_csv_without(spark: SparkSession, path: str, schema: str, drop: Sequence[str]) -> DataFrame:
    """Header CSV without some of its columns; they are pruned in the scan."""
    return spark.read.schema(schema).csv(path, header=True, quote='"', escape='"').drop(*drop)


def read_access_log(spark: SparkSession, *paths: str) -> DataFrame:
    """Nine string columns per line; a line that does not match counts as a row of NULLs."""
    parts = read_lines(spark, *paths).select(access_log_parts(F.col("value")).alias("parts"))
    return parts.select(*access_log_fields(F.col("parts")))


def write_lines(df: DataFrame, path: str, sep: str = "\t") -> str:
    """Each row as one line of a text file, the columns joined by ``sep``."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *cells).alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)
    return path


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = False) -> str:
    df.write.mode("overwrite").csv(path, sep=sep, header=header, quote='"', escape='"')
    return path


def write_report(df: DataFrame, path: str, order: Sequence[Column], n: int = 20) -> str:
    """The first n rows of an order as one tab-separated file; only those n rows meet in one task."""
    df.orderBy(*order).limit(n).coalesce(1).sortWithinPartitions(*order).write.mode("overwrite").csv(path, sep="\t")
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).parquet(path)
    return path
