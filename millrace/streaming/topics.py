"""Topics as streaming frames of key, value and timestamp, and the ways to run a stream to a table.

The broker connector is a separate package, named only in options. Without it the same code runs on
folders of files, which is also how the tests drive it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from millrace.functions.scalars import nonempty
from millrace.operators.keyed import newest_per_key


def open_topics(spark: SparkSession, servers: str, *topics: str, **options: str) -> DataFrame:
    """Subscribe to broker topics: key, value, timestamp, all text but the time."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", ",".join(topics)).options(**options).load().selectExpr(
        "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "timestamp")


def open_files(spark: SparkSession, path: str, schema: StructType, format: str = "parquet", **options: str) -> DataFrame:
    """A folder as a stream: each new file is read once."""
    return spark.readStream.schema(schema).format(format).options(**options).load(path)


def as_records(df: DataFrame, key: Column, value: Column, time: Column) -> DataFrame:
    return df.select(key.cast("string").alias("key"), value.cast("string").alias("value"),
                     time.cast("timestamp").alias("timestamp"))


def publish(records: DataFrame, servers: str, topic: str, checkpoint: str):
    """Start publishing a stream of key and value to a broker topic."""
    return (records.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def run_append(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> DataFrame:
    """Run a stream over all available input into Parquet files, and read them.

    With an ``interval`` it runs in fixed micro-batches until the input is used up; without, once.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    if interval:
        query = writer.trigger(processingTime=interval).start()
        query.processAllAvailable()
        query.stop()
    else:
        writer.trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def with_end(stream: DataFrame, folder: str) -> DataFrame:
    """A stream that also reads end marks from ``folder``, see ``mark_end``. It may have none yet."""
    stream.sparkSession.createDataFrame([], stream.schema).write.mode("append").parquet(folder)
    return stream.unionByName(open_files(stream.sparkSession, folder, stream.schema))


def mark_end(spark: SparkSession, folder: str, schema: StructType, time: str, at: Column) -> None:
    """Put an end mark into ``folder``: a row of NULLs with the time ``at``.

    A watermark only moves with the rows' times, so the last windows of a stream that ends would never be written.
    The mark moves it past them. Its own window lies behind the watermark it makes, so it is never written itself.
    """
    cells = [(at if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    spark.range(1).select(*cells).write.mode("append").parquet(folder)


def run_update(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """Run an aggregation in update mode and read the newest row of each key.

    Each micro-batch goes to its own folder and overwrites it when replayed, so a restart after a
    failure leaves every batch exactly once.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    (stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return read_newest(stream.sparkSession, path, stream.schema, keys)


def read_newest(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    versions = StructType([*schema.fields]).add("batch", LongType())
    try:
        written = spark.read.schema(versions).parquet(path)
    except AnalysisException:  # no batch ran, so there is no folder yet
        written = spark.createDataFrame([], versions)
    return newest_per_key(written, keys, "batch").select(*schema.names)


def injected(lines: DataFrame, id: str, value: str, time: str, delay: str) -> DataFrame:
    """Lines replayed as messages: empty ones are dropped, a repeat of an id within ``delay`` is dropped."""
    kept = lines.filter(nonempty(F.col(value))).withColumn(time, F.col(time).cast("timestamp"))
    if lines.isStreaming:
        return kept.withWatermark(time, delay).dropDuplicatesWithinWatermark([id])
    return kept.dropDuplicates([id])
