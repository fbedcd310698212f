"""Sharding over fixed virtual slots and a versioned map from slots to shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.base import filled, query, read
from millrace.session import freeze, scratch_path

#: Fixed for the life of a data set: rows never change their slot, only slots change their shard.
SLOTS = 4096


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int")


def placed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot`` per row: 8 bytes a row and the text's UTF-8 bytes (null: none).

    A row without an id is placed by its text, so that such rows do not meet in one slot.
    """
    size = (F.octet_length(filled(text)) + F.lit(8)).cast("long")
    crc = F.crc32(F.encode(filled(text), "UTF-8"))
    key = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), crc.cast("string")))
    return docs.select(F.col(doc_id).alias("doc_id"), size.alias("size"), crc.alias("text_crc32"),
                       slot_of(key, slots).alias("virtual_slot"))


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``virtual_slot, bytes, n_rows`` of every slot, empty ones too: at most ``slots`` rows."""
    counted = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(counted, "virtual_slot", "left").select(
        "virtual_slot", F.coalesce("bytes", F.lit(0)).alias("bytes"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: slots dealt in turn. ``virtual_slot, shard``."""
    return spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"),
                                     (F.col("id") % shards).cast("int").alias("shard"))


def rebalance(current: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The map edited for ``shards`` shards and the slots' present bytes: ``virtual_slot, shard``.

    Every shard keeps its largest slots up to the mean load, and at least one; what is above it, and the slots of
    shards that are gone, move one by one, largest first, to the shard with the least bytes. Ties go to the smaller
    slot and shard. The fold runs over the slots (a fixed number, here in one row), never over documents.
    """
    mean = F.sum("bytes").over(Window.partitionBy()) / F.lit(shards)
    # Windows over the slots only: their number is the parameter ``slots``.
    largest = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    marked = (
        sizes.join(current, "virtual_slot")
        .withColumn("mean", mean).withColumn("run", F.sum("bytes").over(largest))
        .withColumn("nth", F.row_number().over(largest))
        .withColumn("stays", (F.col("shard") < shards) & ((F.col("run") <= F.col("mean")) | (F.col("nth") == 1)))
    )
    gathered = marked.agg(
        F.collect_list(F.when(F.col("stays"), F.struct("virtual_slot", "shard", "bytes"))).alias("stay"),
        F.array_sort(F.collect_list(F.when(~F.col("stays"), F.struct(
            (-F.col("bytes")).alias("less"), "virtual_slot", "bytes")))).alias("move"))
    loads = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.aggregate(
        F.filter("stay", lambda s: s["shard"] == i), F.lit(0).cast("long"), lambda a, s: a + s["bytes"]))
    zero = F.struct(F.col("loads").alias("loads"), F.array().cast("array<int>").alias("to"))

    def give(state, slot):
        least = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        return F.struct(
            F.transform(state["loads"], lambda x, i: F.when(i == least, x + slot["bytes"]).otherwise(x)).alias("loads"),
            F.concat(state["to"], F.array(least)).alias("to"))

    dealt = gathered.withColumn("loads", loads).withColumn("to", F.aggregate("move", zero, give, lambda s: s["to"]))
    stay = F.transform("stay", lambda s: F.struct(s["virtual_slot"].alias("virtual_slot"), s["shard"].alias("shard")))
    moved = F.zip_with("move", "to", lambda s, t: F.struct(s["virtual_slot"].alias("virtual_slot"), t.alias("shard")))
    return dealt.select(F.inline(F.concat(stay, moved)))


def save_map(mapping: DataFrame, path: str, version: int) -> DataFrame:
    """Store a version of the map below ``path`` and read it back; a version is never overwritten."""
    mapping.coalesce(1).write.parquet(f"{path}/version={version}")
    return load_map(mapping.sparkSession, path, version)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, the newest when none is named."""
    every = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == version).select("virtual_slot", "shard")


def shard(rows: DataFrame, mapping: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` with their ``shard`` and ``slot``: the row's place in its shard, gapless from 0.

    Places follow the virtual slot, then the id. The offset of a slot in its shard comes from the row counts per
    slot, so only rows of one virtual slot are ever sorted together.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot")
    offsets = mapping.join(sizes, "virtual_slot").select(
        "virtual_slot", "shard", (F.sum("n_rows").over(before) - F.col("n_rows")).alias("offset"))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("nth", F.row_number().over(inside) - 1).join(F.broadcast(offsets), "virtual_slot")
        .select(*rows.columns, "shard", (F.col("offset") + F.col("nth")).cast("long").alias("slot"))
    )


@query("op1_sharding")
def sharding(spark, folder):
    """Law ``bytes``: the map is edited until the shards' sizes are near equal.

    Null or empty texts count 8 bytes, repeated rows share a slot and get places of their own, an empty table has
    no rows but a map. Columns beside the id and the text are not read.
    """
    shards, maps = 24, scratch_path(spark, "slot-map")
    rows = freeze(placed(read(spark, folder, "documents")))
    sizes = freeze(slot_sizes(rows).coalesce(1))
    first = save_map(first_map(spark, shards), maps, 1)
    edited = save_map(rebalance(first, sizes, shards), maps, 2)
    return shard(rows, edited, sizes).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(2).alias("map_version"))
