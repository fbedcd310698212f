"""Exact duplicates: 128-bit content hash, smallest id, and a byte comparison inside each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import SPACE, filled, query, read
from millrace.session import freeze


def normalized(text: str) -> Column:
    """The text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(filled(text), f"{SPACE}+", " ")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the raw text's 64-bit key, and the normalized text's MD5 and SHA-256, one row per row."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(filled(text)).alias("raw_key"),
                        normalized(text).alias("norm"))
    return plain.select("doc_id", "raw_key", F.unhex(F.md5("norm")).alias("digest"),
                        F.unhex(F.sha2("norm", 256)).alias("sha"))


def collisions(docs: DataFrame, rows: DataFrame, several: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows whose bytes differ from the text that their group keeps, regrouped by their bytes.

    Texts travel once, keyed by the raw text's hash; only members of groups of two or more come out of that
    join, and each is then compared with the one text of its group. A hot group is split by AQE on both joins,
    since the other side has one row per distinct text.
    """
    keys = rows.join(several, "digest").groupBy("raw_key", "digest").agg(F.min("keep_id").alias("keep_id"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(filled(text)).alias("raw_key"),
                        F.col(text).alias("text"))
    members = freeze(
        texts.join(keys, "raw_key")
        .select("doc_id", "digest", "keep_id", normalized("text").alias("norm"))
        .where(F.unhex(F.md5("norm")) == F.col("digest"))
    )
    kept = (members.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .groupBy("digest").agg(F.min("norm").alias("kept_norm")))
    odd = freeze(members.join(kept, "digest").where("norm != kept_norm")
                 .select("doc_id", "digest", F.unhex(F.sha2("norm", 256)).alias("sha"), "norm"))
    regrouped = odd.groupBy("digest", "norm").agg(
        F.min("doc_id").alias("odd_keep_id"), F.count("*").alias("odd_size"))
    return odd.join(regrouped, ["digest", "norm"]).select(
        "doc_id", "digest", "sha", "odd_keep_id", "odd_size").distinct()


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after white space is squeezed; a null text equals the empty one. The row with
    the smallest id stays (a null id only where the whole group has none); of rows that repeat the kept id and
    text, one is ``kept``. An empty table gives no rows. Other columns are not read, so none can clash.
    """
    rows = freeze(digests(docs, doc_id, text))
    # Frozen, so that both sides of its joins are plain exchanges, which AQE splits where a group is hot.
    several = freeze(rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
                     .where("group_size > 1"))
    odd = collisions(docs, rows, several, doc_id, text)
    size_of_odd = odd.groupBy("digest").agg(F.count("*").alias("n_odd"))
    classed = (
        rows.join(several, "digest", "left")
        .join(size_of_odd, "digest", "left")
        .join(odd.withColumnsRenamed({"doc_id": "odd_id", "digest": "odd_digest", "sha": "odd_sha"}),
              F.col("doc_id").eqNullSafe(F.col("odd_id")) & (F.col("digest") == F.col("odd_digest"))
              & (F.col("sha") == F.col("odd_sha")), "left")
        .select("doc_id", "sha",
                F.when(F.col("odd_size").isNotNull(), F.col("odd_keep_id"))
                .when(F.col("group_size").isNotNull(), F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
                F.coalesce("odd_size", F.col("group_size") - F.coalesce("n_odd", F.lit(0)), F.lit(1)).alias("group_size"))
    )
    return one_kept(classed).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def one_kept(classed: DataFrame) -> DataFrame:
    """Mark the kept row of each class: the one with the kept id, and one only where rows repeat."""
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("sha", "doc_id").orderBy("keep_id"))
    return classed.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (nth == 1))


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns."""
    from pyspark.sql import Window

    names = docs.columns
    kept = (exact_groups(docs, doc_id, text).where("kept")
            .select(F.col("doc_id").alias("__kept_id"), F.unhex("text_sha256").alias("__kept_sha")))
    keyed = docs.withColumn("__sha", F.unhex(F.sha2(normalized(text), 256)))
    found = keyed.join(kept, F.col("__sha").eqNullSafe(F.col("__kept_sha"))
                       & F.col(doc_id).eqNullSafe(F.col("__kept_id")))
    nth = F.row_number().over(Window.partitionBy("__sha", "__kept_id").orderBy("__kept_id"))
    return found.withColumn("__nth", nth).where("__nth = 1").select(*names)


@query("op9_exact_dedup", sql=r"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY norm)""")
def exact_dedup(spark, folder):
    return exact_groups(read(spark, folder, "documents"))
