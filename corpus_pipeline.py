"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (  # noqa: F401
    exact_dedup,
    language,
    licenses,
    mixing,
    near_dup,
    pieces,
    quality,
    repeats,
    resample,
    secrets,
    sharding,
    toxicity,
    turns,
)
from millrace.llm.base import QUERIES, query, read
from millrace.session import freeze

#: The near-copy groups and the encoding have no SQL; ``tests/llm/test_pipeline.py`` holds every stage and the whole
#: run against brute force.
ORACLE_SQL = None

# Every stage takes nulls in any column, empty and very long texts, repeated rows and empty tables; what each gives for
# them is said at the operator that it calls. Columns beside those of ``documents`` stay, whatever they are called.


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep; null and empty texts go."""
    return quality.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the smallest id, a null id only where there is no other."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's target weight takes them; null is a source of its own."""
    return mixing.repeat(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, token_ids, decodes`` of every copy that the mix took; the ids are decoded again to tell."""
    return pieces.encode(docs.select("doc_id", "source", "lang", "text"), decodes="decodes").drop("text")


STAGES = [("quality", good), ("exact", exact), ("near", near), ("mix", mix), ("encode", encode)]


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir))
    return docs


LLM_QUERIES = QUERIES
