"""Secret scan by a ledger of blobs: each distinct text is scanned once per version of a rule."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.base import filled, query, read
from millrace.session import freeze, scratch_path


class Rule(NamedTuple):
    """A kind of secret. ``pattern`` finds matches; ``long_group`` must hold ``least`` characters to count."""

    kind: str
    version: int
    pattern: str
    long_group: int
    least: int


#: The kinds of the contract, in the order in which equal starts are listed.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)

SPANS = "array<struct<start:bigint,end:bigint>>"
LEDGER = f"blob binary, kind string, version int, spans {SPANS}"


def matches(text: Column, rule: Rule) -> Column:
    """The rule's spans in code points, end exclusive: leftmost, non-overlapping, short ones dropped.

    ``split`` gives what lies between the matches and ``regexp_extract_all`` the matches, so running lengths
    give the positions.
    """
    # A maximal run shorter than ``least`` would be dropped anyway; asking for the length in the pattern skips it.
    pattern = rule.pattern if rule.long_group else rule.pattern.removesuffix("+") + "{%d,}" % (
        rule.least - len(rule.pattern.split("[")[0]))
    gaps = F.transform(F.split(text, pattern), F.char_length)
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.char_length)
    counted = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.long_group)), F.char_length)
    each = F.arrays_zip(gaps.alias("gap"), whole.alias("len"), counted.alias("counted"))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(state, x):
        start = state["at"] + x["gap"]
        end = start + x["len"]
        found = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(F.coalesce(end, state["at"]).alias("at"),
                        F.when(x["counted"] >= rule.least, F.concat(state["spans"], found))
                        .otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate(each, zero, step, lambda state: state["spans"])
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(F.array().cast(SPANS))


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows ``blob, kind, version, spans``; a new path gets an empty ledger."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def scan_new(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """Scan what the ledger has not seen, append it, and return ``doc_id, blob`` of every row.

    A blob is the SHA-256 of a text (null: empty). Only pairs of blob and rule version without a ledger row are
    scanned, each blob's text once, and a blob without findings gets an empty row, so that it is not scanned again.
    The append is one job: after a failure its pairs are still unseen. The text travels keyed by blob and id, so
    the copies of a hot blob spread over all tasks.
    """
    spark = docs.sparkSession
    paths = freeze(docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(filled(text), 256)).alias("blob")))
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    seen = open_ledger(spark, ledger).select("blob", "kind", "version")
    todo = (
        paths.groupBy("blob").agg(F.xxhash64(F.min("doc_id")).alias("place"))
        .withColumn("pair", F.explode(wanted)).select("blob", "place", "pair.kind", "pair.version")
        .join(seen, ["blob", "kind", "version"], "left_anti")
        .groupBy("blob", "place").agg(F.collect_set("kind").alias("kinds"))
    )
    texts = docs.select(F.xxhash64(doc_id).alias("place"), filled(text).alias("text")).withColumn(
        "blob", F.unhex(F.sha2("text", 256)))
    # rows may repeat id and text; they lie together since the join, so nothing moves to drop them
    fresh = texts.join(todo, ["blob", "place"]).dropDuplicates(["blob", "place"])
    found = F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                 F.when(F.array_contains("kinds", r.kind), matches(F.col("text"), r)).alias("spans")) for r in rules])
    (fresh.select("blob", F.inline(F.filter(found, lambda x: x["spans"].isNotNull())))
     .write.mode("append").parquet(ledger))
    return paths


def findings(paths: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, blob`` and an array column of spans for each rule's kind: the ledger joined back to all paths."""
    spark = paths.sparkSession
    rows = spark.read.schema(LEDGER).parquet(ledger)
    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    by_blob = rows.where(current & (F.size("spans") > 0)).groupBy("blob").agg(*[
        F.max(F.when(F.col("kind") == r.kind, F.col("spans"))).alias(r.kind) for r in rules])
    return paths.join(by_blob, "blob", "left").select(
        "doc_id", "blob", *[F.coalesce(r.kind, F.array().cast(SPANS)).alias(r.kind) for r in rules])


def listed(rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans as ``kind:start:end`` by start, then by the order of the rules, joined by commas."""
    def said(rule: Rule, rank: int) -> Column:
        return F.transform(F.col(rule.kind), lambda s: F.struct(
            s["start"], F.lit(rank).alias("rank"),
            F.concat_ws(":", F.lit(rule.kind), s["start"].cast("string"), s["end"].cast("string")).alias("said")))

    rows = F.concat(*[said(rule, rank) for rank, rule in enumerate(rules)])
    return F.concat_ws(",", F.transform(F.array_sort(rows), lambda s: s["said"]))


@query("op10_secret_scan")
def secret_scan(spark, folder):
    ledger = scratch_path(spark, "ledger")
    paths = scan_new(read(spark, folder, "documents"), ledger)
    found = findings(paths, ledger).withColumn("spans", listed())
    return found.select("doc_id", *[F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in RULES],
                        F.sha2("spans", 256).alias("base_sha256"), "spans")
