"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.base import SPACE, filled, query, read, stripped
from millrace.session import freeze

#: Bins of the seeded order in which a source's rows are taken; only the rows of one bin are sorted together.
BINS = 4096


def word_count(text: str) -> Column:
    """Words of a text (null: none). The white space at the end and the start makes no word."""
    trimmed = stripped(filled(text))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, f"{SPACE}+"))).cast("long")


def targets(sizes: DataFrame, weight: Column, share: Column, epochs: int) -> DataFrame:
    """Water-filling over ``sizes`` (``source, source_size``): adds ``weight`` and ``target``.

    ``share`` of all sizes is dealt by weight, no source above ``epochs`` times its size, and what a full source
    cannot take goes to the others by weight. In order of size per weight the full sources come first, so the level
    at which the rest stand follows from running sums; there is one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    level = (F.col("budget") - (F.sum("cap").over(fill) - F.col("cap"))) / (
        F.sum("weight").over(every) - F.sum("weight").over(fill) + F.col("weight"))
    ranked = (
        sizes.withColumn("nth", F.row_number().over(order))
        .withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs)
        .withColumn("budget", F.sum("source_size").over(every) * share)
        .withColumn("level", level)
        .withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
        .withColumn("water", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(every))
    )
    full = F.col("water").isNull() | (F.col("water.level") * F.col("weight") >= F.col("cap"))
    return ranked.select("source", "source_size", "weight", F.when(full, F.col("cap").cast("double")).otherwise(
        F.col("water.level") * F.col("weight")).alias("target"))


def mix(rows: DataFrame, goals: DataFrame, seed: int, bins: int = BINS) -> DataFrame:
    """Add ``target``, ``repeats`` and ``taken`` to ``rows`` (``doc_id, source, size``).

    Every row is taken ``floor(target / source_size)`` whole times. The remaining words of a source are taken from
    its rows in a seeded order, once more each, up to the row that comes nearest. The order is the MD5 of seed and
    id, so reruns agree. Sums per source and bin of that order give the bin in which the words run out; only the
    rows of that bin are sorted, so a hot source is never in one task. Rows of size 0 are taken like the others.
    """
    said = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    first = F.conv(F.substring("turn", 1, 8), 16, 10).cast("long")
    keyed = rows.withColumn("turn", said).withColumn("bin", F.floor(first * bins / (1 << 32)).cast("int"))
    run = Window.partitionBy("s").orderBy("bin")
    source = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    keyed = keyed.withColumn("s", source).drop("source")
    wanted = goals.select(source.alias("s"), "target", F.col("source_size"))
    wanted = wanted.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                               .otherwise(0).cast("long"))
    wanted = wanted.withColumn("more", F.col("target") - F.col("whole") * F.col("source_size"))
    filled_bins = (
        keyed.groupBy("s", "bin").agg(F.sum("size").alias("bin_size"))
        .withColumn("upto", F.sum("bin_size").over(run))
        .join(wanted, "s")
        .select("s", "bin", "target", "source_size", "whole", "more", (F.col("upto") - F.col("bin_size")).alias("before"),
                "upto")
    )
    # 0: no row of the bin once more, 2: all of them, 1: up to the row that comes nearest
    state = F.when(F.col("upto") <= F.col("more"), 2).when(F.col("before") > F.col("more"), 0).otherwise(1)
    dealt = keyed.join(filled_bins.withColumn("state", state), ["s", "bin"])
    inside = Window.partitionBy("s", "bin").orderBy("turn", "doc_id", "size")
    last = dealt.where("state = 1").withColumn(
        "once", F.col("before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        - F.col("size") / 2 <= F.col("more"))
    rest = dealt.where("state != 1").withColumn("once", F.col("state") == 2)
    kept = [c for c in rows.columns if c != "source"]
    return rest.unionByName(last).select(
        *kept, F.when(~F.col("s.none"), F.col("s.name")).alias("source"), "source_size", "target",
        (F.col("whole") + F.col("once").cast("long")).alias("repeats"),
        ((F.col("whole") + F.col("once").cast("long")) * F.col("size")).alias("taken"))


#: Fixed values of the query: weights in turn, and the mix as a share of all words.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = 7


def weigh_in_turn() -> Column:
    return F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("nth") - 1) % len(WEIGHTS) + 1).cast("long")


def mixed(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, repeats, taken`` of each row of ``docs``.

    A null text has no words, null is a source of its own, repeated rows are rows of their own, and an empty table
    gives no rows. Other columns are not read.
    """
    rows = freeze(docs.select("doc_id", "source", word_count("text").alias("size")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = freeze(targets(sizes, weigh_in_turn(), F.lit(SHARE), EPOCHS))
    return mix(rows, goals, SEED)


def repeat(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as it takes them, with their columns."""
    names = docs.columns
    # The seeded choice depends on the row's id and source; rows that repeat both and differ in size keep their own.
    choice = mixed(docs).groupBy("doc_id", "source", "size").agg(F.max("repeats").alias("__n")).select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), "__n")
    counted = docs.withColumn("__words", word_count("text"))
    return (
        counted.join(choice, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
                     & (F.col("__words") == F.col("__size")))
        .where("__n > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))))
        .select(*names)
    )


@query("op7_mixing", sql=r"""
    WITH rows AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
               md5('7:' || coalesce(doc_id::VARCHAR, '')) AS turn
        FROM documents),
    sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
    weighed AS (
        SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
                  WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
               source_size * 2 AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5 AS budget FROM sources),
    levels AS (
        SELECT *, (budget - ((sum(cap) OVER f)::BIGINT - cap)::DOUBLE)
                  / ((sum(weight) OVER ())::BIGINT - (sum(weight) OVER f)::BIGINT + weight)::DOUBLE AS level
        FROM weighed
        WINDOW f AS (ORDER BY cap::DOUBLE / weight, source IS NULL, source)),
    water AS (SELECT level FROM levels WHERE level * weight < cap ORDER BY cap::DOUBLE / weight, level LIMIT 1),
    goals AS (
        SELECT source, source_size,
               CASE WHEN (SELECT level FROM water) IS NULL OR (SELECT level FROM water) * weight >= cap
                    THEN cap::DOUBLE ELSE (SELECT level FROM water) * weight END AS target
        FROM levels),
    whole AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM goals),
    runs AS (
        SELECT r.doc_id, r.source, r.size, w.source_size, w.target, w.whole,
               w.target - (w.whole * w.source_size)::DOUBLE AS more, r.turn,
               (sum(r.size) OVER (PARTITION BY r.source ORDER BY r.turn, r.doc_id, r.size
                                  ROWS UNBOUNDED PRECEDING))::DOUBLE AS upto
        FROM rows r JOIN whole w ON r.source IS NOT DISTINCT FROM w.source)
    SELECT doc_id, source, size, source_size, target,
           whole + (upto - size / 2.0 <= more)::BIGINT AS repeats,
           (whole + (upto - size / 2.0 <= more)::BIGINT) * size AS taken
    FROM runs""")
def mixing(spark, folder):
    return mixed(read(spark, folder, "documents"))
