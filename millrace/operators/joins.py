"""Joins: vocabularies, participants, lookups and lexicons.

Every side that can be reduced first is: a semi-join needs each key once, a count needs no pairs. What is
left joins many rows to one row per key. Where an aggregate on the same key follows, the hot keys are found by
a sketch and salted by their own counts; where none follows, AQE splits a hot partition by itself.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import same_keys


#: Items that the sketch of frequent keys tracks; keys are salted one by one up to a tenth of them.
TRACKED = 10_000


HotKeys = list[tuple[int, int]]


def hot_keys(rows: DataFrame, *key_sets: Sequence[str]) -> list[HotKeys]:
    """``hash, salts`` of the keys of ``rows`` that exceed half of a task's even share, for each set of key columns.

    A mergeable sketch of frequent items counts the keys' hashes, for all sets in one pass; its memory is fixed, and
    counts are never too low. A key gets as many salts as it has half shares, so all salts of a set are at most two
    per task.
    """
    items = rows.select(*[F.xxhash64(*keys).alias(f"item{i}") for i, keys in enumerate(key_sets)])
    sketches = [F.expr(f"approx_top_k(item{i}, {TRACKED // 10}, {TRACKED})") for i in range(len(key_sets))]
    *found, total = items.agg(*sketches, F.count(F.lit(1))).first()
    share = max(total / (2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), 1.0)
    return [[(top["item"], math.ceil(top["count"] / share)) for top in tops if top["count"] > share] for tops in found]


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, salt_by: Column,
                hot: HotKeys | None = None) -> DataFrame:
    """Join rows whose keys may be hot to a table with one row per key; NULL keys match each other.

    The rows of a hot key go to as many tasks as its count asks for, by a hash of another column, and only its one
    row on the right is copied. Cold keys are not salted and nothing is copied for them. ``hot`` are the ``hot_keys``
    of ``left``, or of rows that are cheaper to count and hold each of its keys at least as often.
    """
    hot = hot_keys(left, keys)[0] if hot is None else hot
    a, b, matched = left.alias("a"), right.alias("b"), same_keys(keys)
    if hot:
        table = F.broadcast(left.sparkSession.createDataFrame(hot, "_hash long, _salts int"))  # at most TRACKED / 10 rows
        salts = F.coalesce("_salts", F.lit(1))
        a = left.join(table, F.xxhash64(*keys) == F.col("_hash"), "left").withColumn("_salt", F.pmod(F.xxhash64(salt_by), salts)).alias("a")
        b = right.join(table, F.xxhash64(*keys) == F.col("_hash"), "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts.cast("bigint") - 1))).alias("b")
        matched = (F.col("a._salt") == F.col("b._salt")) & matched
    joined = a.join(b, matched, how)
    if how in ("left_semi", "left_anti"):
        return joined.select(*[F.col(f"a.{c}") for c in left.columns])
    added = [F.col(f"b.{c}") for c in right.columns if c not in keys]
    return joined.select(*[F.col(f"a.{c}") for c in left.columns], *added)


def merge_vocabularies(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join of two (word, n) tables: word, left_n, right_n, NULL where a side lacks the word."""
    a, b = left.alias("a"), right.alias("b")
    return a.join(b, F.col("a.word") == F.col("b.word"), "full").select(
        F.coalesce("a.word", "b.word").alias("word"), F.col("a.n").alias("left_n"), F.col("b.n").alias("right_n")
    )


def only_in_left(left: DataFrame, right: DataFrame) -> DataFrame:
    """Words of the left table alone, as a left outer join that keeps the unmatched rows."""
    a, b = left.alias("a"), right.alias("b")
    joined = a.join(b, F.col("a.word") == F.col("b.word"), "left")
    return joined.filter(F.col("b.word").isNull()).select("a.word", "a.n")


def only_in_right(left: DataFrame, right: DataFrame) -> DataFrame:
    """Words of the right table alone, as a right outer join that keeps the unmatched rows."""
    a, b = left.alias("a"), right.alias("b")
    joined = a.join(b, F.col("a.word") == F.col("b.word"), "right")
    return joined.filter(F.col("a.word").isNull()).select("b.word", "b.n")


def co_participants(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Sources that share a target with another source.

    A shared target is one whose smallest and largest source differ. That needs one combined row per
    target, where a self-join would make every pair of a popular target.
    """
    links = edges.select(src, dst).distinct()
    shared = (
        edges.groupBy(dst).agg(F.min(src).alias("_lo"), F.max(src).alias("_hi"))
        .filter(F.col("_lo") != F.col("_hi")).select(dst)
    )
    return salted_join(links, shared, [dst], "left_semi", F.col(src), hot_keys(edges, [dst])[0]).select(src).distinct()


def reaching_targets_of(edges: DataFrame, src: str, dst: str, others: DataFrame, other_dst: str) -> DataFrame:
    """Distinct sources with an edge to a target that also has an edge in ``others``."""
    links = edges.select(src, dst).distinct()
    targets = others.select(F.col(other_dst).alias(dst)).distinct()
    return salted_join(links, targets, [dst], "left_semi", F.col(src), hot_keys(edges, [dst])[0]).select(src).distinct()


def double_lookup(links: DataFrame, src_key: str, dst_key: str, src: DataFrame, dst: DataFrame,
                  src_match: str, dst_match: str) -> DataFrame:
    """Replace both names of a link by ids: two inner joins, so unknown names drop and repeated names multiply.

    ``src`` and ``dst`` are (id, name) tables; the link keeps its other columns.
    """
    a = src.select(F.col(src.columns[0]).alias("src"), F.col(src_match).alias(src_key))
    b = dst.select(F.col(dst.columns[0]).alias("dst"), F.col(dst_match).alias(dst_key))
    rest = [c for c in links.columns if c not in (src_key, dst_key)]
    return links.join(a, src_key).join(b, dst_key).select("src", "dst", *rest)


def lemmas_of(senses: DataFrame, lemmas: DataFrame) -> DataFrame:
    """word -> sense -> lemma, from ``senses(word, sense)`` and ``lemmas(sense, lemma)``."""
    return senses.join(lemmas, "sense").select("word", "sense", "lemma")


def hyponyms_of(senses: DataFrame, children: DataFrame, lemmas: DataFrame) -> DataFrame:
    """word -> sense -> direct child sense -> lemma, with ``children(sense, child)``."""
    below = children.join(lemmas.withColumnRenamed("sense", "child"), "child")
    return senses.join(below, "sense").select("word", "sense", "child", "lemma")


def lexicon_totals(senses: DataFrame, children: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Lemmas over all senses of a word and lemmas over all direct child senses, 0 when there are none.

    Lemmas are counted per sense before they meet the words, so no word x lemma rows are made.
    """
    per_sense = lemmas.groupBy("sense").agg(F.count("lemma").alias("own"))
    below = (
        children.join(per_sense.select(F.col("sense").alias("child"), F.col("own").alias("below")), "child")
        .groupBy("sense").agg(F.sum("below").alias("below"))
    )
    return (
        senses.join(per_sense, "sense", "left").join(below, "sense", "left").groupBy("word")
        .agg(F.coalesce(F.sum("own"), F.lit(0)).alias("lemmas"), F.coalesce(F.sum("below"), F.lit(0)).alias("hyponyms"))
    )
