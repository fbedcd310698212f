"""Aggregate queries and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import relational as rel
from millrace.operators.words import tokens_of, word_count
from millrace.plans.filters import LENGTHS, requests
from millrace.plans.registry import plan
from millrace.session import freeze
from millrace.plans.words import DOC_ALNUM


@plan("SELECT count(*) AS total FROM lineitem")
def count_rows(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("total"))


@plan("SELECT count(DISTINCT l_orderkey) AS orders FROM lineitem")
def count_distinct(t):
    return t.lineitem.agg(F.countDistinct("l_orderkey").alias("orders"))


@plan("SELECT count(DISTINCT l_orderkey) AS orders FROM lineitem")
def count_distinct_sql(t):
    return t.spark.sql("SELECT count(DISTINCT l_orderkey) AS orders FROM {lineitem}", lineitem=t.lineitem)


@plan("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def group_count(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@plan("""SELECT l_returnflag, max(l_extendedprice) AS max_price, min(l_extendedprice) AS min_price,
             round(avg(l_extendedprice), 6) AS avg_price FROM lineitem GROUP BY l_returnflag""")
def group_max_min_avg(t):
    price = "l_extendedprice"
    return t.lineitem.groupBy("l_returnflag").agg(
        F.max(price).alias("max_price"), F.min(price).alias("min_price"), F.round(F.avg(price), 6).alias("avg_price"))


@plan("""SELECT l_returnflag, max(n) AS max_n, min(n) AS min_n, avg(n) AS avg_n
      FROM (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_returnflag""")
def agg_two_level(t):
    return rel.two_level_counts(t.lineitem, outer="l_returnflag", inner="l_orderkey")


@plan("""SELECT l_orderkey, sum(l_quantity) AS total, row_number() OVER (ORDER BY sum(l_quantity) DESC, l_orderkey) AS rank
      FROM lineitem GROUP BY l_orderkey ORDER BY rank LIMIT 10""")
def group_sum_topk(t):
    return rel.top_groups(t.lineitem, "l_orderkey", F.sum("l_quantity").alias("total"))


@plan("""SELECT l_orderkey, count(l_linenumber) AS total, row_number() OVER (ORDER BY count(*) DESC, l_orderkey) AS rank
      FROM lineitem GROUP BY l_orderkey ORDER BY rank LIMIT 10""")
def group_count_topk(t):
    return rel.top_groups(t.lineitem, "l_orderkey", F.count("l_linenumber").alias("total"))


PER_ORDER = "SELECT l_orderkey, l_returnflag, count(l_quantity) AS n FROM {lineitem} GROUP BY l_orderkey, l_returnflag"


@plan("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def group_count_sql(t):
    return t.spark.sql("SELECT l_returnflag, count(*) AS n FROM {lineitem} GROUP BY l_returnflag", lineitem=t.lineitem)


@plan("""SELECT l_returnflag, max(l_extendedprice) AS max_price, min(l_extendedprice) AS min_price,
             round(avg(l_extendedprice), 6) AS avg_price FROM lineitem GROUP BY l_returnflag""")
def group_max_min_avg_sql(t):
    return t.spark.sql("""SELECT l_returnflag, max(l_extendedprice) AS max_price, min(l_extendedprice) AS min_price,
        round(avg(l_extendedprice), 6) AS avg_price FROM {lineitem} GROUP BY l_returnflag""", lineitem=t.lineitem)


@plan("""SELECT l_returnflag, max(n) AS max_n, min(n) AS min_n, avg(n) AS avg_n
      FROM (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_returnflag""")
def agg_two_level_sql(t):
    return t.spark.sql("SELECT l_returnflag, max(n) AS max_n, min(n) AS min_n, avg(n) AS avg_n FROM {per_order} GROUP BY l_returnflag",
                       per_order=t.spark.sql(PER_ORDER, lineitem=t.lineitem))


@plan("""SELECT l_orderkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_orderkey ORDER BY total DESC, l_orderkey LIMIT 10""")
def group_sum_topk_sql(t):
    return t.spark.sql("""SELECT l_orderkey, sum(l_quantity) AS total FROM {lineitem} GROUP BY l_orderkey
        ORDER BY total DESC, l_orderkey LIMIT 10""", lineitem=t.lineitem)


@plan("""SELECT l_orderkey, count(*) AS total FROM lineitem GROUP BY l_orderkey ORDER BY total DESC, l_orderkey LIMIT 10""")
def group_count_topk_sql(t):
    return t.spark.sql("""SELECT l_orderkey, count(l_linenumber) AS total FROM {lineitem} GROUP BY l_orderkey
        ORDER BY total DESC, l_orderkey LIMIT 10""", lineitem=t.lineitem)


@plan("SELECT l_orderkey, count(*) AS count FROM lineitem GROUP BY l_orderkey HAVING count(*) = 5")
def filter_expr_string_sql(t):
    counted = t.lineitem.groupBy("l_orderkey").count()
    return t.spark.sql("SELECT * FROM {counted} WHERE count = 5", counted=counted)


@plan("""SELECT l_partkey, string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY l_orderkey) AS items FROM lineitem GROUP BY l_partkey""")
def group_concat_inverted_index(t):
    return rel.posting_lists(rel.posting_blocks(t.lineitem, "l_partkey", "l_orderkey"), "l_partkey")


@plan("""SELECT l_partkey, count(*) AS n, (count(*) + 6) // 7 AS blocks, min(l_orderkey) AS first, max(l_orderkey) AS last,
             CAST(sum(l_orderkey * (nth % 7 + 1)) AS BIGINT) AS places
      FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey) - 1 AS nth FROM lineitem) GROUP BY l_partkey""")
def inverted_index_directory(t):
    """One row per key over blocks of seven items; ``places`` sums the items by their place in their block."""
    blocks = freeze(rel.posting_blocks(t.lineitem, "l_partkey", "l_orderkey", block=7))
    placed = F.aggregate(F.transform("items", lambda x, i: x * (i + 1)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    sums = blocks.groupBy("l_partkey").agg(F.sum(placed).alias("places"))
    return rel.posting_directory(blocks, "l_partkey").join(sums, "l_partkey").select("l_partkey", "n", "blocks", "first", "last", "places")


@plan("SELECT event_type, count(*) AS number FROM events WHERE event_type <> '' GROUP BY event_type")
def count_per_element(t):
    return rel.count_elements(t.events, "event_type")


@plan("SELECT CAST(user_id AS VARCHAR) AS pageid, count(*) AS rqsts_per_page FROM events GROUP BY user_id")
def count_per_page(t):
    pages = t.events.select(F.col("user_id").cast("string").alias("pageid"))
    return rel.count_elements(pages, "pageid", "rqsts_per_page")


@plan("""SELECT host, count(*) AS number FROM (SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host FROM pages)
      WHERE host <> '' GROUP BY host""")
def count_per_host(t):
    hosts = t.pages.select(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"))
    return rel.count_elements(hosts, "host")


@plan(f"""SELECT format, count(*) AS number FROM ({LENGTHS}) WHERE type = 'view' AND format <> '' GROUP BY format""")
def count_per_format(t):
    images = rel.with_valid_length(requests(t).filter(F.col("type") == "view"), "length_text")
    return rel.count_elements(images, "format")


@plan(f"SELECT type, round(avg(length) / 1024, 6) AS avg_content_length FROM ({LENGTHS}) GROUP BY type")
def mean_per_key(t):
    means = rel.mean_length_kib(rel.with_valid_length(requests(t), "length_text", required=["type"]), "type", "length")
    return means.select("type", F.round("avg_content_length", 6).alias("avg_content_length"))


@plan(f"SELECT round(avg(length), 6) AS mean_length FROM ({LENGTHS})")
def mean_global(t):
    return rel.with_valid_length(requests(t), "length_text").agg(F.round(F.avg("length"), 6).alias("mean_length"))


IS_EN = "lang = 'en'"
NOT_EN = "lang <> 'en'"


def _words_sql(condition: str) -> str:
    return f"SELECT DISTINCT unnest({DOC_ALNUM}) AS word FROM documents WHERE {condition}"


def _words(t, condition: str):
    return tokens_of(t.texts("lang", "text").filter(condition), "text").distinct()


@plan(_words_sql(IS_EN))
def set_distinct(t):
    return _words(t, IS_EN)


@plan(f"{_words_sql(IS_EN)} EXCEPT {_words_sql(NOT_EN)}")
def set_subtract(t):
    return _words(t, IS_EN).subtract(_words(t, NOT_EN))


@plan(f"{_words_sql(IS_EN)} INTERSECT {_words_sql(NOT_EN)}")
def set_intersect(t):
    return _words(t, IS_EN).intersect(_words(t, NOT_EN))


@plan(f"""SELECT word, count(*) AS n FROM (SELECT unnest({DOC_ALNUM}) AS word FROM documents
      UNION ALL SELECT unnest({DOC_ALNUM}) FROM conversations) GROUP BY word""")
def set_union_all(t):
    both = t.texts("text").unionByName(t.conversations.select("text"))
    return word_count(both, "text")
