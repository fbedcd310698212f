"""Order, limit and partition-local sort queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalars import route
from millrace.operators.ordered import rank_top
from millrace.plans.registry import plan


@plan("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
             row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank
      FROM lineitem ORDER BY rank LIMIT 20""")
def order_by_limit(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    return rank_top(rows, order, 20)


@plan("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def sort_within_partitions(t):
    """Sorted inside each partition only, as SORT BY does: no row moves, and the order of partitions carries no meaning."""
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").sortWithinPartitions(F.desc("o_totalprice"))


@plan()
def limit_unordered(t):
    return t.customer.select("c_custkey", "c_name").limit(10)


@plan("SELECT least(count(*), 10) AS n, least(count(*), 10) AS known FROM customer")
def limit_unordered_rows(t):
    """Which rows a bare limit keeps is open, but not how many, nor that they are rows of the table."""
    some = limit_unordered(t)
    found = some.join(t.customer.select("c_custkey", "c_name"), ["c_custkey", "c_name"], "left_semi")
    return some.agg(F.count(F.lit(1)).alias("n")).withColumn("known", found.agg(F.count(F.lit(1))).scalar())


@plan("""SELECT CASE WHEN user_id > 0 THEN user_id % 8 ELSE 0 END AS partition, count(*) AS n,
             count(DISTINCT user_id) AS keys FROM events GROUP BY 1""")
def partition_route(t):
    routed = t.events.withColumn("partition", route(F.col("user_id"), 8))
    return routed.groupBy("partition").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("keys"))


@plan("""SELECT CASE WHEN user_id > 0 THEN user_id % 8 ELSE 0 END AS partition,
             CASE WHEN user_id > 0 THEN user_id % 8 ELSE 0 END AS task, count(*) AS n FROM events GROUP BY 1, 2""")
def partition_route_layout(t):
    """The same rule as a physical layout: the task that holds a row is the row's partition number."""
    routed = t.events.withColumn("partition", route(F.col("user_id"), 8))
    placed = routed.repartitionById(8, F.col("partition").cast("int"))
    placed = placed.withColumn("task", F.spark_partition_id().cast("bigint"))
    return placed.groupBy("partition", "task").agg(F.count(F.lit(1)).alias("n"))
