"""Keyed table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.keyed import KeyedTable, newest_per_key
from millrace.plans.registry import plan
from millrace.session import scratch_path


@plan("""SELECT c_custkey, c_name, CASE WHEN o_total IS NULL THEN c_acctbal ELSE o_total END AS c_acctbal,
             CASE WHEN o_total IS NULL THEN 0 ELSE 1 END AS version
      FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS o_total FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey
      UNION ALL SELECT c_custkey + 1000000, c_name, CAST(0 AS DOUBLE), 1 FROM customer WHERE c_acctbal < 0""")
def upsert_by_key(t):
    base = t.customer.select("c_custkey", "c_name", "c_acctbal", F.lit(0).alias("version"))
    best = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("total"))
    changed = base.join(best, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", "c_name", F.col("total").alias("c_acctbal"), F.lit(1).alias("version"))
    added = base.filter("c_acctbal < 0").select(
        (F.col("c_custkey") + 1000000).alias("c_custkey"), "c_name", F.lit(0.0).alias("c_acctbal"),
        F.lit(1).alias("version"))
    table = KeyedTable.create(base, scratch_path(t.spark, "keyed"), ["c_custkey"], "version", buckets=16)
    table.upsert(changed)
    table.upsert(added)
    return table.rows()


@plan("""SELECT c_custkey, c_name, CAST(7 AS DOUBLE) AS c_acctbal, 1 AS version FROM customer WHERE c_custkey = (SELECT max(c_custkey) FROM customer)
      UNION ALL SELECT c_custkey, c_name, c_acctbal, 0 FROM customer WHERE c_custkey < (SELECT max(c_custkey) FROM customer) AND c_acctbal < 0""")
def upsert_and_find(t):
    """A change of one key rewrites one partition; some keys are then looked up."""
    base = t.customer.select("c_custkey", "c_name", "c_acctbal", F.lit(0).alias("version"))
    table = KeyedTable.create(base, scratch_path(t.spark, "keyed"), ["c_custkey"], "version", buckets=16)
    last = base.filter(F.col("c_custkey") == base.agg(F.max("c_custkey")).scalar())
    table.upsert(last.withColumns({"c_acctbal": F.lit(7.0), "version": F.lit(1)}))
    return table.find(base.filter("c_acctbal < 0").select("c_custkey").unionByName(last.select("c_custkey")))


@plan("""SELECT user_id, event_id, event_type, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def last_write_wins(t):
    writes = t.events.select("user_id", "event_id", "event_type", "value")
    return newest_per_key(writes, ["user_id"], "event_id")
