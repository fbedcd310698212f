"""Chart dataset queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import charts as ch
from millrace.operators.ordered import global_rank
from millrace.plans.registry import plan
from millrace.plans.statistics import rounded


@plan("""WITH s AS (SELECT p_brand, count(*) AS number FROM part GROUP BY p_brand),
      c AS (SELECT *, sum(number) OVER (ORDER BY number, p_brand ROWS UNBOUNDED PRECEDING) AS upto,
                   sum(number) OVER () AS total FROM s)
      SELECT p_brand, number, round((upto - number) * (2 * pi() / total), 9) AS start_angle,
             round(upto * (2 * pi() / total), 9) AS end_angle FROM c""")
def pie_angles(t):
    slices = t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("number"))
    return rounded(ch.pie_angles(slices, "number", [F.asc("number"), F.asc("p_brand")]), 9, "start_angle", "end_angle")


@plan("""WITH s AS (SELECT c_custkey, r_name AS region, c_acctbal + 1000 AS population FROM customer
                 JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
      c AS (SELECT *, sum(population) OVER (ORDER BY region, c_custkey ROWS UNBOUNDED PRECEDING) AS upto,
                   sum(population) OVER () AS total FROM s)
      SELECT c_custkey, region, round((upto - population) * (2 * pi() / total), 6) AS start_angle,
             round(upto * (2 * pi() / total), 6) AS end_angle FROM c""")
def pie_angles_by_region(t):
    placed = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    slices = placed.select("c_custkey", F.col("r_name").alias("region"), (F.col("c_acctbal") + 1000).alias("population"))
    angles = ch.pie_angles(slices, "population", [F.asc("region"), F.asc("c_custkey")])
    return rounded(angles.drop("population"), 6, "start_angle", "end_angle")


@plan("""WITH m AS (SELECT event_type, avg(value) AS mean FROM events GROUP BY event_type)
      SELECT event_type, round(mean, 9) AS mean, CAST(0 AS DOUBLE) AS domain_low,
             round((SELECT max(mean) FROM m), 9) AS domain_high FROM m""")
def bar_domain(t):
    means = t.events.groupBy("event_type").agg(F.avg("value").alias("mean"))
    return rounded(ch.bar_domain(means, "event_type", "mean"), 9, "mean", "domain_high")


@plan("""SELECT c_custkey, c_mktsegment, round((log10(income) - log10(300)) / (5 - log10(300)) * CAST(870.5 AS DOUBLE), 6) AS cx,
             round(461 + (nation - 10) * CAST(-6.1466666666666665 AS DOUBLE), 6) AS cy,
             round(sqrt(population / CAST(5e8 AS DOUBLE)) * 40, 6) AS r,
             row_number() OVER (ORDER BY population DESC, c_custkey) AS rank
      FROM (SELECT c_custkey, c_mktsegment, c_acctbal + 2000 AS income, CAST(c_nationkey AS DOUBLE) AS nation,
                   (c_acctbal + 2000) * 10000 AS population FROM customer)""")
def bubble_dataset(t):
    income = F.col("c_acctbal") + 2000
    people = t.customer.select("c_custkey", "c_mktsegment", income.alias("income"),
                               F.col("c_nationkey").cast("double").alias("nation"),
                               (income * 10000).alias("population"))
    placed = ch.bubbles(people, "income", "nation", "population", ["c_custkey", "c_mktsegment", "population"])
    ordered = global_rank(placed, [F.desc("population"), F.asc("c_custkey")])
    return rounded(ordered.drop("population"), 6, "cx", "cy", "r")


@plan("""SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
      GROUP BY l_returnflag, l_linestatus""")
def rollup_rows(t):
    counted = ch.rollup_rows(t.lineitem, ["l_returnflag", "l_linestatus"],
                             F.struct(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")).alias("v"))
    return counted.select("l_returnflag", "l_linestatus", "v.n", "v.quantity")


@plan("""WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, l_linenumber AS c, struct_pack(n := count(*),
                    quantity := CAST(sum(l_quantity) AS BIGINT)) AS v FROM lineitem GROUP BY ALL),
      l AS (SELECT a, b, list(struct_pack("key" := c, "values" := v) ORDER BY c) AS v FROM c GROUP BY a, b)
      SELECT a AS "key", len(list(b)) AS n, CAST(to_json(list(struct_pack("key" := b, "values" := v) ORDER BY b)) AS VARCHAR) AS entries
      FROM l GROUP BY a""")
def nest_rollup(t):
    """Three levels, each a sorted list inside the one above, written as JSON."""
    totals = F.struct(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))
    nested = ch.nest_rollup(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"], totals)
    return nested.select("key", F.size("values").cast("bigint").alias("n"), F.to_json("values").alias("entries"))


@plan("""WITH c AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS x, event_type AS series, count(*) AS y FROM events GROUP BY ALL)
      SELECT strftime(x, '%Y-%m-%d') AS x, series, y,
             CAST(coalesce(sum(y) OVER (PARTITION BY x ORDER BY series ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS y0
      FROM c""")
def stack_offsets(t):
    cells = t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("x"), F.col("event_type").alias("series")).agg(
        F.count(F.lit(1)).alias("y"))
    return ch.stack_offsets(cells, "x", "series", "y")


@plan("""SELECT r_name, n_name, c_custkey, CAST((r_name IS NOT NULL)::INT + (n_name IS NOT NULL)::INT + (c_custkey IS NOT NULL)::INT AS INTEGER) AS depth,
             round(sum(c_acctbal), 2) AS value
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      GROUP BY ROLLUP (r_name, n_name, c_custkey)""")
def hierarchy_values(t):
    leaves = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    return rounded(ch.hierarchy_values(leaves, ["r_name", "n_name", "c_custkey"], "c_acctbal"), 2, "value")


LINKED = """links AS (SELECT 'r:' || r_regionkey AS id, NULL AS parent, CAST(0 AS DOUBLE) AS v FROM region
        UNION ALL SELECT 'n:' || n_nationkey, 'r:' || n_regionkey, 0 FROM nation
        UNION ALL SELECT 'c:' || c_custkey, 'n:' || c_nationkey, c_acctbal FROM customer
        UNION ALL SELECT 'o:' || o_orderkey, 'c:' || o_custkey, o_totalprice FROM orders
        UNION ALL SELECT 'x:' || p_partkey, 'x:' || CASE WHEN p_partkey <= 2 THEN 3 - p_partkey ELSE p_partkey // 2 END, 1 FROM part)"""


@plan(f"""WITH RECURSIVE {LINKED},
      up(id, anc, steps) AS (SELECT id, id, 0 FROM links WHERE id NOT LIKE 'x:%'
        UNION ALL SELECT up.id, parent, steps + 1 FROM up JOIN links ON links.id = up.anc WHERE parent IS NOT NULL)
      SELECT links.id AS id, parent, CASE WHEN links.id NOT LIKE 'x:%' THEN CAST(depth AS INTEGER) END AS depth, round(total, 2) AS value
      FROM links LEFT JOIN (SELECT id, max(steps) AS depth FROM up GROUP BY id) d ON d.id = links.id
      LEFT JOIN (SELECT up.anc AS id, sum(v) AS total FROM up JOIN links ON links.id = up.id GROUP BY up.anc) s ON s.id = links.id""")
def hierarchy_from_links(t):
    """Regions, nations, customers and orders by parent links, and parts that all hang below a cycle of two."""
    def link(df, prefix, key, above, parent, value):
        to = F.concat(F.lit(above), parent.cast("string")) if above else F.lit(None).cast("string")
        return df.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"), to.alias("parent"), value.cast("double").alias("v"))

    zero, key = F.lit(0), F.col("p_partkey")
    loop = F.when(key <= 2, 3 - key).otherwise(F.floor(key / 2))
    links = (
        link(t.region, "r:", "r_regionkey", "", zero, zero)
        .unionByName(link(t.nation, "n:", "n_nationkey", "r:", F.col("n_regionkey"), zero))
        .unionByName(link(t.customer, "c:", "c_custkey", "n:", F.col("c_nationkey"), F.col("c_acctbal")))
        .unionByName(link(t.orders, "o:", "o_orderkey", "c:", F.col("o_custkey"), F.col("o_totalprice")))
        .unionByName(link(t.part, "x:", "p_partkey", "x:", loop, F.lit(1)))
    )
    return rounded(ch.hierarchy_from_links(links, "id", "parent", "v"), 2, "value")
