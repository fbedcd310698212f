"""Graph queries: suppliers, parts and customers as nodes, line items and orders as edges; and matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import graph as g
from millrace.operators import matrix as m
from millrace.plans.registry import plan


def _id(prefix: str, key: str):
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def trade_graph(t):
    nodes = (
        g.nodes_from(t.supplier, "Supplier", _id("s:", "s_suppkey"), F.col("s_name"))
        .unionByName(g.nodes_from(t.part, "Part", _id("p:", "p_partkey"), F.col("p_name"), brand=F.col("p_brand")))
        .unionByName(g.nodes_from(t.customer, "Customer", _id("c:", "c_custkey"), F.col("c_name"),
                                  segment=F.col("c_mktsegment")))
    )
    bought = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    edges = (
        g.edges_from(t.lineitem, "SUPPLIES", _id("s:", "l_suppkey"), _id("p:", "l_partkey"), order=F.col("l_orderkey"))
        .unionByName(g.edges_from(bought, "BUYS", _id("c:", "o_custkey"), _id("p:", "l_partkey"), order=F.col("l_orderkey")))
    )
    return nodes, edges


GRAPH = """nodes AS (SELECT 's:' || s_suppkey AS id, 'Supplier' AS label, s_name AS name, NULL AS extra FROM supplier
        UNION ALL SELECT 'p:' || p_partkey, 'Part', p_name, p_brand FROM part
        UNION ALL SELECT 'c:' || c_custkey, 'Customer', c_name, c_mktsegment FROM customer),
      edges AS (SELECT 's:' || l_suppkey AS src, 'p:' || l_partkey AS dst, 'SUPPLIES' AS type, CAST(l_orderkey AS VARCHAR) AS "order" FROM lineitem
        UNION ALL SELECT 'c:' || o_custkey, 'p:' || l_partkey, 'BUYS', CAST(l_orderkey AS VARCHAR)
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@plan(f"""WITH {GRAPH} SELECT src, dst, type, "order" FROM edges""")
def graph_from_tables(t):
    _, edges = trade_graph(t)
    return edges.select("src", "dst", "type", F.col("props")["order"].alias("order"))


@plan(f"WITH {GRAPH} SELECT id, label, name, extra FROM nodes")
def graph_nodes(t):
    nodes, _ = trade_graph(t)
    extra = F.coalesce(F.try_element_at("props", F.lit("brand")), F.try_element_at("props", F.lit("segment")))
    return nodes.select("id", F.col("labels")[0].alias("label"), "name", extra.alias("extra"))


PEOPLE = [("x:1", ["Supplier"], "Keel and Sons", {"city": "Leith"}), ("x:2", ["Part"], "left-handed widget", {})]
LINKS = [("x:1", "x:2", "SUPPLIES", {"role": "maker"}), ("s:1", "x:2", "SUPPLIES", {"role": "agent"})]


@plan(f"""WITH {GRAPH},
      n AS (SELECT id, label, name FROM nodes UNION ALL VALUES ('x:1', 'Supplier', 'Keel and Sons'), ('x:2', 'Part', 'left-handed widget')),
      e AS (SELECT src, dst, type, NULL AS role FROM edges UNION ALL VALUES ('x:1', 'x:2', 'SUPPLIES', 'maker'), ('s:1', 'x:2', 'SUPPLIES', 'agent'))
      SELECT n.label AS label, n.name AS name, e.type AS type, e.role AS role, count(*) AS edges FROM e JOIN n ON e.src = n.id
      GROUP BY n.label, n.name, e.type, e.role""")
def graph_create_literals(t):
    nodes, edges = trade_graph(t)
    nodes, edges = g.add_nodes(nodes, PEOPLE), g.add_edges(edges, LINKS)
    per_source = edges.groupBy("src", "type", F.try_element_at("props", F.lit("role")).alias("role")).agg(
        F.count(F.lit(1)).alias("n"))
    return (per_source.join(nodes.select(F.col("id").alias("src"), F.col("labels")[0].alias("label"), "name"), "src")
            .groupBy("label", "name", "type", "role").agg(F.sum("n").alias("edges")))


@plan(f"""WITH {GRAPH} SELECT a.id AS src, b.id AS dst, o_orderpriority AS priority FROM orders
      JOIN nodes a ON a.label = 'Customer' AND a.name = 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
      JOIN nodes b ON b.label = 'Supplier' AND b.name = 'Supplier#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')""")
def graph_match_create(t):
    nodes, edges = trade_graph(t)
    number = F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    wanted = t.orders.select(F.concat(F.lit("Customer#"), number).alias("src_name"),
                             F.concat(F.lit("Supplier#"), number).alias("dst_name"),
                             F.col("o_orderpriority").alias("priority"))
    created = g.match_create(nodes, edges, wanted, "Customer", "Supplier", "SAME_NUMBER").filter("type = 'SAME_NUMBER'")
    return created.select("src", "dst", F.col("props")["priority"].alias("priority"))


@plan(f"""WITH {GRAPH} SELECT id, CASE WHEN extra = 'Brand#7' THEN 'gold' END AS grade,
             CASE WHEN label = 'Part' THEN extra END AS brand FROM nodes""")
def graph_set_property(t):
    nodes, _ = trade_graph(t)
    brand = F.try_element_at("props", F.lit("brand"))
    graded = g.set_property(nodes, brand == "Brand#7", "grade", "silver")
    graded = g.set_property(graded, brand == "Brand#7", "grade", "gold")
    return graded.select("id", F.try_element_at("props", F.lit("grade")).alias("grade"), brand.alias("brand"))


@plan(f"""WITH {GRAPH} SELECT src, dst, type, CASE WHEN type = 'BUYS' THEN 'paid' END AS state FROM edges""")
def graph_set_edge_property(t):
    _, edges = trade_graph(t)
    paid = g.set_property(edges, F.col("type") == "BUYS", "state", "paid")
    return paid.select("src", "dst", "type", F.try_element_at("props", F.lit("state")).alias("state"))


@plan(f"""WITH {GRAPH} SELECT id, CASE WHEN extra = 'BUILDING' THEN 'Customer,Builder' ELSE label END AS labels FROM nodes""")
def graph_add_label(t):
    nodes, _ = trade_graph(t)
    labelled = g.add_label(nodes, F.try_element_at("props", F.lit("segment")) == "BUILDING", "Builder")
    return labelled.select("id", F.array_join("labels", ",").alias("labels"))


@plan(f"""WITH {GRAPH} SELECT a.name AS src_name, a.label AS src_label, type, b.name AS dst_name, b.label AS dst_label, "order"
      FROM edges JOIN nodes a ON a.id = src JOIN nodes b ON b.id = dst""")
def graph_triples(t):
    found = g.triples(*trade_graph(t))
    return found.select("src_name", F.col("src_labels")[0].alias("src_label"), "type", "dst_name",
                        F.col("dst_labels")[0].alias("dst_label"), F.col("props")["order"].alias("order"))


@plan(f"""WITH {GRAPH}, e AS (SELECT *, row_number() OVER () AS nr FROM edges WHERE type = 'SUPPLIES')
      SELECT DISTINCT n.id AS id, n.name AS name FROM nodes n JOIN e a ON a.src = n.id
      JOIN e b ON a.dst = b.dst AND a.nr <> b.nr""")
def graph_coactors(t):
    return g.co_actors(*trade_graph(t), "Supplier", "SUPPLIES", "Part")


@plan(f"""WITH {GRAPH} SELECT DISTINCT n.id AS id, n.name AS name FROM nodes n JOIN edges d ON d.src = n.id AND d.type = 'SUPPLIES'
      WHERE d.dst IN (SELECT dst FROM edges WHERE type = 'BUYS')""")
def graph_directors_of_cast(t):
    return g.directors_of_cast(*trade_graph(t), ("Supplier", "SUPPLIES"), ("Customer", "BUYS"), "Part")


@plan(f"""WITH {GRAPH}, doomed AS (SELECT id FROM nodes WHERE extra = 'Brand#7')
      SELECT type, count(*) AS edges, count(DISTINCT src) AS sources, count(DISTINCT dst) AS targets FROM edges
      WHERE src NOT IN (SELECT id FROM doomed) AND dst NOT IN (SELECT id FROM doomed) GROUP BY type
      UNION ALL SELECT 'nodes', count(*), 0, 0 FROM nodes WHERE id NOT IN (SELECT id FROM doomed)""")
def graph_detach_delete(t):
    nodes, edges = g.detach_delete(*trade_graph(t), F.try_element_at("props", F.lit("brand")) == "Brand#7")
    left = edges.groupBy("type").agg(F.count(F.lit(1)).alias("edges"), F.countDistinct("src").alias("sources"),
                                     F.countDistinct("dst").alias("targets"))
    none = F.lit(0).cast("bigint")
    return left.unionByName(nodes.agg(F.lit("nodes").alias("type"), F.count(F.lit(1)).alias("edges"),
                                      none.alias("sources"), none.alias("targets")))


@plan("""WITH RECURSIVE e AS (
        SELECT 'r:' || n_regionkey AS src, 'n:' || n_nationkey AS dst FROM nation
        UNION ALL SELECT 'n:' || c_nationkey, 'c:' || c_custkey FROM customer
        UNION ALL SELECT 'c:' || o_custkey, 'o:' || o_orderkey FROM orders
        UNION ALL SELECT 'c:' || c_custkey, 'n:' || c_nationkey FROM customer),
      walk(id, depth) AS (SELECT 'r:1', 0 UNION SELECT dst, depth + 1 FROM walk JOIN e ON e.src = walk.id WHERE depth < 10)
      SELECT id, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY id""")
def graph_bounded_traversal(t):
    def holds(df, a, key_a, b, key_b):
        return g.edges_from(df, "HOLDS", _id(a, key_a), _id(b, key_b))

    edges = (
        holds(t.nation, "r:", "n_regionkey", "n:", "n_nationkey")
        .unionByName(holds(t.customer, "n:", "c_nationkey", "c:", "c_custkey"))
        .unionByName(holds(t.orders, "c:", "o_custkey", "o:", "o_orderkey"))
        .unionByName(holds(t.customer, "c:", "c_custkey", "n:", "c_nationkey"))
    )
    start = t.region.filter("r_regionkey = 1").select(_id("r:", "r_regionkey").alias("id"))
    return g.traverse(edges, start, "HOLDS")


CELLS = """cells AS (SELECT vec_id AS i, CAST(unnest(range(0, len(embedding))) AS BIGINT) AS j,
             CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"""


def _vectors(t):
    return m.from_vectors(t.embeddings, "vec_id", "embedding")


@plan(f"WITH {CELLS} SELECT j AS i, i AS j, v FROM cells")
def matrix_transpose(t):
    return m.transpose(_vectors(t))


@plan(f"""WITH {CELLS}, means AS (SELECT j AS k, CAST(label AS BIGINT) AS j, avg(v) AS v
             FROM cells JOIN embeddings ON vec_id = i GROUP BY ALL)
      SELECT a.i AS i, b.j AS j, round(sum(a.v * b.v), 9) AS v FROM cells a JOIN means b ON a.j = b.k GROUP BY a.i, b.j""")
def matrix_multiply(t):
    vectors = _vectors(t)
    labelled = t.embeddings.select("label", F.posexplode("embedding").alias("i", "v"))
    means = labelled.groupBy(F.col("i").cast("bigint").alias("i"), F.col("label").cast("bigint").alias("j")).agg(
        F.avg(F.col("v").cast("double")).alias("v"))
    return m.multiply(vectors, means).withColumn("v", F.round("v", 9))


@plan(f"""WITH {CELLS} SELECT a.j AS i, b.j AS j, round(sum(a.v * b.v), 9) AS v FROM cells a JOIN cells b ON a.i = b.i
      GROUP BY a.j, b.j""")
def matrix_gram(t):
    return m.gram(t.embeddings, "embedding").withColumn("v", F.round("v", 9))


@plan(f"WITH {CELLS} SELECT max(i) + 1 AS rows, max(j) + 1 AS cols FROM cells")
def matrix_dims(t):
    return m.dims(_vectors(t))
