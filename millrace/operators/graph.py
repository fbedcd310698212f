"""Property graphs as two tables: nodes(id, labels, name, props) and edges(src, dst, type, props).

Pattern queries reduce each target to what the pattern needs (how many edges, or whether there is one)
before joining, so a target with very many edges never yields its pairs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.joins import HotKeys, hot_keys, salted_join
from millrace.session import freeze, scratch_name, scratch_path

PROPS = "map<string,string>"
NODES = f"id string, labels array<string>, name string, props {PROPS}"
EDGES = f"src string, dst string, type string, props {PROPS}"


def _props(values: Mapping[str, Column]) -> Column:
    if not values:
        return F.create_map().cast(PROPS)
    return F.create_map(*[c for k, v in values.items() for c in (F.lit(k), v.cast("string"))])


def nodes_from(df: DataFrame, label: str, id: Column, name: Column, **props: Column) -> DataFrame:
    return df.select(id.cast("string").alias("id"), F.array(F.lit(label)).alias("labels"),
                     name.cast("string").alias("name"), _props(props).alias("props"))


def edges_from(df: DataFrame, type: str, src: Column, dst: Column, **props: Column) -> DataFrame:
    return df.select(src.cast("string").alias("src"), dst.cast("string").alias("dst"),
                     F.lit(type).alias("type"), _props(props).alias("props"))


def add_nodes(nodes: DataFrame, rows: list[tuple]) -> DataFrame:
    """Add literal nodes (id, labels, name, props)."""
    return nodes.unionByName(nodes.sparkSession.createDataFrame(rows, NODES))


def add_edges(edges: DataFrame, rows: list[tuple]) -> DataFrame:
    """Add literal edges (src, dst, type, props)."""
    return edges.unionByName(edges.sparkSession.createDataFrame(rows, EDGES))


def empty_graph(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame([], NODES), spark.createDataFrame([], EDGES)


def ids_with(nodes: DataFrame, label: str) -> DataFrame:
    return nodes.filter(F.array_contains("labels", label)).select("id")


def match_create(nodes: DataFrame, edges: DataFrame, wanted: DataFrame, src_label: str, dst_label: str,
                 type: str) -> DataFrame:
    """Add an edge for each pair of nodes that match a wanted (src_name, dst_name) row; no match adds nothing.

    Matching is two equi-joins on the names, and columns of ``wanted`` beyond the names become properties.
    """
    def named(label: str, id: str, name: str) -> DataFrame:
        return nodes.filter(F.array_contains("labels", label)).select(F.col("id").alias(id), F.col("name").alias(name))

    matched = (wanted.join(named(src_label, "src", "src_name"), "src_name")
               .join(named(dst_label, "dst", "dst_name"), "dst_name"))
    props = {c: F.col(c) for c in wanted.columns if c not in ("src_name", "dst_name")}
    return edges.unionByName(edges_from(matched, type, F.col("src"), F.col("dst"), **props))


def set_property(df: DataFrame, where: Column, key: str, value: str) -> DataFrame:
    """Set one property on the matching nodes or edges, replacing an older value."""
    others = F.map_filter("props", lambda k, _: k != key)
    return df.withColumn("props", F.when(where, F.map_concat(others, F.create_map(F.lit(key), F.lit(value))))
                         .otherwise(F.col("props")))


def add_label(nodes: DataFrame, where: Column, label: str) -> DataFrame:
    return nodes.withColumn("labels", F.when(where, F.array_union("labels", F.array(F.lit(label))))
                            .otherwise(F.col("labels")))


def triples(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """All (node, edge, node) rows."""
    def end(prefix: str, key: str) -> DataFrame:
        return nodes.select(F.col("id").alias(key), F.col("labels").alias(f"{prefix}_labels"),
                            F.col("name").alias(f"{prefix}_name"))

    return edges.join(end("src", "src"), "src").join(end("dst", "dst"), "dst")


def _between(nodes: DataFrame, edges: DataFrame, src_label: str, type: str, dst_label: str) -> tuple[DataFrame, HotKeys]:
    """Edges of one type between nodes of the given labels, as (src, dst, n): parallel edges are counted. And the hot targets."""
    of_type = edges.filter(F.col("type") == type).select("src", "dst")
    hot_src, hot_dst = hot_keys(of_type, ["src"], ["dst"])
    typed = of_type.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    from_src = ids_with(nodes, src_label).withColumnRenamed("id", "src")
    to_dst = ids_with(nodes, dst_label).withColumnRenamed("id", "dst")
    kept = salted_join(typed, from_src, ["src"], "left_semi", F.col("dst"), hot_src)
    return salted_join(kept, to_dst, ["dst"], "left_semi", F.col("src"), hot_dst), hot_dst


def _named(nodes: DataFrame, label: str, found: DataFrame) -> DataFrame:
    """The found nodes; naming their label again spares the nodes of all other labels the join."""
    return nodes.filter(F.array_contains("labels", label)).join(found, "id", "left_semi").select("id", "name")


def co_actors(nodes: DataFrame, edges: DataFrame, label: str, type: str, target: str) -> DataFrame:
    """(a:label)-[:type]->(m:target)<-[:type]-(:label), distinct a.

    The two edges must differ, the two nodes need not: a target with two or more such edges qualifies
    all its sources.
    """
    acting, hot = _between(nodes, edges, label, type, target)
    acting = freeze(acting)  # read twice
    shared = acting.groupBy("dst").agg(F.sum("n").alias("edges")).filter("edges > 1").select("dst")
    found = salted_join(acting, shared, ["dst"], "left_semi", F.col("src"), hot).select(F.col("src").alias("id")).distinct()
    return _named(nodes, label, found)


def directors_of_cast(nodes: DataFrame, edges: DataFrame, director: tuple[str, str], actor: tuple[str, str],
                      target: str) -> DataFrame:
    """(d:director)-[:type]->(m:target)<-[:type]-(:actor), distinct d; each pair is (label, edge type)."""
    directing, hot = _between(nodes, edges, director[0], director[1], target)
    cast = _between(nodes, edges, actor[0], actor[1], target)[0].select("dst").distinct()
    found = salted_join(directing, cast, ["dst"], "left_semi", F.col("src"), hot).select(F.col("src").alias("id")).distinct()
    return _named(nodes, director[0], found)


def detach_delete(nodes: DataFrame, edges: DataFrame, where: Column) -> tuple[DataFrame, DataFrame]:
    """Delete the matching nodes and every edge that touches one."""
    doomed = nodes.filter(where).select("id")
    hot_src, hot_dst = hot_keys(edges, ["src"], ["dst"])
    kept_edges = salted_join(edges, doomed.withColumnRenamed("id", "src"), ["src"], "left_anti", F.col("dst"), hot_src)
    kept_edges = salted_join(kept_edges, doomed.withColumnRenamed("id", "dst"), ["dst"], "left_anti", F.col("src"), hot_dst)
    return nodes.filter(~F.coalesce(where, F.lit(False))), kept_edges.select("src", "dst", "type", "props")


def traverse(edges: DataFrame, start: DataFrame, type: str, max_depth: int = 10) -> DataFrame:
    """Nodes reachable over outgoing edges of one type, each once, with its least depth.

    Breadth-first. The edges are stored in buckets of their source, what was seen in buckets of its id, one partition
    a ring. A round so reads both where they lie and moves only the newest ring and the nodes ahead of it. The source
    of very many edges is salted by their count, and its bucket split as often.
    """
    spark = edges.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    typed = edges.filter(F.col("type") == type).select("src", "dst")
    hot = spark.createDataFrame(hot_keys(typed, ["src"])[0], "_hash long, _salts int")  # a few rows per task
    salts = F.coalesce("_salts", F.lit(1))

    def placed(df: DataFrame, id: str, salt: Column) -> DataFrame:
        known = df.join(F.broadcast(hot), F.xxhash64(id) == F.col("_hash"), "left")
        return known.withColumn("_salt", salt).withColumn("_place", F.xxhash64(id, "_salt"))

    seen, steps = scratch_name("seen"), scratch_name("steps")
    try:
        (placed(typed.distinct(), "src", F.pmod(F.xxhash64("dst"), salts)).select("_place", "src", "dst")
         .repartition(buckets, "_place").write.bucketBy(buckets, "_place").option("path", scratch_path(spark, "steps")).saveAsTable(steps))
        path = scratch_path(spark, "seen")

        def add(ring: DataFrame, depth: int) -> DataFrame:
            """Store the ring and return it."""
            (ring.repartition(buckets, "id").withColumn("depth", F.lit(depth)).write.mode("append").partitionBy("depth")
             .bucketBy(buckets, "id").option("path", path).saveAsTable(seen))
            return spark.table(seen).filter(F.col("depth") == depth).select("id")

        ring = add(start.select("id").distinct(), 0)
        for depth in range(1, max_depth + 1):
            ring = add(_ahead(placed, salts, ring, spark.table(steps), spark.table(seen)), depth)
            if ring.isEmpty():
                break
        return spark.read.schema("id string, depth int").parquet(path)
    finally:
        for name in (seen, steps):
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # the names; the files stay in the scratch folder


def _ahead(placed, salts: Column, ring: DataFrame, steps: DataFrame, seen: DataFrame) -> DataFrame:
    """The unseen nodes one step ahead of a ring."""
    here = placed(ring, "id", F.explode(F.sequence(F.lit(0).cast("bigint"), salts.cast("bigint") - 1))).select("_place", "id")
    # ``between``, because the buckets serve a join on the place alone; a second equal key would shuffle the edges
    next_to = steps.join(here, (steps["_place"] == here["_place"]) & steps.src.between(here.id, here.id)).select(F.col("dst").alias("id"))
    return next_to.distinct().join(seen.select("id"), "id", "left_anti")
