"""Model queries: line item quantity against price, part categories."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import charts as ch
from millrace.operators import learning as ml
from millrace.operators import stats
from millrace.plans.registry import plan
from millrace.session import freeze

INDEXED = """indexed AS (SELECT p_partkey, p_size, p_retailprice, dense_rank() OVER (ORDER BY p_brand) - 1 AS b,
             dense_rank() OVER (ORDER BY p_type) - 1 AS c,
             (SELECT count(DISTINCT p_brand) FROM part) AS nb, (SELECT count(DISTINCT p_type) FROM part) AS nc FROM part)"""


@plan("SELECT p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand_index FROM (SELECT DISTINCT p_brand FROM part)")
def ml_category_index(t):
    return ml.category_index(t.part, "p_brand")


@plan(f"""WITH {INDEXED} SELECT p_partkey, CAST(nb + nc AS INTEGER) AS size, CAST(b AS INTEGER) AS first_one, CAST(nb + c AS INTEGER) AS second_one,
      CAST(2 AS DOUBLE) AS ones FROM indexed""")
def ml_one_hot(t):
    """Both categories as sparse columns of 0 and 1 side by side: the places of the ones, never the zeros."""
    coded = ml.code_columns(t.part.select("p_partkey", "p_brand", "p_type"), ["p_brand", "p_type"], [])
    ones = F.aggregate("x", F.lit(0.0), lambda total, c: total + c["x"])
    return coded.rows.select("p_partkey", F.lit(coded.width).cast("int").alias("size"), F.col("x")[0]["i"].cast("int").alias("first_one"),
                             F.col("x")[1]["i"].cast("int").alias("second_one"), ones.alias("ones"))


@plan(f"""WITH {INDEXED} SELECT p_partkey, CAST(nb + nc AS INTEGER) AS size, CAST(b AS INTEGER) AS first_one, CAST(nb + c AS INTEGER) AS second_one,
      CAST(2 AS DOUBLE) AS ones FROM indexed""")
def ml_one_hot_vectors(t):
    """The same as assembled vectors, expanded here so that every cell is looked at."""
    encoded, _ = ml.one_hot(t.part, ["p_brand", "p_type"])
    vector = ml.assemble(encoded, ["p_brand_vec", "p_type_vec"], "hot")
    cells = vector.select("p_partkey", vector_to_array("hot").alias("a"))
    first = F.array_position("a", 1.0).cast("int")
    later = F.array_position(F.slice("a", first + 1, F.size("a") - first), 1.0).cast("int")
    return cells.select("p_partkey", F.size("a").alias("size"), (first - 1).alias("first_one"),
                        (first + later - 1).alias("second_one"),
                        F.aggregate("a", F.lit(0.0), lambda s, v: s + v).alias("ones"))


@plan(f"WITH {INDEXED} SELECT p_partkey, CAST(b AS DOUBLE) AS f0, CAST(c AS DOUBLE) AS f1, CAST(p_size AS DOUBLE) AS f2 FROM indexed")
def ml_index_features(t):
    rows = ml.assemble(ml.with_indices(t.part, ["p_brand", "p_type"]), ["p_brand_index", "p_type_index", "p_size"])
    cells = rows.select("p_partkey", vector_to_array("features").alias("f"))
    return cells.select("p_partkey", *[F.col("f")[i].alias(f"f{i}") for i in range(3)])


@plan("""SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_discount AS f1, l_tax AS f2, l_extendedprice AS label FROM lineitem""")
def ml_assemble(t):
    rows = ml.assemble(t.lineitem, ["l_quantity", "l_discount", "l_tax"])
    cells = rows.select("l_orderkey", "l_linenumber", vector_to_array("features").alias("f"),
                        F.col("l_extendedprice").alias("label"))
    return cells.select("l_orderkey", "l_linenumber", *[F.col("f")[i].alias(f"f{i}") for i in range(3)], "label")


PART_OF = "CASE WHEN ('0x' || substr(md5('42:' || {k}), 1, 8))::BIGINT / CAST(4294967296 AS DOUBLE) < 0.9 THEN 'train' ELSE 'test' END"
LINE = "(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR))"
SPLIT = f"split AS (SELECT *, {PART_OF.format(k=LINE)} AS part FROM lineitem)"


def _split(t):
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice",
                             "l_returnflag", "l_linestatus", ml.split_label(key).alias("part"))


@plan(f"WITH {SPLIT} SELECT l_orderkey, l_linenumber, part FROM split")
def ml_random_split(t):
    return _split(t).select("l_orderkey", "l_linenumber", "part")


def _descent(condition: str) -> str:
    return f"""s AS (SELECT sum(l_quantity * l_quantity) AS xx, sum(l_quantity * l_extendedprice) AS xy, CAST(count(*) AS DOUBLE) AS n
             FROM split WHERE {condition}),
      d(i, w, done) AS (SELECT 0, CAST(0 AS DOUBLE), false
        UNION ALL SELECT i + 1, nw, i > 0 AND abs(nw - w) < CAST(0.001 AS DOUBLE) * greatest(abs(nw), 1)
        FROM (SELECT i, w, done, w - CAST(0.0005 AS DOUBLE) / sqrt(i + 1) * (xx * w - xy) / n AS nw FROM d, s) WHERE NOT done AND i < 100)"""


@plan(f"WITH RECURSIVE {SPLIT}, {_descent('true')} SELECT round(w, 4) AS slope, i AS iterations FROM d ORDER BY i DESC LIMIT 1")
def ml_linear_sgd(t):
    (slope,), rounds = ml.linear_sgd(t.lineitem, ["l_quantity"], "l_extendedprice", step=0.0005)
    return t.spark.range(1).select(F.round(F.lit(slope), 4).alias("slope"), F.lit(rounds).alias("iterations"))


@plan("SELECT round(sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity), 4) AS slope FROM lineitem")
def ml_linear_fit(t):
    (slope,) = ml.linear_fit(t.lineitem, ["l_quantity"], "l_extendedprice")
    return t.spark.range(1).select(F.round(F.lit(slope), 4).alias("slope"))


@plan(f"""WITH RECURSIVE {SPLIT}, {_descent("part = 'train'")}, m AS (SELECT w FROM d ORDER BY i DESC LIMIT 1)
      SELECT l_orderkey, l_linenumber, l_extendedprice AS actual, round(l_quantity * w, 3) AS predicted FROM split, m
      WHERE part = 'test'""")
def ml_predict_pairs(t):
    rows = _split(t)
    weights, _ = ml.linear_sgd(rows.filter("part = 'train'"), ["l_quantity"], "l_extendedprice", step=0.0005)
    return rows.filter("part = 'test'").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("actual"),
        F.round(ml.predict_linear(["l_quantity"], weights), 3).alias("predicted"))


@plan(f"""WITH RECURSIVE {SPLIT}, {_descent("part = 'train'")}, m AS (SELECT w FROM d ORDER BY i DESC LIMIT 1),
      p AS (SELECT l_extendedprice AS a, l_quantity * w AS p FROM split, m WHERE part = 'test')
      SELECT round(avg((p - a) * (p - a)), 0) AS mse, round(avg(abs(p - a)), 2) AS mae,
             round(sqrt(avg((ln(p + 1) - ln(a + 1)) * (ln(p + 1) - ln(a + 1)))), 6) AS rmsle FROM p""")
def ml_linear_errors(t):
    rows = _split(t)
    weights, _ = ml.linear_sgd(rows.filter("part = 'train'"), ["l_quantity"], "l_extendedprice", step=0.0005)
    pairs = rows.filter("part = 'test'").withColumn("predicted", ml.predict_linear(["l_quantity"], weights))
    errors = stats.regression_errors(pairs, "l_extendedprice", "predicted")
    return errors.select(F.round("mse", 0).alias("mse"), F.round("mae", 2).alias("mae"), F.round("rmsle", 6).alias("rmsle"))


def _coded_descent(cells: str, step: str) -> str:
    """Gradient descent over sparse columns in SQL, from ``cells`` (r, i, x, y, part) and ``dims`` (width)."""
    return f"""cells AS ({cells}),
      train AS (SELECT * FROM cells WHERE part = 'train'),
      n AS (SELECT CAST(count(DISTINCT r) AS DOUBLE) AS n FROM train),
      g AS (SELECT a.i AS i, b.i AS j, sum(a.x * b.x) AS v FROM train a JOIN train b ON a.r = b.r GROUP BY 1, 2),
      xy AS (SELECT i, sum(x * y) AS v FROM train GROUP BY 1),
      m AS (SELECT p.i AS i, list(coalesce(g.v, 0) ORDER BY p.j) AS xx, any_value(coalesce(xy.v, 0)) AS xy
            FROM (SELECT a.i AS i, b.i AS j FROM dims, range(0, width) a(i), range(0, width) b(i)) p
            LEFT JOIN g ON g.i = p.i AND g.j = p.j LEFT JOIN xy ON xy.i = p.i GROUP BY p.i),
      d(k, w, done) AS (SELECT 0, list_transform(range(0, width), lambda i: CAST(0 AS DOUBLE)), false FROM dims
        UNION ALL SELECT k + 1, nw, k > 0 AND list_distance(nw, w) < CAST(0.001 AS DOUBLE) * greatest(sqrt(list_dot_product(nw, nw)), 1)
        FROM (SELECT k, any_value(w) AS w,
                     list(w[m.i + 1] - CAST({step} AS DOUBLE) / sqrt(k + 1) / n * (list_dot_product(xx, w) - xy) ORDER BY m.i) AS nw
              FROM d, m, n WHERE NOT done AND k < 100 GROUP BY k)),
      fit AS (SELECT w, k FROM d ORDER BY k DESC LIMIT 1)"""


ONEHOT = """dims AS (SELECT count(DISTINCT p_brand) AS nb, count(DISTINCT p_type) AS nt, nb + nt + 1 AS width FROM part),
      coded AS (SELECT p_partkey AS r, p_retailprice AS y, 'train' AS part, [dense_rank() OVER (ORDER BY p_brand) - 1,
             (SELECT nb FROM dims) + dense_rank() OVER (ORDER BY p_type) - 1, (SELECT nb + nt FROM dims)] AS pos,
             [CAST(1 AS DOUBLE), 1, p_size] AS x FROM part)"""
UNNESTED = "SELECT r, y, part, unnest(pos) AS i, unnest(x) AS x FROM coded"


@plan(f"""WITH RECURSIVE {ONEHOT}, {_coded_descent(UNNESTED, '0.001')}
      SELECT r AS p_partkey, any_value(y) AS p_retailprice, round(sum(x * w[i + 1]), 4) AS predicted FROM cells, fit GROUP BY r""")
def ml_linear_onehot(t):
    """Price of a part from its one-hot brand and type and its size, by gradient descent."""
    coded = ml.code_columns(t.part.select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"), ["p_brand", "p_type"], ["p_size"])
    weights, _ = ml.linear_sgd_coded(coded, coded.rows, "p_retailprice", step=0.001)
    predicted = ml.predict_coded(coded, coded.rows, weights)
    return predicted.select("p_partkey", "p_retailprice", F.round("predicted", 4).alias("predicted"))


COLUMNS = f"""{SPLIT}, dims AS (SELECT count(DISTINCT l_returnflag) AS nf, count(DISTINCT l_linestatus) AS ns, nf + ns + 4 AS width FROM lineitem),
      coded AS (SELECT l_orderkey, l_linenumber, row_number() OVER () AS r, l_extendedprice AS y, part,
             [dense_rank() OVER (ORDER BY l_returnflag) - 1, nf + dense_rank() OVER (ORDER BY l_linestatus) - 1,
              nf + ns, nf + ns + 1, nf + ns + 2, nf + ns + 3] AS pos,
             [CAST(1 AS DOUBLE), 1, l_quantity, l_discount, l_tax, l_linenumber] AS x FROM split, dims)"""


@plan(f"""WITH RECURSIVE {COLUMNS}, {_coded_descent(UNNESTED, '0.0005')}
      SELECT l_orderkey, l_linenumber, y AS actual, round(list_sum(list_transform(range(1, 7), lambda k: x[k] * w[pos[k] + 1])), 3) AS predicted
      FROM coded, fit WHERE part = 'test'""")
def ml_linear_columns(t):
    """Price from two categories and four numbers: fitted to nine tenths of the rows, predicted for the rest."""
    coded = ml.code_columns(_split(t), ["l_returnflag", "l_linestatus"], ["l_quantity", "l_discount", "l_tax", "l_linenumber"])
    weights, _ = ml.linear_sgd_coded(coded, coded.rows.filter("part = 'train'"), "l_extendedprice", step=0.0005)
    predicted = ml.predict_coded(coded, coded.rows.filter("part = 'test'"), weights)
    return predicted.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("actual"), F.round("predicted", 3).alias("predicted"))


def _tree(t):
    features = ["l_returnflag_index", "l_linestatus_index", "l_quantity", "l_discount", "l_tax"]
    # Frozen once: the fit reads the training rows several times, the prediction reads the others.
    rows = freeze(ml.assemble(ml.with_indices(_split(t), ["l_returnflag", "l_linestatus"]), features).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "part", "features"))
    return ml.tree_fit(rows.filter("part = 'train'"), "l_extendedprice"), rows.filter("part = 'test'")


@plan()
def ml_tree_regressor(t):
    model, test = _tree(t)
    return model.transform(test).select("l_orderkey", "l_linenumber", "l_extendedprice", "prediction")


@plan()
def ml_tree_stats(t):
    model, test = _tree(t)
    errors = stats.regression_errors(model.transform(test), "l_extendedprice", "prediction")
    return errors.select(F.lit(model.depth).alias("depth"), F.lit(model.numNodes).alias("nodes"), "mse", "mae", "rmsle")


@plan("""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice AS original, round(l_quantity * slope, 3) AS predicted
      FROM lineitem, (SELECT sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity) AS slope FROM lineitem)""")
def ml_fit_line_dataset(t):
    fit = t.lineitem.agg(
        (F.sum(F.col("l_quantity") * F.col("l_extendedprice")) / F.sum(F.col("l_quantity") * F.col("l_quantity"))).alias("slope"))
    points = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    line = ch.fitted_line(points, ["l_orderkey", "l_linenumber"], "l_quantity", "l_extendedprice", fit.scalar())
    return line.withColumn("predicted", F.round("predicted", 3))
