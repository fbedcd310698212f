"""Joins, graphs, statistics, charts, matrices and models on small literal inputs."""

import math
import random

import numpy as np
import pytest
from conftest import listed
from pyspark.sql import functions as F

from millrace.functions import scalars as sc
from millrace.operators import charts, graph, joins, learning, matrix, relational, stats
from millrace.operators.keyed import upsert

LEFT = [("ark", 3), ("bell", 2), ("cup", 9)]
RIGHT = [("bell", 7), ("dove", 1)]


@pytest.fixture
def vocabularies(rows):
    return rows(LEFT, "word string, n bigint"), rows(RIGHT, "word string, n bigint")


def test_vocabulary_joins(vocabularies):
    merged = joins.merge_vocabularies(*vocabularies)
    assert listed(merged) == sorted([("ark", 3, None), ("bell", 2, 7), ("cup", 9, None), ("dove", None, 1)], key=repr)
    assert listed(joins.only_in_left(*vocabularies)) == [("ark", 3), ("cup", 9)]
    assert listed(joins.only_in_right(*vocabularies)) == [("dove", 1)]
    assert listed(joins.only_in_left(*vocabularies)) == listed(vocabularies[0].join(vocabularies[1], "word", "left_anti"))


@pytest.mark.parametrize("limit", ["-1", "10485760"])
@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_salted_join_with_a_hot_key(spark, rows, how, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        left = rows([("hot" if i % 3 else f"k{i % 7}", i) for i in range(400)] + [(None, -1)], "k string, i int")
        right = rows([("hot", 1), ("k3", 2), (None, 3)], "k string, w int")
        got = joins.salted_join(left, right, ["k"], how, F.col("i"))
        known = {"hot": 1, "k3": 2, None: 3}
        data = [tuple(r) for r in left.collect()]
        expected = {"inner": [(k, i, known[k]) for k, i in data if k in known],
                    "left_semi": [r for r in data if r[0] in known],
                    "left_anti": [r for r in data if r[0] not in known]}[how]
        assert listed(got) == sorted(expected, key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_hot_keys_are_salted(spark, rows):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    data = [("hot" if i % 3 == 0 else None if i % 3 == 1 and i % 2 else f"k{i}", i % 2) for i in range(3000)]
    left = rows(data, "k string, i int")
    hot, both = (dict(found) for found in joins.hot_keys(left, ["k"], ["i"]))
    by_name = {r[0]: r[1] for r in left.select("k", F.xxhash64("k")).distinct().collect()}
    share = 3000 / (2 * parts)
    assert hot == {by_name["hot"]: math.ceil(1000 / share), by_name[None]: math.ceil(500 / share)}
    assert list(both.values()) == [parts, parts]
    assert joins.hot_keys(left.limit(0), ["k"]) == [[]]
    assert joins.hot_keys(rows([(f"k{i}", i) for i in range(300)], "k string, i int"), ["k"]) == [[]]


def test_a_hot_key_fills_an_even_stage(spark, rows):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        left = rows([("hot" if i % 3 == 0 else f"k{i % 500}", i) for i in range(24_000)], "k string, i int")
        right = rows([("hot", 1), *[(f"k{i}", i) for i in range(500)]], "k string, w int")
        plain, salted = (
            [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            for joined in (left.join(right, "k"), joins.salted_join(left, right, ["k"], "inner", F.col("i"))))
        assert sum(plain) == sum(salted) == 24_000
        assert max(plain) > 8_000 and len(salted) == 8 and max(salted) < 2 * 3_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_co_participants_need_another_source(rows):
    edges = rows([("a", 1), ("a", 1), ("b", 2), ("c", 2), ("d", 3)], "src string, dst int")
    assert listed(joins.co_participants(edges, "src", "dst")) == [("b",), ("c",)]


def test_double_lookup_drops_unknown_and_multiplies_repeated_names(rows):
    links = rows([("ann", "x", 1), ("ann", "nowhere", 2), ("zed", "x", 3)], "who string, what string, nr int")
    people = rows([(10, "ann"), (11, "ann")], "id int, name string")
    films = rows([(7, "x")], "id int, title string")
    assert listed(joins.double_lookup(links, "who", "what", people, films, "name", "title")) == [(10, 7, 1), (11, 7, 1)]


def test_lexicon(rows):
    senses = rows([("state", "s1"), ("state", "s2"), ("leaf", "s3")], "word string, sense string")
    lemmas = rows([("s1", "state"), ("s1", "land"), ("s2", "state"), ("s3", "leaf"), ("k1", "realm")], "sense string, lemma string")
    children = rows([("s1", "k1")], "sense string, child string")
    assert listed(joins.lexicon_totals(senses, children, lemmas)) == [("leaf", 1, 0), ("state", 3, 1)]
    assert listed(joins.hyponyms_of(senses, children, lemmas)) == [("state", "s1", "k1", "realm")]


@pytest.mark.parametrize("cell, expected", [
    ("12", 12), ("0", 0), ("12;13", None), ("1 2", None), ("1,2", None), ("2147483648", None), ("9999999999", None),
    ("1999999999", 1999999999), ("", None), (None, None), ("x", None), ("12345678901", None), ("99999", 99999),
])
def test_valid_length(rows, cell, expected):
    assert rows([(cell,)], "t string").select(sc.valid_length(F.col("t"))).first()[0] == expected


def test_above_global_mean_uses_all_rows(rows):
    df = rows([("svg", 10), ("svg", 2), ("png", 6), ("png", 100)], "format string, length int")
    kept = relational.above_global_mean(df, "length", F.col("format") == "svg")
    assert listed(kept) == []
    kept = relational.above_global_mean(df.filter("length < 100"), "length", F.col("format") == "svg")
    assert listed(kept) == [("svg", 10)]


def test_route(rows):
    df = rows([(0,), (-3,), (5,), (8,)], "k int")
    assert [r[0] for r in df.select(sc.route(F.col("k"), 4)).collect()] == [0, 0, 1, 0]


def test_upsert(rows):
    base = rows([("a", "old", 1), ("b", "kept", 1)], "id string, v string, version int")
    delta = rows([("a", "new", 2), ("c", "added", 2), ("a", "newest", 3)], "id string, v string, version int")
    assert listed(upsert(base, delta, ["id"], "version")) == [("a", "newest", 3), ("b", "kept", 1), ("c", "added", 2)]


@pytest.fixture
def films(spark):
    nodes, edges = graph.empty_graph(spark)
    nodes = graph.add_nodes(nodes, [
        (i, [label], name, {}) for i, label, name in [
            ("a1", "Actor", "Ann"), ("a2", "Actor", "Bo"), ("a3", "Actor", "Cy"), ("a4", "Actor", "Di"),
            ("d1", "Director", "Ed"), ("d2", "Director", "Flo"), ("m1", "Movie", "Mill"), ("m2", "Movie", "Race"),
            ("m3", "Movie", "Pond")]])
    edges = graph.add_edges(edges, [
        ("a1", "m1", "ACTS_IN", {"role": "x"}), ("a2", "m1", "ACTS_IN", {}), ("a3", "m2", "ACTS_IN", {"role": "y"}),
        ("a3", "m2", "ACTS_IN", {"role": "z"}), ("a4", "m3", "ACTS_IN", {}),
        ("d1", "m1", "DIRECTS", {}), ("d2", "m9", "DIRECTS", {})])
    return nodes, edges


def test_graph_patterns(films):
    assert listed(graph.co_actors(*films, "Actor", "ACTS_IN", "Movie")) == [("a1", "Ann"), ("a2", "Bo"), ("a3", "Cy")]
    assert listed(graph.directors_of_cast(*films, ("Director", "DIRECTS"), ("Actor", "ACTS_IN"), "Movie")) == [("d1", "Ed")]
    assert graph.triples(*films).count() == 6


def test_graph_match_create(films, rows):
    nodes, edges = films
    wanted = rows([("Di", "Mill", "cameo"), ("Nobody", "Mill", "-"), ("Ed", "Mill", "-")],
                  "src_name string, dst_name string, role string")
    added = graph.match_create(nodes, edges, wanted, "Actor", "Movie", "ACTS_IN")
    assert added.count() == edges.count() + 1
    assert added.filter("src = 'a4' AND dst = 'm1'").select(F.col("props")["role"]).first()[0] == "cameo"


def test_graph_changes(films):
    nodes, edges = films
    changed = graph.set_property(edges, F.col("src") == "a1", "role", "new")
    assert [r[0] for r in changed.filter("src = 'a1'").select(F.col("props")["role"]).collect()] == ["new"]
    labelled = graph.add_label(graph.add_label(nodes, F.col("id") == "a1", "Star"), F.col("id") == "a1", "Star")
    assert labelled.filter("id = 'a1'").select("labels").first()[0] == ["Actor", "Star"]
    left_nodes, left_edges = graph.detach_delete(nodes, edges, F.array_contains("labels", "Movie"))
    assert left_nodes.count() == 6
    assert listed(left_edges.select("src", "dst")) == [("d2", "m9")]


def test_traversal_visits_once_and_stops_at_depth(rows):
    pairs = [("n0", "n1"), ("n1", "n2"), ("n2", "n0"), ("n0", "n2"), ("n2", "n3"), ("n3", "n4"), ("q", "n0")]
    edges = rows([(a, b, "OUT") for a, b in pairs] + [("n0", "z", "OTHER")], "src string, dst string, type string")
    start = rows([("n0",)], "id string")
    assert listed(graph.traverse(edges, start, "OUT")) == [("n0", 0), ("n1", 1), ("n2", 1), ("n3", 2), ("n4", 3)]
    assert listed(graph.traverse(edges, start, "OUT", max_depth=1)) == [("n0", 0), ("n1", 1), ("n2", 1)]


def test_binned_stats_keep_empty_bins_and_drop_outside(rows):
    df = rows([(1.0, 5.0), (2.0, 7.0), (1.0 + 1.86, 1.0), (94.0, 9.0), (0.5, 9.0)], "x double, y double")
    got = {r["bin"]: r for r in stats.binned_stats(df, "x", "y").collect()}
    assert len(got) == 50
    assert (got[0]["mid_x"], got[0]["max_y"], got[0]["min_y"], got[0]["mean_y"]) == (1.5, 7.0, 5.0, 6.0)
    assert got[1]["max_y"] == 1.0
    assert got[5]["max_y"] is None


def test_boxplot(rows):
    df = rows([("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", 5.0)], "k string, v double")
    got = {r["k"]: r for r in stats.boxplot_stats(df, ["k"], "v").collect()}
    assert (got["a"]["q1"], got["a"]["median"], got["a"]["q3"]) == (2.0, 3.0, 4.0)
    assert (got["a"]["low_whisker"], got["a"]["high_whisker"], got["a"]["outliers"]) == (1.0, 4.0, 1)
    assert got["b"]["outliers"] == 0
    assert listed(stats.outliers(df, ["k"], "v")) == [("a", 100.0)]


def test_array_stats_skip_nan_and_null(rows):
    df = rows([(1.0,), (float("nan"),), (None,), (4.0,)], "v double")
    assert tuple(stats.array_stats(df, "v").first()) == (1.0, 4.0, 5.0, 2.5)


def test_histogram_last_bin_is_closed(rows):
    df = rows([(float(v),) for v in [0, 1, 2, 3, 4]], "v double")
    assert listed(stats.histogram(df, "v", 2)) == [(0, 0.0, 2.0, 2), (1, 2.0, 2.0, 3)]
    assert stats.histogram(df, "v").count() == math.ceil(math.log2(5) + 1)


def test_histogram_without_nan_and_null(rows):
    df = rows([(1.0,), (float("nan"),), (None,), (2.0,)], "v double")
    assert listed(stats.histogram(df, "v", 1)) == [(0, 1.0, 1.0, 2)]


def test_summary_of_a_column_of_nulls(rows):
    df = rows([(1.0, None), (3.0, None)], "a double, b double")
    got = {r["column"]: (r["min"], r["median"], r["mean"]) for r in stats.numeric_summary(df, ["a", "b"]).collect()}
    assert got == {"a": (1.0, 2.0, 2.0), "b": (None, None, None)}


def test_null_category_is_the_last_level(rows):
    df = rows([("x", 1), (None, 2), ("a", 3), (None, 4)], "c string, v int")
    assert listed(learning.with_indices(df, ["c"]).select("v", "c_index")) == [(1, 1), (2, 2), (3, 0), (4, 2)]


def test_bins(rows):
    df = rows([(-1.0,), (0.0,), (5.0,), (10.0,), (11.0,)], "v double")
    assert [r[0] for r in df.select(stats.quantize(F.col("v"), 0, 10, 5)).collect()] == [0, 0, 2, 4, 4]
    assert [r[0] for r in df.select(stats.threshold(F.col("v"), [0, 10])).collect()] == [0, 1, 1, 2, 2]
    assert [r["bin"] for r in stats.quantile_bins(df, "v", 2).orderBy("v").collect()] == [0, 0, 1, 1, 1]


def test_regression_errors(rows):
    got = stats.regression_errors(rows([(1.0, 2.0), (3.0, 3.0)], "a double, p double"), "a", "p").first()
    assert tuple(got) == pytest.approx((0.5, 0.5, math.sqrt((math.log(3) - math.log(2)) ** 2 / 2)))
    got = stats.regression_errors(rows([(1.0, -2.0), (3.0, 3.0)], "a double, p double"), "a", "p").first()
    assert got["mse"] == 4.5 and math.isnan(got["rmsle"])


def test_pie_angles_fill_the_circle(rows):
    slices = rows([("a", 1), ("b", 3), ("c", 4)], "k string, v int")
    got = {r["k"]: (r["start_angle"], r["end_angle"]) for r in charts.pie_angles(slices, "v", [F.asc("k")]).collect()}
    assert got["a"] == pytest.approx((0, math.pi / 4))
    assert got["c"] == pytest.approx((math.pi, 2 * math.pi))


def test_stack_offsets(rows):
    cells = rows([("x", "s1", 2), ("x", "s2", 3), ("x", "s3", 1), ("y", "s1", 5)], "x string, s string, y int")
    assert listed(charts.stack_offsets(cells, "x", "s", "y").select("x", "s", "y0")) == [
        ("x", "s1", 0), ("x", "s2", 2), ("x", "s3", 5), ("y", "s1", 0)]


def to_cells(array):
    return [(i, j, float(v)) for (i, j), v in np.ndenumerate(array)]


@pytest.mark.parametrize("block", [1, 2, 512])
def test_matrix_products(rows, block):
    a = np.array([7, 2, 1, 0, 3, -1, -3, 4]).reshape(4, 2)
    cells = rows(to_cells(a), "i bigint, j bigint, v double")
    assert listed(matrix.multiply(cells, matrix.transpose(cells), block)) == sorted(to_cells(a @ a.T), key=repr)
    assert listed(matrix.multiply(matrix.transpose(cells), cells, block)) == sorted(to_cells(a.T @ a), key=repr)
    assert tuple(matrix.dims(cells).first()) == (4, 2)


@pytest.mark.parametrize("shape,fill", [((40, 3, 50), 1.0), ((30, 70, 20), 0.1), ((6, 90, 5), 0.6)])
def test_block_products_of_sparse_and_full_matrices(spark, rows, shape, fill):
    rng = np.random.default_rng(3)
    n, k, m = shape
    a, b = ([(int(i), int(j), float(rng.normal())) for i in range(x) for j in range(y) if rng.random() < fill] for x, y in ((n, k), (k, m)))
    b += b[:3]  # entries of the same cell add up
    want = {}
    for i, l, v in a:
        for l2, j, w in b:
            if l == l2:
                want[i, j] = want.get((i, j), 0.0) + v * w
    frames = [rows(cells, "i bigint, j bigint, v double") for cells in (a, b)]
    got = {(r.i, r.j): r.v for r in matrix.multiply(*frames, block=16).collect()}
    assert got.keys() == want.keys() and all(got[c] == pytest.approx(want[c]) for c in want)
    assert matrix.multiply(frames[0].limit(0), frames[1]).count() == 0


def test_products_are_not_shuffled(spark, rows):
    """A full 256 x 256 product: a quarter of a million cells, but a few blocks in the shuffles."""
    a = spark.range(256 * 256).selectExpr("id div 256 AS i", "id % 256 AS j", "1.0D AS v")
    product = matrix.multiply(a, a, block=128)
    assert product.agg(F.sum("v")).first()[0] == 256.0 ** 3
    blocks = matrix.to_blocks(a, 128)
    assert blocks.count() == 4 and blocks.select(F.max(F.size("cells"))).first()[0] == 128 * 128


def test_gram(rows):
    a = np.array([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]])
    df = rows([(r.tolist(),) for r in a] + [(None,)], "v array<double>").repartition(2)
    assert listed(matrix.gram(df, "v")) == sorted(to_cells(a.T @ a), key=repr)


def test_linear_sgd_equals_row_by_row_descent(rows):
    rng = random.Random(1)
    points = [(x, 0.5 * x + rng.uniform(-5, 5)) for x in (rng.uniform(50, 400) for _ in range(80))]
    x, y = np.array(points).T
    w, rounds = 0.0, 0
    for i in range(1, 101):
        moved = w - 1e-5 / math.sqrt(i) * np.mean((w * x - y) * x)
        done, w, rounds = i > 1 and abs(moved - w) < 0.001 * max(abs(moved), 1), moved, i
        if done:
            break
    (got,), used = learning.linear_sgd(rows(points, "x double, y double"), ["x"], "y", step=1e-5)
    assert (got, used) == (pytest.approx(w), rounds)
    (exact,) = learning.linear_fit(rows(points, "x double, y double"), ["x"], "y")
    assert exact == pytest.approx((x @ y) / (x @ x))


def test_category_index_and_one_hot(rows):
    cars = rows([(1, "ford", "US"), (2, "audi", "EU"), (3, "ford", "EU")], "id int, make string, origin string")
    assert listed(learning.category_index(cars, "make")) == [("audi", 0), ("ford", 1)]
    encoded, _ = learning.one_hot(cars, ["make", "origin"])
    got = {r["id"]: (r["make_vec"].toArray().tolist(), r["origin_vec"].toArray().tolist()) for r in encoded.collect()}
    assert got == {1: ([0, 1], [0, 1]), 2: ([1, 0], [1, 0]), 3: ([0, 1], [1, 0])}


def test_split_label_is_stable(rows):
    df = rows([(i,) for i in range(2000)], "id int")
    first = listed(df.select("id", learning.split_label(F.col("id"))))
    assert first == listed(df.repartition(9).select("id", learning.split_label(F.col("id"))))
    assert 0.87 < sum(part == "train" for _, part in first) / 2000 < 0.93
