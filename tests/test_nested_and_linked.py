"""Sentences over splits, nested groups, trees from links and walks over stored graphs."""

import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import listed
from pyspark.sql import functions as F

from millrace.operators import charts, graph
from millrace.sources import files


@pytest.mark.parametrize("split", [40, 700, 10_000_000])
def test_sentences_over_lines_and_splits(spark, tmp_path, split):
    rng = random.Random(split)
    texts = {}
    for name in "abcd":
        words = [rng.choice(["w", "été", "漢字", "end.", "what?", "", "x" * rng.randrange(60)]) for _ in range(400)]
        texts[name] = "".join(w + rng.choice([" ", "\n", "\n\n"]) for w in words).rstrip("\n")
    texts["none"] = "no end at all\n" * 30 + "still none"
    texts["ends"] = "a.\nb.\n\nc."
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    settings = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert (files.read_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20) == (split == 40 or split == 700)
        got = Counter((r.path.rsplit("/", 1)[1][:-4], r.sentence) for r in files.read_sentences(spark, str(tmp_path)).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = Counter((name, s) for name, text in texts.items() for s in re.split("[.?!]", text.replace("\n", " ")))
    assert got == want


def test_nested_groups_are_sorted_and_complete(rows):
    rng = random.Random(1)
    data = [(rng.choice("xy"), rng.choice(["a", "b", None]), rng.randrange(3), rng.randrange(9)) for _ in range(200)]
    nested = charts.nest_rollup(rows(data, "k string, l string, m int, v int"), ["k", "l", "m"], F.sum("v"))
    got = {r["key"]: [(e["key"], [(i["key"], i["values"]) for i in e["values"]]) for e in r["values"]] for r in nested.collect()}
    sums = defaultdict(int)
    for *keys, v in data:
        sums[tuple(keys)] += v
    for k in "xy":
        inner = sorted({l for a, l, _ in sums if a == k}, key=lambda v: (v is not None, v))
        assert got[k] == [(l, [(m, sums[k, l, m]) for m in range(3) if (k, l, m) in sums]) for l in inner]
    assert charts.nest_rollup(rows(data, "k string, l string, m int, v int"), ["k"], F.count("*")).count() == 2


def test_a_deep_chain_takes_the_logarithm_of_its_depth(spark, rows, monkeypatch):
    rounds = []
    monkeypatch.setattr(charts, "freeze", lambda df, keep=charts.freeze: rounds.append(1) or keep(df))
    chain = [(i, i - 1 if i else None, 1.0) for i in range(1000)]
    got = {r.id: (r.depth, r.value) for r in charts.hierarchy_from_links(rows(chain, "id int, up int, v double"), "id", "up", "v").collect()}
    assert got == {i: (i, 1000.0 - i) for i in range(1000)}
    assert len(rounds) <= 11


def test_trees_from_links(rows):
    rng = random.Random(6)
    links = [(i, rng.randrange(i) if i and rng.random() < 0.95 else None, float(i % 7)) for i in range(120)]
    links += [(200, 201, 1.0), (201, 202, 1.0), (202, 200, 1.0), (203, 202, 1.0), (204, 204, 1.0), (300, 999, 5.0), (301, 300, None)]
    up = {i: p for i, p, _ in links}
    value = {i: v or 0.0 for i, _, v in links}

    def chain(i):
        seen = []
        while i in up and i not in seen:
            seen.append(i)
            i = up[i]
        return None if i in seen else seen

    chains = {i: chain(i) for i in up}
    want = {i: (None, None) if c is None else (len(c) - 1, sum(value[k] for k, other in chains.items() if other and i in other))
            for i, c in chains.items()}
    frame = rows(links, "id int, up int, v double")
    got = {r.id: (r.depth, r.value) for r in charts.hierarchy_from_links(frame, "id", "up", "v").collect()}
    assert got == want and got[203] == (None, None) and got[300] == (0, 5.0)
    assert charts.hierarchy_from_links(frame.limit(0), "id", "up", "v").count() == 0


def test_walks_with_a_hot_node(rows):
    rng = random.Random(3)
    pairs = [("hub", f"n{i}") for i in range(300)] + [(f"n{rng.randrange(300)}", f"n{rng.randrange(500)}") for _ in range(400)]
    pairs += [("n7", "hub"), ("far", "n1")]
    depth, ring = {"n7": 0}, {"n7"}
    for d in range(1, 11):
        ring = {b for a, b in pairs if a in ring} - depth.keys()
        depth |= dict.fromkeys(ring, d)
    edges = rows([(a, b, "OUT") for a, b in pairs], "src string, dst string, type string")
    got = graph.traverse(edges, rows([("n7",)], "id string"), "OUT")
    assert listed(got) == sorted(depth.items(), key=repr)


def test_a_round_moves_the_ring_alone(spark, rows, capsys, monkeypatch):
    monkeypatch.setattr(graph, "_ahead", lambda *args, keep=graph._ahead: keep(*args).explain() or keep(*args))
    edges = rows([("a", "b", "OUT"), ("b", "c", "OUT")], "src string, dst string, type string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert listed(graph.traverse(edges, rows([("a",)], "id string"), "OUT", 1)) == [("a", 0), ("b", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    plan = capsys.readouterr().out
    # one exchange of the ring (to the places of its edges), one of the nodes ahead; none above the edges and what was seen
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Bucketed: true") == 3
    assert not spark.catalog.listTables()
