"""Order-dependent operators against brute force, with one key holding a third of the rows or more."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import listed
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import ordered as o
from millrace.operators.keyed import newest_per_key
from millrace.operators.relational import posting_blocks, posting_directory, posting_lists


def skewed(n=3000, seed=7):
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.4 else f"k{rng.randrange(40)}", i, rng.randrange(1, 50)) for i in range(n)]


def test_running_sum_per_group(rows):
    data = skewed()
    got = o.running_sum(rows(data, "k string, pos int, v int"), ["k"], ["pos"], "v", "upto", total="total")
    sums, expected = defaultdict(int), []
    totals = Counter()
    for k, _, v in data:
        totals[k] += v
    for k, pos, v in data:
        sums[k] += v
        expected.append((k, pos, v, totals[k], sums[k]))
    assert listed(got.select("k", "pos", "v", "total", "upto")) == sorted(expected, key=repr)


def test_running_sum_keeps_a_null_group(rows):
    got = o.running_sum(rows([(None, 1, 5), (None, 2, 6), ("a", 1, 7)], "k string, pos int, v int"), ["k"], ["pos"], "v", "s")
    assert listed(got.select("k", "pos", "s")) == sorted([(None, 1, 5), (None, 2, 11), ("a", 1, 7)], key=repr)


def test_global_rank_is_the_sorted_position(rows):
    data = [(v, i) for i, (_, _, v) in enumerate(skewed(2000))]
    got = o.global_rank(rows(data, "v int, id int").repartition(7), [F.desc("v"), F.asc("id")])
    expected = [(v, i, r) for r, (v, i) in enumerate(sorted(data, key=lambda x: (-x[0], x[1])), start=1)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "hot", "hot"]), st.integers(-5, 5)), min_size=1, max_size=60))
def test_quantiles_match_numpy(rows, data):
    probs = {"q0": 0.0, "q1": 0.25, "median": 0.5, "p9": 0.9, "q4": 1.0}
    got = {r["k"]: r for r in o.quantiles(rows(data, "k string, v int"), ["k"], "v", probs).collect()}
    groups = defaultdict(list)
    for k, v in data:
        groups[k].append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(values, p))


def test_quantiles_ignore_null_values(rows):
    got = o.quantiles(rows([("a", 1.0), ("a", None), ("a", 3.0)], "k string, v double"), ["k"], "v", {"m": 0.5})
    assert listed(got) == [("a", 2.0)]


@pytest.mark.parametrize("margin,few", [(0.02, 1_000_000), (0.02, 0), (1e-6, 1_000_000)])
def test_quantiles_by_selection(rows, monkeypatch, margin, few):
    """Brackets that hold few values, cells numbered by runs, and brackets too narrow, which are widened."""
    monkeypatch.setattr(o, "FEW_CELLS", few)
    if margin < 1e-3:
        monkeypatch.setattr(o, "ACCURACY", 20)  # a sketch far coarser than the margin
    rng = random.Random(4)
    data = [("hot", 5.0 if rng.random() < 0.3 else rng.gauss(0, 9)) for _ in range(4000)]
    data += [(None, float(rng.randrange(3))) for _ in range(900)] + [("one", -1.0), ("nan", float("nan")), ("nan", 1.0), ("none", None)]
    probs = {"p0": 0.0, "p1": 0.01, "q1": 0.25, "q2": 0.26, "median": 0.5, "p99": 0.99, "p100": 1.0}
    frame = rows(data, "k string, v double").repartition(5)
    got = {r["k"]: r for r in o.quantiles(frame, ["k"], "v", probs, extra=[F.sum("n").alias("rows"), F.max("v").alias("top")], margin=margin).collect()}
    assert set(got) == {"hot", None, "one", "nan"}
    for k in ("hot", None, "one"):
        values = [v for g, v in data if g == k]
        assert got[k]["rows"] == len(values) and got[k]["top"] == max(values)
        assert [got[k][name] for name in probs] == pytest.approx([np.quantile(values, p) for p in probs.values()])
    assert got["nan"]["p0"] == 1.0 and math.isnan(got["nan"]["p100"])
    whole = o.quantiles(frame.filter("k = 'hot'"), [], "v", {"median": 0.5}, margin=margin).first()
    assert whole["median"] == pytest.approx(np.quantile([v for g, v in data if g == "hot"], 0.5))


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_next_in_group_crosses_blocks(rows, block):
    data = [("hot", i, i * 10) for i in range(50)] + [("b", 0, 1), ("b", 1, 2), ("c", 0, 9)]
    got = o.next_in_group(rows(data, "k string, pos int, v int"), ["k"], "pos", "v", "after", block=block)
    where = {(k, p): v for k, p, v in data}
    expected = [(k, p, where.get((k, p + 1))) for k, p, _ in data]
    assert listed(got.select("k", "pos", "after")) == sorted(expected, key=repr)


@pytest.mark.parametrize("block", [1, 4, 7, 100_000])
def test_posting_blocks(rows, block):
    rng = random.Random(3)
    pairs = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(5)}", rng.randrange(12)) for _ in range(300)]
    blocks = posting_blocks(rows(pairs, "cited string, citing int"), "cited", "citing", block)
    lists = defaultdict(list)
    for cited, citing in sorted(pairs):
        lists[cited].append(citing)
    expected = [(c, i // block, len(items[i:i + block]), items[i:i + block]) for c, items in lists.items() for i in range(0, len(items), block)]
    assert listed(blocks) == sorted(expected, key=repr)
    assert listed(posting_lists(blocks, "cited")) == sorted(((c, ",".join(map(str, items))) for c, items in lists.items()), key=repr)
    directory = [(c, len(items), -(-len(items) // block), items[0], items[-1]) for c, items in lists.items()]
    assert listed(posting_directory(blocks, "cited")) == sorted(directory, key=repr)


def test_sort_within_partitions_sorts_each(spark):
    """Rows stay in their partition, and each partition is in order."""
    rows = spark.range(5000).selectExpr("id", "hash(id) AS v").repartition(6).sortWithinPartitions(F.desc("v"))
    by_part = defaultdict(list)
    for r in rows.withColumn("part", F.spark_partition_id()).collect():
        by_part[r.part].append(r.v)
    assert len(by_part) == 6 and all(v == sorted(v, reverse=True) for v in by_part.values()) and sum(map(len, by_part.values())) == 5000


def test_newest_per_key(rows):
    data = [("hot", i, f"v{i}") for i in range(500)] + [("a", 3, "x"), ("a", 9, None)]
    got = newest_per_key(rows(data, "k string, version int, v string").repartition(5), ["k"], "version")
    assert listed(got) == sorted([("hot", 499, "v499"), ("a", 9, None)], key=repr)


def test_newest_per_key_with_ties_and_null_versions(rows):
    data = [("t", 1, "a"), ("t", 1, "b"), ("n", None, "only"), ("m", None, "x"), ("m", 0, "y")]
    for order in (data, data[::-1]):
        got = newest_per_key(rows(order, "k string, version int, v string"), ["k"], "version")
        assert listed(got) == sorted([("t", 1, "b"), ("n", None, "only"), ("m", 0, "y")], key=repr)
