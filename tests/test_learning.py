"""Models over coded columns and trees, against plain numpy."""

import itertools
import math
import random

import numpy as np
import pytest
from conftest import listed

from millrace.operators import learning


def design(data, categories, numbers):
    """The dense matrix of the coded columns: levels in ascending order, null last, then the numbers."""
    columns = []
    for c in categories:
        levels = sorted({r[c] for r in data}, key=lambda v: (v is None, v))
        columns += [[1.0 if r[c] == level else 0.0 for r in data] for level in levels]
    columns += [[float(r[c]) for r in data] for c in numbers]
    return np.array(columns).T


def descend(x, y, step, iterations=100, tolerance=0.001):
    w = np.zeros(x.shape[1])
    for i in range(1, iterations + 1):
        moved = w - step / math.sqrt(i) * (x.T @ (x @ w - y)) / len(y)
        done = i > 1 and np.linalg.norm(moved - w) < tolerance * max(np.linalg.norm(moved), 1.0)
        w = moved
        if done:
            break
    return w, i


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    return [{"c": rng.choice(["x", "y", "z", None]), "d": rng.randrange(9), "a": rng.uniform(0, 4), "b": rng.choice([0.0, 1.0, 2.0]),
             "y": rng.uniform(0, 9)} for _ in range(90)]


@pytest.mark.parametrize("widest,block", [(512, 512), (3, 4), (3, 512)])
def test_coded_descent_against_numpy(spark, data, widest, block):
    frame = spark.createDataFrame([tuple(r.values()) for r in data], "c string, d int, a double, b double, y double")
    coded = learning.code_columns(frame.repartition(3), ["c", "d"], ["a", "b"])
    x = design(data, ["c", "d"], ["a", "b"])
    assert coded.width == x.shape[1] == 15
    y = np.array([r["y"] for r in data])
    iterations = 100 if widest == 512 else 6
    want, rounds = descend(x, y, 0.05, iterations)
    weights, used = learning.linear_sgd_coded(coded, coded.rows, "y", 0.05, iterations, widest=widest, block=block)
    got = dict(map(tuple, weights.collect()))
    assert used == rounds and [got[i] for i in range(15)] == pytest.approx(list(want))
    predicted = learning.predict_coded(coded, coded.rows, weights).select("y", "predicted").collect()
    assert np.allclose(sorted(map(tuple, predicted)), sorted(zip(y, x @ want)))


def test_a_category_of_five_thousand_levels(spark, monkeypatch):
    monkeypatch.setattr(learning, "FEW_LEVELS", 1000)
    data = [{"c": f"level {i % 5000:04}", "a": float(i % 7), "y": float(i % 5000 % 11) + i % 7} for i in range(15_000)]
    frame = spark.createDataFrame([tuple(r.values()) for r in data], "c string, a double, y double")
    coded = learning.code_columns(frame, ["c"], ["a"])
    x = np.zeros((15_000, 5001))
    x[np.arange(15_000), np.arange(15_000) % 5000] = 1
    x[:, 5000] = [r["a"] for r in data]
    want, rounds = descend(x, np.array([r["y"] for r in data]), 0.1, 3)
    weights, used = learning.linear_sgd_coded(coded, coded.rows, "y", 0.1, 3)
    got = dict(map(tuple, weights.collect()))
    assert used == rounds and len(got) == 5001 and [got[i] for i in range(5001)] == pytest.approx(list(want))


def test_rows_with_nulls_take_no_part(spark, data):
    schema = "c string, d int, a double, b double, y double"
    known = [tuple(r.values()) for r in data]
    holes = [("x", 1, None, 1.0, 5.0), ("y", 2, 1.0, 1.0, None)]
    both = [learning.code_columns(spark.createDataFrame(rows, schema), ["c", "d"], ["a", "b"]) for rows in (known, known + holes)]
    one, two = (listed(learning.linear_sgd_coded(c, c.rows, "y", 0.05)[0]) for c in both)
    assert [w for _, w in one] == pytest.approx([w for _, w in two])
    with pytest.raises(ValueError, match="no rows"):
        learning.linear_sgd_coded(both[0], both[0].rows.limit(0), "y", 0.05)


@pytest.mark.parametrize("few", [10_000, 0])
def test_indices_by_list_and_by_table(spark, monkeypatch, few):
    monkeypatch.setattr(learning, "FEW_LEVELS", few)
    rows = spark.createDataFrame([("b", 3), ("a", None), (None, 10), ("b", 3)], "c string, d int")
    got = listed(learning.with_indices(rows, ["c", "d"]).select("c", "d", "c_index", "d_index"))
    assert got == sorted([("b", 3, 1, 0), ("a", None, 0, 2), (None, 10, 2, 1), ("b", 3, 1, 0)], key=repr)



def test_tree_splits_where_the_variance_falls_most(spark):
    rng = random.Random(2)
    data = [(float(rng.randrange(6)), float(rng.randrange(8)), 0.0) for _ in range(300)]
    data = [(a, b, 10.0 * (a > 2) + 3.0 * (b > 4) + rng.random()) for a, b, _ in data]
    rows = learning.assemble(spark.createDataFrame(data, "a double, b double, y double"), ["a", "b"])
    stump = learning.tree_fit(rows, "y", depth=1)
    y = np.array([r[2] for r in data])

    def left_over(k, cut):
        side = np.array([r[k] <= cut for r in data])
        return sum(((part - part.mean()) ** 2).sum() for part in (y[side], y[~side]) if len(part))

    best = min(itertools.product((0, 1), range(8)), key=lambda c: left_over(*c))
    got = stump.transform(rows).select("a", "b", "y", "prediction").collect()
    side = np.array([r[best[0]] <= best[1] for r in got])
    for part in (side, ~side):
        want = np.mean([r["y"] for r, inside in zip(got, part) if inside])
        assert [r["prediction"] for r, inside in zip(got, part) if inside] == pytest.approx([want] * part.sum())


def test_deeper_trees_predict_the_mean_of_their_leaf(spark):
    rng = random.Random(8)
    data = [(float(rng.randrange(10)), float(rng.randrange(10))) for _ in range(400)]
    rows = learning.assemble(spark.createDataFrame([(a, b, a * b + rng.random()) for a, b in data], "a double, b double, y double"), ["a", "b"])
    errors = []
    for depth in (0, 1, 3, 5):
        model = learning.tree_fit(rows, "y", depth=depth)
        got = model.transform(rows).select("prediction", "y").collect()
        groups = {}
        for prediction, y in got:
            groups.setdefault(prediction, []).append(y)
        assert all(p == pytest.approx(np.mean(ys)) for p, ys in groups.items()) and model.depth <= depth
        errors.append(sum((p - y) ** 2 for p, y in got))
    assert errors == sorted(errors, reverse=True) and errors[-1] < errors[0] / 5
