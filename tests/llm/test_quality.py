"""Quality rules: base columns against a plain count, planted junk against clean texts, and the determinant against numpy."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string"


def clean(rng, n):
    words = [f"w{rng.randrange(900):03d}" for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", "\n"]) for w in words)


@pytest.fixture(scope="module")
def table():
    rng = random.Random(1)
    rows = [(i, clean(rng, rng.randrange(120, 400)), "en", "web") for i in range(400)]
    rows += [(600 + i, clean(rng, rng.randrange(120, 400)), None, None) for i in range(80)]
    for k, share in enumerate((0.0, 0.1, 0.3, 0.6)):
        words = clean(rng, 200).split()
        rows.append((1000 + k, " ".join(w + ("#" if i < share * 200 else "") for i, w in enumerate(words)), "en", "web"))
    line = "the same line of words again\n"
    rows += [(2000, clean(rng, 150) + "\n" + "".join(f"{line[:-1]}\n" if i % 2 else f"x{i} y{i}\n" for i in range(300)), "en", "web"),
             (2001, "".join(w.upper() + " " for w in clean(rng, 200).split()), "en", "web"),
             (3000, None, "en", "web"), (3001, "", None, "web"), (3002, "a b c " * 60, "en", None), (3003, clean(rng, 100), "rare", "few"),
             (3004, clean(rng, 40_000), "en", "web"), (3005, " #\n\n#\n\x85", "en", "web")]
    return rows + [rows[0]] * 3


@pytest.fixture(scope="module")
def judged(spark, table):
    docs = spark.createDataFrame(table, SCHEMA).selectExpr("*", *[f"'clash' AS {c}" for c in quality.ADDED], "7 AS other")
    return [r.asDict() for r in quality.judge(docs).collect()]


def test_base_columns(table, judged):
    def plain(text):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again),
                len(words) < 50 or 100 * len(again) > 50 * len(words))

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r["doc_id"], *(r[c] for c in names)) for r in judged) == Counter((i, *plain(t)) for i, t, _, _ in table)


def test_planted_junk_goes_and_clean_texts_stay(judged):
    kept = {r["doc_id"]: r["kept"] for r in judged}
    assert kept[1000] and kept[1001] and not kept[1002] and not kept[1003]
    assert not kept[2000] and not kept[2001] and not kept[3000] and not kept[3001] and not kept[3002]
    plain = [r for r in judged if r["doc_id"] < 1000]
    assert sum(r["kept"] for r in plain) / len(plain) > 0.99
    assert len({r["kept"] for r in judged if r["doc_id"] == 0}) == 1
    distance = {r["doc_id"]: r["distance2"] for r in judged}
    assert distance[1000] < distance[1001] < distance[1002] < distance[1003]


def test_small_and_empty_tables(spark, table):
    few = spark.createDataFrame(table[:20], SCHEMA)
    got = quality.judge(few).collect()
    assert len(got) == 20 and all(r.distance2 is None and r.kept != r.base_failed for r in got)
    assert quality.judge(few.limit(0)).count() == 0


def test_steps_lower_the_determinant(spark):
    """Outliers in a third of a group do not move the estimate, which ends where the nearest rows stay the nearest."""
    rng = np.random.default_rng(3)
    names = list(quality.VECTOR)
    good = rng.normal(0, 1, (600, 6)) @ np.diag([2.0, 1.5, 1.0, 1.0, 1.0, 3.0])
    bad = rng.normal(12, 1, (130, 6))
    rows = [(i, False, *map(float, v)) for i, v in enumerate(np.vstack([good, bad]))]
    frame = spark.createDataFrame(rows, "id int, base_failed boolean, " + ", ".join(f"{n} double" for n in names))
    frame = frame.withColumn("fit_group", F.struct(F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source")))
    d2 = np.array([r.distance2 for r in quality.mcd(frame).orderBy("id").collect()])
    assert d2[600:].min() > 3 * np.median(d2[:600]) and (d2[600:] > quality.CUT).all() and (d2[:600] > quality.CUT).mean() < 0.02
    x = np.vstack([good, bad])
    inner = x[np.argsort(d2, kind="stable")[: int(0.75 * len(x))]]
    centre, spread = inner.mean(axis=0), np.cov(inner.T, bias=True)
    again = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(spread), x - centre)
    assert np.corrcoef(again, d2)[0, 1] > 0.999
    longer = np.array([r.distance2 for r in quality.mcd(frame, steps=9).orderBy("id").collect()])
    assert np.abs(longer / d2 - 1).max() < 0.02
