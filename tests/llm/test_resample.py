"""Importance resampling against a plain computation: nulls, ties, repeated rows, hot keys, longer grams, empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from millrace.llm import resample
from millrace.session import freeze

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, grams):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, grams, buckets, percent, least, seed=2024):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    s, t = (Counter(bucket(f) for text in texts for f in features(text, grams)) for texts in ([x for _, x in docs], target))
    total_s, total_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for doc_id, text in docs:
        found = features(text, grams)
        weight = sum(math.floor(1000 * math.log(float(t[b] + 1) * total_s / (float(s[b] + 1) * total_t))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    can = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = [(*r, i + 1) for i, r in enumerate(can[: len(can) * percent // 100])]
    rest = Counter(rows) - Counter(r[:4] for r in drawn)
    return sorted(drawn + [(*r, None) for r in rest.elements()], key=repr)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(9)
    words = ["the", "The", "ÉTÉ", "été", "漢字", "fox", "x9", "ſ", "K", "lazy", "dog's", "\x85", "\x00nul"]
    table = [(i if i % 11 else None, " ".join(rng.choice(words) for _ in range(rng.randrange(12)))) for i in range(240)]
    table += [(5, None), (6, ""), (7, "1!"), (1000, "fox " * 3000)]
    return table + [(3, "the lazy fox the lazy fox")] * 60 + [(None, "the lazy fox the lazy fox")] * 60


@pytest.mark.parametrize("grams,percent,step", [(1, 10, 1), (3, 60, 3), (1, 100, 16)])
def test_against_a_plain_computation(spark, docs, monkeypatch, grams, percent, step):
    monkeypatch.setattr(resample, "OVERSAMPLE", step)
    monkeypatch.setattr(resample, "PIECE", 64)
    target = ["a lazy dog", None, "été fox"]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'clash' AS score", "1 AS rank", "0 AS _run")
    got = resample.resample(frame.repartition(7), spark.createDataFrame([(t,) for t in target], "text string"),
                            percent, 4, grams=grams, buckets=50)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, target, grams, 50, percent, 4)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(none, none).collect() == []
    got = resample.resample(spark.createDataFrame(docs, none.schema), none.select("text"), least=2)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, [], 1, resample.BUCKETS, 10, 2)


def test_segments_are_even_with_a_hot_key(spark):
    rows = spark.range(30_000).selectExpr("IF(id % 3 = 0, NULL, id) AS doc_id", "20L AS n_features", "0L AS weight",
                                          "IF(id % 3 = 0, 5L, id % 1000) AS score")
    placed = resample.draw(rows.repartition(6), percent=50)
    assert placed.where("rank IS NOT NULL").selectExpr("count(DISTINCT rank)", "max(rank)").first()[:] == (15_000, 15_000)
    keyed = rows.selectExpr("*", "-score AS _less", "doc_id IS NULL AS _none").repartition(6)
    runs = freeze(keyed.sortWithinPartitions("_less", "_none", "doc_id").selectExpr(
        "*", "spark_partition_id() AS _run", "monotonically_increasing_id() & 8589934591 AS _slot"))
    sizes = [r["count"] for r in resample.in_segments(runs, resample.splitters(runs, 30_000, 8)).groupBy("_segment").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 3 * 30_000 / 8
