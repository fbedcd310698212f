"""The license scan against a plain search for the phrases, and on notices with words added, lost and changed."""

import random
import re

import pytest

from millrace.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def base(text):
    words = WORD.findall(lower(text))
    found = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
             if words[i : i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in found]
    return (len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({label for _, label in found})))


def notice(label):
    return max((b" ".join(t.words).decode() for t in licenses.NOTICES if t.label == label), key=len)


@pytest.fixture(scope="module")
def table():
    rng = random.Random(4)
    bits = ["under", "the", "MIT", "license", "License,", "Apache", "version", "2", "2.0", "CC", "BY-NC", "by", "nc", "é", "漢字", "ſ", "K", "\n", "x"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(150)]
    texts += [None, "", " \t", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0 " * 3,
              "cc by nc by nc cc by nc", "under the mİt license", "x " * 60_000 + "CC-BY-NC"]
    return [(i % 140 if i % 9 else None, t) for i, t in enumerate(texts)] + [(7, "CC BY NC")] * 3


def test_base_against_a_search(spark, table):
    docs = spark.createDataFrame(table, "doc_id long, text string").selectExpr("*", "'clash' AS words", "0 AS row", "'x' AS labels")
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(docs).collect()]
    assert sorted(got, key=repr) == sorted([(i, *base(t)) for i, t in table], key=repr)
    assert licenses.scan(docs.limit(0)).collect() == []


def test_notices(spark):
    mit, gpl = notice("mit").split(), notice("gpl").split()
    rng = random.Random(2)
    filler = [f"w{rng.randrange(500)}" for _ in range(400)]
    changed = list(mit)
    changed[10], changed[30] = "other", "words"
    cases = {
        1: filler + mit + filler,
        2: filler + mit[:20] + ["new", "words"] + mit[20:] + filler,
        3: filler + mit[:15] + mit[17:] + filler,
        4: filler + changed + filler,
        5: filler + mit[:12] + filler,
        6: mit[::-1] + filler,
        7: filler + gpl + mit + filler,
        8: filler + ["this", "work", "is", "licensed", "under", "the", "gnu", "general", "public", "license", "version", "3"],
        9: filler,
    }
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in cases.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert {i: got[i].labels for i in cases} == {1: "mit", 2: "mit", 3: "mit", 4: "mit", 5: "", 6: "", 7: "gpl,mit", 8: "gpl,gpl-3", 9: ""}
    assert got[1].score == 1.0 and [tuple(s)[:3] for s in got[1].spans] == [("mit", 400, 400 + len(mit) - 1)]
    assert [tuple(s)[1:3] for s in got[2].spans] == [(400, 400 + len(mit) + 1)]
    assert got[4].score == pytest.approx(1 - 2 / len(mit)) and got[5].score == 0.0 and got[8].n_base == 0


def test_votes_join_every_gram(spark):
    each = licenses.template("x", "a b a b a b c")
    got = licenses.votes(spark.createDataFrame([(5, "z a b a b a b c")], "row long, text string"), (each,)).collect()
    assert {r.diagonal: r.votes for r in got} == {1: 5, 3: 2, -1: 2}
