from collections import Counter

import pytest
from conftest import listed
from pyspark.sql import functions as F

from millrace.functions import tokens as tk
from millrace.operators import words as w

TEXT = ["It's half-past 9. Don't stop!\nthe well-known (mill) race", "", None, "  Stop? the END of the 3rd race."]


@pytest.fixture
def docs(rows):
    return rows(list(enumerate(TEXT)), "doc int, text string")


def tokens(rows, tokenizer, text):
    return rows([(text,)], "t string").select(tokenizer(F.col("t"))).first()[0]


@pytest.mark.parametrize("text, expected", [
    ("Don't STOP", ["don", "t", "stop"]), ("", []), (" \t ", []), ("a1-b2", ["a1", "b2"]),
    ("naïve KİT", ["na", "ve", "k", "t"]), ("x\ny", ["x", "y"]),
])
def test_alnum_tokens(rows, text, expected):
    assert tokens(rows, tk.alnum_tokens, text) == expected


@pytest.mark.parametrize("token, first, second, prefix", [
    ("well-known", "well", "well", "well"), ("can't", "can", "can't", "can"), ("--Dash", "dash", "dash", ""),
    ("...", "", "", ""), ("3rd", "rd", "3rd", ""), ("R&D", "r", "r&d", "r"), ("(Mill)", "mill", "mill", ""),
])
def test_fragments(rows, token, first, second, prefix):
    row = rows([(token,)], "t string").select(tk.first_fragment(F.col("t")), tk.first_fragment_v2(F.col("t")),
                                              tk.alpha_prefix(F.col("t"))).first()
    assert tuple(row) == (first, second, prefix)


def test_second_fragment_rule_skips_blank_pieces(rows):
    assert rows([(". .Word-x",)], "t string").select(tk.first_fragment_v2(F.col("t"))).first()[0] == "word"


def test_word_count(docs):
    expected = Counter("it s half past 9 don t stop the well known mill race stop the end of the 3rd race".split())
    assert dict(listed(w.word_count(docs, "text"))) == expected


def test_fragment_word_count_drops_stop_and_reserved_words(rows):
    docs = rows([("the unknown Mill stopwords mill, can't www",)], "text string")
    assert listed(w.fragment_word_count(docs, "text")) == [("can", 1), ("mill", 2)]


def test_recount_adds_counts_of_equal_words(rows):
    counts = rows([("said,", 3), ("Said", 4), ("can't", 9), ("--", 5)], "word string, n bigint")
    assert listed(w.recount(counts, tk.first_fragment_v2, tk.STOPWORDS)) == [("said", 7)]


def test_bigrams_stop_at_sentence_ends_but_not_at_line_ends(rows):
    docs = rows([("one two. three\nfour",)], "text string")
    assert listed(w.bigrams(docs, "text")) == [("one", "two"), ("three", "four")]
    assert listed(w.bigrams(docs, "text", tk.lines)) == [("one", "two"), ("two", "three")]


def test_bigrams_of_one_token_are_none(rows):
    assert listed(w.bigrams(rows([("one",), ("",), (None,)], "text string"), "text")) == []


def test_adjacent_pairs_equal_the_array_form(rows):
    docs = rows([(1, "a b a b c"), (2, "solo"), (3, "x y")], "doc int, text string")
    pairs = w.adjacent_pairs(w.token_table(docs, "doc", "text"), "doc").select("w1", "w2")
    assert listed(w.adjacent_pairs(w.token_table(docs, "doc", "text"), "doc")) == listed(w.adjacent_pairs_of(docs, "doc", "text"))
    one_unit = docs.select(F.inline(tk.neighbours(F.split("text", " "))))
    assert listed(pairs) == listed(one_unit)


def test_pairs_with_whole_word(rows):
    pairs = rows([("to", "heaven"), ("heavenly", "host"), ("heaven", "s")], "w1 string, w2 string")
    assert listed(w.pairs_with(pairs, "heaven")) == [("heaven", "s"), ("to", "heaven")]


def test_frequency_of_frequency_adds_up(docs):
    counts = w.word_count(docs, "text")
    histogram = w.frequency_of_frequency(counts)
    total = counts.agg(F.sum("n")).first()[0]
    assert histogram.agg(F.sum(F.col("n") * F.col("words"))).first()[0] == total == 20


def test_conditional_frequency_has_zeros_and_all_conditions(rows):
    docs = rows([("a", "can may can"), ("a", "Can"), ("b", ""), ("c", None)], "file string, text string")
    table = w.conditional_frequency(docs, "file", tk.blank_tokens(F.col("text")), ["can", "may", "will"])
    assert listed(table) == [("a", 2, 1, 0), ("b", 0, 0, 0), ("c", 0, 0, 0)]


def test_concordance_context_width_and_limit(rows):
    words = [f"w{i}" for i in range(60)]
    words[0], words[30], words[59] = "May", "may", "MAY"
    docs = rows([(1, " ".join(words)), (2, "none")], "doc int, text string")
    lines = w.concordance(docs, "doc", tk.blank_tokens(F.col("text")), "may", lines=2).orderBy("line").collect()
    assert [(r["line"], r["matches"], r["keyword"]) for r in lines] == [(1, 3, "May"), (2, 3, "may")]
    assert lines[0]["left_context"] == " " * 37
    assert lines[1]["left_context"] == " ".join(words[11:30])[-37:]
    assert lines[1]["right_context"] == " ".join(words[31:49])[:37]


def test_concordance_fills_its_width_with_one_letter_words(rows):
    docs = rows([(1, " ".join(["x"] * 60 + ["may"] + ["y"] * 60))], "doc int, text string")
    line = w.concordance(docs, "doc", tk.blank_tokens(F.col("text")), "may").first()
    assert line["left_context"] == (" ".join("x" * 60))[-37:] and line["right_context"] == (" ".join("y" * 60))[:37]
