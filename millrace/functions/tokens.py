"""Tokenizers as column expressions: text in, array of lower-case tokens out, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiter sets and stop-word lists that results depend on.
FRAGMENT_DELIMITERS = r".,;:$%&'+/*#\-?!\"\[\](){}0-9_"
FRAGMENT_DELIMITERS_V2 = r".,;:*\-?!\"\[\](){}_"
SENTENCE_END = "[.?!]"
BLANKS = "[ \\t\\n\\r\\f]+"
STOPWORDS = (
    "the a an and or of to about above after all are be but he she by can't for do i "
    "has don't her is in our his with that you it was on him"
).split()
STOPWORDS_V2 = (
    "i a an and or of to about above after all are be but he she by can't for do i "
    "has don't her is in our his with that you it was on him "
    "as at com from how on the this what when where who will www "
    "not only other off me your my we so no up until hasn't which"
).split()
RESERVED_WORDS = ["stopwords", "unknown"]


def blank_tokens(text: Column) -> Column:
    """Pieces between blanks, punctuation kept."""
    return F.array_remove(F.split(text, BLANKS), "")


def alnum_tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits: ``don't`` gives ``don`` and ``t``."""
    return F.transform(F.regexp_extract_all(text, F.lit("([a-zA-Z0-9]+)"), F.lit(1)), F.lower)


def sentences(text: Column) -> Column:
    """Text cut at each full stop, question mark and exclamation mark."""
    return F.split(text, SENTENCE_END)


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def first_fragment(token: Column) -> Column:
    """First run of a lower-cased token that holds no delimiter; '' when there is none."""
    return F.regexp_extract(F.lower(token), f"([^{FRAGMENT_DELIMITERS}]+)", 1)


def first_fragment_v2(token: Column) -> Column:
    """As ``first_fragment`` with the smaller delimiter set, skipping blank runs; lower-cased last."""
    d = FRAGMENT_DELIMITERS_V2
    return F.lower(F.regexp_extract(token, rf"([^{d}]*[^{d}\x00-\x20][^{d}]*)", 1))


def alpha_prefix(token: Column) -> Column:
    """Leading ASCII letters, lower-cased; '' when the token starts with anything else."""
    return F.lower(F.regexp_extract(token, "^([a-zA-Z]+)", 1))


def neighbours(tokens: Column) -> Column:
    """Array of (w1, w2) pairs of adjacent tokens; empty below two tokens.

    ``tokens`` is used several times, so pass a column of an earlier select rather than an expression.
    """
    last = F.greatest(F.size(tokens) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(tokens, F.lit(1), last).alias("w1"), F.slice(tokens, F.lit(2), last).alias("w2"))
    return pairs.cast("array<struct<w1:string,w2:string>>")
