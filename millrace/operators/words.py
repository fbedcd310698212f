"""Word counts, n-grams, vocabularies and concordances."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import tokens as tk
from millrace.operators.ordered import next_in_group, rank_top


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def tokens_of(df: DataFrame, text: str, tokenizer: Callable[[Column], Column] = tk.alnum_tokens,
              keep: Sequence[str] = (), name: str = "word") -> DataFrame:
    """One row per token, with the columns ``keep``."""
    return df.select(*keep, F.explode(tokenizer(F.col(text))).alias(name))


def word_count(df: DataFrame, text: str, tokenizer: Callable[[Column], Column] = tk.alnum_tokens) -> DataFrame:
    return count_by(tokens_of(df, text, tokenizer), "word")


def rule_words(df: DataFrame, text: str, rule: Callable[[Column], Column], name: str = "word") -> DataFrame:
    """One row per blank-separated token that the rule leaves something of.

    The rule runs inside the token array: a filter on an exploded column would make Spark run it twice.
    """
    def words(column: Column) -> Column:
        return F.array_remove(F.transform(tk.blank_tokens(column), rule), "")

    return tokens_of(df, text, words, name=name)


def fragment_word_count(df: DataFrame, text: str, stopwords: Sequence[str] = tuple(tk.STOPWORDS_V2)) -> DataFrame:
    """Count first fragments of blank-separated tokens, without stop words and the two reserved words."""
    words = rule_words(df, text, tk.first_fragment)
    return count_by(drop_words(words, "word", [*stopwords, *tk.RESERVED_WORDS]), "word")


def drop_words(df: DataFrame, word: str, stopwords: Sequence[str]) -> DataFrame:
    """Rows whose word is not in a fixed list. The list is a set inside the expression, no join is needed."""
    return df.filter(~F.col(word).isin(list(dict.fromkeys(stopwords))))


def recount(counts: DataFrame, normalize: Callable[[Column], Column], stopwords: Sequence[str],
            word: str = "word", n: str = "n") -> DataFrame:
    """Normalize already counted words and add the counts of words that become equal."""
    normal = F.array_remove(F.array(normalize(F.col(word))), "")
    merged = counts.select(F.explode(normal).alias("word"), F.col(n).alias("n"))
    return drop_words(merged, "word", stopwords).groupBy("word").agg(F.sum("n").alias("n"))


def top_words(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent words, ties by word."""
    return rank_top(counts, [F.desc("n"), F.asc("word")], k)


def frequency_of_frequency(counts: DataFrame) -> DataFrame:
    """How many words occur exactly n times."""
    return counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))


def bigrams(df: DataFrame, text: str, units: Callable[[Column], Column] = tk.sentences) -> DataFrame:
    """One row per adjacent word pair inside a unit (a sentence, or with ``tokens.lines`` a line)."""
    unit = df.select(F.explode(units(F.col(text))).alias("unit"))
    tokens = unit.select(tk.alnum_tokens(F.col("unit")).alias("tokens"))
    return tokens.select(F.inline(tk.neighbours(F.col("tokens"))))


def bigram_count(df: DataFrame, text: str, units: Callable[[Column], Column] = tk.sentences) -> DataFrame:
    return count_by(bigrams(df, text, units), "w1", "w2")


def pairs_with(pairs: DataFrame, word: str) -> DataFrame:
    """Pairs in which either whole word equals the given one."""
    return pairs.filter((F.col("w1") == word) | (F.col("w2") == word))


def token_table(df: DataFrame, doc: str, text: str,
                tokenizer: Callable[[Column], Column] = tk.alnum_tokens) -> DataFrame:
    """Corpus form: one row per document, position (from 0) and token."""
    return df.select(F.col(doc), F.posexplode(tokenizer(F.col(text))).alias("pos", "token"))


def adjacent_pairs(token_rows: DataFrame, doc: str) -> DataFrame:
    """Each token with its successor in the document, from the corpus form."""
    ahead = next_in_group(token_rows, [doc], "pos", "token", "w2")
    return ahead.filter(F.col("w2").isNotNull()).select(doc, "pos", F.col("token").alias("w1"), "w2")


def adjacent_pairs_of(df: DataFrame, doc: str, text: str, tokenizer: Callable[[Column], Column] = tk.alnum_tokens) -> DataFrame:
    """``adjacent_pairs`` from the documents themselves: the pairs of a document are inside one array, nothing moves."""
    tokens = df.select(F.col(doc), tokenizer(F.col(text)).alias("tokens"))
    each = tokens.select(doc, F.posexplode(tk.neighbours(F.col("tokens"))).alias("pos", "pair"))
    return each.select(doc, "pos", "pair.w1", "pair.w2")


def conditional_frequency(df: DataFrame, condition: str, tokens: Column, samples: Sequence[str]) -> DataFrame:
    """A condition x sample table of token counts, 0 where a sample is absent.

    Each row counts its own tokens, so nothing is exploded and a condition without any sample keeps its row.
    """
    per_row = [
        (F.size(tokens) - F.size(F.array_remove(tokens, s))).cast("bigint").alias(s)
        for s in samples
    ]
    counted = df.select(condition, *per_row)
    return counted.groupBy(condition).agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in samples])


def concordance(df: DataFrame, doc: str, tokens: Column, word: str, width: int = 79, lines: int = 25) -> DataFrame:
    """Keyword in context: the first ``lines`` matches of each document and its number of matches.

    The context is the last / first ``(width - len(word) - 2) // 2`` characters of the neighbouring
    tokens joined by blanks; matching ignores case.
    """
    half = (width - len(word) - 2) // 2
    reach = half // 2 + 1  # a token and its blank take two characters at least
    tokenized = df.select(F.col(doc), tokens.alias("tokens"))
    found = tokenized.select(
        doc, "tokens",
        F.filter(F.transform("tokens", lambda t, i: F.when(F.lower(t) == word.lower(), i)),
                 lambda i: i.isNotNull()).alias("hits"))

    def line(at: Column, nr: Column) -> Column:
        start = F.greatest(at - reach, F.lit(0))
        before = F.array_join(F.slice("tokens", start + 1, at - start), " ")
        after = F.array_join(F.slice("tokens", at + 2, F.lit(reach)), " ")
        return F.struct(
            (nr + 1).cast("bigint").alias("line"),
            F.size("hits").cast("bigint").alias("matches"),
            F.right(F.concat(F.lit(" " * half), before), F.lit(half)).alias("left_context"),
            F.get("tokens", at).alias("keyword"),
            F.left(after, F.lit(half)).alias("right_context"),
        )

    return found.select(doc, F.inline(F.transform(F.slice("hits", 1, lines), line)))
