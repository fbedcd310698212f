"""Text queries over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import tokens as tk
from millrace.operators import words as w
from millrace.operators.ordered import global_rank, rank_top
from millrace.plans.registry import plan

# SQL building blocks shared by the DuckDB twins.
ALNUM = "list_filter(string_split_regex(lower(regexp_replace({t}, '[^a-zA-Z0-9]', ' ', 'g')), ' +'), lambda x: x <> '')"
BLANK = r"list_filter(string_split_regex({t}, '[ \t\n\r\f]+'), lambda x: x <> '')"
FRAGMENT = r"regexp_extract(lower({t}), '([^.,;:$%&''+/*#\-?!\"\[\](){{}}0-9_]+)', 1)"
FRAGMENT_V2 = r"lower(regexp_extract({t}, '([^.,;:*\-?!\"\[\](){{}}_]*[^.,;:*\-?!\"\[\](){{}}_\x00-\x20][^.,;:*\-?!\"\[\](){{}}_]*)', 1))"


def quoted(words) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in dict.fromkeys(words))


DOC_ALNUM = ALNUM.format(t="text")
WORDS = f"SELECT unnest({DOC_ALNUM}) AS word FROM documents"
COUNTS = f"SELECT word, count(*) AS n FROM ({WORDS}) GROUP BY word"
RAW_TOKENS = f"SELECT unnest({BLANK.format(t='text')}) AS token FROM documents"
RAW_COUNTS = f"SELECT token, count(*) AS n FROM ({RAW_TOKENS}) GROUP BY token"
FRAGMENTS = f"SELECT {FRAGMENT.format(t='token')} AS word FROM ({RAW_TOKENS})"
FRAGMENT_COUNTS = (
    f"SELECT word, count(*) AS n FROM ({FRAGMENTS}) WHERE word <> '' "
    f"AND word NOT IN ({quoted([*tk.STOPWORDS_V2, *tk.RESERVED_WORDS])}) GROUP BY word"
)


def pairs_sql(units: str) -> str:
    return f"""
        WITH u AS (SELECT unnest({units}) AS unit FROM documents),
             t AS (SELECT {ALNUM.format(t='unit')} AS tk FROM u),
             p AS (SELECT tk, unnest(range(1, len(tk))) AS i FROM t WHERE len(tk) > 1)
        SELECT tk[i] AS w1, tk[i + 1] AS w2 FROM p"""


SENTENCE_PAIRS = pairs_sql("string_split_regex(text, '[.?!]')")
LINE_PAIRS = pairs_sql(r"string_split(text, E'\n')")
PAIR_COUNTS = f"SELECT w1, w2, count(*) AS n FROM ({SENTENCE_PAIRS}) GROUP BY w1, w2"


@plan(COUNTS)
def word_count(t):
    return w.word_count(t.texts("text"), "text")


@plan(COUNTS)
def tok_alnum(t):
    return w.count_by(w.tokens_of(t.texts("text"), "text", tk.alnum_tokens), "word")


@plan(f"SELECT word, count(*) AS n FROM ({FRAGMENTS}) WHERE word <> '' GROUP BY word")
def tok_first_fragment(t):
    return w.count_by(w.rule_words(t.texts("text"), "text", tk.first_fragment), "word")


@plan(f"SELECT word, count(*) AS n FROM (SELECT {FRAGMENT_V2.format(t='token')} AS word FROM ({RAW_TOKENS})) "
      "WHERE word <> '' GROUP BY word")
def tok_first_fragment_v2(t):
    return w.count_by(w.rule_words(t.texts("text"), "text", tk.first_fragment_v2), "word")


@plan(f"SELECT word, count(*) AS n FROM (SELECT lower(regexp_extract(token, '^([a-zA-Z]+)', 1)) AS word "
      f"FROM ({RAW_TOKENS})) WHERE word <> '' GROUP BY word")
def tok_alpha_prefix(t):
    return w.count_by(w.rule_words(t.texts("text"), "text", tk.alpha_prefix), "word")


@plan("SELECT doc_id, s AS sentence FROM (SELECT doc_id, unnest(string_split_regex(text, '[.?!]')) AS s FROM documents)")
def split_sentences(t):
    return t.documents.select("doc_id", F.explode(tk.sentences(F.col("text"))).alias("sentence"))


@plan(FRAGMENT_COUNTS)
def word_count_fragments(t):
    return w.fragment_word_count(t.texts("text"), "text")


@plan(f"SELECT word, n FROM ({COUNTS}) WHERE word NOT IN ({quoted(tk.STOPWORDS)})")
def filter_stopwords(t):
    return w.drop_words(w.word_count(t.texts("text"), "text"), "word", tk.STOPWORDS)


@plan(f"SELECT word, n FROM ({COUNTS}) WHERE word NOT IN ({quoted(tk.STOPWORDS_V2)})")
def filter_stopwords_v2(t):
    return w.drop_words(w.word_count(t.texts("text"), "text"), "word", tk.STOPWORDS_V2)


@plan(f"""SELECT word, CAST(sum(n) AS BIGINT) AS n
      FROM (SELECT {FRAGMENT_V2.format(t='token')} AS word, n FROM ({RAW_COUNTS}))
      WHERE word <> '' AND word NOT IN ({quoted(tk.STOPWORDS)}) GROUP BY word""")
def reaggregate_counts(t):
    raw = w.count_by(w.tokens_of(t.texts("text"), "text", tk.blank_tokens), "word")
    return w.recount(raw, tk.first_fragment_v2, tk.STOPWORDS)


@plan(f"""SELECT word, CAST(sum(n) AS BIGINT) AS n
      FROM (SELECT lower(regexp_extract(token, '^([a-zA-Z]+)', 1)) AS word, n FROM ({RAW_COUNTS}))
      WHERE word <> '' AND word NOT IN ({quoted(tk.STOPWORDS)}) GROUP BY word""")
def reaggregate_counts_prefix(t):
    raw = w.count_by(w.tokens_of(t.texts("text"), "text", tk.blank_tokens), "word")
    return w.recount(raw, tk.alpha_prefix, tk.STOPWORDS)


@plan(f"SELECT n, count(*) AS words FROM ({COUNTS}) GROUP BY n")
def freq_of_freq(t):
    return w.frequency_of_frequency(w.word_count(t.texts("text"), "text"))


@plan(f"SELECT n, count(*) AS words FROM ({FRAGMENT_COUNTS}) GROUP BY n")
def chained_jobs(t):
    return w.fragment_word_count(t.texts("text"), "text").transform(w.frequency_of_frequency)


@plan(PAIR_COUNTS)
def bigram_count(t):
    return w.bigram_count(t.texts("text"), "text")


@plan(f"SELECT w1, w2, count(*) AS n FROM ({LINE_PAIRS}) GROUP BY w1, w2")
def bigram_count_line(t):
    return w.bigram_count(t.texts("text"), "text", tk.lines)


@plan(f"SELECT count(*) AS pairs, CAST(sum(n) AS BIGINT) AS occurrences FROM ({PAIR_COUNTS})")
def bigram_total(t):
    counted = w.bigram_count(t.texts("text"), "text")
    return counted.agg(F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("occurrences"))


@plan(f"SELECT w1, w2, n FROM ({PAIR_COUNTS}) WHERE w1 = 'with' OR w2 = 'with'")
def filter_token_equals(t):
    return w.pairs_with(w.bigram_count(t.texts("text"), "text"), "with")


PAIRS = f"""
    WITH t AS (SELECT doc_id, {DOC_ALNUM} AS tk FROM documents),
         p AS (SELECT doc_id, tk, unnest(range(1, len(tk))) AS i FROM t WHERE len(tk) > 1)
    SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, tk[i] AS w1, tk[i + 1] AS w2 FROM p"""


@plan(PAIRS)
def adjacent_pairs(t):
    return w.adjacent_pairs_of(t.texts("doc_id", "text"), "doc_id", "text")


@plan(PAIRS)
def adjacent_pairs_of_rows(t):
    """The same from the corpus form, one row per token."""
    return w.adjacent_pairs(w.token_table(t.texts("doc_id", "text"), "doc_id", "text"), "doc_id")


@plan(f"SELECT count(*) AS total FROM ({COUNTS}) WHERE lower(word) LIKE 't%' AND length(word) >= 4 AND n > 25")
def filter_like_length(t):
    counts = w.word_count(t.texts("text"), "text")
    kept = counts.filter(F.lower("word").like("t%") & (F.length("word") >= 4) & (F.col("n") > 25))
    return kept.agg(F.count(F.lit(1)).alias("total"))


@plan(f"SELECT word, n FROM ({COUNTS}) WHERE length(word) > 7 AND n > 85")
def filter_long_frequent_words(t):
    counts = w.word_count(t.texts("text"), "text")
    return counts.filter((F.length("word") > 7) & (F.col("n") > 85))


@plan(f"""SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS rank
      FROM ({COUNTS}) WHERE length(word) > 7""")
def rank_words_by_freq(t):
    counts = w.word_count(t.texts("text"), "text").filter(F.length("word") > 7)
    return global_rank(counts, [F.desc("n"), F.asc("word")])


# Column names that differ only in case would collide, so the case-sensitive table uses its own samples.
CASED = ["The", "and", "That", "with", "zebra"]


@plan("SELECT source, " + ", ".join(
    f"CAST(sum(len(list_filter(tk, lambda x: x = '{s}'))) AS BIGINT) AS \"{s}\"" for s in CASED)
    + f" FROM (SELECT source, {BLANK.format(t='text')} AS tk FROM documents) GROUP BY source")
def cond_freq_table(t):
    return w.conditional_frequency(t.texts("source", "text"), "source", tk.blank_tokens(F.col("text")), CASED)


@plan("SELECT source, " + ", ".join(
    f"CAST(sum(len(list_filter(tk, lambda x: x = '{s.lower()}'))) AS BIGINT) AS \"{s.lower()}\"" for s in CASED)
    + f" FROM (SELECT source, {BLANK.format(t='lower(text)')} AS tk FROM documents) GROUP BY source")
def cond_freq_table_folded(t):
    return w.conditional_frequency(
        t.texts("source", "text"), "source", tk.blank_tokens(F.lower("text")), [s.lower() for s in CASED])


@plan(f"""
    WITH t AS (SELECT doc_id, {BLANK.format(t='text')} AS tk FROM documents),
         h AS (SELECT doc_id, tk, list_filter(range(1, len(tk) + 1), lambda i: lower(tk[i]) = 'with') AS hits FROM t),
         s AS (SELECT doc_id, tk, CAST(len(hits) AS BIGINT) AS matches,
                      unnest(hits[1:25]) AS i, unnest(range(1, least(len(hits), 25) + 1)) AS line
               FROM h WHERE len(hits) > 0)
    SELECT doc_id, line, matches,
           right(repeat(' ', 36) || array_to_string(tk[1:i - 1], ' '), 36) AS left_context,
           tk[i] AS keyword,
           left(array_to_string(tk[i + 1:len(tk)], ' '), 36) AS right_context
    FROM s""")
def kwic_concordance(t):
    return w.concordance(t.texts("doc_id", "text"), "doc_id", tk.blank_tokens(F.col("text")), "with")


@plan(f"SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS rank FROM ({COUNTS}) ORDER BY rank LIMIT 20")
def top_k(t):
    return w.top_words(w.word_count(t.texts("text"), "text"), 20)


@plan(f"""SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS rank
      FROM (SELECT word, CAST(sum(n) AS BIGINT) AS n
            FROM (SELECT {FRAGMENT_V2.format(t='token')} AS word, n FROM ({RAW_COUNTS}))
            WHERE word <> '' AND word NOT IN ({quoted(tk.STOPWORDS)}) GROUP BY word)
      ORDER BY rank LIMIT 200""")
def top_k_reaggregated(t):
    raw = w.count_by(w.tokens_of(t.texts("text"), "text", tk.blank_tokens), "word")
    return w.top_words(w.recount(raw, tk.first_fragment_v2, tk.STOPWORDS), 200)


@plan(f"SELECT w1, w2, n, row_number() OVER (ORDER BY n DESC, w1, w2) AS rank FROM ({PAIR_COUNTS}) ORDER BY rank LIMIT 20")
def top_k_bigrams(t):
    return rank_top(w.bigram_count(t.texts("text"), "text"), [F.desc("n"), F.asc("w1"), F.asc("w2")], 20)


@plan(f"SELECT word, n, row_number() OVER (ORDER BY word) AS rank FROM ({COUNTS})")
def sort_by_key(t):
    return global_rank(w.word_count(t.texts("text"), "text"), [F.asc("word")])


@plan(f"SELECT n, word, row_number() OVER (ORDER BY n DESC, word) AS rank FROM ({FRAGMENT_COUNTS})")
def sort_by_count_desc(t):
    counts = w.fragment_word_count(t.texts("text"), "text").select("n", "word")
    return global_rank(counts, [F.desc("n"), F.asc("word")])


@plan(f"""SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS rank
      FROM (SELECT word, CAST(sum(n) AS BIGINT) AS n
            FROM (SELECT {FRAGMENT_V2.format(t='token')} AS word, n FROM ({RAW_COUNTS}))
            WHERE word <> '' AND word NOT IN ({quoted(tk.STOPWORDS)}) GROUP BY word)""")
def sort_count_desc_word_asc(t):
    raw = w.count_by(w.tokens_of(t.texts("text"), "text", tk.blank_tokens), "word")
    return global_rank(w.recount(raw, tk.first_fragment_v2, tk.STOPWORDS), [F.desc("n"), F.asc("word")])


@plan(f"SELECT n, word FROM ({FRAGMENT_COUNTS})")
def swap_key_value(t):
    return w.fragment_word_count(t.texts("text"), "text").select("n", "word")
