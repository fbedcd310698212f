"""Join queries: vocabularies of English against other documents, suppliers over parts, lookups, lexicons."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import joins as j
from millrace.operators.ordered import rank_top
from millrace.operators.words import word_count
from millrace.plans.registry import plan
from millrace.plans.words import DOC_ALNUM


def vocabularies(t):
    texts = t.texts("lang", "text")
    english, other = texts.filter(F.col("lang") == "en"), texts.filter(F.col("lang") != "en")
    return word_count(english, "text"), word_count(other, "text")


def _vocabulary_sql(name: str, condition: str) -> str:
    return (f"{name} AS (SELECT word, count(*) AS n FROM (SELECT unnest({DOC_ALNUM}) AS word FROM documents "
            f"WHERE {condition}) GROUP BY word)")


IS_EN = "lang = 'en'"
NOT_EN = "lang <> 'en'"
BOTH = f"WITH {_vocabulary_sql('s', IS_EN)}, {_vocabulary_sql('k', NOT_EN)} "
MERGED = "SELECT coalesce(s.word, k.word) AS word, s.n AS left_n, k.n AS right_n FROM s FULL JOIN k ON s.word = k.word"


@plan(BOTH + "SELECT count(*) AS words FROM s JOIN k ON s.word = k.word")
def join_inner_count(t):
    left, right = vocabularies(t)
    return left.join(right, "word").agg(F.count(F.lit(1)).alias("words"))


@plan(BOTH + MERGED)
def join_full_outer_merge(t):
    return j.merge_vocabularies(*vocabularies(t))


@plan(BOTH + f"SELECT count(word) AS merged, count(left_n) AS in_left, count(right_n) AS in_right FROM ({MERGED})")
def count_non_null(t):
    merged = j.merge_vocabularies(*vocabularies(t))
    return merged.agg(F.count("word").alias("merged"), F.count("left_n").alias("in_left"),
                      F.count("right_n").alias("in_right"))


@plan(BOTH + "SELECT s.word, s.n FROM s LEFT JOIN k ON s.word = k.word WHERE k.word IS NULL")
def join_left_outer_null(t):
    return j.only_in_left(*vocabularies(t))


@plan(BOTH + "SELECT word, n FROM s WHERE word NOT IN (SELECT word FROM k)")
def join_left_anti(t):
    left, right = vocabularies(t)
    return left.join(right, "word", "left_anti")


@plan(BOTH + """SELECT s.word, s.n, row_number() OVER (ORDER BY s.n DESC, s.word) AS rank
      FROM s LEFT JOIN k ON s.word = k.word WHERE k.word IS NULL ORDER BY rank LIMIT 10""")
def join_left_only_top(t):
    return rank_top(j.only_in_left(*vocabularies(t)), [F.desc("n"), F.asc("word")], 10)


@plan(BOTH + "SELECT k.word, k.n FROM s RIGHT JOIN k ON s.word = k.word WHERE s.word IS NULL")
def join_right_outer_null(t):
    return j.only_in_right(*vocabularies(t))


@plan(BOTH + """SELECT k.word, k.n, row_number() OVER (ORDER BY k.n DESC, k.word) AS rank
      FROM s RIGHT JOIN k ON s.word = k.word WHERE s.word IS NULL ORDER BY rank LIMIT 10""")
def join_right_only_top(t):
    return rank_top(j.only_in_right(*vocabularies(t)), [F.desc("n"), F.asc("word")], 10)


@plan(BOTH + f"""SELECT count_if(right_n IS NULL) AS left_only, count_if(left_n IS NULL) AS right_only,
             count_if(left_n IS NOT NULL AND right_n IS NOT NULL) AS in_both FROM ({MERGED})""")
def join_anti_via_merged(t):
    merged = j.merge_vocabularies(*vocabularies(t))
    return merged.agg(F.count_if(F.col("right_n").isNull()).alias("left_only"),
                      F.count_if(F.col("left_n").isNull()).alias("right_only"),
                      F.count_if(F.col("left_n").isNotNull() & F.col("right_n").isNotNull()).alias("in_both"))


@plan(BOTH + f"SELECT word, right_n FROM ({MERGED}) WHERE left_n IS NULL")
def filter_is_null(t):
    merged = j.merge_vocabularies(*vocabularies(t))
    return merged.filter(F.col("left_n").isNull()).select("word", "right_n")


@plan("""SELECT DISTINCT a.l_suppkey AS l_suppkey FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) a
      JOIN (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) b
      ON a.l_partkey = b.l_partkey AND a.l_suppkey <> b.l_suppkey""")
def join_self_coparticipant(t):
    return j.co_participants(t.lineitem, "l_suppkey", "l_partkey")


@plan("""SELECT DISTINCT s.l_suppkey AS l_suppkey FROM lineitem s
      JOIN (SELECT DISTINCT l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING') b ON s.l_partkey = b.l_partkey""")
def join_bipartite_two_types(t):
    builders = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    bought = (
        t.lineitem.select("l_orderkey", "l_partkey")
        .join(t.orders.join(builders, F.col("o_custkey") == F.col("c_custkey"), "left_semi"),
              F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    )
    return j.reaching_targets_of(t.lineitem, "l_suppkey", "l_partkey", bought, "l_partkey")


@plan("""SELECT s_suppkey AS src, p_partkey AS dst, l_orderkey, l_linenumber
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey""")
def join_double_lookup(t):
    def label(prefix, key):
        return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), 9, "0"))

    links = t.lineitem.select(label("Supplier#", "l_suppkey").alias("supplier"),
                              label("Part#", "l_partkey").alias("part"), "l_orderkey", "l_linenumber")
    suppliers = t.supplier.select("s_suppkey", "s_name")
    parts = t.part.select("p_partkey", label("Part#", "p_partkey").alias("p_label"))
    return j.double_lookup(links, "supplier", "part", suppliers, parts, "s_name", "p_label")


@plan("""SELECT n_name, c_mktsegment, count(*) AS customers, CAST(count_if(c_acctbal < 0) AS BIGINT) AS in_debt
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment""")
def join_broadcast_dictionary(t):
    # Spark broadcasts the small side only while its measured size stays under autoBroadcastJoinThreshold.
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("c_acctbal") < 0).alias("in_debt"))


@plan("""SELECT l_orderkey, l_linenumber, round(l_extendedprice / (SELECT max(l_extendedprice) FROM lineitem), 9) AS share
      FROM lineitem""")
def join_cross_scalar(t):
    top = t.lineitem.agg(F.max("l_extendedprice").alias("top")).scalar()
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") / top, 9).alias("share"))


LEXICON = """WITH senses AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS word, p_type AS sense FROM part),
      children AS (SELECT DISTINCT p_type AS sense, p_type || '/' || p_size AS child FROM part WHERE p_type <> 'PROMO'),
      lemmas AS (SELECT DISTINCT p_type AS sense, p_brand AS lemma FROM part
                 UNION SELECT DISTINCT p_type || '/' || p_size, p_brand FROM part) """


def lexicon(t):
    size = F.concat("p_type", F.lit("/"), F.col("p_size").cast("string"))
    senses = t.part.select(F.get(F.split("p_name", " "), F.lit(0)).alias("word"), F.col("p_type").alias("sense")).distinct()
    children = t.part.filter("p_type <> 'PROMO'").select(F.col("p_type").alias("sense"), size.alias("child")).distinct()
    lemmas = (t.part.select(F.col("p_type").alias("sense"), F.col("p_brand").alias("lemma"))
              .union(t.part.select(size, "p_brand")).distinct())
    return senses, children, lemmas


@plan(LEXICON + "SELECT word, sense, lemma FROM senses JOIN lemmas USING (sense)")
def join_lexicon_one_level(t):
    senses, _, lemmas = lexicon(t)
    return j.lemmas_of(senses, lemmas)


@plan(LEXICON + """SELECT word, s.sense, c.child, lemma FROM senses s JOIN children c ON s.sense = c.sense
      JOIN lemmas l ON l.sense = c.child""")
def join_lexicon_children(t):
    senses, children, lemmas = lexicon(t)
    return j.hyponyms_of(senses, children, lemmas)


@plan(LEXICON + """SELECT word,
        CAST((SELECT count(*) FROM senses a JOIN lemmas USING (sense) WHERE a.word = w.word) AS BIGINT) AS lemmas,
        CAST((SELECT count(*) FROM senses a JOIN children c ON a.sense = c.sense JOIN lemmas l ON l.sense = c.child
              WHERE a.word = w.word) AS BIGINT) AS hyponyms
      FROM (SELECT DISTINCT word FROM senses) w""")
def lexicon_totals(t):
    return j.lexicon_totals(*lexicon(t))
