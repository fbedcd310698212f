"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars as sc
from millrace.operators import relational as rel
from millrace.plans.registry import plan

# A web-request view of ``events``: the length column is text and holds some of the cells the rules reject.
DIRTY = """CASE CAST(event_id AS BIGINT) % 12
        WHEN 3 THEN concat(CAST(event_id AS VARCHAR), ';13') WHEN 4 THEN '1 2' WHEN 5 THEN '1,2'
        WHEN 6 THEN '2147483648' WHEN 7 THEN '9999999999' WHEN 8 THEN '' WHEN 9 THEN NULL
        WHEN 10 THEN '1999999999' WHEN 11 THEN 'n/a'
        ELSE CAST(CAST(floor(value * 1000) AS INTEGER) AS VARCHAR) END"""
FORMAT = "CASE WHEN CAST(user_id AS BIGINT) % 10 = 9 THEN '' WHEN user_id % 3 = 0 THEN 'svg' WHEN user_id % 3 = 1 THEN 'png' ELSE 'jpg' END"
REQUESTS = f"SELECT event_id, user_id, event_type AS type, {FORMAT} AS format, {DIRTY} AS length_text FROM events"
VALID = r"""CASE WHEN NOT regexp_matches(length_text, '[; ,]')
        AND NOT (length(length_text) >= 10 AND length_text[1] > '1')
        AND regexp_matches(length_text, '^[+-]?[0-9]+$') THEN TRY_CAST(length_text AS INTEGER) END"""
LENGTHS = f"SELECT * FROM (SELECT *, {VALID} AS length FROM ({REQUESTS})) WHERE length IS NOT NULL"


def requests(t):
    dirty = DIRTY.replace("VARCHAR", "STRING")
    return t.events.selectExpr("event_id", "user_id", "event_type AS type", f"{FORMAT} AS format",
                               f"{dirty} AS length_text")


@plan("SELECT c_name, c_acctbal AS balance FROM customer")
def project_columns(t):
    return t.customer.select("c_name", F.col("c_acctbal").alias("balance"))


@plan("SELECT c_name FROM customer WHERE c_acctbal > 3500")
def filter_compare_df(t):
    return t.customer.filter(F.col("c_acctbal") > 3500).select("c_name")


@plan("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 60000")
def filter_compare_sql(t):
    return t.spark.sql(
        "SELECT l_orderkey, l_linenumber, l_extendedprice FROM {lineitem} WHERE l_extendedprice > 60000",
        lineitem=t.lineitem)


@plan("SELECT l_orderkey, count(*) AS count FROM lineitem GROUP BY l_orderkey HAVING count(*) = 5")
def filter_expr_string(t):
    return t.lineitem.groupBy("l_orderkey").count().filter("count = 5")


@plan("SELECT event_id, type FROM (" + REQUESTS + ") WHERE format <> '' AND length_text <> ''")
def filter_nonempty(t):
    return requests(t).filter(sc.nonempty(F.col("format")) & sc.nonempty(F.col("length_text"))).select("event_id", "type")


@plan(f"SELECT event_id, type, length FROM ({LENGTHS})")
def filter_valid_length(t):
    return rel.with_valid_length(requests(t), "length_text", required=["type"]).select("event_id", "type", "length")


@plan(f"SELECT event_id, length FROM ({LENGTHS}) WHERE format = 'svg'")
def filter_param_equals(t):
    wanted = "svg"
    return (rel.with_valid_length(requests(t), "length_text").filter(F.col("format") == wanted)
            .select("event_id", "length"))


@plan(f"""WITH img AS (SELECT * FROM ({LENGTHS}) WHERE type = 'view' AND format <> '')
      SELECT event_id, type, format, CAST(length AS DOUBLE) AS length FROM img
      WHERE format = 'svg' AND length > (SELECT avg(length) FROM img)""")
def filter_above_global_mean(t):
    images = rel.with_valid_length(requests(t).filter(F.col("type") == "view"), "length_text", required=["format"])
    kept = rel.above_global_mean(images, "length", F.col("format") == "svg")
    return kept.select("event_id", "type", "format", F.col("length").cast("double").alias("length"))


@plan("SELECT l_orderkey, l_linenumber, l_extendedprice / CAST(1024.0 AS DOUBLE) AS kib, "
      "l_quantity / CAST(1e6 AS DOUBLE) AS millions FROM lineitem")
def scale_value(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", sc.kib(F.col("l_extendedprice")).alias("kib"),
                             (F.col("l_quantity") / 1e6).alias("millions"))


@plan("""SELECT doc_id, lower(lang) AS lang_lower, length(text) AS chars, trim('  ' || source || ' ') AS source_trim,
             lang || ':' || source AS lang_source, contains(source, '1') AS has_one,
             source LIKE 'src1%' AS like_src1, substr(source, 4, 1) AS char_at_3
      FROM documents""")
def str_basic(t):
    source = F.col("source")
    return t.documents.select(
        "doc_id", F.lower("lang").alias("lang_lower"), F.length("text").cast("bigint").alias("chars"),
        F.trim(F.concat(F.lit("  "), source, F.lit(" "))).alias("source_trim"),
        F.concat("lang", F.lit(":"), "source").alias("lang_source"), source.contains("1").alias("has_one"),
        source.like("src1%").alias("like_src1"), F.substring(source, 4, 1).alias("char_at_3"))


@plan(f"SELECT event_id, coalesce(nullif(length_text, ''), nullif(format, ''), type) AS first_known FROM ({REQUESTS})")
def coalesce_columns(t):
    blank = F.lit("")
    return requests(t).select("event_id", F.coalesce(F.nullif(F.col("length_text"), blank),
                                                     F.nullif(F.col("format"), blank), "type").alias("first_known"))


@plan(f"""SELECT event_id, TRY_CAST(CASE WHEN regexp_matches(length_text, '^[0-9]+$') THEN length_text END AS BIGINT) AS as_long,
             CAST(user_id AS DOUBLE) AS as_double FROM ({REQUESTS})""")
def cast_parse(t):
    digits = F.when(F.col("length_text").rlike("^[0-9]+$"), F.col("length_text"))
    return requests(t).select("event_id", digits.try_cast("bigint").alias("as_long"),
                              F.col("user_id").cast("double").alias("as_double"))


@plan("""SELECT event_id, abs(value - 50) AS abs_v, round(value * value, 6) AS sq, round(ln(value + 1), 9) AS ln1p,
             round(sqrt(value), 9) AS root, round(log10(value), 9) AS log10_v, user_id % 7 AS mod7 FROM events""")
def math_basic(t):
    v = F.col("value")
    return t.events.select("event_id", F.abs(v - 50).alias("abs_v"), F.round(v * v, 6).alias("sq"),
                           F.round(F.log1p(v), 9).alias("ln1p"), F.round(F.sqrt(v), 9).alias("root"),
                           F.round(F.log10(v), 9).alias("log10_v"), (F.col("user_id") % 7).alias("mod7"))


MESSAGE = "'Message sent at ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ':' || chr(9) || CAST(user_id AS VARCHAR)"


@plan(f"SELECT event_id, {MESSAGE} AS message, CAST(user_id AS VARCHAR) AS number FROM events")
def message_format(t):
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    built = t.events.select("event_id", sc.message(time, F.col("user_id")).alias("message"))
    return built.withColumn("number", sc.message_number(F.col("message")))


@plan("""SELECT event_id, event_type AS first_field, CAST(user_id AS VARCHAR) AS second_field,
             CAST(NULL AS VARCHAR) AS absent_field FROM events""")
def split_field(t):
    record = F.concat_ws("\t", "event_type", F.col("user_id").cast("string"))
    return t.events.select("event_id", sc.field(record, 0).alias("first_field"),
                           sc.field(record, 1).alias("second_field"), sc.field(record, 2).alias("absent_field"))
