"""Source and sink queries: each writes given rows to the shared folder in some form and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import tokens as tk
from millrace.operators.words import word_count
from millrace.plans.registry import plan
from millrace.plans.words import COUNTS, FRAGMENT_COUNTS
from millrace.operators.words import fragment_word_count
from millrace.session import freeze, scratch_name, scratch_path
from millrace.sources import files, tables


@plan(r"SELECT unnest(string_split(text, E'\n')) AS value FROM documents")
def scan_text_lines(t):
    path = files.write_lines(t.documents.select("text"), scratch_path(t.spark, "lines"))
    return files.read_lines(t.spark, path)


@plan(r"SELECT doc_id, replace(text, E'\n', ' ') AS body FROM documents")
def whole_document_lines(t):
    """Whole documents on one line each, from a column."""
    return t.documents.select("doc_id", files.joined_lines(F.col("text")).alias("body"))


FILES = 8


@plan(rf"""WITH whole AS (SELECT string_agg(replace(coalesce(text, ''), E'\n', ' '), ' ' ORDER BY doc_id) AS body FROM documents
             GROUP BY doc_id % {FILES}),
      cut AS (SELECT unnest(string_split_regex(body, '[.?!]')) AS sentence FROM whole)
      SELECT sentence, count(*) AS n FROM cut GROUP BY sentence""")
def scan_whole_document(t):
    """Sentences over the line ends and split ends of a few long documents, files that are read in several splits each."""
    texts = t.documents.select("doc_id", "text")
    placed = texts.repartitionById(FILES, F.pmod("doc_id", F.lit(FILES)).cast("int")).sortWithinPartitions("doc_id")
    path = files.write_lines(placed.select("text"), scratch_path(t.spark, "files"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    setting, before = "spark.sql.files.maxPartitionBytes", t.spark.conf.get("spark.sql.files.maxPartitionBytes")
    t.spark.conf.set(setting, str(max(size // FILES // 5, 1 << 14)))  # about five splits a file
    try:
        sentences = freeze(files.read_sentences(t.spark, path))
    finally:
        t.spark.conf.set(setting, before)
    return sentences.groupBy("sentence").agg(F.count(F.lit(1)).alias("n"))


CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@plan("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_delimited_typed(t):
    path = files.write_csv(t.customer, scratch_path(t.spark, "tab"), sep="\t")
    return files.read_delimited(t.spark, path, CUSTOMER, sep="\t")


@plan("SELECT c_name AS name, c_nationkey AS age, c_acctbal AS salary FROM customer")
def scan_delimited_multichar(t):
    rows = t.customer.select("c_name", "c_nationkey", "c_acctbal")
    path = files.write_csv(rows, scratch_path(t.spark, "emps"), sep=", ")
    return files.read_delimited(t.spark, path, "name STRING, age INT, salary DOUBLE", sep=", ")


@plan("""SELECT p_partkey, p_name || ', "' || p_type || '", ' || p_brand AS label, p_retailprice FROM part""")
def scan_csv_header(t):
    label = F.concat("p_name", F.lit(', "'), "p_type", F.lit('", '), "p_brand")
    path = files.write_csv(t.part.select("p_partkey", label.alias("label"), "p_retailprice"),
                           scratch_path(t.spark, "header"), header=True)
    cells = files.read_csv_header(t.spark, path, ["p_partkey", "label", "p_retailprice"])
    return cells.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "label",
                        F.col("p_retailprice").cast("double").alias("p_retailprice"))


@plan("SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part")
def scan_csv_drop_columns(t):
    path = files.write_csv(t.part, scratch_path(t.spark, "drop"), header=True)
    schema = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    return files.read_csv_without(t.spark, path, schema, ["p_retailprice"])


@plan("""SELECT CASE WHEN ok THEN '10.0.0.' || user_id END AS host, CASE WHEN ok THEN '-' END AS "identity",
             CASE WHEN ok THEN 'u' || event_id END AS "user", CASE WHEN ok THEN strftime(ts, '[%d/%m/%Y:%H:%M:%S +0000]') END AS "time",
             CASE WHEN ok THEN '"GET /' || event_type || ' HTTP/1.1"' END AS request, CASE WHEN ok THEN '200' END AS status,
             CASE WHEN ok THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS size,
             CASE WHEN event_type = 'click' THEN '"http://a.example/x"' END AS referer,
             CASE WHEN event_type = 'click' THEN '"agent/1.0 (x)"' END AS agent
      FROM (SELECT *, event_type <> 'error' AS ok FROM events)""")
def scan_regex_log(t):
    """Error events are written without a request, so their lines do not match."""
    number = F.floor("value").cast("string")
    head = F.concat(F.lit("10.0.0."), F.col("user_id").cast("string"), F.lit(" - u"), F.col("event_id").cast("string"),
                    F.date_format("ts", " '['dd/MM/yyyy:HH:mm:ss' +0000]'"))
    request = F.concat(F.lit(' "GET /'), "event_type", F.lit(' HTTP/1.1" 200 '), number)
    tail = F.when(F.col("event_type") == "click", ' "http://a.example/x" "agent/1.0 (x)"').otherwise("")
    line = F.when(F.col("event_type") == "error", F.concat(head, F.lit(" broken"))).otherwise(F.concat(head, request, tail))
    path = files.write_lines(t.events.select(line.alias("line")), scratch_path(t.spark, "log"))
    return files.read_access_log(t.spark, path)


@plan("""SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders""")
def scan_parquet(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    return t.spark.read.parquet(files.write_parquet(rows, scratch_path(t.spark, "orders")))


@plan("""SELECT l_returnflag, max(n) AS max_n, min(n) AS min_n, avg(n) AS avg_n
      FROM (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_returnflag""")
def sink_parquet(t):
    """A first aggregate kept as Parquet, from which a second job answers."""
    per_order = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    kept = t.spark.read.parquet(files.write_parquet(per_order, scratch_path(t.spark, "per-order")))
    return kept.groupBy("l_returnflag").agg(F.max("n").alias("max_n"), F.min("n").alias("min_n"), F.avg("n").alias("avg_n"))


@plan("SELECT l_orderkey, sum(l_quantity) AS total, count(*) AS items FROM lineitem GROUP BY l_orderkey")
def scan_catalog_table(t):
    name = scratch_name("order_items")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    tables.save_table(rows, name, location=scratch_path(t.spark, name))
    totals = t.spark.sql(f"SELECT l_orderkey, sum(l_quantity) AS total, count(l_linenumber) AS items FROM {name} GROUP BY l_orderkey")
    return tables.without_name(totals, name)


@plan("""SELECT col_name, data_type, (SELECT count(*) FROM customer) AS n FROM (VALUES ('freq', 'int'), ('word', 'string'))
      v(col_name, data_type)""")
def ddl_create_describe_drop(t):
    name = scratch_name("segments")
    place = scratch_path(t.spark, name)
    tables.create_table(t.spark, name, "freq INT, word STRING", place)
    if tables.table_names(t.spark).filter(F.col("tableName") == name).isEmpty():
        raise RuntimeError(f"table {name} is not listed")
    tables.load_append(t.customer.select(F.lit(1).alias("freq"), F.col("c_mktsegment").alias("word")), name)
    columns = tables.describe(t.spark, name)
    n = t.spark.table(name).count()
    t.spark.sql(f"DROP TABLE {name}")
    return columns.withColumn("n", F.lit(n))


@plan("SELECT event_type, count(*) AS n, sum(CASE WHEN value < 50 THEN 1 ELSE 0 END)::BIGINT AS low FROM events GROUP BY event_type")
def load_append(t):
    name = scratch_name("log")
    tables.create_table(t.spark, name, "event_type STRING, value DOUBLE", scratch_path(t.spark, name))
    tables.load_append(t.events.filter("value < 50"), name)
    tables.load_append(t.events.filter("NOT value < 50 OR value IS NULL"), name)
    counts = t.spark.sql(f"SELECT event_type, count(*) AS n, count_if(value < 50) AS low FROM {name} GROUP BY event_type")
    return tables.without_name(counts, name)


@plan("""SELECT p_brand AS word, count(*) AS freq FROM part GROUP BY p_brand""")
def insert_overwrite_select(t):
    name = scratch_name("merged")
    tables.create_table(t.spark, name, "word STRING, freq BIGINT", scratch_path(t.spark, name))
    tables.load_append(t.part.select(F.col("p_type").alias("word"), F.lit(0).cast("bigint").alias("freq")), name)
    tables.insert_overwrite(t.spark, name, "SELECT p_brand AS word, count(*) AS freq FROM {part} GROUP BY p_brand", part=t.part)
    return tables.without_name(t.spark.table(name), name)


@plan("SELECT c_name FROM customer WHERE c_acctbal > 3500")
def register_temp_view(t):
    name = scratch_name("customers")
    t.customer.createOrReplaceTempView(name)
    kept = t.spark.sql(f"SELECT c_name FROM {name} WHERE c_acctbal > 3500")
    t.spark.catalog.dropTempView(name)
    return kept


@plan(f"SELECT word || chr(9) || n AS value FROM ({COUNTS})")
def sink_text(t):
    counts = word_count(t.texts("text"), "text").orderBy("word")
    return files.read_lines(t.spark, files.write_lines(counts, scratch_path(t.spark, "counts")))


@plan(f"""SELECT word, n FROM (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS rank FROM ({COUNTS})) WHERE rank <= 20""")
def sink_top_n_report(t):
    counts = word_count(t.texts("text"), "text")
    path = files.write_report(counts, scratch_path(t.spark, "top"), [F.desc("n"), F.asc("word")], 20)
    return files.read_delimited(t.spark, path, "word STRING, n BIGINT")


@plan(f"""SELECT word, n FROM (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS rank FROM ({FRAGMENT_COUNTS})) WHERE rank <= 200""")
def sink_top_n_report_200(t):
    counts = fragment_word_count(t.texts("text"), "text", tk.STOPWORDS_V2)
    path = files.write_report(counts, scratch_path(t.spark, "top200"), [F.desc("n"), F.asc("word")], 200)
    return files.read_delimited(t.spark, path, "word STRING, n BIGINT")


@plan("""SELECT 'create' AS step, 'written' AS result, count(*) AS n FROM customer
      UNION ALL SELECT 'if_empty', 'refused', count(*) FROM customer
      UNION ALL SELECT 'truncate', 'written', count(*) FROM supplier""")
def sink_table_dispositions(t):
    name = scratch_name("result")
    place = scratch_path(t.spark, name)
    people = t.customer.select(F.col("c_name").alias("name"))
    tables.save_table(people, name, "if_empty", place)
    steps = [("create", "written", t.spark.table(name).count())]
    try:
        tables.save_table(people, name, "if_empty", place)
        steps.append(("if_empty", "written", t.spark.table(name).count()))
    except FileExistsError:
        steps.append(("if_empty", "refused", t.spark.table(name).count()))
    tables.save_table(t.supplier.select(F.col("s_name").alias("name")), name, "truncate", place)
    steps.append(("truncate", "written", t.spark.table(name).count()))
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.createDataFrame(steps, "step STRING, result STRING, n BIGINT")


@plan("""SELECT 'missing' AS step, 'created' AS result, 0 AS n
      UNION ALL SELECT 'same', 'accepted', count(*) FROM customer
      UNION ALL SELECT 'other', 'refused', count(*) FROM customer""")
def table_schema_guard(t):
    name = scratch_name("guarded")
    declared = "c_name STRING, c_acctbal DOUBLE"
    tables.guard_schema(t.spark, name, declared, scratch_path(t.spark, name))
    steps = [("missing", "created", t.spark.table(name).count())]
    tables.load_append(t.customer, name)
    tables.guard_schema(t.spark, name, declared)
    steps.append(("same", "accepted", t.spark.table(name).count()))
    try:
        tables.guard_schema(t.spark, name, "c_name STRING, c_acctbal BIGINT")
        steps.append(("other", "accepted", t.spark.table(name).count()))
    except tables.SchemaMismatch:
        steps.append(("other", "refused", t.spark.table(name).count()))
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.createDataFrame(steps, "step STRING, result STRING, n BIGINT")


PERSONS = [("person-1", "Ada", "Leith"), ("person-2", "Bram", "Delft"), ("person-3", "Caro", "Ghent")]


@plan("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS city FROM customer
      UNION ALL VALUES ('person-1', 'Ada', 'Leith'), ('person-2', 'Bram', 'Delft'), ('person-3', 'Caro', 'Ghent')""")
def rows_from_literals(t):
    """Literal rows inserted into a table of given rows, then a full scan."""
    base = t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
                             F.col("c_mktsegment").alias("city"))
    return base.unionByName(tables.literal_rows(t.spark, PERSONS, "id STRING, name STRING, city STRING"))


@plan("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 100")
def parameterized_sql(t):
    return tables.run_bound(t.spark, "SELECT c_custkey, c_name FROM {customer} WHERE c_mktsegment = ? AND c_acctbal > ?",
                            ["BUILDING", 100.0], customer=t.customer)


@plan("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey = 7")
def parameterized_sql_named(t):
    return tables.run_bound(t.spark, "SELECT c_custkey, c_name FROM {customer} WHERE c_mktsegment = :segment AND c_nationkey = :nation",
                            {"segment": "MACHINERY", "nation": 7}, customer=t.customer)
