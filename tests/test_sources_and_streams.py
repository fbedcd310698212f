import datetime as dt

import pytest
from conftest import listed
from pyspark.sql import functions as F

from millrace.session import freeze, scratch_name, scratch_path
from millrace.sources import files, tables
from millrace.streaming import topics as tp
from millrace.streaming import windows as win


def test_lines_and_whole_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo")
    (tmp_path / "b.txt").write_text("three\n")
    assert listed(files.read_lines(spark, f"{tmp_path}/a.txt", f"{tmp_path}/b.txt")) == [("",), ("one",), ("three",), ("two",)]
    assert listed(files.read_documents(spark, str(tmp_path)).select("value")) == [("one\n\ntwo",), ("three\n",)]


def test_delimited_bad_cell_is_null(spark, tmp_path):
    (tmp_path / "f.tsv").write_text("12\tword\nx\tother\n")
    assert listed(files.read_delimited(spark, str(tmp_path), "freq INT, word STRING")) == sorted(
        [(12, "word"), (None, "other")], key=repr)


def test_multi_character_separator(spark, tmp_path):
    (tmp_path / "emps.txt").write_text("Ann, 41, 3600.5\nBo, 29, 3000\n")
    got = files.read_delimited(spark, str(tmp_path), "name STRING, age INT, salary DOUBLE", sep=", ")
    assert listed(got) == [("Ann", 41, 3600.5), ("Bo", 29, 3000.0)]


def test_header_csv_with_quotes(spark, tmp_path):
    (tmp_path / "n.csv").write_text('country,income\n"Congo, Dem. Rep. ",700\n"say ""hi""",1\n')
    assert listed(files.read_csv_header(spark, str(tmp_path), ["country", "income"])) == [
        ("Congo, Dem. Rep. ", "700"), ('say "hi"', "1")]
    assert files.read_csv_without(spark, str(tmp_path), "country STRING, income INT", ["income"]).columns == ["country"]


def test_access_log(spark, tmp_path):
    full = '1.2.3.4 - bob [10/Oct/2000:13:55:36 -0700] "GET /x HTTP/1.0" 200 2326 "http://r" "agent x"'
    short = '5.6.7.8 - - [10/Oct/2000:13:55:36 -0700] "GET /y HTTP/1.0" 404 -'
    odd = ["\x02" + short, "\x02a\x01b", "a\x01b - - [x] \"q\" 200 1", "", "\x02"]
    (tmp_path / "log").write_text("\n".join([full, short, "not a log line"]))
    (tmp_path / "odd").write_text("\n".join(odd))
    got = files.read_access_log(spark, str(tmp_path / "odd")).collect()
    assert len(got) == 5 and {r.host for r in got} == {"\x025.6.7.8", "a\x01b", None}
    rows = files.read_access_log(spark, str(tmp_path / "log")).orderBy(F.col("host").asc_nulls_last()).collect()
    assert tuple(rows[0])[:3] == ("1.2.3.4", "-", "bob") and rows[0]["agent"] == '"agent x"'
    assert rows[1]["status"] == "404" and rows[1]["referer"] is None and rows[1]["size"] == "-"
    assert set(rows[2]) == {None}


def test_report_is_one_ordered_file(spark, rows):
    df = rows([(f"w{i}", i % 7) for i in range(100)], "word string, n int").repartition(6)
    path = files.write_report(df, scratch_path(spark, "report"), [F.desc("n"), F.asc("word")], 5)
    got = files.read_delimited(spark, path, "word STRING, n INT").collect()
    assert [r["n"] for r in got] == [6] * 5
    assert [r["word"] for r in got] == sorted(r["word"] for r in got)


def test_table_rules(spark, rows):
    name = scratch_name("t")
    place = scratch_path(spark, name)
    df = rows([("a", 1)], "k string, v int")
    tables.guard_schema(spark, name, "k STRING, v INT", place)
    tables.save_table(df, name, "if_empty", place)
    with pytest.raises(FileExistsError):
        tables.save_table(df, name)
    tables.load_append(df, name)
    assert spark.table(name).count() == 2
    with pytest.raises(tables.SchemaMismatch):
        tables.guard_schema(spark, name, "k STRING, v BIGINT")
    tables.insert_overwrite(spark, name, "SELECT k, v + 1 AS v FROM {d}", d=df)
    assert listed(spark.table(name)) == [("a", 2)]
    spark.sql(f"DROP TABLE {name}")


def test_bound_values_are_not_spliced(spark, rows):
    df = rows([("x' OR '1'='1",), ("y",)], "k string")
    got = tables.run_bound(spark, "SELECT k FROM {d} WHERE k = ?", ["x' OR '1'='1"], d=df)
    assert listed(got) == [("x' OR '1'='1",)]


T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


SCHEMA = "ts timestamp, key string"
ROWS = [(at(s), k) for s, k in [(0, "a"), (3, "b"), (4, "a"), (12, "a"), (31, "b"), (44, "a")]]


def test_sliding_forms_agree(rows):
    df = rows(ROWS, SCHEMA)
    direct = win.sliding_count(df, "ts", "key")
    assert listed(direct) == listed(win.sliding_from_panes(df, "ts", "key", 6, "5 seconds"))
    brute = {}
    for start in range(-30, 50, 5):
        for ts, key in ROWS:
            if at(start) <= ts < at(start + 30):
                brute[at(start), key] = brute.get((at(start), key), 0) + 1
    assert {(r["window_start"], r["key"]): r["n"] for r in direct.collect()} == brute


def test_zero_keys_stay_after_first_sight(rows):
    df = rows([(at(0), "a"), (at(20), "b")], SCHEMA)
    counts = win.sliding_count(df, "ts", "key", "10 seconds", "5 seconds", total="total")
    filled = {(r["window_start"], r["key"]): r["n"] for r in win.with_zero_keys(counts, "key", "5 seconds").collect()}
    assert filled[at(10), "a"] == 0 and filled[at(20), "a"] == 0
    assert (at(0), "b") not in filled
    assert filled[at(20), "total"] == 1 and filled[at(5), "total"] == 0


def test_tumbling_totals_equal_plain_counts(rows):
    df = rows(ROWS, SCHEMA)
    counts = win.tumbling_count(df, "ts", "key", "20 seconds")
    assert listed(counts.groupBy("key").agg(F.sum("count"))) == [("a", 4), ("b", 2)]
    assert counts.filter("key = 'b'").agg(F.min("window_timestamp")).first()[0] == at(3)


def deliver(rows, inbox, data):
    rows(data, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)


def test_stream_over_restarts_equals_batch(spark, rows):
    inbox, out, checkpoint = (scratch_path(spark, x) for x in ("in", "out", "cp"))
    for part in (ROWS[:2], ROWS[2:5], ROWS[5:]):
        deliver(rows, inbox, part)
        stream = tp.open_files(spark, inbox, rows([], SCHEMA).schema)
        got = tp.run_update(win.sliding_count(stream, "ts", "key", lateness="1 hour"), out, checkpoint, ["window_start", "key"])
    assert listed(got) == listed(win.sliding_count(rows(ROWS, SCHEMA), "ts", "key"))


def test_rows_later_than_the_watermark_are_dropped(spark, rows):
    inbox, out, checkpoint = (scratch_path(spark, x) for x in ("in", "out", "cp"))
    for part in ([(at(0), "a"), (at(3600), "a")], [(at(7200), "a")], [(at(1), "late")]):
        deliver(rows, inbox, part)
        stream = tp.open_files(spark, inbox, rows([], SCHEMA).schema)
        got = tp.run_update(win.tumbling_count(stream, "ts", "key", "1 minute", lateness="1 minute"), out, checkpoint,
                            ["window_start", "key"])
    assert {r["key"] for r in got.collect()} == {"a"}


def test_injected_repeats_count_once(spark, rows):
    lines = rows([("1", "x", at(0)), ("2", "", at(1)), ("3", None, at(2)), ("4", "y", at(3))], "id string, value string, sent timestamp")
    inbox = scratch_path(spark, "in")
    for _ in range(2):
        lines.write.mode("append").parquet(inbox)
    stream = tp.injected(tp.open_files(spark, inbox, lines.schema, maxFilesPerTrigger="1"), "id", "value", "sent", "1 hour")
    got = tp.run_append(stream, scratch_path(spark, "out"), scratch_path(spark, "cp"))
    assert listed(got.select("id", "value")) == [("1", "x"), ("4", "y")]
    assert listed(tp.injected(lines.union(lines), "id", "value", "sent", "1 hour").select("id")) == [("1",), ("4",)]


def test_empty_stream_gives_an_empty_table(spark, rows):
    inbox = scratch_path(spark, "in")
    rows([], SCHEMA).write.parquet(inbox)
    stream = tp.open_files(spark, inbox, rows([], SCHEMA).schema)
    got = tp.run_update(win.tumbling_count(stream, "ts", "key"), scratch_path(spark, "out"), scratch_path(spark, "cp"),
                        ["window_start", "key"])
    assert got.count() == 0


def test_broker_connector_is_only_needed_when_opened(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        tp.open_topics(spark, "localhost:9092", "topic")


def test_frozen_rows_keep_schema_and_values(rows):
    df = rows([("a", 1, [1.5]), (None, 2, None)], "k string, v int, a array<double>")
    frozen = freeze(df)
    assert frozen.schema == df.schema
    assert listed(frozen) == listed(df)
    assert "Scan parquet" in frozen._jdf.queryExecution().executedPlan().toString() or frozen.inputFiles()
