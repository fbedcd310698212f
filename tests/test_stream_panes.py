"""The incremental sliding count: each event is in one pane, a restart inside a window loses nothing, late rows drop."""

import datetime as dt

import pytest
from conftest import listed
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming import topics as tp
from millrace.streaming import windows as win

SCHEMA = "ts timestamp, key string"


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


@pytest.fixture
def places(spark):
    return {label: scratch_path(spark, label) for label in ("inbox", "ends", "out", "checkpoint")}


def deliver(spark, places, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(places["inbox"])


def run(spark, places, total=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = tp.with_end(tp.open_files(spark, places["inbox"], schema), places["ends"])
    return tp.run_append(win.sliding_incremental(stream, "ts", "key", "30 minutes", "10 minutes", lateness="5 minutes", total=total),
                         places["out"], places["checkpoint"])


def end(spark, places, minute):
    tp.mark_end(spark, places["ends"], spark.createDataFrame([], SCHEMA).schema, "ts", F.lit(at(minute)))


def batch(spark, data, total=None):
    rows = spark.createDataFrame(data, SCHEMA)
    if total:
        rows = rows.withColumn("key", F.explode(F.array("key", F.lit(total))))
    return listed(win.sliding_count(rows, "ts", "key", "30 minutes", "10 minutes"))


def test_restart_inside_a_window(spark, places):
    data = [(at(m), "ab"[m % 3 == 0]) for m in range(0, 95, 4)] + [(at(50), None), (at(50), None)]
    data.sort(key=lambda r: r[0])
    deliver(spark, places, data[:13])  # stops at minute 48, inside a pane and three windows
    first = listed(run(spark, places, "total"))
    assert first and all(start + dt.timedelta(minutes=30) <= at(48 - 5) for start, _, _ in first)
    deliver(spark, places, data[13:])
    run(spark, places, "total")
    end(spark, places, 95 + 60)
    got = listed(run(spark, places, "total"))
    assert got == batch(spark, data, "total")
    assert listed(run(spark, places, "total")) == got  # nothing is written twice


def test_each_event_enters_one_pane(spark, places):
    data = [(at(m % 60), "k") for m in range(600)]
    deliver(spark, places, data)
    rows = spark.createDataFrame(data, SCHEMA)
    assert win.pane_counts(rows, "ts", "key", "10 minutes").agg(F.sum("n")).first()[0] == 600
    stream = tp.with_end(tp.open_files(spark, places["inbox"], rows.schema), places["ends"])
    end(spark, places, 200)
    counts = win.sliding_incremental(stream, "ts", "key", "30 minutes", "10 minutes", lateness="5 minutes")
    query = (counts.writeStream.format("parquet").option("path", places["out"]).option("checkpointLocation", places["checkpoint"])
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    # the windows' state takes rows of panes (6 panes in 3 windows each), the panes' state the groups of the events
    windows, panes = (sum(p["stateOperators"][i]["numRowsUpdated"] for p in query.recentProgress) for i in (0, 1))
    assert panes == 6 + 1 and windows <= 8
    assert listed(spark.read.parquet(places["out"])) == batch(spark, data)


def test_late_rows_drop_and_the_batch_form_agrees(spark, places):
    data = [(at(1), "a"), (at(61), "a"), (at(125), "b")]
    deliver(spark, places, data)
    run(spark, places)
    deliver(spark, places, [(at(2), "late"), (at(122), "b")])
    end(spark, places, 200)
    got = listed(run(spark, places))
    assert got == batch(spark, [*data, (at(122), "b")])
    rows = spark.createDataFrame(data, SCHEMA)
    assert listed(win.sliding_incremental(rows, "ts", "key", "30 minutes", "10 minutes")) == batch(spark, data)
    assert win.sliding_incremental(rows.limit(0), "ts", "key", "30 minutes", "10 minutes").count() == 0
