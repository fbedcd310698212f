"""Streaming queries over ``events``: each runs a real stream to its end and returns the table it wrote.

Their SQL twins are the batch results, because a stream that has read everything must agree with a batch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalars import message, message_number, route
from millrace.plans.registry import plan
from millrace.session import scratch_path
from millrace.streaming import topics as tp
from millrace.streaming import windows as win


def event_stream(t):
    """The events table as a stream, be it one file or a folder of part files: the pattern matches either."""
    return tp.open_files(t.spark, f"{t.folder}/event[s].parquet", t.events.schema)


def _update(t, stream, keys):
    return tp.run_update(stream, scratch_path(t.spark, "out"), scratch_path(t.spark, "checkpoint"), keys)


def _append(t, stream, **options):
    return tp.run_append(stream, scratch_path(t.spark, "out"), scratch_path(t.spark, "checkpoint"), **options)


def _wall_clock(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


SLIDING = """SELECT time_bucket(INTERVAL '1 hour', ts) - to_hours(k) AS window_start, {key} AS event_type, count(*) AS n
      FROM events, range(0, 6) r(k) GROUP BY 1, 2"""
TUMBLING = """SELECT time_bucket(INTERVAL '20 minutes', ts) AS window_start, user_id, count(*) AS count, min(ts) AS window_timestamp
      FROM events GROUP BY 1, 2"""
RECORDS = ("SELECT CAST(user_id AS VARCHAR) AS key, 'Message sent at ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ':' || chr(9) "
           "|| event_id AS value FROM events")


@plan(SLIDING.format(key="event_type"))
def stream_sliding_count(t):
    counts = win.sliding_count(event_stream(t), "ts", "event_type", "6 hours", "1 hour", lateness="1 hour")
    return _wall_clock(_update(t, counts, ["window_start", "event_type"]), "window_start")


@plan(SLIDING.format(key="event_type"))
def sliding_count_panes(t):
    return _wall_clock(win.sliding_from_panes(t.events, "ts", "event_type", 6, "1 hour"), "window_start")


@plan(f"""WITH c AS ({SLIDING.format(key='event_type')} UNION ALL {SLIDING.format(key="'total'")}),
      k AS (SELECT event_type, min(window_start) AS first FROM c GROUP BY event_type),
      e AS (SELECT event_type, unnest(generate_series(first, (SELECT max(window_start) FROM c), INTERVAL '1 hour')) AS window_start FROM k)
      SELECT e.window_start AS window_start, e.event_type AS event_type, coalesce(n, 0) AS n
      FROM e LEFT JOIN c ON c.window_start = e.window_start AND c.event_type = e.event_type""")
def stream_sliding_incremental(t):
    """Chained states: panes of an hour, then windows of six panes; the stream ends with a mark, which closes them all."""
    ends, out, checkpoint = (scratch_path(t.spark, label) for label in ("ends", "out", "checkpoint"))

    def run():
        stream = tp.with_end(event_stream(t), ends)
        counts = win.sliding_incremental(stream, "ts", "event_type", "6 hours", "1 hour", lateness="1 hour", total="total")
        return tp.run_append(counts, out, checkpoint)

    run()
    beyond = t.events.agg(F.max("ts") + F.expr("INTERVAL 8 HOURS")).scalar()
    tp.mark_end(t.spark, ends, t.events.schema, "ts", beyond)
    return _wall_clock(win.with_zero_keys(run(), "event_type", "1 hour"), "window_start")


@plan(TUMBLING)
def stream_tumbling_count(t):
    counts = win.tumbling_count(event_stream(t), "ts", "user_id", "20 minutes", lateness="1 hour")
    return _wall_clock(_update(t, counts, ["window_start", "user_id"]), "window_start", "window_timestamp")


@plan(TUMBLING)
def tumbling_count_batch(t):
    return _wall_clock(win.tumbling_count(t.events, "ts", "user_id", "20 minutes"), "window_start", "window_timestamp")


@plan("SELECT event_id, TIMESTAMP '2016-05-10 20:00:00' - to_seconds(event_id % 3600) AS event_time FROM events")
def assign_event_time(t):
    base = F.lit("2016-05-10 20:00:00").cast("timestamp_ntz")
    return win.assign_event_time(t.events.select("event_id"), F.col("event_id"), base)


@plan(f"""WITH timed AS (SELECT user_id, TIMESTAMP '2016-05-10 20:00:00' - to_seconds(event_id % 3600) AS ts FROM events)
      SELECT time_bucket(INTERVAL '20 minutes', ts) AS window_start, user_id, count(*) AS count, min(ts) AS window_timestamp
      FROM timed GROUP BY 1, 2""")
def windowed_requests_per_page(t):
    base = F.lit("2016-05-10 20:00:00").cast("timestamp")
    timed = win.assign_event_time(t.events.select("event_id", "user_id"), F.col("event_id"), base)
    counts = win.tumbling_count(timed, "event_time", "user_id", "20 minutes")
    return _wall_clock(counts, "window_start", "window_timestamp")


@plan(f"SELECT 'batch' AS input, * FROM ({TUMBLING}) UNION ALL SELECT 'stream', * FROM ({TUMBLING})")
def unified_batch_stream(t):
    def transform(df):
        return win.tumbling_count(df, "ts", "user_id", "20 minutes", lateness="1 hour")

    streamed = _update(t, transform(event_stream(t)), ["window_start", "user_id"])
    both = transform(t.events).withColumn("input", F.lit("batch")).unionByName(streamed.withColumn("input", F.lit("stream")))
    return _wall_clock(both, "window_start", "window_timestamp")


@plan("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_checkpoint(t):
    """Run on half of the input, stop, add the other half, and go on from the checkpoint."""
    inbox, out, checkpoint = (scratch_path(t.spark, label) for label in ("inbox", "out", "checkpoint"))
    events = t.events.select("event_type", "value")

    def deliver_and_run(half):
        half.write.mode("append").parquet(inbox)
        counts = tp.open_files(t.spark, inbox, events.schema).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        return tp.run_update(counts, out, checkpoint, ["event_type"])

    deliver_and_run(events.filter("value < 50"))
    return deliver_and_run(events.filter("NOT value < 50 OR value IS NULL"))


@plan(RECORDS)
def stream_source_topic(t):
    records = _records(event_stream(t))
    return _append(t, records.select("key", "value"))


def _records(events):
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return tp.as_records(events, F.col("user_id"), message(time, F.col("event_id")), F.col("ts"))


@plan(f"SELECT key, value, CAST(CASE WHEN CAST(key AS BIGINT) > 0 THEN CAST(key AS BIGINT) % 4 ELSE 0 END AS INTEGER) AS partition FROM ({RECORDS})")
def stream_sink_topic(t):
    """Records with the partition their key routes to, written the way a broker sink takes them."""
    partition = route(F.col("key").cast("bigint"), 4).cast("int").alias("partition")
    return _append(t, _records(event_stream(t)).select("key", "value", partition))


@plan("SELECT CAST(user_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS number FROM events")
def stream_stateless_parse(t):
    parsed = _records(event_stream(t)).select("key", message_number(F.col("value")).alias("number"))
    return _append(t, parsed)


@plan("SELECT event_id, event_type FROM events")
def stream_microbatch_interval(t):
    return _append(t, event_stream(t).select("event_id", "event_type"), interval="1 second")


@plan(r"""SELECT doc_id || '-' || (line - 1) AS id, value FROM (
        SELECT doc_id, unnest(string_split(text, E'\n')) AS value, unnest(range(1, len(string_split(text, E'\n')) + 1)) AS line FROM documents)
      WHERE value <> ''""")
def file_to_stream_inject(t):
    """Document lines injected twice, as an at-least-once sender may do, and read once each."""
    inbox = scratch_path(t.spark, "inbox")
    split = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "value"))
    lines = split.select(F.concat_ws("-", F.col("doc_id").cast("string"), F.col("line").cast("string")).alias("id"), "value")
    base = F.lit("2016-05-10 20:00:00").cast("timestamp")
    lines = win.assign_event_time(lines, F.crc32("id"), base, "sent")
    for _ in range(2):
        lines.write.mode("append").parquet(inbox)
    stream = tp.open_files(t.spark, inbox, lines.schema)
    return _append(t, tp.injected(stream, "id", "value", "sent", "2 hours").select("id", "value"))
