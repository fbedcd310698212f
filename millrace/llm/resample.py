"""Importance resampling towards a target distribution, with exact ranks by regular sampling.

Word features of a text fall into a fixed number of buckets. Two counts, of the corpus and of the target, become one
array of gains, and a text's weight is the sum of the gains of its features. Seeded noise added to the weight makes
the highest scores a draw without replacement. The ranks come from a parallel sort by regular sampling: every task
sorts its own rows into a run, evenly spaced keys of the runs give the splitters, each run is cut at them, a segment's
pieces are merged in one task, and the counts of the segments before it give the ranks.
"""

from __future__ import annotations

import math
import re
import string
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.llm.base import query, read
from millrace.session import freeze

BUCKETS = 10_000
#: Rows of a segment, which one task merges; there are at least as many segments as shuffle partitions.
SEGMENT_ROWS = 4_000_000
#: Keys sampled for each segment: the driver sorts ``segments * OVERSAMPLE`` keys, some 240,000 for 60 billion rows.
OVERSAMPLE = 16
#: Bytes of a text that are cut into words at a time, and features whose bucket a task remembers.
PIECE = 1 << 20
MEMO = 1 << 19

# Words are runs of digits, a to z and whatever is not ASCII; in UTF-8 those are these bytes.
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


class Buckets(dict):
    """The bucket of each feature, remembered for the most recent ones."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[feature] = bucket = zlib.crc32(feature) % self.buckets
        return bucket


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """The words of UTF-8 ``data``, A-Z in lower case, by pieces that end with a word."""
    data, start = data.translate(_LOWER), 0
    while start < len(data):
        end = start + PIECE
        going_on = _WORDS.match(data, end) if end < len(data) else None
        end = going_on.end() if going_on else end
        yield _WORDS.findall(data, start, end)
        start = end


def buckets_of(data: bytes | None, known: Buckets, grams: int) -> Iterator[np.ndarray]:
    """Buckets of all runs of 1 to ``grams`` words, by pieces; a null text has none."""
    before: list[bytes] = []
    for words in words_of(data or b""):
        yield np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        run = before + words
        for n in range(2, grams + 1):
            # runs of n words that end in this piece
            late = run[max(len(before) - n + 1, 0):]
            joined = [b" ".join(late[i : i + n]) for i in range(len(late) - n + 1)]
            yield np.fromiter(map(known.__getitem__, joined), np.int64, len(joined))
        before = run[len(run) - grams + 1:] if grams > 1 else []


def bucket_counts(texts: DataFrame, text: str = "text", grams: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all features of all ``texts``, added up in each task first."""

    def run(batches):
        total, known = np.zeros(buckets, np.int64), Buckets(buckets)
        for batch in batches:
            for data in batch.column(0).cast(pa.binary()):
                for found in buckets_of(data.as_py(), known, grams):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return texts.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """What one feature of each bucket adds to a weight, from two tables of ``bucket, n`` (``buckets`` rows at most)."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, table in ((s, corpus), (t, target)):
        for row in table.collect():
            counts[row.bucket] = row.n
    total_s, total_t = float(s.sum()) + buckets, float(t.sum()) + buckets
    return np.array([math.floor(1000 * math.log((b + 1) * total_s / ((a + 1) * total_t))) for a, b in zip(s, t)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", grams: int = 1) -> DataFrame:
    """``doc_id, n_features, weight`` of every row of ``docs``, from its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one array of ``buckets`` numbers
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        gain, known = shared.value, Buckets(len(shared.value))
        for batch in batches:
            n, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, data in enumerate(batch.column(1).cast(pa.binary())):
                for found in buckets_of(data.as_py(), known, grams):
                    n[i] += len(found)
                    weight[i] += gain[found].sum()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(weight)], ["doc_id", "n_features", "weight"])

    return docs.select(F.col(doc_id).alias("doc_id"), text).mapInArrow(run, f"doc_id {kind}, n_features long, weight long")


def noise(doc_id: str, seed: int) -> Column:
    """Seeded Gumbel noise in thousandths; a null id counts as an empty one."""
    said = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(said, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


#: The order of the ranks: highest score, then smallest id, null last. Rows that agree in these are equal as a whole,
#: so run and place only make their keys differ: copies of one row can be cut anywhere.
_KEY = ("_less", "_none", "doc_id", "n_features", "_run", "_slot")
_SLOT_BITS = (1 << 33) - 1


def splitters(runs: DataFrame, n: int, segments: int) -> list[tuple]:
    """Keys that cut the sorted ``runs`` of ``n`` rows into about ``segments`` even parts.

    Each run gives the keys at every ``step``-th place, from a start of its own, so short runs are sampled in turn.
    """
    step = max(n // (segments * OVERSAMPLE), 1)
    start = F.pmod(F.col("_run") * F.lit(2654435761), F.lit(step))
    sample = runs.where(F.pmod(F.col("_slot") + start, F.lit(step)) == 0).select(*_KEY)
    return sorted(map(tuple, sample.collect()))[OVERSAMPLE - 1 :: OVERSAMPLE]


def in_segments(runs: DataFrame, cuts: list[tuple]) -> DataFrame:
    """Add ``_segment``: how many of the sorted ``cuts`` are not above the row's key."""
    shared = runs.sparkSession.sparkContext.broadcast(cuts)
    names = runs.columns

    def run(batches):
        cuts = shared.value
        firsts = np.array([cut[0] for cut in cuts], np.int64)
        for batch in batches:
            less = batch.column(names.index("_less")).to_numpy()
            segment, after = np.searchsorted(firsts, less, "left"), np.searchsorted(firsts, less, "right")
            tied = np.flatnonzero(segment < after)
            keys = zip(*[batch.column(names.index(c)).take(pa.array(tied)).to_pylist() for c in _KEY])
            segment[tied] = [bisect_right(cuts, key) for key in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment, pa.int64())], [*names, "_segment"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema)
    return runs.mapInArrow(run, f"{schema}, _segment long")


def draw(scored: DataFrame, percent: int = 10, least: int = 20) -> DataFrame:
    """Add ``rank`` to rows of ``doc_id, n_features, weight, score``: 1, 2, 3... of the drawn ones, else null.

    Drawn are the ``percent`` hundredths (rounded down) of the rows with at least ``least`` features that score
    highest. Segments beyond the last drawn row are counted, but not exchanged.
    """
    session = scored.sparkSession
    keyed = scored.withColumns({"_out": F.col("n_features") < least, "_less": -F.col("score"), "_none": F.col("doc_id").isNull()})
    runs = freeze(keyed.sortWithinPartitions("_out", *_KEY[:4]).select(
        "*", F.spark_partition_id().alias("_run"), F.monotonically_increasing_id().bitwiseAND(F.lit(_SLOT_BITS)).alias("_slot")))
    names = scored.columns
    rest = runs.where("_out").select(*names, F.lit(None).cast("long").alias("rank"))
    runs = runs.where("NOT _out").drop("_out")
    n = runs.count()
    wanted = n * percent // 100
    segments = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-n // SEGMENT_ROWS))
    placed = in_segments(runs, splitters(runs, n, segments))
    ahead, offsets = 0, []
    for row in sorted(placed.groupBy("_segment").count().collect()):  # a row per segment
        if ahead < wanted:
            offsets.append((row["_segment"], ahead))
        ahead += row["count"]
    before = F.broadcast(session.createDataFrame(offsets, "_segment long, _ahead long"))
    inside = Window.partitionBy("_segment").orderBy(*_KEY)
    place = F.col("_ahead") + F.row_number().over(inside)
    ranked = placed.join(before, "_segment").select(*names, F.when(place <= wanted, place).alias("rank"))
    undrawn = placed.join(before, "_segment", "left_anti").select(*names, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(undrawn).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least: int = 20, seed: int = 2024, grams: int = 1,
             buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``, drawn towards the texts of ``target``.

    A null or empty text has no features and weight 0. Ties go to the smaller id, a null id comes last; repeated rows
    are rows of their own with ranks of their own. An empty table of documents gives no rows; without target texts the
    gains only tell rare features from frequent ones. Very long texts are cut into words a piece at a time. Columns
    beside the id and the text are not read, so none can clash.
    """
    gain = gains(bucket_counts(docs, text, grams, buckets), bucket_counts(target, text, grams, buckets), buckets)
    scored = weights(docs, gain, doc_id, text, grams)
    return draw(scored.withColumn("score", F.col("weight") + noise("doc_id", seed)), percent, least)


@query("op11_resample", sql=r"""
    WITH RECURSIVE crc_steps(i, c, k) AS (
        SELECT i, i, 0 FROM range(256) r(i)
        UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8),
    crc AS (SELECT list(c ORDER BY i) AS tab FROM crc_steps WHERE k = 8),
    words AS (
        SELECT kind, row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
        FROM (SELECT 's' AS kind, row_number() OVER () AS row, doc_id, text FROM documents
              UNION ALL SELECT 't', 0, 0, text FROM benchmark)),
    counted AS (SELECT kind, row, doc_id, word, count(*) AS n FROM words GROUP BY ALL),
    hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM counted)),
    placed AS (
        SELECT word, xor(list_reduce(list_transform(range(0, len(h) // 2), lambda j: ('0x' || substr(h, (2 * j + 1)::INT, 2))::BIGINT),
                                     lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
        FROM hexed, crc),
    totals AS (SELECT bucket, sum(CASE kind WHEN 's' THEN n ELSE 0 END) AS s, sum(CASE kind WHEN 't' THEN n ELSE 0 END) AS t
               FROM counted JOIN placed USING (word) GROUP BY bucket),
    gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((sum(s) OVER ()) + 10000)::DOUBLE
                                             / ((s + 1)::DOUBLE * ((sum(t) OVER ()) + 10000)::DOUBLE)))::BIGINT AS gain FROM totals),
    weighed AS (SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
                FROM counted JOIN placed USING (word) JOIN gains USING (bucket) WHERE kind = 's' GROUP BY row),
    scored AS (
        SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                         / 4294967296::DOUBLE)))::BIGINT AS score
        FROM (SELECT row_number() OVER () AS row, doc_id FROM documents) LEFT JOIN weighed USING (row)),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
               count(*) OVER (PARTITION BY n_features >= 20) * 10 // 100 AS wanted
        FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= wanted THEN place END AS rank FROM ranked""")
def resampled(spark, folder):
    return resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
