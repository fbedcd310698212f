"""Repeated passages: remove every byte of a long string that occurs again anywhere in the corpus.

Suffixes are compared blockwise, a bucket at a time, with a cover sample whose ranks settle long ties. The sample is
content-defined: of every window of ``length`` bytes, the place with the least hash of the next ``GRAM`` bytes. Equal
windows sample equal places, which a cover by residues of positions gives only pair by pair, and the sample is about
1.3 % of all places instead of 11 %. A sample's bucket holds all places with the same ``GRAM`` bytes. A run is the
maximal row of window starts with one sample; its rank is the hash of all bytes its windows cover. Runs of equal rank
are repeated as a whole. Only in buckets with unequal runs, where passages begin or end, are single windows compared,
one run for each rank: the bytes of these runs meet by bucket, one bucket at a time. In a bucket with many ranks the
runs are divided into pieces, and pieces at the same distance from the sample meet in buckets of their own, named by
the bytes that all their windows share. Pieces are judged as runs were: equal ones are repeated as a whole, those that
share their bytes with nobody are dropped, and what is left is divided again, at last into single windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import filled, query, read
from millrace.session import freeze

LENGTH = 200
GRAM = 50
#: Window starts handled together, so that a very long text takes bounded memory.
CHUNK = (1 << 20) - 2048
#: Ranks of a bucket whose bytes may meet in one task; the runs of larger buckets are divided.
MOST_RANKS = 500
#: Windows of a piece, at each division of what larger buckets hold; the last are single windows.
PIECES = (16, 1)
_BASE = 0x9E3779B97F4A7C15 | 1


class Sampler:
    """Finds samples and runs of one text after another; holds powers for the rolling hash."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        self.powers = self.inverses = np.ones(1, np.uint64)

    def extend(self, size: int) -> None:
        if size > len(self.powers):
            size = max(size, 2 * len(self.powers))
            inverse = pow(_BASE, -1, 1 << 64)
            base = np.full(size, _BASE, np.uint64)
            back = np.full(size, inverse, np.uint64)
            base[0] = back[0] = 1
            self.powers, self.inverses = np.multiply.accumulate(base), np.multiply.accumulate(back)

    def runs(self, data: bytes):
        """Arrays: first window start, number of starts, and bucket of each run of ``data``."""
        found = [self._chunk(data[at : at + CHUNK + self.length - 1], at) for at in range(0, len(data) - self.length + 1, CHUNK)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(part) for part in zip(*found))

    def place(self, data: bytes) -> int:
        """The place that the first window of ``data`` samples."""
        return self._least(data[: self.length])[1][0]

    def _chunk(self, data: bytes, offset: int):
        hashes, least = self._least(data)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1])
        return starts + offset, np.diff(np.append(starts, len(least))), hashes[least[starts]].view(np.int64)

    def _least(self, data: bytes):
        """The hash at every place, and the place that each window samples."""
        n, gram = len(data), self.gram
        self.extend(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
        hashes = (sums[gram:] - sums[:-gram]) * self.inverses[: n - gram + 1]
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(29)
        low = np.uint64((1 << 20) - 1)
        least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        width, span = self.length - gram + 1, 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        return hashes, (least & low).astype(np.int64)


def short_hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, key, text``: id and MD5 name a text, so rows without an id, or with the same, do not mix."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.md5(filled(text))).alias("key"),
                       filled(text).alias("text"))


def sampled(texts: DataFrame, length: int) -> DataFrame:
    """``doc_id, key, start, n, bucket, rank`` of every run of every text."""

    def run(batches):
        sampler = Sampler(length, min(GRAM, length))
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                row, starts, sizes, buckets, ranks = [], [], [], [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    data = text.encode()
                    if len(data) < length:
                        continue
                    s, n, b = sampler.runs(data)
                    row.append(np.full(len(s), i))
                    starts.append(s)
                    sizes.append(n)
                    buckets.append(b)
                    ranks += [short_hash(data[x : x + y + length - 1]) for x, y in zip(s.tolist(), n.tolist())]
                if row:
                    which = pa.array(np.concatenate(row))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(which), part.column(1).take(which), pa.array(np.concatenate(starts), pa.int64()),
                         pa.array(np.concatenate(sizes), pa.int32(), safe=False), pa.array(np.concatenate(buckets), pa.int64()),
                         pa.array(ranks, pa.int64())], ["doc_id", "key", "start", "n", "bucket", "rank"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, key binary, start long, n int, bucket long, rank long")


def regions_of(joined: DataFrame, length: int) -> DataFrame:
    """``bucket, large, doc_id, key, start, open, bytes`` of the listed runs (``runs``: bucket, large, start, n, open)."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                row, buckets, larges, starts, flags, regions = [], [], [], [], [], []
                for i, (text, runs) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                    data = text.encode()
                    for r in runs:
                        row.append(i)
                        buckets.append(r["bucket"])
                        larges.append(r["large"])
                        starts.append(r["start"])
                        flags.append(r["open"])
                        regions.append(data[r["start"] : r["start"] + r["n"] + length - 1])
                which = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int64()), pa.array(larges, pa.bool_()), part.column(0).take(which),
                     part.column(1).take(which), pa.array(starts, pa.int64()), pa.array(flags, pa.bool_()),
                     pa.array(regions, pa.binary())],
                    ["bucket", "large", "doc_id", "key", "start", "open", "bytes"])

    kind = joined.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        run, f"bucket long, large boolean, doc_id {kind}, key binary, start long, open boolean, bytes binary")


def pieces_of(regions: DataFrame, length: int, size: int) -> DataFrame:
    """``bucket, rank, doc_id, key, start, stop, open, bytes`` of the regions' pieces of at most ``size`` windows.

    A region's windows share one sampled place, and pieces are cut at fixed distances from it. So equal windows of
    different regions are in pieces at one distance, and any piece there with such a window holds the bytes that all
    windows at these distances share: these and the distance give the bucket.
    """
    size = min(size, length)

    def run(batches):
        sampler = Sampler(length, min(GRAM, length))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                row, buckets, ranks, starts, stops, pieces = [], [], [], [], [], []
                for i, (start, data) in enumerate(zip(part.column(2).to_pylist(), part.column(4).to_pylist())):
                    n, place = len(data) - length + 1, int(sampler.place(data))
                    cuts = [0, *range((place + 1) % size or size, n, size), n]
                    for s, e in zip(cuts, cuts[1:]):
                        apart = (place - s) // size
                        last = place - apart * size
                        row.append(i)
                        starts.append(start + s)
                        stops.append(start + e - 1 + length)
                        pieces.append(data[s : e - 1 + length])
                        buckets.append(short_hash(apart.to_bytes(8, "little") + data[last : last - size + 1 + length]))
                        ranks.append(short_hash(pieces[-1]))
                which = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int64()), pa.array(ranks, pa.int64()), part.column(0).take(which),
                     part.column(1).take(which), pa.array(starts, pa.int64()), pa.array(stops, pa.int64()), part.column(3).take(which),
                     pa.array(pieces, pa.binary())], ["bucket", "rank", "doc_id", "key", "start", "stop", "open", "bytes"])

    kind = regions.schema["doc_id"].dataType.simpleString()
    return regions.select("doc_id", "key", "start", "open", "bytes").mapInArrow(
        run, f"bucket long, rank long, doc_id {kind}, key binary, start long, stop long, open boolean, bytes binary")


def repeated(pieces: DataFrame) -> DataFrame:
    """Spans ``doc_id, key, start, stop`` of the open pieces that have an equal."""
    again = pieces.groupBy("bucket", "rank").agg(F.count("*").alias("same")).where("same > 1").drop("same")
    return pieces.where("open").join(again.hint("merge"), ["bucket", "rank"]).select("doc_id", "key", "start", "stop")


def undecided(pieces: DataFrame) -> DataFrame:
    """``bucket, large, doc_id, key, start, open, bytes`` of what is still to be compared: a piece of each rank in the
    buckets that have unequal pieces and an open one without an equal."""
    ones = pieces.groupBy("bucket", "rank").agg(
        F.count("*").alias("same"), F.min(F.struct("doc_id", "key", "start", "open", "bytes")).alias("one"))
    ones = freeze(ones.select("bucket", "one.doc_id", "one.key", "one.start",
                              (F.col("one.open") & (F.col("same") == 1)).alias("open"), "one.bytes"))
    mixed = ones.groupBy("bucket").agg(F.count("*").alias("ranks"), F.max("open").alias("alone"))
    mixed = mixed.where("ranks > 1 AND alone").select("bucket", (F.col("ranks") > MOST_RANKS).alias("large"))
    return ones.join(mixed.hint("merge"), "bucket").select(
        "bucket", "large", "doc_id", "key", "start", "open", "bytes")


def compared(regions: DataFrame, length: int) -> DataFrame:
    """Spans ``doc_id, key, start, stop`` of the open runs' windows that occur twice in their bucket.

    Rows come sorted by bucket, and a task holds one bucket at a time.
    """
    doc_type = regions.schema["doc_id"].dataType.simpleString()

    def spans(rows):
        if len(rows) < 2:
            return
        seen: dict[bytes, int] = {}
        for *_, data in rows:
            for s in range(len(data) - length + 1):
                window = data[s : s + length]
                seen[window] = seen.get(window, 0) + 1
        for doc_id, key, start, is_open, data in rows:
            first = None
            for s in range(len(data) - length + 2) if is_open else ():
                again = s <= len(data) - length and seen[data[s : s + length]] > 1
                if again and first is None:
                    first = s
                elif not again and first is not None:
                    yield doc_id, key, start + first, start + s - 1 + length
                    first = None

    def run(batches):
        bucket, rows = None, []
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            found = []
            for b, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if b != bucket:
                    found += spans(rows)
                    bucket, rows = b, []
                rows.append(row)
            yield as_batch(found, kind)
        if rows:
            yield as_batch(list(spans(rows)), kind)

    def as_batch(found, kind):
        columns = list(zip(*found)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], kind), pa.array(columns[1], pa.binary()), *[pa.array(c, pa.int64()) for c in columns[2:]]], ["doc_id", "key", "start", "stop"])

    sorted_rows = regions.repartition("bucket").sortWithinPartitions("bucket")
    return sorted_rows.mapInArrow(run, f"doc_id {doc_type}, key binary, start long, stop long")


def same_text(a: DataFrame, b: DataFrame):
    return a.doc_id.eqNullSafe(b.doc_id) & (a.key == b.key)


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, key, start, stop``: spans, which may overlap, whose bytes lie in repeated windows of ``length``."""
    runs = freeze(sampled(texts, length))
    ranked = runs.groupBy("bucket", "rank").agg(F.count("*").alias("same"))
    # a bucket is alive with two runs; it needs windows where it has unequal runs and one of them is alone
    alive = freeze(ranked.groupBy("bucket").agg(
        F.sum("same").alias("all"), ((F.count("*") > 1) & (F.min("same") == 1)).alias("mixed"),
        (F.count("*") > MOST_RANKS).alias("large")).where("all > 1").select("bucket", "mixed", "large"))
    live = freeze(runs.join(alive.hint("merge"), "bucket"))
    counts = live.groupBy("bucket", "rank").agg(
        F.count("*").alias("same"), F.max("mixed").alias("mixed"), F.max("large").alias("large"), F.min(F.struct("doc_id", "key", "start", "n")).alias("one"))
    counts = freeze(counts)
    whole = live.join(counts.where("same > 1").select("bucket", "rank"), ["bucket", "rank"]).select(
        "doc_id", "key", "start", (F.col("start") + F.col("n") + (length - 1)).alias("stop"))
    chosen = freeze(counts.where("mixed").select("bucket", "large", "one.*", (F.col("same") == 1).alias("open"))
                    .groupBy("doc_id", "key")
                    .agg(F.collect_list(F.struct("bucket", "large", "start", "n", "open")).alias("runs")))
    # The texts meet their chosen runs once, in the same shuffled join at every size: the runs grow with the corpus.
    # Rows that repeat a text give its runs twice, and these are repeated indeed.
    met = texts.join(chosen.hint("merge"), same_text(texts, chosen)).select(texts.doc_id, texts.key, texts.text, "runs")
    regions = freeze(regions_of(met, length))
    spans = whole.unionByName(compared(regions.where("NOT large").drop("large"), length))
    for size in PIECES:
        pieces = pieces_of(regions.where("large"), length, size)
        pieces = freeze(pieces if size > 1 else pieces.drop("bytes"))
        spans = spans.unionByName(repeated(pieces))
        if size > 1:
            regions = freeze(undecided(pieces))
            spans = spans.unionByName(compared(regions.where("NOT large").drop("large"), length))
    return spans


def cut(data: bytes, spans) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs removed, and what is left when ``spans`` (start, stop) are taken out."""
    removed, runs, kept, at = 0, 0, [], 0
    stop = -1
    for s, e in sorted(spans):
        if s > stop:
            runs += 1
            kept.append(data[at:s])
            removed += e - s
        elif e > stop:
            removed += e - stop
        stop = max(stop, e)
        at = stop
    kept.append(data[at:])
    return removed, runs, b"".join(kept)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes`` of every row.

    Every byte of a string of ``length`` bytes that starts anywhere else too, in the same text or another, is removed;
    matches are judged on the input and do not cross texts. A null text is empty; shorter texts stay as they are; of
    rows that repeat id and text each loses all its bytes, since each is the other's copy. An empty table gives no
    rows. Only the id and the text are read.
    """
    texts = keyed(docs, doc_id, text)
    spans = repeated_spans(texts, length).distinct().groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans"))
    spans = freeze(spans)
    joined = texts.join(spans.hint("merge"), same_text(texts, spans), "left").select(texts.doc_id, texts.text, "spans")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sizes, removed, runs, left = [], [], [], []
                for t, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    data = t.encode()
                    gone, parts, kept = cut(data, [(s["start"], s["stop"]) for s in spans or ()])
                    sizes.append(len(data))
                    removed.append(gone)
                    runs.append(parts)
                    left.append(kept)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                     pa.array([hashlib.sha256(k).hexdigest() for k in left]), pa.array(left, pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary")


@query("op3_repeated_passages")
def repeated_passages(spark, folder):
    return without_repeats(read(spark, folder, "documents")).drop("kept_bytes")
