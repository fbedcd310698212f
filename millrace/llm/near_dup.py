"""N-gram Jaccard self-join: MinHash banding proposes, exact shingle counts decide.

Each tree is a band: a fixed number of MinHash labels, and documents that share them all are candidates. The number is
the greatest up to ``DEEPEST`` at which a pair at the threshold shares a band with the wanted recall; nothing is
shortened on data, so this is not an LSH forest. Candidates are gathered into components; the texts of a component
meet once, and there every pair is counted exactly through posting lists, without pairs being written.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import SPACE, filled, query, read, stripped
from millrace.session import freeze

SHINGLE = 5
THRESHOLD = 0.8
TREES = 24
DEEPEST = 10
RECALL = 0.9999
#: Texts that meet in one task: a larger component is split into blocks, and each two of them meet.
BLOCK_ROWS = 1000
BLOCK_BYTES = 8_000_000

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def depth_for(threshold: float, trees: int, recall: float, deepest: int = DEEPEST) -> int:
    """Shorten the prefix from ``deepest`` until a pair at ``threshold`` meets in some tree with ``recall``."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_hashes(words: list[str], memo: dict[str, int]) -> np.ndarray:
    """64-bit hashes of all windows of five words; a shorter text is one window."""
    if len(memo) > 200_000:
        memo.clear()
    numbers = np.empty(len(words), np.uint64)
    for i, word in enumerate(words):
        number = memo.get(word)
        if number is None:
            data = word.encode()
            number = memo[word] = zlib.crc32(data) << 32 | zlib.crc32(data, 0x5BD1E995)
        numbers[i] = number
    n = max(1, len(words) - SHINGLE + 1)
    mixed = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(words))):
        mixed = (mixed ^ numbers[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def labels_of(hashes: np.ndarray, multiply: np.ndarray, add: np.ndarray) -> np.ndarray:
    """MinHash labels of a shingle set, one per function, in bounded pieces."""
    least = np.full(len(multiply), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        mixed = hashes[at : at + 2048, None] * multiply + add
        mixed ^= mixed >> np.uint64(32)
        np.minimum(least, mixed.min(axis=0), out=least)
    return least


def raw_key(text: str):
    return F.unhex(F.md5(filled(text)))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, raw_key, words_key``: MD5 of the text and of its words, the latter null where there is none."""
    said = F.regexp_replace(stripped(filled(text)), f"{SPACE}+", " ")
    return docs.select(F.col(doc_id).alias("doc_id"), raw_key(text).alias("raw_key"),
                       F.when(said != "", F.unhex(F.md5(said))).alias("words_key"))


def forest(docs: DataFrame, trees: int = TREES, recall: float = RECALL, threshold: float = THRESHOLD) -> DataFrame:
    """``raw_key, prefixes``: each text's prefix in every tree, hashed to a long. Input: ``raw_key, text``."""
    depth = depth_for(threshold, trees, recall)
    draw = np.random.default_rng(11)
    multiply = draw.integers(1, 2**63, trees * depth, np.uint64) * np.uint64(2) + np.uint64(1)
    add = draw.integers(0, 2**63, trees * depth, np.uint64)
    fold = draw.integers(1, 2**63, depth, np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        memo: dict[str, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = []
                for t in part.column(1).to_pylist():
                    labels = labels_of(shingle_hashes(_WORDS.findall(t), memo), multiply, add).reshape(trees, depth)
                    prefix = np.zeros(trees, np.uint64)
                    for level in range(depth):
                        prefix = (prefix ^ labels[:, level]) * fold[level]
                        prefix ^= prefix >> np.uint64(31)
                    found.append(prefix.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(pa.int64()))], ["raw_key", "prefixes"])

    return docs.select("raw_key", "text").mapInArrow(run, "raw_key binary, prefixes array<long>")


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the least node of each component of ``edges`` (``a, b``); nodes without an edge are not listed.

    Large-star and small-star rounds: each replaces the edges by edges to the least neighbour, so their number never
    grows, and ends when a round changes nothing, after about the logarithm of the longest path.
    """
    now = freeze(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("root"))
        large = freeze(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct())
        # small star: every node's smaller neighbours, and the node itself, to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        joined = large.join(least, "a")
        now = freeze(joined.select(F.col("b").alias("a"), F.col("root").alias("b"))
                     .unionByName(least.select("a", F.col("root").alias("b"))).where("a != b").distinct())
        said = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if said == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = said


def count_links(texts: list[str], copies: np.ndarray, side: np.ndarray | None, threshold: float):
    """Links of every text to the others (copies of these count), and the least text of its linked group.

    Shingles are numbered exactly, by their words. For each text the numbers of its shingles that the others share
    are added up through posting lists. With ``side``, only pairs of different sides count.
    """
    index: dict[tuple, int] = {}
    rows = []
    for text in texts:
        words = _WORDS.findall(text)
        windows = {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}
        rows.append(np.fromiter((index.setdefault(w, len(index)) for w in windows), np.int64, len(windows)))
    del index
    sizes = np.array([len(r) for r in rows])
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(flat, kind="stable")
    owner, starts = owner[order], np.searchsorted(flat[order], np.arange(flat.max() + 2))
    frequent = np.diff(starts) > 1
    links, root = np.zeros(len(rows), np.int64), np.arange(len(rows))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, row in enumerate(rows):
        row = row[frequent[row]]
        if not len(row):
            continue
        shared = np.bincount(np.concatenate([owner[starts[s] : starts[s + 1]] for s in row]), minlength=len(rows))
        near = shared >= threshold * (sizes + sizes[i] - shared) - 1e-9
        near[i] = False
        if side is not None:
            near &= side != side[i]
        links[i] = copies[near].sum()
        for j in np.flatnonzero(near):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return links, np.array([find(i) for i in range(len(rows))])


def verify(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``words_key, n_links, linked_to`` from ``component, lo, hi, words_key, copies, block, text``, a block pair at a time."""

    def run(table: pa.Table) -> pa.Table:
        keys = table.column("words_key").to_pylist()
        first = sorted({k: i for i, k in enumerate(keys)}.values(), key=lambda i: keys[i])  # rows may repeat a document
        table = table.take(pa.array(first))
        keys = [keys[i] for i in first]
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        side = None if lo == hi else table.column("block").to_numpy()
        links, root = count_links(table.column("text").to_pylist(), table.column("copies").to_numpy(), side, threshold)
        return pa.table({"words_key": pa.array(keys, pa.binary()), "n_links": pa.array(links),
                         "linked_to": pa.array([keys[r] for r in root], pa.binary())})

    return members.groupBy("component", "lo", "hi").applyInArrow(run, "words_key binary, n_links long, linked_to binary")


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, class_id, n_links, class_size, class_key``.

    Two documents are linked when their sets of five-word shingles have a Jaccard similarity of at least
    ``threshold``; a text of fewer words is one shingle. ``n_links`` counts linked documents, exact copies included,
    without listing them; a class is a connected group, named by its smallest id that is not null. Ids may be null or
    repeat, so ``class_key`` (the key of its least text) tells classes apart where ids do not. A null text or one
    without a word has no shingle, no link and a class of its own, without a key. Repeated rows are copies of each other. Only the id and the text
    are read, so other columns cannot clash; an empty table gives no rows.
    """
    return keyed_classes(docs, doc_id, text, threshold).select("doc_id", "class_id", "n_links", "class_size", "class_key")


def keyed_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``jaccard_classes`` with the ``raw_key`` of each row."""
    rows = freeze(keyed(docs, doc_id, text))
    texts = freeze(rows.where("words_key IS NOT NULL").groupBy("words_key")
                   .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "raw_key")).alias("one"), F.count("*").alias("copies"))
                   .select("words_key", F.col("one.doc_id").alias("one_id"), F.col("one.raw_key").alias("one_key"), "copies"))
    whole = docs.select(F.col(doc_id).alias("this_id"), raw_key(text).alias("raw_key"), filled(text).alias("text"))
    signed = freeze(forest(whole, threshold=threshold).dropDuplicates(["raw_key"])
                    .join(texts, F.col("raw_key") == F.col("one_key")).select("words_key", "prefixes"))
    leaves = signed.select("words_key", F.posexplode("prefixes").alias("tree", "prefix"))
    shared = freeze(leaves.groupBy("tree", "prefix").agg(F.min("words_key").alias("b"), F.count("*").alias("n"))
                    .where("n > 1").drop("n"))
    proposed = leaves.join(shared, ["tree", "prefix"]).select(F.col("words_key").alias("a"), "b").distinct()
    found = freeze(components(proposed).join(texts, F.col("node") == F.col("words_key")).drop("node"))
    # The same shuffled join at every size: the candidates grow with the corpus.
    bodies = freeze(whole.join(found.hint("merge"), (F.col("raw_key") == F.col("one_key"))
                               & F.col("this_id").eqNullSafe(F.col("one_id")))
                    .select(F.col("root").alias("component"), "words_key", "copies", "text"))
    sizes = bodies.groupBy("component").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES)).cast("int").alias("blocks"))
    placed = bodies.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("words_key"), "blocks").cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "words_key", "copies", "block", "text")
    verified = freeze(verify(met, threshold))
    classes = components(verified.select(F.col("words_key").alias("a"), F.col("linked_to").alias("b")))
    links = verified.groupBy("words_key").agg(F.sum("n_links").alias("other_links"))
    known = freeze(texts.join(links, "words_key", "left").join(classes, F.col("words_key") == F.col("node"), "left").select(
        "words_key", "one_id", "copies", (F.col("copies") - 1 + F.coalesce("other_links", F.lit(0))).alias("n_links"),
        F.coalesce("root", "words_key").alias("class_key")))
    named = known.groupBy("class_key").agg(F.min("one_id").alias("class_id"), F.sum("copies").alias("class_size"))
    judged = freeze(known.join(named, "class_key").select("words_key", "class_key", "class_id", "n_links", "class_size"))
    return rows.join(judged, "words_key", "left").select(
        "doc_id", "raw_key", "class_key", F.when(F.col("words_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("class_size", F.lit(1)).alias("class_size"))


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` of each class, with all its columns: of the class's smallest id, null last, and its least text.

    Of rows that repeat id and text one stays; a document without a word stays.
    """
    from pyspark.sql import Window

    names = docs.columns
    wordless = F.col("class_key").isNull()
    # Ids may be null or repeat: the row is found by its id and text together.
    chosen = (keyed_classes(docs, doc_id, text)
              .groupBy("class_key", F.when(wordless, F.col("doc_id")).alias("own_id"), F.when(wordless, F.col("raw_key")).alias("own_key"))
              .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "raw_key")).alias("one"))
              .select(F.col("one.doc_id").alias("__kept_id"), F.col("one.raw_key").alias("__kept_key")))
    kept = docs.withColumn("__key", raw_key(text)).join(
        chosen, (F.col("__key") == F.col("__kept_key")) & F.col(doc_id).eqNullSafe(F.col("__kept_id")))
    nth = F.row_number().over(Window.partitionBy("__kept_id", "__key").orderBy("__kept_id"))
    return kept.withColumn("__nth", nth).where("__nth = 1").select(*names)


@query("op6_jaccard_join")
def jaccard_join(spark, folder):
    return jaccard_classes(read(spark, folder, "documents"))
