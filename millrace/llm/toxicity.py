"""Toxicity by class-conditional Kneser-Ney models with shared backoff counts.

A word is a pair of symbols, its stem (the first letters) and its ending, so that inflected and rare forms of an
expression share what is known of the stem. Each class has a bigram model of these pairs: an ending after its stem
backs off to the continuation counts of both classes together, and a stem to the counts of both classes. Passages of
a document are compared by their log-likelihoods per word under the two models; a small logistic fit turns the
strongest passages and the whole text into a probability.

Counts are tables keyed by the stems and endings themselves and grow with the corpus. The likelihood ratios of the most
frequent words are broadcast; every other word meets its ratio in a join, so that the same word has the same ratio
either way.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import query, read
from millrace.session import freeze

STEM = 5
#: A ratio weighs n / (n + DOUBT), with n the words with its stem in the class that it speaks for: little seen is little sure.
DOUBT = 3.0
#: Words of the longest of the compared passages; the others are one word and the whole text.
PASSAGE = 3
#: Most words whose ratios are broadcast. This decides by which way a word meets its ratio, not the ratio.
MOST_COMMON = 1 << 19
#: Most labelled rows the logistic fit reads; everything else is counted over all training rows.
MOST_FIT_ROWS = 20_000
#: Texts whose words are looked up together.
TEXTS_AT_ONCE = 500
#: 1, the length, and the log-likelihood ratios per word of the strongest word, the strongest passage and the whole text.
FEATURES = 5

_WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def stem_of(word: str) -> Column:
    return F.substring(word, 1, STEM)


def ending_of(word: str) -> Column:
    return F.expr(f"substring({word}, {STEM + 1})")


def word_counts(rows: DataFrame) -> DataFrame:
    """``stem, ending, n0, n1``: words of ordinary and toxic ``rows`` (``text, toxic``), counted per batch first."""

    def run(batches):
        for batch in batches:
            found = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[toxic].update(words_of(text))
            words = list(found[0] | found[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), *[pa.array([f[w] for w in words], pa.int64()) for f in found]],
                ["word", "n0", "n1"])

    return (rows.select("text", "toxic").mapInArrow(run, "word string, n0 long, n1 long")
            .groupBy(stem_of("word").alias("stem"), ending_of("word").alias("ending"))
            .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))


class Smoothing(NamedTuple):
    """A distribution's total, the discounts of its counts, and the share that they leave."""

    total: float
    discounts: tuple[float, float, float]
    left: float

    def less(self, n: Column) -> Column:
        """What is taken from a count."""
        one, two, more = map(F.lit, self.discounts)
        return F.when(n <= 0, 0.0).when(n == 1, one).when(n == 2, two).otherwise(more)

    def kept(self, n: Column) -> Column:
        return (n - self.less(n)) / F.lit(max(self.total, 1.0))


def count_of_counts(n: Column) -> Column:
    """``total, c1, c2, c3, c4, kinds``: the sum of ``n``, how often it is 1 to 4, and how often it is not 0."""
    return F.struct(F.sum(n).alias("total"), *[F.count_if(n == i).alias(f"c{i}") for i in (1, 2, 3, 4)],
                    F.count_if(n > 0).alias("kinds"))


def discounts_of(c1: int, c2: int, c3: int, c4: int) -> tuple[float, float, float]:
    """Kneser-Ney discounts of counts of 1, 2 and more, from how often the counts 1 to 4 occur.

    Each is below its count, so a count is never lost as a whole, and a greater count keeps more. Without a count to estimate it from, a discount is
    that of the count below, the first 0.75.
    """
    share = c1 / (c1 + 2 * c2) if c1 else 0.75
    found, last = [], 0.75
    for i, (n, more) in enumerate(((c1, c2), (c2, c3), (c3, c4)), 1):
        if n and more:
            last = min(max(i - (i + 1) * share * more / n, 0.05), (found[-1] if found else 0) + 0.95)
        found.append(last)
    return tuple(found)


def smoothing(said) -> Smoothing:
    total, discounts = float(said.total or 0), discounts_of(said.c1, said.c2, said.c3, said.c4)
    taken = said.c1 * discounts[0] + said.c2 * discounts[1] + (said.kinds - said.c1 - said.c2) * discounts[2]
    return Smoothing(total, discounts, taken / total if total else 1.0)


class Tables(NamedTuple):
    """Counts of both classes as frozen tables, and what their distributions leave to the shared ones."""

    counts: DataFrame  # stem, ending, n0, n1
    stems: DataFrame  # stem; of each class the words with the stem, and its endings seen once, twice, more often
    endings: DataFrame  # ending, continued: distinct stems before it in each class, added
    pairs: tuple[Smoothing, Smoothing]
    firsts: tuple[Smoothing, Smoothing]
    shared: tuple[Smoothing, Smoothing]  # of stems and of endings
    unseen: tuple[float, float]  # shared likelihood of one stem and of one ending before any count


def tables(rows: DataFrame) -> Tables:
    """Count all training rows; only totals come to the driver."""
    counts = freeze(word_counts(rows))
    stems = freeze(counts.groupBy("stem").agg(*[
        what for c in "01" for n in [F.col(f"n{c}")] for what in (
            F.sum(n).alias(f"s{c}"), F.count_if(n == 1).alias(f"one{c}"), F.count_if(n == 2).alias(f"two{c}"),
            F.count_if(n > 2).alias(f"more{c}"))]))
    endings = freeze(counts.groupBy("ending").agg((F.count_if(F.col("n0") > 0) + F.count_if(F.col("n1") > 0)).alias("continued")))
    of_pairs = counts.agg(*[count_of_counts(F.col(c)).alias(c) for c in ("n0", "n1")]).first()
    of_stems = stems.withColumn("both", F.col("s0") + F.col("s1")).agg(
        *[count_of_counts(F.col(c)).alias(c) for c in ("s0", "s1", "both")]).first()
    of_endings = endings.agg(count_of_counts(F.col("continued")).alias("continued")).first().continued
    shared = (smoothing(of_stems.both), smoothing(of_endings))
    # one kind more than was seen: a stem or an ending that no row has
    unseen = tuple(s.left / (kinds + 1) for s, kinds in zip(shared, (of_stems.both.kinds, of_endings.kinds)))
    return Tables(counts, stems, endings, tuple(map(smoothing, of_pairs)),
                  (smoothing(of_stems.s0), smoothing(of_stems.s1)), shared, unseen)


def ratios(words: DataFrame, model: Tables) -> DataFrame:
    """``word, ratio``: toxic less ordinary log-likelihood of the distinct ``words`` (``word``), by the weight of its evidence."""
    # The counts grow with the corpus: the same shuffled joins at every size, never a broadcast.
    met = (words.select("word", stem_of("word").alias("stem"), ending_of("word").alias("ending"))
           .join(model.counts.hint("merge"), ["stem", "ending"], "left")
           .join(model.stems.hint("merge"), "stem", "left")
           .join(model.endings.hint("merge"), "ending", "left").na.fill(0))
    stem = model.shared[0].kept(F.col("s0") + F.col("s1")) + F.lit(model.unseen[0])
    ending = model.shared[1].kept(F.col("continued")) + F.lit(model.unseen[1])
    logs = []
    for c in (0, 1):
        n, s = F.col(f"n{c}"), F.col(f"s{c}")
        pair, first = model.pairs[c], model.firsts[c]
        likely = first.kept(s) + F.lit(first.left) * stem
        lost = sum(F.col(f"{kind}{c}") * d for kind, d in zip(("one", "two", "more"), pair.discounts))
        after = F.when(s > 0, (n - pair.less(n) + lost * ending) / s).otherwise(ending)
        logs.append(F.log(likely) + F.log(after))
    said = F.when(logs[1] > logs[0], F.col("s1")).otherwise(F.col("s0"))
    return met.select("word", ((logs[1] - logs[0]) * said / (said + F.lit(DOUBT))).alias("ratio"))


def common(model: Tables, most: int) -> tuple[list[str], np.ndarray]:
    """The most frequent words of the training rows, at most ``most``, and their ratios."""
    n = F.col("n0") + F.col("n1")
    sized = model.counts.select(F.concat("stem", "ending").alias("word"), F.floor(F.log2(n) * 8).cast("int").alias("size"))
    least, words = None, 0
    for size, kinds in sorted(sized.groupBy("size").count().collect(), reverse=True):
        words += kinds
        if words > most:
            break
        least = size
    if least is None:
        return [], np.zeros(0)
    found = ratios(sized.where(F.col("size") >= least).select("word"), model).toArrow()
    return found.column("word").to_pylist(), found.column("ratio").to_numpy()


def lookup(texts: list[list[str]], known: dict[str, float]):
    """What ``known`` says of every text, and what its other words are still to add.

    Of each text: words, the sum of the known ratios, the greatest, the greatest sum of a passage of known words;
    the unknown words in order; and the passages with ``n`` of them from the ``at``-th on, with the greatest sum of
    the known ratios in such a passage.
    """
    sizes = np.array([len(t) for t in texts])
    # shorter texts are filled up to one passage with words that say nothing
    filled = np.maximum(sizes, PASSAGE)
    starts = np.cumsum(filled) - filled
    flat = np.zeros(filled.sum())
    real = np.zeros(len(flat), bool)
    get = known.get
    for words, start in zip(texts, starts):
        flat[start : start + len(words)] = [get(w, np.nan) for w in words]
        real[start : start + len(words)] = True
    rare = np.isnan(flat)
    flat[rare] = 0.0
    single = np.where(real & ~rare, flat, -np.inf)
    before = np.concatenate([[0], np.cumsum(rare)])
    whole = np.add.reduceat(flat, starts)
    inside = np.ones(len(flat), bool)
    for k in range(1, PASSAGE):
        inside[starts + filled - k] = False
    sums = np.full(len(flat), -np.inf)
    at = np.flatnonzero(inside)
    sums[at] = sum(flat[at + k] for k in range(PASSAGE))
    n = np.zeros(len(flat), np.int64)
    n[at] = before[at + PASSAGE] - before[at]
    passage = np.maximum.reduceat(np.where(n == 0, sums, -np.inf), starts)
    # Passages in order have the same or a later first unknown word, and from the same one on the same or more.
    open_at = np.flatnonzero(n)
    text_of = np.searchsorted(starts, open_at, "right") - 1
    first, many = before[open_at], n[open_at]
    edges = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (many[1:] != many[:-1])]) if len(open_at) else open_at
    best = np.maximum.reduceat(sums[open_at], edges) if len(open_at) else np.zeros(0)
    text_of, first, many = text_of[edges], first[edges], many[edges]
    bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
    unknown = [[w for w in words if w not in known] for words in texts]
    return (sizes, whole, np.maximum.reduceat(single, starts), passage, unknown,
            bounds, first - before[starts][text_of], many, best)


def evidence(docs: DataFrame, model: Tables, most_common: int = MOST_COMMON) -> DataFrame:
    """``doc_id, x`` of every row of ``docs`` (``doc_id, text``): its features, from its whole text."""
    words, said = common(model, most_common)
    shared = docs.sparkSession.sparkContext.broadcast((words, said))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def look(batches):
        known = dict(zip(shared.value[0], shared.value[1].tolist()))
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(start, TEXTS_AT_ONCE)
                sizes, whole, single, passage, unknown, bounds, at, many, best = lookup(
                    [words_of(t) for t in part.column(1).to_pylist()], known)
                offsets = pa.array(bounds, pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v, t))
                         for v, t in ((at, pa.int32()), (many, pa.int32()), (best, pa.float64()))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + part.num_rows)), part.column(0), pa.array(sizes, pa.int32()), pa.array(whole),
                     pa.array(single), pa.array(passage), pa.array(unknown, pa.list_(pa.string())), *lists],
                    ["row", "doc_id", "words", "whole", "single", "passage", "unknown", "at", "many", "best"])
                row += part.num_rows

    looked = freeze(docs.select("doc_id", "text").mapInArrow(
        look, f"row long, doc_id {kind}, words int, whole double, single double, passage double, unknown array<string>, "
              "at array<int>, many array<int>, best array<double>"))
    each = looked.select("row", F.posexplode("unknown").alias("nth", "word"))
    rated = ratios(each.select("word").distinct(), model)
    added = (each.join(rated.hint("merge"), "word").groupBy("row")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "ratio"))), lambda r: r["ratio"]).alias("added")))
    met = looked.drop("unknown").join(added.hint("merge"), "row", "left")

    def finish(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                whole, single, passage, words = r["whole"], r["single"], r["passage"], max(r["words"], 1)
                if r["added"]:
                    late = np.array(r["added"])
                    run = np.concatenate([[0.0], np.cumsum(late)])
                    at, many = np.array(r["at"]), np.array(r["many"])
                    whole, single = whole + run[-1], max(single, late.max())
                    passage = max(passage, (run[at + many] - run[at] + np.array(r["best"])).max())
                if not r["words"]:
                    single = 0.0
                out.append([1.0, np.log1p(words), single, passage / min(words, PASSAGE), whole / words])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(pa.float64()))], ["doc_id", "x"])

    return met.select("doc_id", "words", "whole", "single", "passage", "at", "many", "best", "added").mapInArrow(
        finish, f"doc_id {kind}, x array<double>")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    if not len(y):
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return w


def train(docs: DataFrame, labels: DataFrame, most_fit_rows: int = MOST_FIT_ROWS) -> tuple[Tables, DataFrame]:
    """Learn from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``): the tables, and the ids to fit on.

    An eighth of the labelled ids, at most ``most_fit_rows``, fits the logistic step and is not counted; all others
    are counted. Labels without an id or value are not used, and an id labelled twice is toxic if one label says so.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    turn = F.xxhash64("doc_id")
    sample = freeze(known.where(F.pmod(turn, F.lit(8)) == 0).orderBy(turn, "doc_id").limit(most_fit_rows))
    counted = known.join(F.broadcast(sample.select("doc_id")), "doc_id", "left_anti")
    # Labels grow with the corpus: the same shuffled join at every size, never a broadcast.
    return tables(docs.join(counted.hint("merge"), "doc_id")), sample


def score(docs: DataFrame, model: Tables, sample: DataFrame, most_fit_rows: int = MOST_FIT_ROWS, least: float = 0.3,
          most_common: int = MOST_COMMON) -> DataFrame:
    """``doc_id, score, predicted`` of every row, from its whole text alone; ``sample`` (``doc_id, toxic``) is fitted.

    A null or empty text is scored by the fit's base rate. Repeated rows get the same score.
    """
    seen = freeze(evidence(docs, model, most_common))
    # Bounded by ``most_fit_rows``, also where documents repeat an id.
    found = seen.join(F.broadcast(sample), "doc_id").select("x", "toxic").limit(most_fit_rows).toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(-1, FEATURES)
    weights = logistic(x, found.column("toxic").to_numpy().astype(float))
    said = sum(F.col("x")[i] * F.lit(float(w)) for i, w in enumerate(weights))
    said = F.greatest(F.least(said, F.lit(30.0)), F.lit(-30.0))
    return seen.select("doc_id", (1 / (1 + F.exp(-said))).alias("score")).withColumn(
        "predicted", (F.col("score") >= least).cast("int"))


@query("op5_toxicity")
def toxicity(spark, folder):
    docs = read(spark, folder, "documents", "doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    labels = read(spark, folder, "labels", "doc_id", "toxic").where(fold != 2)
    model, sample = train(docs.where(fold != 2), labels)
    return score(docs, model, sample).select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score", "predicted")
