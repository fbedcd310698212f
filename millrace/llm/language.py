"""Language identification by rank-order profiles of n-grams and the out-of-place distance."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.base import query, read

#: N-grams of a profile and of a document, and their lengths; a word is padded with one blank on both sides.
PROFILE = 300
LONGEST = 4
#: The profiles are shared with all workers, so the number of languages is bounded; beyond it the fit fails.
MOST_LANGUAGES = 1000
#: Words counted together, so that a very long text takes bounded memory.
CHUNK = 100_000

_LETTERS = re.compile(r"[^\W\d_]+")


def gram_keys(words: list[str], longest: int = LONGEST) -> np.ndarray:
    """All n-grams of the padded words as longs, 16 bits a letter from the top; letters count by their lower 16 bits.

    Neighbouring words share a blank, and an n-gram with a blank inside belongs to no word.
    """
    if not 1 <= longest <= 4:
        raise ValueError("n-grams have 1 to 4 letters")
    letters = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.int64) & 0xFFFF
    blank = letters == 32
    found = [letters[~blank] << 48]
    key, inside = letters << 48, np.zeros(len(letters), bool)
    for n in range(2, longest + 1):
        size = len(letters) - n + 1
        key = key[:size] | letters[n - 1 :] << (64 - 16 * n)
        if n > 2:
            inside = inside[:size] | blank[n - 2 : n - 2 + size]
            found.append(key[~inside[:size]])
        else:
            found.append(key)
    return np.concatenate(found)


def gram_counts(words: list[str], longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in ascending order and their counts."""
    if len(words) <= CHUNK:
        return np.unique(gram_keys(words, longest) if words else np.zeros(0, np.int64), return_counts=True)
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, len(words), CHUNK):
        more = np.unique(gram_keys(words[at : at + CHUNK], longest), return_counts=True)
        keys, at_key = np.unique(np.concatenate([keys, more[0]]), return_inverse=True)
        counts = np.bincount(at_key, np.concatenate([counts, more[1]]), len(keys)).astype(np.int64)
    return keys, counts


def profiles(docs: DataFrame, size: int = PROFILE, longest: int = LONGEST) -> DataFrame:
    """``lang, gram, place``: the ``size`` most frequent n-grams of each language of ``docs``; ties by the n-gram.

    N-grams (``gram_keys``) are counted per batch before the shuffle. Rows without a language are not read.
    """

    def count(batches):
        for batch in batches:
            found: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    found.setdefault(lang, []).extend(_LETTERS.findall(text.lower()))
            for lang, words in found.items():
                keys, counts = gram_counts(words, longest)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts, pa.int64())],
                    ["lang", "gram", "n"])

    counted = (docs.where("lang IS NOT NULL").select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # A bare row number lets every task keep its own first ``size`` rows before they move.
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counted.withColumn("nth", nth).where(F.col("nth") <= size).select("lang", "gram", (F.col("nth") - 1).alias("place"))


class RankOrder:
    """The profiles as one table of places, n-grams by languages."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE, longest: int = LONGEST):
        self.size, self.longest = size, longest
        self.langs = sorted({lang for lang, _, _ in rows})
        self.grams = np.unique(np.array([gram for _, gram, _ in rows], np.int64))
        self.places = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)  # the last row: unknown n-grams
        column = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, place in rows:
            self.places[np.searchsorted(self.grams, gram), column[lang]] = place

    def profile(self, text: str) -> np.ndarray:
        """The document's most frequent n-grams, ties by the n-gram."""
        keys, counts = gram_counts(_LETTERS.findall(text.lower()), self.longest)
        if len(keys) > self.size:
            frequent = counts >= np.partition(counts, -self.size)[-self.size]
            keys, counts = keys[frequent], counts[frequent]
        return keys[np.argsort(-counts, kind="stable")[: self.size]]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: one less the share of the greatest distance; ``und`` and 0 without a letter."""
        top = self.profile(text) if text else ()
        if not len(top) or not self.langs:
            return "und", 0.0
        at = np.searchsorted(self.grams, top)
        at[self.grams[np.minimum(at, len(self.grams) - 1)] != top] = len(self.grams)
        rows = self.places[at]
        apart = np.where(rows < 0, self.size, np.abs(rows - np.arange(len(top))[:, None])).sum(axis=0)
        best = int(apart.argmin())
        return self.langs[best], float(1 - apart[best] / (self.size * len(top)))


def fit(docs: DataFrame, size: int = PROFILE, longest: int = LONGEST, most: int = MOST_LANGUAGES) -> RankOrder:
    """Learn profiles from all rows of ``docs`` that have a language; at most ``most`` times ``size`` rows come back.

    A language column with more than ``most`` values keeps those that the most rows have, ties by name; the profiles
    of the others, which some wrong values may be, are left out.
    """
    named = docs.where("lang IS NOT NULL").groupBy("lang").count()
    kept = named.orderBy(F.desc("count"), "lang").limit(most).select("lang")
    if named.count() > most:
        docs = docs.join(F.broadcast(kept), "lang", "left_semi")
    return RankOrder([tuple(r) for r in profiles(docs, size, longest).collect()], size, longest)


def identify(docs: DataFrame, model: RankOrder, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from its whole text alone.

    A text that is null or has no letter is ``und`` with score 0, and so is every text under a model without
    languages; ties go to the language that sorts first. Repeated rows get the same answer.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        ranks = shared.value
        for batch in batches:
            said = [ranks.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())],
                ["doc_id", "lang_pred", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text)).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double")


def remainder(doc_id: str, by: int):
    return F.crc32(F.col(doc_id).cast("string")) % by


@query("op8_language_id")
def language_id(spark, folder):
    docs = read(spark, folder, "documents", "doc_id", "text", "lang")
    model = fit(docs.where(remainder("doc_id", 3) != 1))
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
