"""License scan by diagonal voting.

Rolling hashes of word k-grams are joined to the positions of the same grams in license templates. A match votes for
the diagonal ``place in the text - place in the template``; an untouched copy puts all its votes on one diagonal, a word
more or less moves the rest to a neighbouring one. Neighbouring diagonals are merged into spans, and a span is verified
word by word against the text before it counts.
"""

from __future__ import annotations

import re
import string
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.base import query, read
from millrace.session import freeze

#: Words of a gram: three for templates of fewer than ten words, else five.
SHORT, LONG = 3, 5
#: Diagonals of one template at most this far apart are one span; phrases must stand on a single one.
NEAR = 3
#: The share of a template's words that must stand in a span; phrases need all.
COVER = 0.75
#: Words whose hash a task remembers, and grams that leave Python together.
MEMO = 1 << 19
GRAMS_AT_ONCE = 1 << 17

# Words are runs of digits, a to z and whatever is not ASCII; in UTF-8 those are these bytes.
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


class Template(NamedTuple):
    label: str
    words: tuple[bytes, ...]
    base: bool

    @property
    def gram(self) -> int:
        return SHORT if len(self.words) < 10 else LONG

    @property
    def apart(self) -> int:
        return 0 if self.gram == SHORT else NEAR

    @property
    def least(self) -> float:
        return 1.0 if self.gram == SHORT else COVER


def template(label: str, text: str, base: bool = False) -> Template:
    return Template(label, tuple(_WORDS.findall(text.encode().translate(_LOWER))), base)


# The phrases of the contract.
BASE = (
    template("mit", "under the mit license", True),
    template("apache-2", "apache license version 2", True),
    template("cc-by-nc", "cc by nc", True),
)

# The notices that these licenses ask to be put on a work, as their public texts give them.
NOTICES = (
    template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
        use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"""),
    template("apache-2", """you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0"""),
    template("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met"""),
    template("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies"""),
    template("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation"""),
    template("gpl", "GNU General Public License"),
    template("gpl-3", "GNU General Public License version 3"),
    template("gpl-2", "GNU General Public License version 2"),
    template("lgpl", "GNU Lesser General Public License"),
    template("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file"""),
    template("mpl-2", "Mozilla Public License version 2"),
    template("unlicense", "This is free and unencumbered software released into the public domain"),
    template("cc-by", "Creative Commons Attribution 4 0 International"),
    template("cc-by-sa", "Creative Commons Attribution ShareAlike 4 0 International"),
    template("cc-by-nc", "Creative Commons Attribution NonCommercial 4 0 International"),
    template("cc-by-sa", "CC BY SA"),
    template("cc0", "CC0 1 0 Universal"),
)


class Hashes(dict):
    """The 64-bit hash of each word, remembered for the most recent ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def grams_of(numbers: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, from the words' hashes."""
    n = len(numbers) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    mixed = np.full(n, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ numbers[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def numbered(words: list[bytes], known: Hashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def words_of(data: bytes) -> list[bytes]:
    return _WORDS.findall(data.translate(_LOWER))


def positions(templates: tuple[Template, ...]) -> list[tuple[int, int, int]]:
    """``hash, template, at`` of every gram of every template: as many rows as the templates have words."""
    known = Hashes()
    return [(int(h), t, at) for t, each in enumerate(templates)
            for at, h in enumerate(grams_of(numbered(list(each.words), known), each.gram))]


def looked_at(docs: DataFrame, templates: tuple[Template, ...], doc_id: str, text: str) -> DataFrame:
    """``row, doc_id, n_words, text`` of every row; the text only where one of its grams is some template's.

    This is the semi-join of all rolling hashes with those of the templates, made where the text is read, so that
    texts without any match go no further.
    """
    wanted = np.unique(np.array([h for h, _, _ in positions(templates)], np.int64))
    sizes = sorted({t.gram for t in templates})
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        known = Hashes()
        for batch in batches:
            n, hit = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, bool)
            for i, data in enumerate(batch.column(1).cast(pa.binary())):
                numbers = numbered(words_of(data.as_py() or b""), known)
                n[i] = len(numbers)
                for size in sizes:
                    grams = grams_of(numbers, size)
                    at = np.minimum(np.searchsorted(wanted, grams), max(len(wanted) - 1, 0))
                    if len(grams) and len(wanted) and (wanted[at] == grams).any():
                        hit[i] = True
            text = pc.if_else(pa.array(hit), batch.column(1), pa.scalar(None, batch.column(1).type))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), text], ["doc_id", "n_words", "text"])

    found = docs.select(F.col(doc_id).alias("doc_id"), text).mapInArrow(run, f"doc_id {kind}, n_words long, text string")
    return freeze(found.withColumn("row", F.monotonically_increasing_id()))


def votes(texts: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """``row, template, diagonal, first, last`` with the matched places of each diagonal, from ``row, text``."""
    sizes = sorted({t.gram for t in templates})

    def together(parts):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in zip(*parts)], ["row", "hash", "place"])

    def run(batches):
        known, parts, n = Hashes(), [], 0
        for batch in batches:
            for row, data in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                numbers = numbered(words_of(data.as_py()), known)
                for size in sizes:
                    grams = grams_of(numbers, size)
                    parts.append((np.full(len(grams), row, np.int64), grams, np.arange(len(grams))))
                    n += len(grams)
                if n > GRAMS_AT_ONCE:
                    yield together(parts)
                    parts, n = [], 0
        if parts:
            yield together(parts)

    rolling = texts.select("row", "text").mapInArrow(run, "row long, hash long, place long")
    known = F.broadcast(texts.sparkSession.createDataFrame(positions(templates), "hash long, template int, at long"))  # the templates' words
    return (rolling.join(known, "hash").groupBy("row", "template", (F.col("place") - F.col("at")).alias("diagonal"))
            .agg(F.count("*").alias("votes")))


def spans(voted: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """Neighbouring diagonals merged: ``row, template, diagonals`` (start, end), those with enough votes to be verified.

    A word that differs spoils up to ``gram`` votes, so a span needs what is left of a template's grams when as many
    words differ as its least share allows.
    """
    rules = [(t, each.apart, max(1, round((len(each.words) - each.gram + 1)
                                          - (1 - each.least) * len(each.words) * each.gram)))
             for t, each in enumerate(templates)]
    known = F.broadcast(voted.sparkSession.createDataFrame(rules, "template int, apart int, needed long"))
    inside = Window.partitionBy("row", "template").orderBy("diagonal")
    begins = F.col("diagonal") - F.lag("diagonal").over(inside) > F.col("apart")
    return (
        voted.join(known, "template")
        .withColumn("begins", F.coalesce(begins, F.lit(True)).cast("long"))
        .withColumn("span", F.sum("begins").over(inside))
        .groupBy("row", "template", "span", "needed")
        .agg(F.sum("votes").alias("votes"), F.min("diagonal").alias("start"), F.max("diagonal").alias("end"))
        .where("votes >= needed").select("row", "template", "start", "end")
    )


def verified(words: list[bytes], each: Template, start: int, end: int) -> tuple[int, int, float] | None:
    """The first and last word of the span, and the share of the template's words found in order on its diagonals."""
    places, at = [], start
    for i, word in enumerate(each.words):
        for place in range(max(at, start + i, 0), min(end + i, len(words) - 1) + 1):
            if words[place] == word:
                places.append(place)
                at = place + 1
                break
    share = len(places) / len(each.words)
    return (places[0], places[-1], share) if places and share >= each.least else None


RESULT = ("n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "spans array<struct<label:string,first:long,last:long,score:double>>")


def findings(met: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """``row`` and its result, from ``row, text, found`` (``template, start, end``): every span verified on the words."""

    def run(batches):
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
            [("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))]
        for batch in batches:
            out = []
            for row, data, found in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2).to_pylist()):
                words, said, base = words_of(data.as_py()), [], []
                for f in found:
                    each = templates[f["template"]]
                    span = verified(words, each, f["start"], f["end"])
                    if span:
                        said.append({"label": each.label, "first": span[0], "last": span[1], "score": span[2]})
                        if each.base:
                            base.append((span[0], each.label))
                out.append((row, len(base), min(base)[0] if base else None, max(base)[0] if base else None,
                            ",".join(sorted({label for _, label in base})), ",".join(sorted({s["label"] for s in said})),
                            max((s["score"] for s in said), default=0.0),
                            sorted(said, key=lambda s: (s["first"], s["last"], s["label"]))))
            columns = list(zip(*out)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["row", *[f.split()[0] for f in RESULT.split(", ")[:-1]], "spans"])

    return met.select("row", "text", "found").mapInArrow(run, f"row long, {RESULT}")


def scan(docs: DataFrame, templates: tuple[Template, ...] = BASE + NOTICES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans`` of every row of ``docs``.

    ``n_base`` counts the places of the base phrases, overlapping ones too; ``spans`` has every verified span, ``score``
    is the greatest share of a template that stands in one. A null or empty text, or one without a license, has zeros,
    null places, empty labels and no spans. Repeated rows and null ids are rows of their own. An empty table gives no
    rows. Very long texts are read whole. Columns beside the id and the text are not read, so none can clash.
    """
    looked = looked_at(docs, templates, doc_id, text)
    texts = looked.where("text IS NOT NULL")
    found = spans(votes(texts, templates), templates).groupBy("row").agg(
        F.collect_list(F.struct("template", "start", "end")).alias("found"))  # bounded by the words of one text
    met = texts.select("row", "text").join(found.hint("merge"), "row")
    # The rows with spans grow with the corpus: the same join at every size, never a broadcast.
    told = looked.select("row", "doc_id", "n_words").join(findings(met, templates).hint("merge"), "row", "left")
    nothing = F.lit("")
    return told.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
                       F.coalesce("base_labels", nothing).alias("base_labels"), F.coalesce("labels", nothing).alias("labels"),
                       F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("spans", F.array().cast(
                           "array<struct<label:string,first:long,last:long,score:double>>")).alias("spans"))


@query("op12_licenses")
def licenses(spark, folder):
    return scan(read(spark, folder, "documents")).drop("spans")
