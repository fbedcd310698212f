"""Repeated passages in large buckets: pieces against brute force, and the rows that a passage in many texts makes."""

import random
from collections import Counter

import pytest

from millrace.llm import repeats


def removed(texts, length):
    seen = Counter(d[i : i + length] for d in texts for i in range(len(d) - length + 1))
    out = []
    for d in texts:
        gone = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if seen[d[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        out.append((sum(gone), bytes(b for b, g in zip(d, gone) if not g)))
    return out


def letters(rng, size, alphabet="abcdefgh"):
    return "".join(rng.choices(alphabet, k=size))


def pasted(rng):
    """Texts of parts of common sources, some with a letter changed, between letters of their own."""
    sources = [letters(rng, 700), letters(rng, 300), "ab" * 200, "é" + letters(rng, 250) + "é"]
    for _ in range(60):
        parts = []
        for source in rng.choices(sources, k=3):
            a = rng.randrange(len(source) - 200)
            part = source[a : a + rng.randrange(150, 500)]
            at = rng.randrange(len(part))
            parts += [letters(rng, rng.randrange(60)), part if rng.random() < 0.6 else part[:at] + "z" + part[at + 1 :]]
        yield "".join(parts)


@pytest.mark.parametrize("length, pieces, most", [(200, (16, 1), 1), (200, (16, 1), 6), (200, (64, 8, 1), 1), (120, (16, 1), 1), (9, (16, 1), 1)])
def test_pieces_of_large_buckets(rows, monkeypatch, length, pieces, most):
    monkeypatch.setattr(repeats, "MOST_RANKS", most)
    monkeypatch.setattr(repeats, "PIECES", pieces)
    texts = list(pasted(random.Random(length + most)))
    docs = rows(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, bytes(r.kept_bytes)) for r in repeats.without_repeats(docs, length=length).collect()}
    assert [got[i] for i in range(len(texts))] == removed([t.encode() for t in texts], length)


def test_a_passage_in_many_texts_makes_few_rows(rows, monkeypatch):
    monkeypatch.setattr(repeats, "MOST_RANKS", 1)
    made, freeze = [], repeats.freeze

    def counted(df):
        frozen = freeze(df)
        made.append(frozen.count())
        return frozen

    monkeypatch.setattr(repeats, "freeze", counted)
    rng = random.Random(3)
    passage, n = letters(rng, 500), 50
    texts = [letters(rng, 300) + passage + letters(rng, 300) for _ in range(n)]
    docs = rows(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, bytes(r.kept_bytes)) for r in repeats.without_repeats(docs).collect()}
    assert [got[i] for i in range(n)] == removed([t.encode() for t in texts], 200)
    # a hash for each window of the runs at both ends would be over 150 rows a text
    assert max(made) < 60 * n
