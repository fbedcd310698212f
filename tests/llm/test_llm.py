"""The text operators against brute force on a small fixture: nulls, empty and repeated rows, copies, ties."""

import hashlib
import itertools
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, language, mixing, near_dup, pieces, quality, repeats, secrets

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew odd potions near cold rivers".split()
LONG = " ".join(WORDS[i * 7 % 17] + str(i % 23) for i in range(120))
ROWS = [
    (1, LONG), (2, LONG), (3, LONG.replace("the", "le", 1)), (4, None), (5, ""), (6, " \t\n"), (7, "x"),
    (8, "head " + LONG[100:420] + " tail"), (9, "password = hunter22 AKIA" + "A1" * 10 + " " + "ab12" * 8 + " é token:short"),
    (9, "password = hunter22 AKIA" + "A1" * 10 + " " + "ab12" * 8 + " é token:short"), (None, "no id here"), (10, "a b c " * 30),
]


@pytest.fixture
def docs(rows):
    return rows([(i, t, "en", None, "clash") for i, t in ROWS], "doc_id long, text string, lang string, source string, size string")


def test_exact_groups(docs):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in ROWS]
    sizes = Counter(norm)
    got = exact_dedup.exact_groups(docs).collect()
    assert sorted(r.text_sha256 for r in got) == sorted(hashlib.sha256(n.encode()).hexdigest() for n in norm)
    assert sum(r.kept for r in got) == len(sizes)
    assert {r.text_sha256: r.group_size for r in got} == {hashlib.sha256(n.encode()).hexdigest(): c for n, c in sizes.items()}
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_jaccard_classes(docs):
    got = {(r.doc_id, r.class_id): r.n_links for r in near_dup.jaccard_classes(docs).collect()}
    assert got[1, 1] == got[2, 1] == got[3, 1] == 2
    assert got[4, 4] == got[5, 5] == got[7, 7] == 0
    assert got[9, 9] == 1


@pytest.mark.parametrize("most_ranks", [500, 1])
def test_repeats(docs, monkeypatch, most_ranks):
    monkeypatch.setattr(repeats, "MOST_RANKS", most_ranks)
    data = [(t or "").encode() for _, t in ROWS]
    seen = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    want = []
    for (i, _), d in zip(ROWS, data):
        gone = bytearray(len(d))
        for s in range(len(d) - 199):
            if seen[d[s : s + 200]] > 1:
                gone[s : s + 200] = b"\1" * 200
        want.append((i or -1, len(d), sum(gone), hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    got = [(r.doc_id or -1, r.n_bytes, r.n_removed, r.kept_sha256) for r in repeats.without_repeats(docs).collect()]
    assert sorted(got) == sorted(want)


def test_secrets_and_ledger(docs, spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    paths = secrets.scan_new(docs, ledger)
    found = secrets.findings(paths, ledger).withColumn("said", secrets.listed())
    said = {r.doc_id: r.said for r in found.collect()}
    assert said[9] == "assign:0:19,access:20:44,hex:45:77" and said[4] == ""
    before = spark.read.parquet(ledger).count()
    secrets.scan_new(docs, ledger)
    assert spark.read.parquet(ledger).count() == before


def test_a_repeated_row_is_scanned_once(rows, spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    docs = rows([(1, "token = abcdefgh")] * 50 + [(None, "no")] * 3, "doc_id long, text string")
    paths = secrets.scan_new(docs, ledger)
    assert spark.read.parquet(ledger).count() == 2 * len(secrets.RULES)
    found = secrets.findings(paths, ledger)
    assert found.count() == 53 and found.where("size(assign) = 1").count() == 50
    newer = (*secrets.RULES[:2], secrets.RULES[2]._replace(version=2))
    secrets.scan_new(docs, ledger, newer)
    assert spark.read.parquet(ledger).count() == 2 * (len(secrets.RULES) + 1)
    assert secrets.scan_new(docs.limit(0), ledger).count() == 0


def test_words_end_at_ascii_white_space_alone(rows):
    texts = [f"abc {c}" for c in ("\x85", "\u2028", "\u2029")] + [" a\x85 ", "\x0b\x1f \f"]
    docs = rows([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in enumerate(texts)}
    got = docs.select("doc_id", mixing.word_count("text").alias("n"), quality.words_of(F.col("text")).alias("w")).collect()
    assert {r.doc_id: (r.n, r.w) for r in got} == {i: (len(w), w) for i, w in words.items()}
    pair = rows([(1, "abc \x85"), (2, "abc\x85")], "doc_id long, text string")
    assert {r.n_links for r in near_dup.jaccard_classes(pair).collect()} == {0}


def test_texts_of_null_ids_keep_their_own_spans(rows):
    # both texts have the same checksum; only the second repeats passages of a third
    a, b = (bytes.fromhex(h).decode() for h in ("706c756d6c657373", "6275636b65726f6f"))
    assert zlib.crc32(a.encode()) == zlib.crc32(b.encode())
    tail, passage = "".join(f"{i:03d}" for i in range(150)), LONG[:300]
    docs = rows([(None, a + tail), (None, b + tail[::-1] + passage), (7, passage)], "doc_id long, text string")
    got = {r.n_bytes: r.n_removed for r in repeats.without_repeats(docs).collect()}
    assert got == {458: 0, 758: 300, 300: 300}


def test_more_languages_than_are_kept(rows):
    texts = [("en", "the cat and the dog")] * 3 + [("fr", "le chat et le chien")] * 2 + [(f"x{i}", "zzz") for i in range(20)]
    model = language.fit(rows(texts, "lang string, text string"), most=2)
    assert model.langs == ["en", "fr"]


def test_out_of_place_distance(rows):
    texts = {"en": "the cat and the dog sat on the mat", "fr": "le chat et le chien sont sur le tapis", "de": "der hund und die katze"}
    size = 12
    model = language.fit(rows(list(texts.items()), "lang string, text string"), size)

    def top(text):
        padded = [f" {w} " for w in re.findall(r"[^\W\d_]+", text.lower())]
        counts = Counter(p[i : i + n] for p in padded for n in range(1, language.LONGEST + 1) for i in range(len(p) - n + 1) if p[i : i + n] != " ")
        return sorted(counts, key=lambda g: (-counts[g], [ord(c) for c in g] + [0] * (4 - len(g))))[:size]

    for asked in ("the dog", "le chien et la mat", "katze und cat", "xyz", "tapis"):
        mine = top(asked)
        apart = {lang: sum(abs(top(t).index(g) - i) if g in top(t) else size for i, g in enumerate(mine)) for lang, t in texts.items()}
        best = min(apart, key=lambda lang: (apart[lang], lang))
        assert model.predict(asked) == (best, pytest.approx(1 - apart[best] / (size * len(mine))))


def test_repeated_words(docs):
    got = {r.doc_id: (r.n_words, r.n_repeat_words, r.base_failed) for r in quality.judge(docs).collect()}
    assert got[4] == (0, 0, True) and got[10] == (90, 90, True) and got[1][0] == 120


def test_pieces_agree_with_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    with open(pieces.MODEL, "rb") as file:
        ours = pieces.PieceTransducer(file.read())
    for text in [t or "" for _, t in ROWS] + ["  two  spaces\n\ttab 漢字 😀 ▁▁▁▁▁ ", " " * 40 + "x", "ab" * 200]:
        assert ours.encode(text) == library.encode(text)
        assert ours.decode(ours.encode(text)) == text.replace("▁", " ")


def test_pieces_of_whole_tables(docs, rows, monkeypatch):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    monkeypatch.setattr(pieces, "TEXTS_AT_ONCE", 5)
    got = sorted(((r.token_ids, r.n_tokens, r.text_crc32, r.round_trip) for r in pieces.round_trips(docs).collect()), key=repr)
    want = [(library.encode(t or ""), len(library.encode(t or "")), zlib.crc32((t or "").encode()), True) for _, t in ROWS]
    assert got == sorted(want, key=repr)
    coded = pieces.encode(docs)
    assert coded.columns == [*docs.columns, "token_ids"]
    assert {r.text: r.token_ids for r in coded.collect()} == {t: None if t is None else library.encode(t) for _, t in ROWS}
    assert {r.text: r.decoded for r in pieces.decode(coded).collect()} == {t: t for _, t in ROWS}
    assert pieces.round_trips(docs.limit(0)).count() == pieces.encode(docs.limit(0)).count() == 0
    marked = pieces.round_trips(rows([(1, "a ▁ b")], "doc_id int, text string")).first()
    assert marked.token_ids == library.encode("a ▁ b")


def test_paths_of_many_parts_equal_those_of_one(monkeypatch):
    with open(pieces.MODEL, "rb") as file:
        transducer = pieces.PieceTransducer(file.read())
    rng = random.Random(4)
    letters = "aeiourstnl éü漢字😀ſ" + "th" * 3
    parts = list({"▁" * rng.randrange(3) + "".join(rng.choice(letters) for _ in range(rng.randrange(1, 30))).replace(" ", "x") for _ in range(4000)})
    parts += ["x" * 200, "▁" * 70, "▁", "a"]
    table = pieces.PathTable(transducer, 10**6)
    table.compose(set(parts))
    for part in parts:
        number = table[part]
        assert tuple(table.flat[table.ends[number] : table.ends[number + 1]]) == transducer.shortest(part)
        assert table.same[number]
    assert len(table) == len(set(parts)) == len(table.same) == len(table.ends) - 1


def test_lookup_against_a_dict():
    rng = random.Random(7)
    want, ours = {}, pieces.Lookup(2)
    for _ in range(30):
        new = {rng.randrange(1 << 40): rng.randrange(100) for _ in range(rng.randrange(60))}
        new = {k: v for k, v in new.items() if k not in want}
        ours.put(np.array(list(new), np.int64), np.array(list(new.values()), np.int64))
        want |= new
        asked = [*want, *(rng.randrange(1 << 40) for _ in range(50))]
        assert ours.get(np.array(asked, np.int64)).tolist() == [want.get(k, -1) for k in asked]
    assert len(ours.get(np.zeros(0, np.int64))) == 0


def test_the_path_table_forgets_and_goes_on():
    with open(pieces.MODEL, "rb") as file:
        transducer = pieces.PieceTransducer(file.read())
    texts = [f"word{i} and {i * 7}" for i in range(50)]
    table = pieces.PathTable(transducer, 10)
    for at in range(0, 50, 5):
        ids, begins, same = table.encode(texts[at : at + 5])
        assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [transducer.encode(t) for t in texts[at : at + 5]]
        assert same.all() and len(table) <= 40


def test_unigram_path_against_all_segmentations():
    def field(number, data):
        return bytes([number << 3 | 2, len(data)]) + data

    def piece(text, score, kind=1):
        return field(1, field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + bytes([3 << 3, kind]))

    weights = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.9, "ba": -3.0, "aba": -5.5, "▁a": -3.5}
    model = b"".join(piece(t, w) for t, w in weights.items()) + b"".join(piece(f"<0x{i:02X}>", 0.0, 6) for i in range(256))
    model += field(2, bytes([3 << 3, 1, 0x98, 0x02, 1])) + field(3, bytes([3 << 3, 1, 4 << 3, 0, 5 << 3, 1]))
    ours = pieces.PieceTransducer(model)
    names = list(weights)

    def least(text):
        if not text:
            return 0.0
        return min((-weights[text[:n]] + least(text[n:]) for n in range(1, 4) if text[:n] in weights), default=float("inf"))

    for n in range(1, 7):
        for letters in itertools.product("ab", repeat=n):
            text = "".join(letters)
            found = [names[i] for i in ours.encode(text)]
            assert "".join(found) == "▁" + text and -sum(weights[p] for p in found) == pytest.approx(least("▁" + text), abs=1e-5)
    assert ours.decode(ours.encode("abé b")) == "abé b"


def test_gram_counts_against_slices(monkeypatch):
    words = "a été été lazy o 漢字".split()
    want = Counter(p[i : i + n] for w in words for p in [f" {w} "] for n in range(1, 5)
                   for i in range(len(p) - n + 1) if p[i : i + n] != " ")

    def key(gram):
        return sum(ord(c) << 48 - 16 * i for i, c in enumerate(gram))

    for chunk in (100, 2):
        monkeypatch.setattr(language, "CHUNK", chunk)
        keys, counts = language.gram_counts(words)
        assert dict(zip(keys.astype("uint64").tolist(), counts.tolist())) == {key(g): n for g, n in want.items()}
    assert not len(language.gram_counts([])[0])


def test_language_profiles(rows):
    texts = [("en", "the cat and the dog"), ("fr", "le chat et le chien"), (None, "zzz"), ("fr", None), ("en", "")]
    learned = rows([(lang, t, 1) for lang, t in texts], "lang string, text string, n int")
    model = language.fit(learned)
    asked = rows([(1, "the dog"), (2, "le chien"), (3, None), (4, "12 _ !"), (1, "the dog"), (5, "漢")], "doc_id int, text string")
    got = sorted((r.doc_id, r.lang_pred) for r in language.identify(asked, model).collect())
    assert got == [(1, "en"), (1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "en")]
    nothing = language.fit(learned.limit(0))
    assert {r.lang_pred for r in language.identify(asked, nothing).collect()} == {"und"}
    assert language.identify(asked.limit(0), model).count() == 0
