"""The toxicity model against its formulas over plain counters, by the broadcast and by the join."""

import itertools
import zlib
from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest

from millrace.llm import toxicity

#: Unseen words, null and empty texts, repeated rows, texts shorter than a passage, neighbouring rare words.
TRAIN = [("the nice dog runs over the hills", 0), ("the nice cats run", 0), ("idiot idiots scum the dog", 1), ("the scum", 1),
         ("a b c d the dogs the the", 0), (None, 1), ("", 0), ("idiotic scumbag nicely", 1)]
ASKED = [(1, "the idiotische scum dog"), (1, "the idiotische scum dog"), (2, None), (3, ""), (4, "never"), (5, "never seen"),
         (None, "the nice dog the nice dog never seen before scum the nice idiots"), (6, "漢字 the the the the scum"), (7, "the dog")]


def expected_ratio(model):
    counts = [Counter(), Counter()]
    for text, toxic in TRAIN:
        counts[toxic].update(toxicity.words_of(text))
    pairs = [Counter({(w[:5], w[5:]): n for w, n in c.items()}) for c in counts]
    stems, after, both, continued = [Counter(), Counter()], [defaultdict(list), defaultdict(list)], Counter(), Counter()
    for c in (0, 1):
        for (stem, ending), n in pairs[c].items():
            stems[c][stem] += n
            after[c][stem].append(n)
            both[stem] += n
            continued[ending] += 1

    def less(n, discounts):
        return 0 if n <= 0 else discounts[min(n, 3) - 1]

    def smooth(table, discounts, key, other):
        total = sum(table.values())
        left = sum(less(n, discounts) for n in table.values()) / total
        return (table[key] - less(table[key], discounts)) / total + left * other

    def ratio(word):
        stem, ending = word[:5], word[5:]
        first = smooth(both, model.shared[0].discounts, stem, 1 / (len(both) + 1))
        last = smooth(continued, model.shared[1].discounts, ending, 1 / (len(continued) + 1))
        logs = []
        for c in (0, 1):
            said = log(smooth(stems[c], model.firsts[c].discounts, stem, first))
            d, s, n = model.pairs[c].discounts, stems[c][stem], pairs[c][stem, ending]
            logs.append(said + log((n - less(n, d) + sum(less(m, d) for m in after[c][stem]) * last) / s if s else last))
        n = stems[int(logs[1] > logs[0])][stem]
        return (logs[1] - logs[0]) * n / (n + toxicity.DOUBT)

    return ratio


def expected_features(text, ratio):
    r = [ratio(w) for w in toxicity.words_of(text)] or [0.0]
    size = min(3, len(r))
    return [1.0, np.log1p(len(r)), max(r), max(sum(r[i : i + size]) for i in range(len(r) - size + 1)) / size, sum(r) / len(r)]


@pytest.mark.parametrize("most_common", [0, 4, 1 << 19])
def test_evidence_against_formulas(rows, most_common):
    model = toxicity.tables(rows(TRAIN, "text string, toxic int"))
    ratio = expected_ratio(model)
    got = toxicity.evidence(rows(ASKED, "doc_id long, text string"), model, most_common).collect()
    want = [(i or -1, expected_features(t, ratio)) for i, t in ASKED]
    for (i, x), (j, y) in zip(sorted((r.doc_id or -1, r.x) for r in got), sorted(want), strict=True):
        assert i == j and np.allclose(x, y, rtol=1e-9)


def test_unseen_words_share_no_counts(rows, spark, tmp_path):
    """Two words that no text has score alike, also where the hash of one is that of a toxic word."""
    places, found = {}, None
    for letters in itertools.product("bcdfgaeiou", repeat=5):
        word = "".join(letters)
        first = places.setdefault(zlib.crc32(word.encode()) & 0x3FFFF, word)
        if first != word:
            found = first, word
            break
    toxic, alike = found
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 == 2][:2]
    plain = ["river", "stone", "cloud", "field", "house", "bread", "light"]
    docs = [(i, " ".join([plain[i % 7], plain[i // 7 % 7], toxic if i % 3 == 0 else plain[i // 49 % 7]])) for i in range(1000)]
    docs = [d for d in docs if d[0] not in held] + [(held[0], alike), (held[1], "zzzzz")]
    rows(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows([(i, int(i % 3 == 0)) for i in range(1000)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r.score for r in toxicity.toxicity(spark, str(tmp_path)).collect()}
    assert len(got) == 1000 and got[held[0]] == pytest.approx(got[held[1]])
    toxic_scores = [got[i] for i, t in docs if toxic in t]
    assert min(toxic_scores) > 0.9 > 0.1 > max(got[i] for i, t in docs if i not in held and toxic not in t)


def test_few_toxic_uses_count(rows):
    """Words seen one to three times, only in toxic texts, speak for toxic, and the more the oftener they were seen."""
    plain = " ".join(f"w{i:03}" * (1 + i % 2) for i in range(60) for _ in range(1 + i % 5))
    model = toxicity.tables(rows([(plain, 0), (plain + " onces twice twice thric thric thric", 1)], "text string, toxic int"))
    got = {r.word: r.ratio for r in toxicity.ratios(rows([("onces",), ("twice",), ("thric",), ("never",)], "word string"), model).collect()}
    assert got["thric"] > got["twice"] > got["onces"] > 0.1 and abs(got["never"]) < 0.1


def test_discounts_stay_below_their_counts():
    assert toxicity.discounts_of(100, 40, 20, 10) == pytest.approx((5 / 9, 2 - 3 * 5 / 9 / 2, 3 - 4 * 5 / 9 / 2))
    for counts in ((0, 0, 0, 0), (1, 0, 0, 0), (1, 9, 90, 900), (0, 5, 1, 7), (10, 1, 1, 1)):
        assert all(0 < d < n for n, d in enumerate(toxicity.discounts_of(*counts), 1)), counts


def test_no_labels(rows):
    model = toxicity.tables(rows([], "text string, toxic int"))
    got = toxicity.score(rows(ASKED, "doc_id long, text string"), model, rows([], "doc_id long, toxic int")).collect()
    assert [r.score for r in got] == [0.5] * len(ASKED)
