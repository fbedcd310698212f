"""Every stage of the pipeline and the whole run against brute force, and the sharding and mixing queries."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from millrace.llm import mixing, pieces, sharding
from millrace.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def documents():
    rng = random.Random(12)
    words = [f"w{i}" for i in range(400)] + ["#tag", "é.", "漢字"]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    rows = []
    for i in range(24):
        body = text(rng.randrange(40, 120))
        rows.append((i, body, "en", rng.choice(["a", "b", None])))
        if i % 4 == 0:
            rows += [(100 + i, body.replace(" ", " \n", 3), "en", "a"), (200 + i, body + " more", None, "b")]
        if i % 5 == 0:
            changed = body.split()
            changed[len(changed) // 2] = "changed"
            rows.append((300 + i, " ".join(changed), "en", "c"))
    rows += [(None, rows[0][1], "en", "a"), (500, None, "en", "a"), (501, "", None, None), (502, "x y z " * 40, "en", "a"),
             (503, "short text", "en", "a"), (504, text(6000), "de", "c"), rows[2], rows[2], (None, text(60), None, None), (None, text(61), None, None)]
    return [(i, t, lang, source, len(t or "")) for i, t, lang, source in rows]


@pytest.fixture(scope="module")
def docs(spark):
    clash = [F.lit("clash").alias(c) for c in ("text_sha256", "n_words", "kept", "class_id", "size", "token_ids")]
    return spark.createDataFrame(documents(), SCHEMA).select("*", *clash)


def kept_by_rules(rows):
    out = []
    for r in rows:
        words = WORDS.findall(r[1] or "")
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        if len(words) >= 50 and 100 * len(again) <= 50 * len(words):
            out.append(r)
    return out


def by_text(rows, key):
    groups = defaultdict(list)
    for r in rows:
        groups[key(r)].append(r)
    return groups


def without_copies(rows):
    """Of equal texts one row with the smallest id."""
    groups = by_text(rows, lambda r: re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or ""))
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def near_groups(rows):
    def shingles(text):
        words = WORDS.findall(text or "")
        return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()

    sets, root = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = sets[i] | sets[j]
        if both and 10 * len(sets[i] & sets[j]) >= 8 * len(both):
            root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def ids(rows):
    return Counter((r[0], r[1]) for r in rows)


def listed(df):
    return [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in df.collect()]


def test_good(spark, docs):
    got = cp.good(spark, docs, "")
    assert got.columns == docs.columns and ids(listed(got)) == ids(kept_by_rules(documents()))


def test_exact(spark, docs):
    got = cp.exact(spark, docs, "")
    assert got.columns == docs.columns and ids(listed(got)) == ids(without_copies(documents()))


def test_near(spark, docs):
    rows = without_copies(documents())
    got = cp.near(spark, spark.createDataFrame(rows, SCHEMA), "")
    left = listed(got)
    group = dict(zip(rows, near_groups(rows)))
    assert len(set(group.values())) < len(rows) - 8
    assert Counter(group[r] for r in left) == Counter(set(group.values()))
    assert cp.near(spark, docs, "").columns == docs.columns


def test_mix(spark, docs):
    rows = documents()
    size = Counter()
    for r in rows:
        size[r[3]] += len(WORDS.findall(r[1] or ""))
    sources = sorted(size, key=lambda s: (s is None, s or ""))
    weight = dict(zip(sources, itertools.cycle((3, 1, 2))))
    left, target, live = 1.5 * sum(size.values()), {}, set(sources)
    while live:
        share = {s: left * weight[s] / sum(weight[x] for x in live) for s in live}
        full = {s for s in live if share[s] > 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in full} if full else share
        left -= sum(2 * size[s] for s in full)
        live = live - full if full else set()
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.taken <= 2 * r["size"] and r.taken == r.repeats * r["size"]
        taken[r.source] += r.taken
    longest = {s: max(len(WORDS.findall(r[1] or "")) for r in rows if r[3] == s) for s in sources}
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in sources)
    mixed = cp.mix(spark, docs, "")
    assert mixed.columns == docs.columns
    counted = Counter((r.doc_id, r.text) for r in mixed.collect())
    wanted = Counter()
    for r in mixing.mixed(docs).collect():
        wanted[r.doc_id] += r.repeats
    assert Counter({i: sum(n for (d, _), n in counted.items() if d == i) for i, _ in counted}) == +wanted
    assert sorted(map(str, mixing.mixed(docs.repartition(5)).collect())) == sorted(map(str, got))


def test_encode(spark, docs):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    got = cp.encode(spark, docs, "")
    assert got.columns == ["doc_id", "source", "lang", "token_ids", "decodes"]
    want = Counter((r[0], None if r[1] is None else tuple(library.encode(r[1]))) for r in documents())
    assert Counter((r.doc_id, None if r.token_ids is None else tuple(r.token_ids)) for r in got.collect()) == want
    assert all(r.decodes for r in got.collect())


@pytest.mark.parametrize("name,stage", cp.STAGES)
def test_empty_tables(spark, docs, name, stage):
    assert stage(spark, docs.limit(0), "").count() == 0


def test_whole_run(spark, tmp_path):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    spark.createDataFrame(documents(), SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = cp.run(spark, str(tmp_path)).collect()
    rows = without_copies(kept_by_rules(documents()))
    group = dict(zip(rows, near_groups(rows)))
    text_of = {r[0]: r for r in rows if r[0] is not None} | {None: None}
    seen = {group[text_of[r.doc_id]] for r in got if r.doc_id is not None}
    copies = Counter(r.doc_id for r in got)
    assert len(seen) == len({i for i in copies if i is not None}) and all(n <= 2 for i, n in copies.items() if i is not None)
    for r in got:
        if r.doc_id is not None:
            assert r.token_ids == library.encode(text_of[r.doc_id][1]) and r.decodes
    words = sum(len(WORDS.findall(library.decode(r.token_ids))) for r in got)
    one_of_each = sum(min(len(WORDS.findall(r[1])) for r in rows if group[r] == g) for g in set(group.values()))
    assert words > 1.2 * one_of_each


def test_sharding(spark, docs, tmp_path):
    spark.createDataFrame(documents(), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = sharding.sharding(spark, str(tmp_path)).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in documents())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    by_shard = defaultdict(list)
    for r in got:
        assert 0 <= r.shard < 24 and r.law == "bytes" and r.grown_shard is None
        by_shard[r.shard].append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    empty = tmp_path / "none"
    spark.createDataFrame([], SCHEMA).write.parquet(str(empty / "documents.parquet"))
    assert sharding.sharding(spark, str(empty)).count() == 0


def test_sizes_even_out_and_maps_have_versions(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame([(i, "x" * rng.randrange(400)) for i in range(6000)], "doc_id long, text string")
    placed = sharding.placed(rows, slots=512)
    sizes = sharding.slot_sizes(placed, 512)
    first = sharding.first_map(spark, 6, 512)
    path = scratch_path(spark, "maps")
    sharding.save_map(first, path, 1)
    second = sharding.save_map(sharding.rebalance(first, sizes, 6), path, 2)
    loads = [r.n for r in second.join(sizes, "virtual_slot").groupBy("shard").agg(F.sum("bytes").alias("n")).collect()]
    assert len(loads) == 6 and max(loads) - min(loads) < 0.01 * sum(loads)
    grown = sharding.rebalance(second, sizes, 7)
    moved = second.alias("a").join(grown.alias("b"), "virtual_slot").where("a.shard != b.shard").selectExpr("b.shard").collect()
    # a shard more takes about a seventh; what is above the mean elsewhere may go to any shard
    assert 512 / 8 < len(moved) < 512 / 4 and sum(r.shard == 6 for r in moved) > 0.8 * len(moved)
    assert sharding.load_map(spark, path, 1).where("shard = virtual_slot % 6").count() == 512
    assert sorted(sharding.load_map(spark, path).collect()) == sorted(second.collect())
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sharding.save_map(first, path, 2)
