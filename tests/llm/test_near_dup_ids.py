"""Near copies whose ids are null or repeat."""

from millrace.llm import near_dup

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew odd potions near cold rivers".split()


def text(seed: int, change: str = "") -> str:
    return " ".join(WORDS[i * seed % 17] + str(i % (19 + seed)) for i in range(100)) + change


#: Group 3 has only null ids, group 4 two texts of one id, group 5 a null id and others, group 6 an id of another group.
ROWS = [(None, text(3), "a"), (None, text(3, " x"), "b"), (7, text(4), "c"), (7, text(4, " y"), "d"),
        (None, text(5), "e"), (9, text(5, " z"), "f"), (8, text(5, " zz"), "g"), (7, text(6), "h"), (11, text(6, " q"), "i"),
        (None, text(7), "j"), (None, "", "k"), (12, None, "l"), (12, " ", "m"), (7, text(4), "n"), (12, None, "o")]


def test_one_row_of_each_group_stays(rows):
    kept = near_dup.drop_near_copies(rows(ROWS, "doc_id long, text string, tag string")).collect()
    tags = "".join(sorted(r.tag for r in kept))
    # one of the null-id group, of id 7's group, document 8, one of the group of 7 and 11, the single, three without a word
    assert len(tags) == 8 and len(set("ab") & set(tags)) == 1 and len(set("cdn") & set(tags)) == 1
    assert set(tags) - set("abcdnlo") == set("ghjkm") and len(set("lo") & set(tags)) == 1


def test_classes_with_null_ids(rows):
    got = near_dup.jaccard_classes(rows(ROWS, "doc_id long, text string, tag string")).collect()
    assert len(got) == len(ROWS)
    null_classes = {r.class_key: r.class_size for r in got if r.class_id is None and r.class_key is not None}
    assert sorted(null_classes.values()) == [1, 2]
    assert {r.class_id for r in got if r.doc_id in (8, 9)} == {8}
    assert sorted((r.class_id, r.class_size) for r in got if r.doc_id == 7) == [(7, 2), (7, 3), (7, 3), (7, 3)]
    assert len({r.class_key for r in got if r.doc_id == 7}) == 2
    assert [r.class_key for r in got if r.doc_id == 12] == [None] * 3
