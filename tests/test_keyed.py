"""The stored keyed table: an upsert rewrites the partitions of its keys, and no other file changes."""

import os
import re

from conftest import listed

from millrace.operators.keyed import KeyedTable


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_only_touched_partitions_are_rewritten(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    base = rows([(i, f"n{i}", 0) for i in range(200)] + [(5, "older", -1)], "id long, name string, version int")
    table = KeyedTable.create(base, path, ["id"], "version", buckets=8)
    before = files(path)
    assert len(before) == 8 and table.rows().count() == 200
    delta = rows([(5, "new", 2), (5, "newer", 3), (5, "old", -5), (1000, "added", 0), (7, "late", -1)], "id long, name string, version int")
    touched = table.upsert(delta)
    after = files(path)
    kept = {f for f, t in before.items() if after.get(f) == t}
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in kept} == set(range(8)) - set(touched)
    assert 0 < len(touched) <= 3
    want = {i: f"n{i}" for i in range(200)} | {5: "newer", 1000: "added"}
    assert {r.id: r.name for r in table.rows().collect()} == want and table.rows().count() == 201


def test_an_upsert_run_again_gives_the_same_rows(rows, tmp_path):
    table = KeyedTable.create(rows([(1, "a", 1), (None, "none", 1)], "id long, name string, version int"), str(tmp_path / "t"), ["id"], "version", 4)
    delta = rows([(1, "b", 2), (None, "one", 2), (3, "c", None)], "id long, name string, version int")
    first = table.upsert(delta)
    once = listed(table.rows())
    assert table.upsert(delta) == first and listed(table.rows()) == once == sorted([(1, "b", 2), (None, "one", 2), (3, "c", None)], key=repr)
    assert table.upsert(delta.limit(0)) == [] and listed(table.rows()) == once


def test_find_reads_the_partitions_of_its_keys(rows, tmp_path, capsys):
    table = KeyedTable.create(rows([(i, i % 3, f"n{i}", 0) for i in range(90)], "a int, b int, name string, version int"),
                              str(tmp_path / "t"), ["a", "b"], "version", 16)
    found = table.find(rows([(4, 1), (4, 2), (500, 0)], "a int, b int"))
    assert listed(found.select("name")) == [("n4",)]
    found.explain()
    pruned = re.search(r"PartitionFilters: \[_bucket#\d+ IN \(([\d,]+)\)", capsys.readouterr().out)
    assert len(pruned[1].split(",")) <= 3
    empty = KeyedTable.create(rows([], "id long, version int"), str(tmp_path / "none"), ["id"], "version", 4)
    assert empty.rows().count() == 0
    empty.upsert(rows([(1, 1)], "id long, version int"))
    assert listed(empty.rows()) == [(1, 1)]
