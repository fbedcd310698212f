"""Conversation repair against all edit sequences, whole tables against a plain walk, and blocks against one block."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from millrace.llm import turns

SPACES = " \t\n\x0b\x0c\r"
GRAMMAR = re.compile("(s?(ua)+)?")


def cheapest(rows, most_inserts=3):
    """Least (cost, audit, lines) over every choice of edits and insertions."""
    best = None
    # enumerated without the grammar's states: choices per row, insertions before each and at the end
    for choices in itertools.product("DKR", repeat=len(rows)):
        if any(c != "D" and r["fault"] in ("blank", "duplicate") for c, r in zip(choices, rows)):
            continue
        for inserts in itertools.product(range(most_inserts), repeat=len(rows) + 1):
            if sum(inserts) > most_inserts:
                continue
            base = sum({"D": 2, "K": 0, "R": 1}[c] + 5 * (c != "D" and r["fault"] == "truncated") for c, r in zip(choices, rows))
            cost = base + 5 * sum(inserts)
            if best and cost > best[0]:
                continue
            audit = "".join("I" * k + c for k, c in zip(inserts, choices)) + "I" * inserts[-1]
            options = []
            for k, c, r in zip(inserts, choices, rows):
                options += [[("user", ""), ("assistant", "")]] * k
                if c == "K":
                    options.append([(r["role"], r["text"])])
                elif c == "R":
                    options.append([("user", r["text"]), ("assistant", r["text"])])
            options += [[("user", ""), ("assistant", "")]] * inserts[-1]
            for said in itertools.product(*options):
                if GRAMMAR.fullmatch("".join(role[:1] or "-" for role, _ in said)):
                    found = (cost, audit, "\n".join(f"{role}:{text}" for role, text in said))
                    best = min(best, found) if best else found
    return best


def code_of(role, fault):
    return turns.FAULTS[fault]["suax".index(role[:1] if role[:1] in "sua" and role else "x")]


def test_parser_against_all_edits():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 3, 4, 4, 4):
        for _ in range(6):
            rows = [{"role": rng.choice(["system", "user", "assistant", "tool", ""]), "text": f"t{i}",
                     "fault": rng.choice(["fine", "fine", "fine", "truncated", "blank", "duplicate"])} for i in range(n)]
            codes = "".join(code_of(r["role"], r["fault"]) for r in rows)
            stack = turns.chain([(0, None), None, None, None], turns.block_table(codes))
            cost, audit = turns.finished(stack)
            want = cheapest(rows, 3 if n < 4 else 2)
            assert (cost, audit) == want[:2], (rows, audit, want)
            edits, top, lines = iter(audit), turns.EMPTY, []
            for r in rows:
                made, top = turns.edited(edits, top, r["role"], r["text"])
                lines += made
            lines += turns.edited(edits, top, "", "")[0]
            assert "\n".join(lines) == want[2]


def test_blocks_chain_like_one_block():
    rng = random.Random(5)
    for _ in range(60):
        codes = "".join(rng.choice("suaxSUAX1256" + "ua" * 6) for _ in range(rng.randrange(1, 60)))
        whole = turns.finished(turns.chain([(0, None), None, None, None], turns.block_table(codes)))
        stack, at = [(0, None), None, None, None], 0
        while at < len(codes):
            size = rng.randrange(1, 9)
            stack = turns.chain(stack, turns.block_table(codes[at : at + size]))
            at += size
        assert turns.finished(stack) == whole


def plain(table):
    """The query's rows by a walk over each conversation."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for conv_id, turn, role, text in table:
            if conv_id != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
            hit = zlib.crc32(key.encode()) % 20
            if hit == 0:
                continue
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            role = "user" if hit == 4 else role
            rows += [(turn, role, text)] * (2 if hit == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in rows:
            end = text.rstrip(SPACES)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen
                          else "truncated" if end[-1] not in ".!?" else "fine")
            seen.add((role, text))
        known = [t for t, _, _ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, said = cheapest([{"role": r[1], "text": r[2], "fault": f} for r, f in zip(rows, faults)], 2) if rows else (0, "", "")
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
                     hashlib.sha256(said.encode()).hexdigest())
    return out


def small_table():
    rng, table = random.Random(11), []
    for conv in [*range(24), None]:
        for turn in rng.sample(range(7), rng.randrange(1, 5)):
            table.append((conv, turn, rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool"]),
                          rng.choice(["Fine.", "No end", None, "", " \x0b\t", "Fine.", "Ends!\n", "\x85", "é? "])))
    table += [(30, None, "user", "A."), (30, None, "user", "A."), (30, 3, "assistant", "B."), (31, 5, "user", "x" * 50_000 + ".")]
    return table


@pytest.mark.parametrize("block", [1024, 1])
def test_query_against_a_walk(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(turns, "BLOCK", block)
    table = small_table()
    spark.createDataFrame(table, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'clash' AS code", "1 AS part", "'x' AS audit").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r)[1:] for r in turns.repair_damaged(spark, str(tmp_path)).collect()}
    assert got == plain(table)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert turns.repair_damaged(spark, str(tmp_path)).collect() == []


def test_a_long_conversation_and_equal_rows_fill_several_blocks(spark):
    rows = spark.range(6000).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role",
                                        "concat('line ', id, '.') AS text", "false AS gone")
    same = spark.range(3000).selectExpr("8L AS conv_id", "NULL AS turn", "'user' AS role", "'Same.' AS text", "false AS gone")
    got = {r.conv_id: r for r in turns.repair(rows.unionByName(same.withColumn("turn", same.turn.cast("long")))).collect()}
    assert got[7].audit == "K" * 6000 and got[7].cost == 0
    said = "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:line {i}." for i in range(6000))
    assert got[7].repaired_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[8].duplicate == 2999 and got[8].audit == "D" * 3000 and got[8].cost == 6000 and got[8].gaps == 0
