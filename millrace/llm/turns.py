"""Conversation structure repair: generalised LR parsing of role sequences with weighted edits.

The role grammar is

    Conversation -> (nothing) | Turns        Turns -> s Pair | Pair | Turns Pair        Pair -> u a

with the roles' initials as terminals. An LR parser of it has four stack tops: the empty stack, ``s``, an open ``u``
over any of the others, and ``Turns``, to which ``u a`` reduces at once. The graph-structured stack keeps one node per
top: all stacks with the same top accept the same continuations, so they are merged to the least (cost, audit). Besides
shifting a row, the parser may delete or rerole it, and insert a row before it.

Rows are sorted by conversation and turn over the whole cluster. A long conversation is cut into blocks, each parsed
from every top by its own task, and the blocks' least (cost, audit) between tops are then chained.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.base import SPACE_CHARS, query, read
from millrace.operators.ordered import in_sorted_runs
from millrace.session import freeze

#: Rows of a block of one conversation.
BLOCK = 1024

# The costs of the edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: Stack tops; a conversation may end on the first and the last.
EMPTY, SYSTEM, USER, TURNS = range(4)
ENDS = (EMPTY, TURNS)
#: Tops after a terminal is shifted (and ``u a`` reduced).
SHIFT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": TURNS}, {"u": USER})
#: The one role other than the system's that each top takes.
TAKES = ("u", "u", "a", "u")
LEGAL = ("su", "ua", "au")

#: A row is one character: its initial (``s``, ``u``, ``a``, ``x`` for others), and its fault.
FAULTS = {"fine": "suax", "truncated": "SUAX", "duplicate": "1234", "blank": "5678"}
_INITIAL = {c: i for codes in FAULTS.values() for c, i in zip(codes, "suax")}

Stack = list[tuple[int, str] | None]


def offer(stack: Stack, top: int, cost: int, audit: str) -> bool:
    """Merge an equal stack top: the least (cost, audit) stays."""
    if stack[top] is not None and stack[top] <= (cost, audit):
        return False
    stack[top] = cost, audit
    return True


def inserted(stack: Stack) -> Stack:
    """The stack with rows inserted wherever that reaches a top at less."""
    out = list(stack)
    todo = [top for top in range(4) if out[top]]
    while todo:
        top = todo.pop()
        cost, audit = out[top]
        after = SHIFT[top][TAKES[top]]
        if offer(out, after, cost + INSERT, audit + "I"):
            todo.append(after)
    return out


def parsed(codes: str, start: Stack) -> Stack:
    """The stack after the rows ``codes``: keep, rerole or delete each, and insert before any."""
    stack = start
    for code in codes:
        initial, truncated = _INITIAL[code], code in FAULTS["truncated"]
        broken = code in FAULTS["blank"] or code in FAULTS["duplicate"]
        after: Stack = [None] * 4
        for top, best in enumerate(inserted(stack)):
            if best is None:
                continue
            cost, audit = best
            offer(after, top, cost + DELETE, audit + "D")
            if broken:
                continue
            cost += TRUNCATED * truncated
            if initial in SHIFT[top]:
                offer(after, SHIFT[top][initial], cost + KEEP, audit + "K")
            offer(after, SHIFT[top][TAKES[top]], cost + REROLE, audit + "R")
        stack = after
    return stack


def block_table(codes: str) -> list[tuple[int, int, int, str]]:
    """``start, end, cost, audit``: the least edits of a block between any two tops."""
    out = []
    for start in range(4):
        stack: Stack = [None] * 4
        stack[start] = 0, ""
        out += [(start, end, *best) for end, best in enumerate(parsed(codes, stack)) if best]
    return out


class Trail:
    """A chain of audits that shares its beginning with other chains, compared without being joined."""

    __slots__ = ("before", "audit", "depth")

    def __init__(self, before: Trail | None, audit: str):
        self.before, self.audit, self.depth = before, audit, (before.depth if before else 0) + 1

    def tail(self, other: Trail) -> tuple[str, str]:
        """What follows in both chains after the part that they share."""
        a, b, left, right = self, other, [], []
        while a is not b:
            if b is None or (a is not None and a.depth >= b.depth):
                left.append(a.audit)
                a = a.before
            else:
                right.append(b.audit)
                b = b.before
        return "".join(reversed(left)), "".join(reversed(right))

    def text(self) -> str:
        return self.tail(None)[0]


def chain(stack: list[tuple[int, Trail] | None], moves: Iterable[tuple[int, int, int, str]]) -> list[tuple[int, Trail] | None]:
    """The stack after another block, given as its table."""
    after: list[tuple[int, Trail] | None] = [None] * 4
    for start, end, cost, audit in moves:
        if stack[start] is None:
            continue
        total, trail = stack[start][0] + cost, Trail(stack[start][1], audit)
        best = after[end]
        if best is None or total < best[0] or (total == best[0] and trail.tail(best[1])[0] < trail.tail(best[1])[1]):
            after[end] = total, trail
    return after


def finished(stack: list[tuple[int, Trail] | None]) -> tuple[int, str]:
    """The least (cost, audit) that ends a conversation, rows inserted at its end included."""
    last = inserted([best and (best[0], best[1].text()) for best in stack])
    return min(last[top] for top in ENDS if last[top])


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` after seeded damage; nulls of role, text and key count as one space.

    ``gone`` marks a dropped row, which stays so that its conversation does.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    text = F.coalesce("text", blank)
    hit = F.col("_hit")
    return rows.select("conv_id", "turn", "role", "text", (F.crc32(key) % 20).alias("_hit")).select(
        "conv_id", "turn",
        F.when(hit == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (hit == 0).alias("gone"),
        F.explode(F.when(hit == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")).drop("_copy")


#: The order of a conversation's rows. Rows that agree in it are equal.
ORDER = ("conv_id", "turn", "role", "digest")  # ascending, null first


def marked(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, code, _run, _slot`` of every row: its place in the order, and its code (empty if it is gone)."""
    short = rows.withColumn("end", F.rtrim("text", F.lit(SPACE_CHARS))).select(
        "conv_id", "turn", "role", "gone", F.unhex(F.md5("text")).alias("digest"), (F.col("end") == "").alias("blank"),
        (~F.substring("end", -1, 1).isin(".", "!", "?")).alias("truncated"), F.monotonically_increasing_id().alias("nth"))
    # ``nth`` only tells equal rows apart, so that any number of them can be cut into several runs.
    placed = in_sorted_runs(short, [F.col(c) for c in (*ORDER, "nth")]).drop("nth")
    said = ["conv_id", "role", "digest"]
    several = freeze(placed.where("NOT gone").groupBy(*said).agg(F.min(F.struct("_run", "_slot")).alias("first"), F.count("*").alias("n"))
                     .where("n > 1").drop("n"))
    a, b = placed.alias("a"), several.alias("b").hint("merge")  # grows with the rows: the same join at every size
    met = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role"))
                 & (F.col("a.digest") == F.col("b.digest")), "left").select("a.*", "b.first")
    later = F.col("first").isNotNull() & (F.struct("_run", "_slot") > F.col("first"))
    fault = (F.when(F.col("blank"), FAULTS["blank"]).when(later, FAULTS["duplicate"])
             .when(F.col("truncated"), FAULTS["truncated"]).otherwise(FAULTS["fine"]))
    kind = F.array_position(F.array(*map(F.lit, "sua")), F.substring("role", 1, 1)).cast("int")
    code = F.when(F.col("gone"), "").otherwise(F.expr("substring(fault, nth, 1)"))
    return (met.withColumns({"fault": fault, "nth": F.when(kind > 0, kind).otherwise(4)})
            .select("conv_id", F.when(~F.col("gone"), F.col("turn")).alias("turn"), code.alias("code"), "_run", "_slot"))


def blocks(rows: DataFrame) -> DataFrame:
    """One row per block: ``conv_id, _run, block, codes``, its turns (least, greatest, distinct) and its table."""
    listed = F.array_sort(F.collect_list(F.struct("_slot", "code")))
    each = rows.groupBy("conv_id", "_run", F.floor(F.col("_slot") / BLOCK).alias("block")).agg(
        F.array_join(F.transform(listed, lambda r: r["code"]), "").alias("codes"),
        F.min("turn").alias("first"), F.max("turn").alias("last"), F.size(F.collect_set("turn")).cast("long").alias("turns"))

    def run(batches):
        for batch in batches:
            tables = [[dict(zip(("start", "end", "cost", "audit"), move)) for move in block_table(codes)]
                      for codes in batch.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tables, MOVES)], [*batch.schema.names, "moves"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in each.schema)
    return each.mapInArrow(run, f"{schema}, moves array<struct<start:int,end:int,cost:long,audit:string>>")


MOVES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPORT = ", ".join(f"{c} long" for c in COUNTS) + ", audit string"


class Conversation:
    """What is known of one conversation after its blocks so far."""

    def __init__(self):
        self.stack: list[tuple[int, Trail] | None] = [(0, None), None, None, None]
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.first = self.last = None
        self.turns, self.initial = 0, ""

    def add(self, block: dict) -> None:
        codes = block["codes"]
        if block["turns"]:
            self.turns += block["turns"] - (self.last == block["first"])
            self.first = block["first"] if self.first is None else self.first
            self.last = block["last"]
        if not codes:
            return
        self.stack = chain(self.stack, [tuple(move.values()) for move in block["moves"]])
        for fault in ("blank", "duplicate", "truncated"):
            self.counts[fault] += sum(codes.count(c) for c in FAULTS[fault])
        initials = self.initial + "".join(map(_INITIAL.get, codes))
        self.counts["illegal"] += sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))
        self.initial = initials[-1]

    def report(self) -> list:
        cost, audit = (0, "") if not self.initial else finished(self.stack)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return [gaps, *self.counts.values(), cost, audit]


def reports(rows: DataFrame) -> DataFrame:
    """``conv_id`` and its report, one row per conversation: its blocks chained in order, streamed."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    put = rows.repartition("conv_id").sortWithinPartitions("conv_id", "_run", "block")

    def run(batches):
        ids, current, out = [], None, []
        for batch in batches:
            for block in batch.to_pylist():
                if current is None or ids[-1] != block["conv_id"]:
                    if current is not None:
                        out.append(current.report())
                    ids.append(block["conv_id"])
                    current = Conversation()
                current.add(block)
            yield listed(ids[: len(out)], out)
            ids, out = ids[len(out):], []
        if current is not None:
            yield listed(ids, [current.report()])

    def listed(ids, found):
        columns = list(zip(*found)) or [()] * 7
        kinds = [pa.int64()] * 6 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, of_id), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["conv_id", *COUNTS, "audit"])

    of_id = to_arrow_type(rows.schema["conv_id"].dataType)
    return put.mapInArrow(run, f"conv_id {kind}, {_REPORT}")


def edited(audit: Iterator[str], top: int, role: str, text: str) -> tuple[list[str], int]:
    """The lines that the audit makes of the next row, and the stack top after it."""
    lines = []
    for edit in audit:
        if edit == "D":
            return lines, top
        if edit == "K":
            lines.append(f"{role}:{text}")
            return lines, SHIFT[top][role[0]]
        taken = TAKES[top]
        top = SHIFT[top][taken]
        name = "user" if taken == "u" else "assistant"
        if edit == "R":
            lines.append(f"{name}:{text}")
            return lines, top
        lines.append(f"{name}:")
    return lines, top


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The reports ``found`` with ``repaired_sha256``: each conversation's rows follow its report, and are hashed in order.

    A digest is a chain over the whole conversation, so its rows pass through one task; they are sorted on disk and
    streamed, never held.
    """
    kind = rows.schema["conv_id"].dataType
    of_id = to_arrow_type(kind)
    texts = rows.where("NOT gone").select("conv_id", F.lit(1).alias("part"), "turn", "role", F.unhex(F.md5("text")).alias("digest"), "text")
    both = found.withColumn("part", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    put = both.repartition("conv_id").sortWithinPartitions("conv_id", "part", *ORDER[1:])

    def run(batches):
        report = audit = digest = None
        top, begun = EMPTY, False

        def take(lines):
            nonlocal begun
            for line in lines:
                digest.update(("\n" + line if begun else line).encode())
                begun = True

        def end():
            lines, _ = edited(audit, top, "", "")  # what is inserted after the last row
            take(lines)
            return [*report, digest.hexdigest()]

        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", *COUNTS, "audit", "part", "role", "text")]
            for conv_id, *counts, edits, part, role, text in zip(*columns):
                if part == 0:
                    if report:
                        out.append(end())
                    report, audit, digest, top, begun = [conv_id, *counts, edits], iter(edits), hashlib.sha256(), EMPTY, False
                else:
                    lines, top = edited(audit, top, role, text)
                    take(lines)
            yield as_batch(out)
        if report:
            yield as_batch([end()])

    def as_batch(out):
        columns = list(zip(*out)) or [()] * 9
        kinds = [of_id] + [pa.int64()] * 6 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", *COUNTS, "audit", "repaired_sha256"])

    return put.mapInArrow(run, f"conv_id {kind.simpleString()}, {_REPORT}, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest repair and digest of every conversation of ``rows`` (``conv_id, turn, role, text, gone``).

    Rows follow their turn, null first, and where turns are equal their role and the text's digest. Each row's first
    fault counts: blank, duplicate of an earlier row's role and text, truncated. A null id is a conversation of its
    own. A conversation whose rows are all ``gone`` has zeros, an empty audit and the digest of nothing. An empty
    table gives no rows. Very long texts are streamed into the digest. Other columns are not read.
    """
    return repaired(rows, reports(blocks(marked(rows))))


@query("op13_repair")
def repair_damaged(spark, folder):
    return repair(damaged(read(spark, folder, "conversations")))
