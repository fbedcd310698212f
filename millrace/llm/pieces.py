"""SentencePiece encoding and decoding as a shortest path through a transducer.

The model file compiles to three parts that are composed with each text: the normaliser (dummy prefix, spaces to the
meta symbol), one arc per piece, and byte fallback arcs for a character that no piece covers. The best path in the
tropical semiring (weights add along a path, the least path wins) is the encoding.

- Unigram models: an arc weighs minus the piece's score.
- BPE models: scores are merge ranks and do not add up, so the piece transducer has one state per last piece, and an
  arc ``a -> b`` exists exactly where merging the characters of ``ab`` gives ``a, b`` again. A sequence is the BPE
  encoding of its text if and only if all its neighbours are such pairs, so the path that survives is the encoding.

No piece goes on over a space that follows another character (checked when compiling), so the lattice falls apart
there, and equal parts of texts have equal paths. A bounded memo per worker keeps them.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.base import filled, query, read

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
#: Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
#: Distinct parts whose paths a worker remembers, and texts encoded together.
MOST_PARTS = 800_000
#: Letters of the longest part that is composed together with others.
LONG_PART = 64
TEXTS_AT_ONCE = 500


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one message of the model file."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, data[at : at + size]
        at += size


class PieceTransducer:
    """The compiled model: ``encode`` a text to piece ids, ``decode`` ids to the normalized text."""

    def __init__(self, model: bytes, memo: int = 200_000):
        self.memo_size = memo  # of known arcs
        pieces, trainer, normalizer = [], {}, {}
        for number, value in fields(model):
            if number == 1:
                pieces.append(dict(fields(value)))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE) or not trainer.get(35) or normalizer.get(2):
            raise ValueError("needs a unigram or BPE model with byte fallback and without a character map")
        if normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("needs a model that keeps repeated spaces and escapes them")
        self.prefix = SPACE_MARK if normalizer.get(3, 1) else ""
        self.arcs: dict[str, int] = {}
        self.weight: list[float] = []
        self.out: list[bytes] = []
        self.byte_ids = [0] * 256
        for i, piece in enumerate(pieces):
            text, kind = piece[1].decode(), piece.get(3, NORMAL)
            self.weight.append(-struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            self.out.append(b"" if kind in (CONTROL, UNKNOWN) else piece[1])
            if kind == BYTE:
                value = int(text[3:5], 16)
                self.byte_ids[value], self.out[i] = i, bytes([value])
            elif kind in (NORMAL, USER):
                self.arcs[text] = i
        #: what may still become a piece, with its number where it is one
        self.starts: dict[str, int | None] = {}
        for text in self.arcs:
            for end in range(1, len(text)):
                self.starts.setdefault(text[:end], None)
            self.starts[text] = self.arcs[text]
        self.worst = max((self.weight[i] for i in self.arcs.values()), default=0.0) + 10.0
        if any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", text) for text in self.arcs):
            raise ValueError("a piece goes on over a space")
        lone = "".join(re.escape(c) for c in "\n\t\r" if not any(c in text for text in self.arcs))
        self.parts = re.compile(f"[{lone}]|{SPACE_MARK}*[^{SPACE_MARK}{lone}]+|{SPACE_MARK}+" if lone
                                else f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+")
        self.pairs: dict[int, bool] = {}  # known arcs of the BPE transducer
        self.made: dict[str, tuple[str, str] | None] = {}

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two symbols whose merge gives a piece when its characters are merged; None if they never give it."""
        known = self.made.get(piece, False)
        if known is not False:
            return known
        symbols, last = list(piece), None
        while len(symbols) > 1:
            ranked = [(self.weight[self.arcs[a + b]], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
                      if a + b in self.arcs]
            if not ranked:
                last = None
                break
            i = min(ranked)[1]
            last = symbols[i], symbols[i + 1]
            symbols[i : i + 2] = ["".join(last)]
        self.made[piece] = last
        return last

    def alone(self, piece: str) -> bool:
        return len(piece) == 1 or self.halves(piece) is not None

    def follows(self, before: str, after: str) -> bool:
        """Whether the BPE transducer has an arc from the state ``before`` (empty: the start) to ``after``."""
        return self.alone(after) and (not before or self.border_stands(before, after))

    def border_stands(self, left: str, right: str) -> bool:
        """Undo the merges of both pieces, the latest first. The border between them stands unless two symbols that
        touch it form a piece that ranks before the merge that took one of them away; at equal ranks the place
        further left is merged first.
        """
        limit = (float("inf"), 0)
        while True:
            joined = self.arcs.get(left + right)
            if joined is not None and (self.weight[joined], 0) < limit:
                return False
            of_left = self.weight[self.arcs[left]] if len(left) > 1 else None
            of_right = self.weight[self.arcs[right]] if len(right) > 1 else None
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and of_left > of_right):
                limit, left = (of_left, 0), self.halves(left)[1]
            else:
                limit, right = (of_right, 1), self.halves(right)[0]

    def shortest(self, part: str) -> tuple[int, ...]:
        """Compose one part with the arcs and return the labels of the least path."""
        last, back = self.bpe_path(part) if self.kind == BPE else self.unigram_path(part)
        labels: list[list[int]] = []
        end = len(part)
        while end:
            number = self.arcs.get(last[end])
            labels.append([self.byte_ids[b] for b in last[end].encode()] if number is None else [number])
            end = back[end]
        return tuple(i for piece in reversed(labels) for i in piece)

    def bpe_path(self, part: str) -> tuple[list[str], list[int]]:
        """Last piece and its start on the one path to each place: arcs weigh nothing, missing ones are infinite.

        States are piece numbers plus one; -1 is a character without a piece, which merges with nothing.
        """
        n, starts, pairs = len(part), self.starts, self.pairs
        state, last, back = [0] * (n + 1), [""] * (n + 1), [0] * (n + 1)
        for start in range(n):
            if state[n]:
                break  # the path to the end is known
            before = state[start] << 20
            for end in range(start + 1, n + 1):
                piece = part[start:end]
                number = starts.get(piece, -1)
                if number is None and end - start > 1 or state[end]:
                    continue
                if number == -1 or number is None:
                    if end - start == 1 and piece not in self.arcs:
                        state[end], last[end], back[end] = -1, piece, start
                    if number == -1:
                        break
                    continue
                known = pairs.get(before + number)
                if known is None:
                    if len(pairs) >= self.memo_size:
                        pairs.clear()
                    known = pairs[before + number] = self.follows(last[start] if state[start] > 0 else "", piece)
                if known:
                    state[end], last[end], back[end] = number + 1, piece, start
        return last, back

    def unigram_path(self, part: str) -> tuple[list[str], list[int]]:
        """Last piece and its start on the least path to each place; a character without a piece weighs the worst."""
        n = len(part)
        cost, last, back = [0.0] + [float("inf")] * n, [""] * (n + 1), [0] * (n + 1)
        for start in range(n):
            for end in range(start + 1, n + 1):
                piece = part[start:end]
                number = self.starts.get(piece, -1)
                if (number == -1 or number is None) and end - start == 1:
                    weight = self.worst
                elif number == -1:
                    break
                elif number is None:
                    continue
                else:
                    weight = self.weight[number]
                if cost[start] + weight < cost[end]:
                    cost[end], last[end], back[end] = cost[start] + weight, piece, start
        return last, back

    def parts_of(self, text: str) -> list[str]:
        """The parts of a text, whose paths do not depend on each other."""
        return self.parts.findall(self.prefix + text.replace(" ", SPACE_MARK)) if text else []

    def encode(self, text: str) -> list[int]:
        """Piece ids of a text; none for an empty one."""
        return [i for part in self.parts_of(text) for i in self.shortest(part)]

    def decode(self, labels) -> str:
        """The text of piece ids: bytes together, meta symbols as spaces, without the dummy prefix."""
        text = b"".join(map(self.out.__getitem__, labels)).decode("utf-8", "replace").replace(SPACE_MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


class Lookup:
    """Numbers not below 0 with a value each, found many at a time: open addressing in arrays."""

    def __init__(self, bits: int = 12):
        self.bits, self.size = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for a key that is not there."""
        out, live, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), self.slots(keys)
        while len(live):
            there = self.keys[at]
            hit = there == keys[live]
            out[live[hit]] = self.values[at[hit]]
            on = ~hit & (there >= 0)
            live, at = live[on], (at[on] + 1) & (len(self.keys) - 1)
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct new keys."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            old = self.keys[self.keys >= 0], self.values[self.keys >= 0]
            size = self.size + len(keys)
            self.__init__(max(self.bits + 1, (4 * size).bit_length()))
            self.put(*old)
        self.size += len(keys)
        at = self.slots(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several keys for a slot the last stays
            mine = self.keys[at] == keys
            self.values[at[mine]] = values[mine]
            keys, values, at = keys[~mine], values[~mine], (at[~mine] + 1) & (len(self.keys) - 1)


class Arcs:
    """The piece arcs as arrays, composed with many parts at a time; the same paths as ``PieceTransducer.shortest``."""

    def __init__(self, transducer: PieceTransducer):
        self.transducer = transducer
        self.names = {number: text for text, number in transducer.arcs.items()}
        letters = sorted({c for text in transducer.arcs for c in text})
        self.letters = np.zeros(0x110000, np.int64)  # 0: in no piece
        self.letters[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.single = np.zeros(0x110000, bool)
        self.single[[ord(text) for text in transducer.arcs if len(text) == 1]] = True
        self.width = len(letters) + 1
        nodes, number = {"": 0}, [-1]
        for text in transducer.arcs:
            for end in range(1, len(text) + 1):
                if text[:end] not in nodes:
                    nodes[text[:end]] = len(nodes)
                    number.append(-1)
            number[nodes[text]] = transducer.arcs[text]
        edges = [(nodes[text[:-1]] * self.width + int(self.letters[ord(text[-1])]), node) for text, node in nodes.items() if text]
        self.edges = Lookup()
        self.edges.put(*(np.array(column, np.int64) for column in zip(*edges)))
        self.number = np.array(number, np.int64)
        self.states = len(transducer.weight) + 1
        self.forget()

    def forget(self) -> None:
        self.pairs = Lookup()

    def takes(self, parts: list[str]) -> tuple[list[str], list[str]]:
        """The parts that ``paths`` can take, and the others."""
        rest = [p for p in parts if len(p) > LONG_PART]
        parts = [p for p in parts if len(p) <= LONG_PART] if rest else parts
        if not parts:
            return [], rest
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        known = np.minimum.reduceat(self.single[np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)], np.cumsum(sizes) - sizes)
        return [p for p, k in zip(parts, known) if k], rest + [p for p, k in zip(parts, known) if not k]

    def read(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every arc that reads a piece of the joined parts: its place, the place after it, and the piece."""
        letters = self.letters[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        start = np.arange(len(letters))
        at, node, found = start.copy(), np.zeros(len(start), np.int64), []
        while len(start):
            node = self.edges.get(node * self.width + letters[at])
            goes = node >= 0
            start, at, node = start[goes], at[goes] + 1, node[goes]
            piece = self.number[node]
            found.append((start[piece >= 0], at[piece >= 0], piece[piece >= 0]))
            more = at < ends[start]
            start, at, node = start[more], at[more], node[more]
        return tuple(np.concatenate(column) for column in zip(*found))

    def follow(self, states: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """Whether each piece may follow the state (a piece's number plus one, 0: the start of a part)."""
        keys = states * self.states + pieces
        known = self.pairs.get(keys)
        if (known < 0).any():
            new, names = np.unique(keys[known < 0]), self.names
            self.pairs.put(new, np.array([self.transducer.follows(
                names[k // self.states - 1] if k >= self.states else "", names[k % self.states]) for k in new.tolist()], np.int64))
            known = self.pairs.get(keys)
        return known > 0

    def paths(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts in a row and where each part's end; every part is made of letters of pieces.

        Places are entered in the order of their distance from the start of their part, so one step serves all parts.
        """
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        first = np.cumsum(sizes) - sizes
        part_of = np.repeat(np.arange(len(parts)), sizes)
        start, end, piece = self.read("".join(parts), np.repeat(first + sizes, sizes))
        owner = part_of[start]
        order = np.argsort(end - first[owner], kind="stable")
        start, end, piece, owner = start[order], end[order], piece[order], owner[order]
        steps = np.searchsorted(end - first[owner], np.arange(1, int(sizes.max(initial=0)) + 2))
        start, end = start + owner, end + owner  # places between letters: one more than letters for each part
        state, back = np.zeros(len(part_of) + len(parts), np.int64), np.zeros(len(part_of) + len(parts), np.int64)
        for a, b in zip(steps, steps[1:]):
            on = np.flatnonzero(self.follow(state[start[a:b]], piece[a:b])) + a
            state[end[on]], back[end[on]] = piece[on] + 1, start[on]
        begin = first + np.arange(len(parts))
        at, who, taken = begin + sizes, np.arange(len(parts)), []
        while len(at):
            going = at > begin[who]
            at, who = at[going], who[going]
            taken.append((who, state[at] - 1))
            at = back[at]
        counts = sum((np.bincount(w, minlength=len(parts)) for w, _ in taken), np.zeros(len(parts), np.int64))
        ends = np.cumsum(counts)
        ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        for step, (w, numbers) in enumerate(taken):
            ids[ends[w] - 1 - step] = numbers
        return ids, ends


class PathTable(dict):
    """The paths of distinct parts, each composed once, in one array; the key's value is the path's number."""

    def __init__(self, transducer: PieceTransducer, most: int):
        super().__init__()
        self.transducer, self.most = transducer, most
        self.arcs = Arcs(transducer) if transducer.kind == BPE else None
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.flat, self.ends, self.same = array("i"), array("q", [0]), array("b")
        if self.arcs:
            self.arcs.forget()

    def compose(self, new: set[str]) -> None:
        """Add the paths of new parts: many at a time, but one by one where a part is long or holds a letter of no piece."""
        many, rest = self.arcs.takes(list(new)) if self.arcs else ([], list(new))
        if many:
            self.add(many, *self.arcs.paths(many))
        for part in rest:
            path = self.transducer.shortest(part)
            self.add([part], np.array(path, np.int32), np.array([len(path)]))

    def add(self, parts: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        out = list(map(self.transducer.out.__getitem__, ids.tolist()))
        sizes = np.concatenate([[0], np.cumsum(np.fromiter(map(len, out), np.int64, len(out)))])[ends]
        wanted = [part.encode() for part in parts]
        if b"".join(out) == b"".join(wanted) and np.array_equal(sizes, np.cumsum(np.fromiter(map(len, wanted), np.int64, len(wanted)))):
            same = [True] * len(parts)
        else:
            same = [b"".join(out[a:b]).decode("utf-8", "replace") == part for part, a, b in zip(parts, [0, *ends], ends)]
        self.update(zip(parts, range(len(self.same), len(self.same) + len(parts))))
        self.ends.extend((len(self.flat) + ends).tolist())
        self.flat.frombytes(ids.astype(np.int32).tobytes())
        self.same.extend(same)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, where each text's begin (and the end), and whether the paths of its parts decode to them."""
        if len(self) > self.most:
            self.forget()
        parts: list[str] = []
        sizes = [0]
        for text in texts:
            parts += self.transducer.parts_of(text or "")
            sizes.append(len(parts))
        self.compose(set(parts).difference(self))
        numbers = np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))
        ends = np.array(self.ends)
        starts, lengths = ends[numbers], ends[numbers + 1] - ends[numbers]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.array(self.flat, np.int32)[np.repeat(starts - upto[:-1], lengths) + np.arange(upto[-1])]
        wrong = np.concatenate([[0], np.cumsum(np.array(self.same, bool)[numbers] == 0)])
        at = np.array(sizes)
        return ids, upto[at], wrong[at[1:]] == wrong[at[:-1]]


_COMPILED: dict[int, PathTable] = {}


def compiled(model: bytes) -> PathTable:
    """The transducer of a worker with the paths it has found: compiled once, then kept."""
    key = hash(model)
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = PathTable(PieceTransducer(model), MOST_PARTS)
    return _COMPILED[key]


def shipped(docs: DataFrame, model: str):
    """The model's bytes for all workers; a model file is some hundred kilobytes, whatever the corpus."""
    with open(model, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, text: str = "text", ids: str = "token_ids", model: str = MODEL, decodes: str | None = None) -> DataFrame:
    """``docs`` with the piece ids of ``text`` in the new array column ``ids``.

    A null text has null ids, an empty text none; every row is encoded whole and for itself, so repeated rows, very
    long texts and empty tables need no rule. An existing column ``ids`` is replaced. ``decodes`` names a further
    column that tells whether the ids decode to the text again, as in ``round_trips``.
    """
    added = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if decodes:
        added.append(T.StructField(decodes, T.BooleanType()))
    names = [c for c in docs.columns if c not in (ids, decodes)]
    schema = T.StructType([docs.schema[c] for c in names] + added)
    shared = shipped(docs, model)

    def run(batches):
        table = compiled(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                found, begins, same = table.encode(part.column(text).to_pylist())
                none = np.append(np.asarray(part.column(text).is_null()), False)
                lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32(), mask=none), pa.array(found))
                told = [lists, pa.array(same)][: len(added)]
                yield pa.RecordBatch.from_arrays([*part.columns, *told], schema.names)

    return docs.select(*names).mapInArrow(run, schema)


def decode(rows: DataFrame, ids: str = "token_ids", text: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` with the text of the piece ids in the new column ``text``; null ids give null."""
    names = [c for c in rows.columns if c != text]
    schema = T.StructType([rows.schema[c] for c in names] + [T.StructField(text, T.StringType())])
    shared = shipped(rows, model)

    def run(batches):
        transducer = compiled(shared.value).transducer
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [None if i is None else transducer.decode(i) for i in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], [*names, text])

    return rows.select(*names).mapInArrow(run, schema)


def round_trips(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, token_ids, n_tokens, text_crc32, round_trip``: the ids, and whether they decode to the text.

    A text is its parts in a row, and so are its ids and their decoding: each distinct part is decoded once, and a
    text comes back if all its parts do. A null text counts as empty. The normaliser maps the meta symbol to a space,
    so a text that holds it comes back with spaces. Repeated rows get the same ids, an empty table gives no rows, and a
    very long text is encoded whole. Columns beside the id and the text are not read.
    """
    shared = shipped(docs, model)

    def run(batches):
        table = compiled(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                found, begins, same = table.encode(part.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(found))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, pa.array(np.diff(begins), pa.int32()), part.column(2), pa.array(same)],
                    ["doc_id", "token_ids", "n_tokens", "text_crc32", "round_trip"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    crc = F.crc32(F.encode(filled("text"), "UTF-8")).alias("text_crc32")
    return docs.select("doc_id", "text", crc).mapInArrow(
        run, f"doc_id {kind}, token_ids array<int>, n_tokens int, text_crc32 long, round_trip boolean")


@query("op2_sentencepiece")
def sentencepiece(spark, folder):
    return round_trips(read(spark, folder, "documents"))
