"""Repairing the structure of conversations: cheapest edits by a dynamic program over grammar-compressed sequences.

A conversation's rows become a sequence of symbols, one of nine: the role's initial and
whether the row must go (blank or duplicate) or is truncated.  The roles that are left
must read ``(s?(ua)+)?``, an automaton of four states, so what a row does is a 4 x 4
matrix in the min-plus semiring: the least cost from state to state and, of the edits
that reach it, the ASCII-least ones.  Sequences of equal cost over the same rows are
never prefixes of each other, so that choice is the same however products are bracketed.

1. The rows of all conversations are sorted over the cluster by range, symbols only, and
   become pieces of at most ``PIECE`` symbols; a conversation of any length is many
   pieces in many tasks.
2. Equal pieces count once.  Re-Pair rules are found over all of them: in each round the
   pairs of neighbours are counted where they lie, and only the most frequent of at most
   (9 + rules)^2 pairs come to the driver.
3. Each rule has one matrix, the product of its two symbols' matrices, made bottom-up
   once for all conversations; audits are ropes that share their parts.  A piece is the
   product of the few symbols that the rules leave of it.
4. Pieces and rows of a conversation meet in order in one stream.  It multiplies the
   pieces' matrices onto a vector, reads the edits off it and applies them row by row.
   It holds one batch and the conversation's edits (one letter a row, as in the result);
   the digest of a repaired conversation is sequential, so no plan can split this pass.

Rows are in order of turn (NULL first), then role, text's digest and arrival; only rows
that are equal in all but arrival can change places.  NULL role and text are one space,
a NULL conv_id is a conversation of its own, and roles other than system, user and
assistant may only be replaced or deleted.  Repeated rows are duplicates.  A conversation
all of whose rows are absent has zeros and an empty audit; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

PIECE = 1 << 14
ROUNDS, RULES_PER_ROUND = 4, 16

#: Costs and letters of the edits: fixed values.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

_BLANKS = " \t\n\v\f\r"
_START, _SYSTEM, _USER, _ASSISTANT = range(4)

#: Where each state goes with an initial; the start and behind an assistant are accepted.
_NEXT = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_ASSISTANT, "u"): _USER, (_USER, "a"): _ASSISTANT}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class Rope(NamedTuple):
    """A text as a leaf or as two ropes one after the other."""

    size: int
    text: str | None
    left: Rope | None = None
    right: Rope | None = None

    def __str__(self) -> str:
        parts, todo = [], [self]
        while todo:
            rope = todo.pop()
            if rope.text is not None:
                parts.append(rope.text)
            else:
                todo += (rope.right, rope.left)
        return "".join(parts)


def leaf(text: str) -> Rope:
    return Rope(len(text), text)


def joined(a: Rope, b: Rope) -> Rope:
    return b if not a.size else a if not b.size else Rope(a.size + b.size, None, a, b)


def less(a: Rope, b: Rope) -> bool:
    """Whether the first text sorts before the second; parts that both share are passed over."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if x.text is None and (y.text is not None or x.size >= y.size):
            left += (x.right, x.left)
            right.append(y)
        elif y.text is None:
            right += (y.right, y.left)
            left.append(x)
        else:
            n = min(x.size, y.size)
            if x.text[:n] != y.text[:n]:
                return x.text[:n] < y.text[:n]
            if x.size > n:
                left.append(leaf(x.text[n:]))
            if y.size > n:
                right.append(leaf(y.text[n:]))
    return bool(right)


Entry = tuple[int, Rope] | None  #: cost and edits; None where no edits lead there
Matrix = list[list[Entry]]


def _better(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if less(b[1], a[1]) else a


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product; the left one may have any number of rows."""
    out = []
    for row in a:
        line: list[Entry] = [None] * 4
        for k, x in enumerate(row):
            if x is not None:
                for j, y in enumerate(b[k]):
                    if y is not None and (line[j] is None or x[0] + y[0] <= line[j][0]):
                        line[j] = _better(line[j], (x[0] + y[0], joined(x[1], y[1])))
        out.append(line)
    return out


def _insertions() -> Matrix:
    """The cheapest rows put in between: none, one or two; more never pay."""
    out: Matrix = [[(0, leaf("")) if i == j else None for j in range(4)] for i in range(4)]
    for i in range(4):
        state = i
        for n in (1, 2):
            state = _NEXT[state, "a" if state == _USER else "u"]
            if out[i][state] is None:
                out[i][state] = (n * INSERT, leaf("I" * n))
    return out


def _edit(symbol: str) -> Matrix:
    """What may be done with one row: ``x`` must go, a capital letter is truncated."""
    out: Matrix = [[(DELETE, leaf("D")) if i == j else None for j in range(4)] for i in range(4)]
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        for (state, initial), to in _NEXT.items():
            if initial != "s":
                out[state][to] = _better(out[state][to], (REROLE + extra, leaf("R")))
            if initial == symbol.lower():
                out[state][to] = _better(out[state][to], (KEEP + extra, leaf("K")))
    return out


INSERTIONS = _insertions()
SYMBOLS = "xsuaoSUAO"

Rules = list[tuple[str, str]]  #: (pair, its symbol), in the order in which they apply


def compressed(sequence: str, rules: Rules) -> str:
    for pair, symbol in rules:
        sequence = sequence.replace(pair, symbol)
    return sequence


def rule_matrices(rules: Rules) -> dict[str, Matrix]:
    """The matrix of each symbol and rule, bottom-up."""
    found = {s: times(INSERTIONS, _edit(s)) for s in SYMBOLS}
    for pair, symbol in rules:
        found[symbol] = times(found[pair[0]], found[pair[1]])
    return found


def sequence_matrix(sequence: str, rules: Rules, found: dict[str, Matrix]) -> Matrix:
    first, *rest = compressed(sequence, rules)
    out = found[first]
    for symbol in rest:
        out = times(out, found[symbol])
    return out


def cheapest(vector: list[Entry]) -> tuple[int, str]:
    """Cost and edits from the start to an accepted end."""
    ends = times([vector], INSERTIONS)[0]
    cost, rope = _better(ends[_START], ends[_ASSISTANT])
    return cost, str(rope)


def _pieces(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[pa.RecordBatch]:
    """Runs of symbols of one conversation, each with the order of its first row."""
    names = ["conv_id", "turn", "role", "digest", "duplicate", "row"]
    first, symbols, size = None, [], 0
    out: list[tuple] = []
    types = None

    def flushed() -> pa.RecordBatch:
        columns = [pa.array([o[0][k] for o in out], types[k]) for k in range(len(names))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([o[1] for o in out])], [*names, "symbols"])

    for batch in batches:
        types = [batch.schema.field(n).type for n in names]
        ids, letters = batch.column(0).to_pylist(), batch.column(6).to_pylist()
        for k, (conv, symbol) in enumerate(zip(ids, letters, strict=True)):
            if first is not None and (conv != first[0] or size >= piece):
                out.append((first, "".join(symbols)))
                first, symbols, size = None, [], 0
            if first is None:
                first = tuple(batch.column(c)[k].as_py() for c in range(len(names)))
            symbols.append(symbol)
            size += 1
        if out:
            yield flushed()
            out = []
    if first is not None:
        out.append((first, "".join(symbols)))
        yield flushed()


def _pair_counts(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for sequence, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            short = compressed(sequence, rules)
            for a, b in zip(short, short[1:], strict=False):
                counts[a + b] += n
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["pair", "n"])


def grammar(sequences: DataFrame, rounds: int = ROUNDS, per_round: int = RULES_PER_ROUND) -> Rules:
    """Re-Pair rules over (symbols, n); a round adds the most frequent pairs, none of which occurs only once."""
    rules: Rules = []
    for _ in range(rounds):
        counts = sequences.select("symbols", "n").mapInArrow(partial(_pair_counts, rules=rules), "pair string, n long")
        top = counts.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "pair").limit(per_round).collect()
        if not top:
            break
        rules = rules + [(r["pair"], chr(0xE000 + len(rules) + k)) for k, r in enumerate(top)]
    return rules


def _evaluated(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    found = rule_matrices(rules)
    for batch in batches:
        sequences = batch.column(0).to_pylist()
        for at in range(0, len(sequences), 256):
            part = sequences[at : at + 256]
            entries = [[e for row in sequence_matrix(s, rules, found) for e in row] for s in part]
            costs = pa.array([[None if e is None else e[0] for e in m] for m in entries], pa.list_(pa.int64()))
            audits = pa.array([[None if e is None else str(e[1]) for e in m] for m in entries], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(part), costs, audits], ["symbols", "costs", "audits"])


class _Conversation:
    """One conversation as its stream goes by: matrices first, then rows."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id = conv_id
        self.vector: list[Entry] = [(0, leaf("")), None, None, None]
        self.audit: str | None = None
        self.cost = self.at = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.initial = None
        self.state, self.rows, self.digest = _START, 0, hashlib.sha256()

    def matrix(self, costs: list[int | None], audits: list[str | None]) -> None:
        entries = [None if c is None else (c, leaf(a)) for c, a in zip(costs, audits, strict=True)]
        self.vector = times([self.vector], [entries[k : k + 4] for k in range(0, 16, 4)])[0]

    def settle(self) -> None:
        if self.audit is None:
            self.cost, self.audit = cheapest(self.vector)

    def _put(self, role: str, text: str, initial: str, edit: str) -> tuple:
        self.state = _NEXT[self.state, initial]
        self.digest.update(f"{'' if not self.rows else chr(10)}{role}:{text}".encode())
        self.rows += 1
        return self.conv_id, self.rows, role, text, edit

    def _wanted(self) -> str:
        return "assistant" if self.state == _USER else "user"

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            role = self._wanted()
            yield self._put(role, "", role[0], "I")

    def row(self, turn: int | None, role: str, text: str, fault: str | None) -> Iterator[tuple]:
        self.settle()
        if turn is not None:
            self.turns += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        initial = role[:1]
        self.illegal += self.initial is not None and (self.initial, initial) not in _LEGAL
        self.initial = initial
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            role = self._wanted()
        if edit != "D":
            yield self._put(role, text, role[0], edit)

    def summary(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit, self.digest.hexdigest()


def _repair(batches: Iterator[pa.RecordBatch], names: list[str], summaries: bool) -> Iterator[pa.RecordBatch]:
    """A row per conversation, or one per row of the repaired conversations."""
    now: _Conversation | None = None
    types: list[pa.DataType] = []
    out: list[tuple] = []

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    def ended() -> None:
        now.settle()
        last = list(now.inserted())
        out.extend([now.summary()] if summaries else last)

    for batch in batches:
        kinds = {"audit": pa.string(), "repaired_sha256": pa.string(), "role": pa.string(), "text": pa.string(), "edit": pa.string()}
        types = [batch.column(0).type, *[kinds.get(n, pa.int64()) for n in names[1:]]]
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "part", "turn", "role", "text", "fault", "costs", "audits")]
        for conv_id, part, turn, role, text, fault, costs, audits in zip(*columns, strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    ended()
                now = _Conversation(conv_id)
            if part == 1:
                now.matrix(costs, audits)
            elif part == 2:
                made = list(now.row(turn, role, text, fault))
                if not summaries:
                    out += made
        if out:
            yield flushed()
            out.clear()
    if now is not None:
        ended()
        if out:
            yield flushed()


def damaged(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with set damages, chosen by crc32 of ``conv_id:turn``: conv_id, turn, role, text and ``present``.

    Of 20 remainders 0 makes a row absent, 1 empties its text, 2 takes its end marks,
    3 repeats the row and 4 makes its role user.
    """
    space = F.lit(" ")
    source = conversations.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), space).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), space).alias("text"),
    )
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.col("kind")
    return source.withColumn("kind", F.crc32(key.cast("binary")) % 20).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


_ORDER = ("turn", "role", "digest", "duplicate", "row")
SUMMARY = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TURNS = ["conv_id", "position", "role", "text", "edit"]


def _stream(rows: DataFrame, piece: int) -> DataFrame:
    """Conversations, their pieces' matrices and their rows, dealt by conversation and in order."""
    visible = F.rtrim("text", F.lit(_BLANKS))
    ended = F.right(visible, F.lit(1)).isin(".", "!", "?")
    fault: Column = F.when(visible == "", "blank").when(~ended, "truncated")
    space = F.lit(" ")
    source = written(
        rows.select(
            "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), "present"
        ).withColumns({"digest": F.unhex(F.sha2("text", 256)), "fault": fault, "row": F.monotonically_increasing_id()}),
        "conversations",
    )
    present = source.where("present")
    # A hot text is grouped with partial sums; only texts that occur again meet their rows.
    groups = ["conv_id", "role", "digest"]
    narrow = present.where("not fault <=> 'blank'").select(*groups, "turn", "row")
    first = narrow.groupBy(*groups).agg(F.min(F.struct("turn", "row")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = narrow["conv_id"].eqNullSafe(first["conv_id"]) & (narrow["role"] == first["role"]) & (narrow["digest"] == first["digest"])
    repeated = written(narrow.join(first, same).where(F.col("row") != F.col("first.row")).select("row", F.lit(True).alias("again")), "repeated")
    flagged = present.join(repeated, "row", "left").withColumn("duplicate", F.coalesce("again", F.lit(False))).withColumn(
        "fault", F.when(F.col("duplicate"), "duplicate").otherwise(F.col("fault"))
    )
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    kinds = {f.name: f.dataType.simpleString() for f in flagged.schema}
    order = ", ".join(f"{c} {kinds[c]}" for c in _ORDER)
    pieces = written(
        flagged.select("conv_id", *_ORDER, symbol.alias("symbol"))
        .repartitionByRange("conv_id", *_ORDER)
        .sortWithinPartitions("conv_id", *_ORDER)
        .mapInArrow(partial(_pieces, piece=piece), f"conv_id {kinds['conv_id']}, {order}, symbols string"),
        "pieces",
    )
    sequences = written(pieces.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "sequences")
    matrices = sequences.mapInArrow(partial(_evaluated, rules=grammar(sequences)), "symbols string, costs array<bigint>, audits array<string>")
    heads = pieces.join(matrices, "symbols").select("conv_id", F.lit(1).alias("part"), *_ORDER, "costs", "audits")
    return (
        source.select("conv_id", F.lit(0).alias("part"))
        .distinct()
        .unionByName(heads, allowMissingColumns=True)
        .unionByName(flagged.select("conv_id", F.lit(2).alias("part"), *_ORDER, "text", "fault"), allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", *_ORDER)
    )


def repaired(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text, present): faults, cost, edits and digest of its repair."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    kinds = {"conv_id": kind, "audit": "string", "repaired_sha256": "string"}
    return _stream(rows, piece).mapInArrow(partial(_repair, names=SUMMARY, summaries=True), ", ".join(f"{c} {kinds.get(c, 'long')}" for c in SUMMARY))


def repaired_turns(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """The rows of the repaired conversations: conv_id, position from 1, role, text and the edit that made the row."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _stream(rows, piece).mapInArrow(
        partial(_repair, names=TURNS, summaries=False), f"conv_id {kind}, position long, role string, text string, edit string"
    )
