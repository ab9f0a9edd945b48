"""Conversation structure repair by weighted CYK interval parsing.

A conversation's rows become one symbol each: what the row's role starts with, whether it is cut
short, or that it has to go. The repair grammar is in Chomsky normal form. Its nonterminals are
pairs (p, q) of places in ``(s?(ua)+)?`` and derive the spans that lead from p to q after edits:
(p, q) -> (p, r) (r, q) for every r, and (p, q) -> one row, kept, given another role or deleted.
A cell holds, for each nonterminal, the least (cost, audit) of its span, where the audit is the
string of the edits' initials; insertions are no rows, so cells are closed under them. Edits of one
span that cost the same are never prefixes of each other (they edit the same rows, and a longer one
has paid for more insertions), so least audits of neighbours joined are the least of the joined span.

Spans up to ``LEAF`` rows are parsed in full: all spans by length, each over all its splits. Since the
nonterminals are pairs of places, every split of a span gives the same cell, so longer ones are
combined from neighbours of doubling length. Cells of equal symbol strings are kept and used again.

Rows are dealt by ranges of (conversation, turn, role, digest of the text), so that a long
conversation spreads over many tasks; only the pieces at the ends of a task's range, two a task at
most, are joined afterwards. Texts move once, sorted, and are written out as a stream.

Nulls: a null role or text is one space (so a null text is blank), null turns come first, and a null
``conv_id`` is a conversation like any other. Rows of one turn are ordered by role and digest; equal
rows may change places. Conversations without rows have no gaps, faults, cost or edits. Further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hourloom.llm.common import portions, staged

WHITE = " \t\n\x0b\f\r"
LEAF = 8
#: Cells remembered by symbol string; the memory is emptied beyond this.
MEMORY = 20_000

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Places that some edits lead to from a place.
PAIRS = [(p, q) for p in range(4) for q in range(4) if p == q or q >= USER or (p, q) == (START, SYSTEM)]
RULES = [[(PAIRS.index((p, r)), PAIRS.index((r, q))) for r in range(4) if (p, r) in PAIRS and (r, q) in PAIRS]
         for p, q in PAIRS]
#: Symbols: must go; or the start of the role (o: any other), a capital where the text is cut short.
GONE = "d"
Cell = tuple


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: for each nonterminal the least over its rules."""
    out = []
    for rules in RULES:
        best = None
        for a, b in rules:
            x, y = left[a], right[b]
            if x is None or y is None:
                continue
            cost = x[0] + y[0]
            if best is None or cost < best[0]:
                best = (cost, x[1] + y[1])
            elif cost == best[0]:
                audit = x[1] + y[1]
                if audit < best[1]:
                    best = (cost, audit)
        out.append(best)
    return tuple(out)


def _least(cells: list[Cell]) -> Cell:
    return tuple(min((c for c in options if c is not None), default=None) for options in zip(*cells))


def _insertions() -> Cell:
    """The cell of no rows: what insertions alone lead to."""
    cell = tuple((0, "") if p == q else (INSERT, "I") if STEP.get((p, "u")) == q or STEP.get((p, "a")) == q else None
                 for p, q in PAIRS)
    for _ in range(4):
        cell = combine(cell, cell)
    return cell


EMPTY = _insertions()


def _terminal(symbol: str) -> Cell:
    """One row's cell: each edit of it, with insertions on both sides."""
    extra, start = (CUT_SHORT if symbol.isupper() else 0), symbol.lower()
    cell = []
    for p, q in PAIRS:
        edits = [(DELETE, "D")] if p == q else []
        if symbol != GONE:
            if STEP.get((p, start)) == q:
                edits.append((KEEP + extra, "K"))
            if q in (STEP.get((p, "u")), STEP.get((p, "a"))):
                edits.append((REROLE + extra, "R"))
        cell.append(min(edits, default=None))
    return combine(combine(EMPTY, tuple(cell)), EMPTY)


TERMINALS = {s: _terminal(s) for s in "dsuaoSUAO"}


def parse(symbols: str, memory: dict[str, Cell] | None = None) -> Cell:
    """CYK chart of ``symbols``: spans by length, each the least over all its splits."""
    memory = {} if memory is None else memory
    if len(memory) > MEMORY:
        memory.clear()
    if not symbols:
        return EMPTY
    for length in range(1, len(symbols) + 1):
        for i in range(len(symbols) - length + 1):
            span = symbols[i:i + length]
            if span not in memory:
                memory[span] = TERMINALS[span] if length == 1 else _least(
                    [combine(memory[span[:k]], memory[span[k:]]) for k in range(1, length)])
    return memory[symbols]


class Spans:
    """Cells of neighbouring spans, combined as soon as two of them have the same length."""

    def __init__(self) -> None:
        self.stack: list[tuple[int, Cell]] = []

    def push(self, cell: Cell) -> None:
        length = 1
        while self.stack and self.stack[-1][0] <= length:
            before, left = self.stack.pop()
            cell, length = combine(left, cell), before + length
        self.stack.append((length, cell))

    def cell(self) -> Cell:
        out = EMPTY
        for _, left in reversed(self.stack):
            out = combine(left, out)
        return out


def cheapest(cell: Cell) -> tuple[int, str]:
    """The least edits of the whole conversation: no row left, or one that ends with the assistant."""
    return min(cell[PAIRS.index((START, START))], cell[PAIRS.index((START, ASSISTANT))])


class Piece:
    """Counts and cells of consecutive rows of one conversation."""

    LEGAL = {"su", "ua", "au"}

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None
        self.spans, self.pending = Spans(), []

    def add(self, turn, initial: str, fault: str, memory: dict) -> None:
        if self.last is not None and self.last + initial not in self.LEGAL:
            self.illegal += 1
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        symbol = initial if initial in ("s", "u", "a") else "o"
        self.pending.append(GONE if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol)
        if len(self.pending) == LEAF:
            self.flush(memory)

    def flush(self, memory: dict) -> None:
        if self.pending:
            self.spans.push(parse("".join(self.pending), memory))
            self.pending = []

    def follow(self, row: dict) -> None:
        """Join the piece that comes next."""
        if self.last is not None and self.last + row["first"] not in self.LEGAL:
            self.illegal += 1
        self.first, self.last = row["first"] if self.first is None else self.first, row["last"]
        if row["low"] is not None:
            self.turns += row["turns"] - (row["low"] == self.high)
            self.low, self.high = row["low"] if self.low is None else self.low, row["high"]
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + row[name])
        self.spans.push(tuple(None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"])))

    def row(self, part: int, whole: bool) -> dict:
        cell = self.spans.cell()
        cost, audit = cheapest(cell)
        return {"part": part, "whole": whole, "turns": self.turns, "low": self.low, "high": self.high,
                "first": self.first, "last": self.last, "blank": self.blank, "duplicate": self.duplicate,
                "truncated": self.truncated, "illegal": self.illegal,
                "cost": cost, "audit": audit if whole else None,
                "costs": None if whole else [c and c[0] for c in cell],
                "audits": None if whole else [c and c[1] for c in cell]}


_PIECE = [("part", "int"), ("whole", "boolean"), ("turns", "long"), ("low", "long"), ("high", "long"),
          ("first", "string"), ("last", "string"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"),
          ("illegal", "long"), ("cost", "long"), ("audit", "string"), ("costs", "array<long>"),
          ("audits", "array<string>")]
_ARROW = {"int": pa.int32(), "boolean": pa.bool_(), "long": pa.int64(), "string": pa.string(),
          "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _fields(key: T.DataType, rest: list[tuple[str, str]]) -> T.StructType:
    tail = T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in rest))
    return T.StructType([T.StructField("conv_id", key), *tail.fields])


def _batch(rows: list[dict], key: pa.DataType, fields: list[tuple[str, str]]) -> pa.RecordBatch:
    schema = pa.schema([("conv_id", key), *[(n, _ARROW[t]) for n, t in fields]])
    return pa.RecordBatch.from_pylist(rows, schema)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a task to one piece a conversation; the first and last may go on elsewhere."""
    part, memory = TaskContext.get().partitionId(), {}
    piece, at, first, done, key = None, None, True, [], None
    for batch in batches:
        key = batch.schema.field("conv_id").type
        for conv, turn, initial, fault in zip(*[batch.column(c).to_pylist()
                                                for c in ("conv_id", "turn", "initial", "fault")]):
            if piece is None or conv != at:
                if piece is not None:
                    piece.flush(memory)
                    done.append({"conv_id": at, **piece.row(part, not first)})
                    first = False
                piece, at = Piece(), conv
            piece.add(turn, initial, fault, memory)
            if len(done) >= 2000:
                yield _batch(done, key, _PIECE)
                done = []
    if piece is not None:
        piece.flush(memory)
        done.append({"conv_id": at, **piece.row(part, False)})
    if done:
        yield _batch(done, key, _PIECE)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation and range to whole conversations."""
    piece, at, key = None, None, None
    for batch in batches:
        key = batch.schema.field("conv_id").type
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if piece is None or row["conv_id"] != at:
                if piece is not None:
                    yield _batch([{"conv_id": at, **piece.row(0, True)}], key, _PIECE)
                piece, at = Piece(), row["conv_id"]
            piece.follow(row)
    if piece is not None:
        yield _batch([{"conv_id": at, **piece.row(0, True)}], key, _PIECE)


def _plain(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """The rows as a faulty export leaves them, by crc32 of ``conv_id:turn`` modulo 20: 0 loses the row,
    1 its text, 2 its sentence ends, 3 doubles it, 4 makes it the user's; ``copies`` is 0, 1 or 2."""
    kind = F.crc32(F.concat_ws(":", _plain("conv_id"), _plain("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(_plain("text"), ".!?", "")).otherwise(_plain("text"))
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(_plain("role")).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _told(rows: DataFrame) -> DataFrame:
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), _plain("role").alias("role"),
                       _plain("text").alias("text"), copies.alias("copies"))


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def edits(rows: DataFrame) -> DataFrame:
    """Per conversation with rows: gaps, faults, illegal neighbours, least cost and audit.

    ``rows`` has conv_id, turn, role, text and optionally ``copies`` (0: the row is lost).
    """
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    light = (_told(rows).where("copies > 0")
             .select("conv_id", "turn", "role", _digest().alias("digest"), (F.length(body) == 0).alias("blank"),
                     (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("open"), "copies")
             .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))))
    seen = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    fault = (F.when(F.col("blank"), "blank").when(F.col("nth") > 1, "duplicate")
             .when(F.col("open"), "truncated").otherwise(""))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest", "nth"]
    sorted_rows = (light.withColumn("nth", F.row_number().over(seen))
                   .select("conv_id", "turn", "role", "digest", "nth", F.substring("role", 1, 1).alias("initial"),
                           fault.alias("fault"))
                   .repartitionByRange(*order).sortWithinPartitions(*order)
                   .select("conv_id", "turn", "initial", "fault"))
    schema = _fields(rows.schema["conv_id"].dataType, _PIECE)
    pieces = staged(sorted_rows.mapInArrow(_pieces, schema), "pieces")
    ends = (pieces.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
            .mapInArrow(_joined, schema))
    found = pieces.where("whole").unionByName(ends)
    gaps = F.when(F.col("low").isNull(), 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))
    return found.select("conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                        "cost", "audit")


_COUNTS = [(n, "long") for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", "string")]
_ROWS = [("position", "long"), ("edit", "string"), ("role", "string"), ("text", "string")]
_DIGESTS = _COUNTS + [("repaired_sha256", "string")]


class _Replay:
    """Walks along an audit while the conversation's rows pass by."""

    def __init__(self, head: dict) -> None:
        self.head, self.at, self.position = head, 0, 0
        audit = head["audit"] or ""
        self.audit = audit
        self.shift = (len(audit) - audit.count("D")) % 2  # a system row comes first

    def _role(self) -> str:
        return ("user", "assistant")[(self.position - self.shift) % 2]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield "I", self._role(), ""
            self.at, self.position = self.at + 1, self.position + 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield edit, role if edit == "K" else self._role(), text
            self.position += 1


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key type, conversation's head, position, edit, role, text) in order; a conversation ends with
    one event whose edit is None."""
    replay, at, key = None, None, None

    def end():
        for edit, role, text in replay.inserted():
            yield key, replay.head, replay.position, edit, role, text
        yield key, replay.head, replay.position, None, None, None

    for batch in batches:
        key = batch.schema.field("conv_id").type
        for part in portions(iter([batch]), batch.schema.get_field_index("text")):
            for row in part.to_pylist():
                if replay is None or row["conv_id"] != at:
                    if replay is not None:
                        yield from end()
                    at = row["conv_id"]
                    head = {n: row[n] if row["kind"] == 0 else "" if n == "audit" else 0 for n, _ in _COUNTS}
                    replay = _Replay({"conv_id": at, **head})
                for _ in range(row["copies"]):
                    for edit, role, text in replay.row(row["role"], row["text"]):
                        yield key, replay.head, replay.position, edit, role, text
    if replay is not None:
        yield from end()


def _write_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, held, key = [], 0, None
    for key, head, position, edit, role, text in _events(batches):
        if edit is None:
            continue
        rows.append({"conv_id": head["conv_id"], "position": position, "edit": edit, "role": role, "text": text})
        held += len(text) + 50
        if held > 1 << 20:
            yield _batch(rows, key, _ROWS)
            rows, held = [], 0
    if rows:
        yield _batch(rows, key, _ROWS)


def _write_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, digest, fresh, key = [], hashlib.sha256(), True, None
    for key, head, _, edit, role, text in _events(batches):
        if edit is not None:
            digest.update(("" if fresh else "\n").encode() + f"{role}:{text}".encode())
            fresh = False
            continue
        rows.append({**head, "repaired_sha256": digest.hexdigest()})
        digest, fresh = hashlib.sha256(), True
        if len(rows) >= 2000:
            yield _batch(rows, key, _DIGESTS)
            rows = []
    if rows:
        yield _batch(rows, key, _DIGESTS)


def _in_order(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's edits and then its rows, in one task and in order: a stream, never a list.

    One task reads a conversation from end to end, since its text is written (and hashed) in order.
    """
    empty = [F.lit(None).cast(t).alias(n) for n, t in _COUNTS]
    told = _told(rows)
    lost = F.col("copies") == 0
    texts = told.select("conv_id", F.lit(1).alias("kind"), "turn", F.when(~lost, F.col("role")).alias("role"),
                        F.when(~lost, F.col("text")).alias("text"), "copies", *empty)
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                         F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                         F.lit(0).alias("copies"), *[n for n, _ in _COUNTS])
    return (heads.unionByName(texts).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", _digest()))


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position from 0, edit (K, R or I), role, text."""
    return _in_order(rows, edits(rows)).mapInArrow(_write_rows, _fields(rows.schema["conv_id"].dataType, _ROWS))


def repair_digests(rows: DataFrame) -> DataFrame:
    """Every conversation with its counts, cost, audit and the SHA-256 of its repaired ``role:text`` lines."""
    return _in_order(rows, edits(rows)).mapInArrow(_write_digests, _fields(rows.schema["conv_id"].dataType, _DIGESTS))
