"""Repair of a conversation's structure by the cheapest edits, in a stream.

A repaired conversation is empty, or an optional system turn and then pairs of user and assistant.  Rows
are kept, given another role, deleted (a must for blank and repeated ones), or rows are inserted; of edits
of equal cost those win whose initials (``D I K R``) come first in ASCII.

- ``Survivors`` is the Viterbi search.  Each of its four states keeps one survivor, a node of a tree of
  backpointers; nodes count their children.  A path that no survivor uses is taken off the tree, and once
  the root has a single child, all survivors share it: its edit is final and is emitted.  Ties are settled
  by the whole suffixes after the last common ancestor.  Memory holds only what is not settled.
- Rows are range-partitioned by (conversation, turn, role, text), so a conversation of any size spreads
  over partitions, numbered in order, and cut into segments of ``SEGMENT`` rows of the numbering.  Most
  conversations lie in one segment.  A segment of another one is searched from each of the four states
  at first; that gives costs and the order of the survivors for each pair of entry and exit, 32 numbers a
  segment.  These are chained per conversation, which fixes each segment's entry and exit, and each
  segment is searched once more by itself.
- Repeated rows are found by an aggregation over hashes, not by the stream, so no task keeps a
  conversation's rows to compare with.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator
from functools import cmp_to_key

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from chatledger.llm.common import materialize, prepare

SEGMENT_BITS = 16
COST = {"K": 0, "R": 2, "D": 3, "I": 2}
START, SYSTEM, USER, ASSISTANT = range(4)
_TRAILING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # rows to insert at the end
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_FILLED = re.compile(r"[^\x20\x09-\x0D]")
_BLANKS = " \t\n\x0b\x0c\r"
_OUT = 4096  # rows of a batch
EDITS = "conv {}, ord bigint, k int, edit string, fault string, illegal boolean, turn {}, role string, text string"


class _Node:
    """An edit on the way to a survivor; the number of ``kids`` is its reference count."""

    __slots__ = ("kids", "letter", "number", "up")

    def __init__(self, up: _Node | None, letter: str, number: int) -> None:
        self.up, self.letter, self.number, self.kids = up, letter, number, []


class Survivors:
    """The best edits from state ``entry`` to each state after the rows seen so far.

    A survivor's edits end with that of the last row: rows inserted before the next one belong to the next
    step, so of two survivors neither's initials begin the other's.  ``emit`` gets each edit once it is settled.
    """

    def __init__(self, entry: int, emit: Callable[[str], None]) -> None:
        self.root, self.made, self.emit = _Node(None, "", 0), 0, emit
        self.best: dict[int, tuple[int, _Node]] = {entry: (0, self.root)}

    def _first(self, a: tuple[int, _Node, str] | None, b: tuple[int, _Node, str]) -> tuple[int, _Node, str]:
        """The cheaper of two ways, or that of the lesser initials."""
        if a is None or b[0] < a[0]:
            return b
        return a if a[0] < b[0] or self.compare(a[1], a[2], b[1], b[2]) <= 0 else b

    @staticmethod
    def compare(a: _Node, more_a: str, b: _Node, more_b: str) -> int:
        """Order of two ways by their whole suffixes after the last common ancestor."""
        x, y = [more_a], [more_b]
        while a is not b:
            if a.number > b.number:
                x.append(a.letter)
                a = a.up
            else:
                y.append(b.letter)
                b = b.up
        p, q = "".join(reversed(x)), "".join(reversed(y))
        return (p > q) - (p < q)

    def _with_inserts(self) -> dict[int, tuple[int, _Node, str]]:
        ways = {s: (c, n, "") for s, (c, n) in self.best.items()}
        for s in (START, SYSTEM, ASSISTANT):
            if s in self.best:
                c, n = self.best[s]
                ways[USER] = self._first(ways.get(USER), (c + COST["I"], n, "I"))
        if USER in ways:
            c, n, letters = ways[USER]
            ways[ASSISTANT] = self._first(ways.get(ASSISTANT), (c + COST["I"], n, letters + "I"))
        return ways

    def step(self, initial: str, must_go: bool, truncated: bool) -> None:
        """Take one more row."""
        after: dict[int, tuple[int, _Node, str]] = {}
        for s, (c, n, letters) in self._with_inserts().items():
            ways = [("D", s)]
            if not must_go:
                ways.append(("R", ASSISTANT if s == USER else USER))
                if (initial == "s" and s == START) or (initial == "u" and s != USER) or (initial == "a" and s == USER):
                    ways.append(("K", SYSTEM if initial == "s" else ways[1][1]))
            for letter, to in ways:
                cost = c + COST[letter] + (1 if truncated and letter != "D" else 0)
                after[to] = self._first(after.get(to), (cost, n, letters + letter))
        self._prune(after)
        old = [n for _, n in self.best.values()]
        self.best = {s: (c, self._grow(n, letters)) for s, (c, n, letters) in after.items()}
        for n in old:
            self._release(n)
        while len(self.root.kids) == 1:  # all survivors share it
            self.root = self.root.kids[0]
            self.root.up = None
            self.emit(self.root.letter)

    @staticmethod
    def _prune(after: dict[int, tuple[int, _Node, str]]) -> None:
        """Drop the states before the first pair once they cannot win: after a pair all that follows costs the same
        as from them, but for a system turn that only the start may keep and that is else deleted."""
        pair = min((after[s][0] + (COST["I"] if s == USER else 0) for s in (USER, ASSISTANT) if s in after), default=None)
        for s, more in ((START, COST["D"]), (SYSTEM, 0)):
            if pair is not None and s in after and pair + more < after[s][0]:
                del after[s]

    def _grow(self, n: _Node, letters: str) -> _Node:
        for x in letters:
            self.made += 1
            n.kids.append(_Node(n, x, self.made))
            n = n.kids[-1]
        return n

    def _release(self, n: _Node) -> None:
        """Take a way that no survivor uses off the tree."""
        while not n.kids and n is not self.root:
            up, n.up = n.up, None
            up.kids.remove(n)
            n = up

    def order(self) -> list[int]:
        """The states reached, by the initials of their ways."""
        return sorted(self.best, key=cmp_to_key(lambda x, y: self.compare(self.best[x][1], "", self.best[y][1], "")))

    def finish(self, state: int | None = None) -> None:
        """Emit the rest of the way to ``state``, or else to the end of the conversation, with its last inserts."""
        letters = ""
        if state is None:
            way = None
            for s, (c, n) in self.best.items():
                way = self._first(way, (c + COST["I"] * _TRAILING[s], n, "I" * _TRAILING[s]))
            _, n, letters = way
        else:
            n = self.best[state][1]
        rest = []
        while n is not self.root:
            rest.append(n.letter)
            n = n.up
        for x in [*reversed(rest), *letters]:
            self.emit(x)


def initial_of(role: str) -> str:
    return role[:1]


class _Writer:
    """Turns settled edits of one segment into rows; rows wait here until their edit is settled."""

    def __init__(self, conv: object, entry: int, out: list[tuple]) -> None:
        self.conv, self.state, self.out = conv, entry, out
        self.waiting: deque[tuple] = deque()
        self.at, self.k = -1, 0

    def __call__(self, letter: str) -> None:
        # Inserts stand before the row that waits, those at the end after the last row.
        at = self.waiting[0][0] if self.waiting else self.at
        self.at, self.k = at, self.k + 1 if at == self.at else 0
        if letter == "I":
            role, self.state = ("assistant", ASSISTANT) if self.state == USER else ("user", USER)
            self.out.append((self.conv, at, self.k, letter, None, False, None, role, ""))
            return
        _, fault, illegal, turn, role, text = self.waiting.popleft()
        if letter == "R":
            role, self.state = ("assistant", ASSISTANT) if self.state == USER else ("user", USER)
        elif letter == "K":
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[initial_of(role)]
        self.out.append((self.conv, at, self.k, letter, fault, illegal, turn, role, text))


def fault_of(text: str, repeated: bool) -> str | None:
    """The first fault of a row."""
    if not _FILLED.search(text):
        return "blank"
    if repeated:
        return "duplicate"
    return "truncated" if text.rstrip(_BLANKS)[-1] not in ".!?" else None


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, int, Iterator[dict]]]:
    """(conversation, segment, its rows) of a partition sorted by them."""
    rows = (row for batch in batches for row in batch.to_pylist())
    row = next(rows, None)
    while row is not None:
        conv, seg = row["conv"], row["seg"]

        def segment() -> Iterator[dict]:
            nonlocal row
            while row is not None and row["conv"] == conv and row["seg"] == seg:
                yield row
                row = next(rows, None)

        yield conv, seg, segment()


def _faulted(rows: Iterator[dict]) -> Iterator[tuple[dict, str | None]]:
    """Rows with their fault; a mark of a repeated row stands before it."""
    mark = None
    for row in rows:
        if row["kind"] == 1:
            mark = row["ord"]
        else:
            yield row, fault_of(row["text"], mark == row["ord"])


def _must_go(fault: str | None) -> bool:
    return fault in ("blank", "duplicate")


def summarise(rows: Iterator[dict]) -> dict:
    """Of a segment: for each entry and exit the cost (-1: no way) and the exit's place among the entry's, first and last initial."""
    trees = [Survivors(e, lambda _: None) for e in range(4)]
    first = last = None
    for row, fault in _faulted(rows):
        last = initial_of(row["role"])
        first = last if first is None else first
        for tree in trees:
            tree.step(last, _must_go(fault), fault == "truncated")
    places = [{s: i for i, s in enumerate(t.order())} for t in trees]
    cost = [t.best[x][0] if x in t.best else -1 for t in trees for x in range(4)]
    return {"cost": cost, "place": [p.get(x, -1) for p in places for x in range(4)], "first": first, "last": last}


def chain(segments: list[dict]) -> list[tuple[int, int | None, str]]:
    """(entry, exit, initial before) of each segment of a conversation, from their summaries in order."""
    reached = {START: (0, 0)}  # state: cost, place among the survivors
    backs = []
    for seg in segments:
        ways: dict[int, tuple] = {}
        for e, (cost, place) in reached.items():
            for x in range(4):
                c = seg["cost"][4 * e + x]
                if c >= 0 and (x not in ways or (cost + c, place) < ways[x][:2]):
                    ways[x] = (cost + c, place, seg["place"][4 * e + x], e)
        backs.append({x: w[3] for x, w in ways.items()})
        ranked = sorted(ways, key=lambda x: ways[x][1:3])
        reached = {x: (ways[x][0], i) for i, x in enumerate(ranked)}
    at = min(reached, key=lambda x: (reached[x][0] + COST["I"] * _TRAILING[x], reached[x][1]))
    ports, exit_ = [], None
    for seg, back in zip(reversed(segments), reversed(backs), strict=True):
        ports.append((back[at], exit_))
        exit_ = at = back[at]
    ports.reverse()
    return [(e, x, segments[i - 1]["last"] if i else None) for i, (e, x) in enumerate(ports)]


def ordered_rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, seg, ord, turn, role, text), written: ``ord`` numbers the rows by conversation, turn, role and text."""
    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))]
    named = rows.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), *text)
    # The bounds of ranges are sampled in the driver: pieces of the strings do there, whole ones sort within a range.
    ranged = named.repartitionByRange("conv", "turn", F.substring("role", 1, 16), F.substring("text", 1, 32))
    return materialize(ranged.sortWithinPartitions("conv", "turn", "role", "text").withColumn("ord", F.monotonically_increasing_id()))


def _repeated(rows: DataFrame) -> DataFrame:
    """(conv, ord) of rows whose role and text were seen earlier in their conversation."""
    slim = rows.select("conv", "ord", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("row"), "text", "role").alias("h2"))
    seen = slim.groupBy("conv", "h1", "h2").agg(F.min("ord").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    seen = materialize(seen.select(F.col("conv").alias("c"), "h1", "h2", "head"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (slim["h1"] == seen["h1"]) & (slim["h2"] == seen["h2"])
    return slim.join(seen, same).where("ord > head").select("conv", "ord")


def _split_conversations(rows: DataFrame) -> DataFrame:
    """Conversations that lie in several segments; a border between segments cuts one at most."""
    return rows.groupBy("conv").agg(F.min("seg").alias("lo"), F.max("seg").alias("hi")).where("lo < hi").select(F.col("conv").alias("c"))


def _ports(events: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv, seg, entry, exit, before) of the segments of conversations that lie in several."""
    kind = rows.schema["conv"].dataType.simpleString()
    split = materialize(_split_conversations(rows))
    some = events.join(split, F.col("conv").eqNullSafe(F.col("c")), "left_semi").repartition("conv", "seg").sortWithinPartitions("conv", "seg", "ord", "order")
    schema = f"conv {kind}, seg bigint, cost array<int>, place array<int>, first string, last string"
    fields = _arrow(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, seg, group in _segments(batches):
            yield pa.RecordBatch.from_pylist([{"conv": conv, "seg": seg} | summarise(group)], fields)

    summaries = materialize(some.mapInArrow(search, schema))
    out = f"conv {kind}, seg bigint, entry int, exit int, before string"
    ports = _arrow(out)

    def link(table: pa.Table) -> pa.Table:
        segments = sorted(table.to_pylist(), key=lambda s: s["seg"])
        found = [{"conv": s["conv"], "seg": s["seg"], "entry": e, "exit": x, "before": b} for s, (e, x, b) in zip(segments, chain(segments), strict=True)]
        return pa.Table.from_pylist(found, ports)

    return summaries.groupBy("conv").applyInArrow(link, out)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """A row for each edit: ``conv``, ``ord`` and ``k`` (place), ``edit`` (K, R, D or I), ``fault``, ``illegal``, ``turn``, ``role``, ``text``.

    Without rows of edit D these are the repaired conversations, in the order of ``ord`` and ``k``.  ``fault`` is the first of
    blank, duplicate and truncated that a row has; ``illegal`` tells that it may not follow the row before.  Rows of a
    conversation are taken by turn, nulls first, then role and text.  A null role or text is one space; a null
    conversation is one, too.  An empty table gives no rows.  Segments have ``2 ** segment_bits`` rows at most.  Runs jobs
    while it is built.
    """
    prepare(rows.sparkSession)
    numbered = ordered_rows(rows, conv_col, turn_col, role_col, text_col).withColumn("seg", F.shiftright("ord", segment_bits))
    none: dict[str, Column] = {"entry": F.lit(None).cast("int"), "exit": F.lit(None).cast("int")}
    base = numbered.select("conv", "seg", "ord", F.lit(2).alias("order"), F.lit(0).alias("kind"), "turn", "role", "text")
    marks = _repeated(numbered).select("conv", F.shiftright("ord", segment_bits).alias("seg"), "ord", F.lit(1).alias("order"), F.lit(1).alias("kind"))
    events = base.unionByName(marks, allowMissingColumns=True)
    ports = materialize(_ports(events, numbered))
    ports = ports.select("conv", "seg", F.lit(-1).cast("bigint").alias("ord"), F.lit(0).alias("order"), F.lit(2).alias("kind"), F.col("before").alias("role"), "entry", "exit")
    every = events.withColumns(none).unionByName(ports, allowMissingColumns=True).repartition("conv", "seg").sortWithinPartitions("conv", "seg", "ord", "order")
    schema = EDITS.format(numbered.schema["conv"].dataType.simpleString(), numbered.schema["turn"].dataType.simpleString())
    kinds = _arrow(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds.types, strict=True)], kinds.names)
            out.clear()
            return batch

        for conv, _, group in _segments(batches):
            head = next(group)
            entry, exit_, before = START, None, None
            if head["kind"] == 2:
                entry, exit_, before = head["entry"], head["exit"], head["role"]
            else:
                group = _again(head, group)
            writer = _Writer(conv, entry, out)
            tree = Survivors(entry, writer)
            for row, fault in _faulted(group):
                initial = initial_of(row["role"])
                illegal = before is not None and (before, initial) not in _LEGAL
                writer.waiting.append((row["ord"], fault, illegal, row["turn"], row["role"], row["text"]))
                tree.step(initial, _must_go(fault), fault == "truncated")
                before = initial
                if len(out) >= _OUT:
                    yield flush()
            tree.finish(exit_)
        if out:
            yield flush()

    return every.select("conv", "seg", "ord", "kind", "turn", "role", "text", "entry", "exit").mapInArrow(search, schema)


def _again(head: dict, rest: Iterator[dict]) -> Iterator[dict]:
    yield head
    yield from rest


DIGEST = "conv {}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def digest(edits: DataFrame) -> DataFrame:
    """Per conversation of ``repair``'s rows: gaps of turns, faults, illegal neighbours, cost, the edits' initials, and the
    hash of the repaired rows.  A stream: it holds a conversation's initials, not its rows."""
    schema = DIGEST.format(edits.schema["conv"].dataType.simpleString())
    kinds = _arrow(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, done = None, None, []

        def close() -> None:
            gaps = held["hi"] - held["lo"] + 1 - held["turns"] if held["turns"] else 0
            faults = [held[f] for f in ("blank", "duplicate", "truncated")]
            done.append((conv, gaps, *faults, held["illegal"], held["cost"], "".join(held["audit"]), held["sha"].hexdigest()))

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds.types, strict=True)], kinds.names)
            done.clear()
            return batch

        for batch in batches:
            for row in batch.to_pylist():
                if held is None or row["conv"] != conv:
                    if held is not None:
                        close()
                    conv = row["conv"]
                    held = {"lo": None, "hi": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "rows": 0}
                edit, fault, turn = row["edit"], row["fault"], row["turn"]
                held["audit"].append(edit)
                held["cost"] += COST[edit] + (1 if fault == "truncated" and edit != "D" else 0)
                held["illegal"] += row["illegal"]
                if fault:
                    held[fault] += 1
                if turn is not None and turn != held["hi"]:  # turns rise
                    held["lo"] = turn if held["lo"] is None else held["lo"]
                    held["hi"], held["turns"] = turn, held["turns"] + 1
                if edit != "D":
                    held["sha"].update(("\n" if held["rows"] else "").encode() + f"{row['role']}:{row['text']}".encode())
                    held["rows"] += 1
            if len(done) >= _OUT:
                yield flush()
        if held is not None:
            close()
        if done:
            yield flush()

    ordered = edits.repartition("conv").sortWithinPartitions("conv", "ord", "k")
    return ordered.mapInArrow(read, schema)


def damage(rows: DataFrame) -> DataFrame:
    """The rows with faults set by crc32 of ``conv_id:turn``: a twentieth each is dropped, emptied, loses its full stops, is
    repeated, or becomes the user's.  Nulls are one space in what is hashed, and as role and text."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20).cast("int")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    kept = rows.select("conv_id", "turn", "role", "text", kind.alias("kind")).where("kind != 0")
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return kept.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"), copies).drop("copy")
