"""Conversation structure repair by a dynamic program over edits, with its audit.

A conversation's rows in order of turn are edited so that the initials of their
roles read ``(s?(ua)+)?``. A row is kept (K, 0), given the role that fits (R, 2)
or deleted (D, 3; rows that are blank or repeat an earlier row must be); empty
rows are inserted (I, 2). Rows that stay though they are cut off cost 1 more. The
cheapest edits win; among equal costs the audit, the string of edits, that is least.

* The program has four states, by what the kept roles end in: nothing, the
  system row, a user row, an assistant row. Each holds a cost and the last node of its audit.
  Audits share their prefixes as linked nodes; a node holds its letter, depth, a
  rolling hash of the whole prefix and its ancestors 1, 2, 4, ... up.
* Two audits of one cost are compared where they part: the longest common prefix is found by
  descending the ancestors while their hashes differ, and the prefixes are then
  walked up to their first common node, so that a collision of hashes cannot decide.
  Audits of equal cost over the same rows are never one another's proper prefix (an
  insertion costs), so an order once found holds for whatever follows.
* A state that another one undercuts by more than the edits that lead from the one to
  the other is dropped. The prefix that all states left share is final: its
  edits are put out and its rows and nodes let go. So a conversation of any length
  streams through its task, sorted by Spark; texts are held for the undecided rows only.
* Whether a row repeats an earlier one is found by an aggregation by conversation,
  role and text before that, so no task holds the texts of a conversation.

Nulls: a null role or text is one space; null conv_ids are one conversation; null
turns come first. Rows of one turn go by role, then text; a repeated row
is a duplicate. A row without a role (empty text) has no initial: it cannot be
kept as it is. Turns that are not integers are not handled. Extra columns are
ignored. An empty table has no conversations.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
#: Added for a row that stays though its text is cut off.
CUT_OFF = 1

_BLANKS = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
#: States: nothing kept yet, system row last, user row last, assistant row last.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_BEFORE = {_USER: (_NONE, _SYSTEM, _ASSISTANT), _ASSISTANT: (_USER,)}
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
#: What at most it costs more to go on from the second state than from the first, whatever follows.
_DETOUR = {
    (_NONE, _ASSISTANT): COST[DELETE],
    (_NONE, _USER): COST[DELETE] + COST[INSERT],
    (_SYSTEM, _ASSISTANT): 0,
    (_SYSTEM, _USER): COST[INSERT],
    (_USER, _ASSISTANT): COST[INSERT],
    (_ASSISTANT, _USER): COST[INSERT],
}
#: Undecided rows after which the common prefix is looked for.
_PENDING = 256
_MOD = (1 << 61) - 1
_BASE = 1_000_003
_BATCH = 4096


# ---- audits -------------------------------------------------------------------


class Node:
    """One edit at the end of a prefix; ``up[k]`` is the node ``2**k`` edits before."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, letter: str, parent: Node | None):
        self.letter = letter
        self.depth = parent.depth + 1 if parent else 0
        self.hash = (parent.hash * _BASE + ord(letter)) % _MOD if parent else 0
        self.up: list[Node] = []
        at = parent
        while at is not None:
            self.up.append(at)
            k = len(self.up) - 1
            at = at.up[k] if k < len(at.up) else None

    def ancestor(self, depth: int) -> Node:
        node = self
        while node.depth > depth:
            node = node.up[(node.depth - depth).bit_length() - 1]
        return node


def _part(a: Node, b: Node) -> tuple[str, str] | None:
    """The first letters in which the prefixes of two nodes of one depth differ; None if they are equal."""
    found = None
    if a.hash != b.hash:
        for k in reversed(range(max(len(a.up), len(b.up)))):
            if k < len(a.up) and k < len(b.up) and a.up[k].hash != b.up[k].hash:
                a, b = a.up[k], b.up[k]
        found = a.letter, b.letter
        a, b = a.up[0], b.up[0]
    while a is not b:  # equal by their hashes: true up to the node they share?
        if a.letter != b.letter:
            found = a.letter, b.letter
        a, b = a.up[0], b.up[0]
    return found


def first_of(a: Node, b: Node) -> Node:
    """The node whose prefix is ASCII-least."""
    depth = min(a.depth, b.depth)
    parts = _part(a.ancestor(depth), b.ancestor(depth))
    if parts is None:
        return a if a.depth <= b.depth else b
    return a if parts[0] < parts[1] else b


def _shared(nodes: list[Node]) -> Node:
    """The last node on the prefixes of all."""
    one = nodes[0]
    for other in nodes[1:]:
        depth = min(one.depth, other.depth)
        a, b = one.ancestor(depth), other.ancestor(depth)
        for k in reversed(range(max(len(a.up), len(b.up)))):
            if k < len(a.up) and k < len(b.up) and a.up[k] is not b.up[k]:
                a, b = a.up[k], b.up[k]
        one = a if a is b else a.up[0]
    return one


class Repair:
    """The program over one conversation: ``add`` its rows in order, then ``end``; both give the edits decided by then.

    An edit is (letter, turn, role, text); what is deleted has the row's own role and text.
    """

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.cost = 0
        self._root = Node("", None)
        self._best: dict[int, tuple[int, Node]] = {_NONE: (0, self._root)}
        self._close()
        self._pending: deque[tuple] = deque()
        self._out = _NONE  # state after the edits put out
        self._last: str | None = None

    def _offer(self, into: dict, state: int, cost: int, parent: Node, letter: str) -> None:
        held = into.get(state)
        if held is None or cost < held[0]:
            into[state] = cost, Node(letter, parent)
        elif cost == held[0]:
            into[state] = cost, first_of(held[1], Node(letter, parent))

    def _close(self) -> None:
        """Insertions before the next row: a user row, then an assistant row."""
        for state, before in _BEFORE.items():
            for s in before:
                if s in self._best:
                    cost, node = self._best[s]
                    self._offer(self._best, state, cost + COST[INSERT], node, INSERT)

    def add(self, turn, role: str, text: str, repeated: bool) -> list[tuple]:
        initial = role[:1]
        self.illegal += self._last is not None and self._last + initial not in _LEGAL
        self._last = initial
        bare = text.rstrip(_BLANKS)
        blank = not bare
        cut = not blank and not repeated and bare[-1] not in ".!?"
        self.blank += blank
        self.duplicate += not blank and repeated
        self.truncated += cut
        best: dict[int, tuple[int, Node]] = {}
        for s, (cost, node) in self._best.items():
            self._offer(best, s, cost + COST[DELETE], node, DELETE)
        if not blank and not repeated:
            more = CUT_OFF * cut
            if initial == "s" and _NONE in self._best:
                cost, node = self._best[_NONE]
                self._offer(best, _SYSTEM, cost + COST[KEEP] + more, node, KEEP)
            for state, before in _BEFORE.items():
                for s in before:
                    if s in self._best:
                        cost, node = self._best[s]
                        if initial == _ROLE[state][0]:
                            self._offer(best, state, cost + COST[KEEP] + more, node, KEEP)
                        else:
                            self._offer(best, state, cost + COST[REROLE] + more, node, REROLE)
        self._best = best
        self._close()
        for (worse, better), detour in _DETOUR.items():
            if worse in self._best and better in self._best and self._best[worse][0] > self._best[better][0] + detour:
                del self._best[worse]
        self._pending.append((turn, role, text))
        if len(self._pending) % _PENDING:
            return []
        return self._decided(_shared([node for _, node in self._best.values()]))

    def end(self) -> list[tuple]:
        (cost, node), *other = [self._best[s] for s in (_NONE, _ASSISTANT) if s in self._best]
        for c, n in other:
            if c < cost or c == cost and first_of(n, node) is n:
                cost, node = c, n
        self.cost = cost
        return self._decided(node)

    def _decided(self, node: Node) -> list[tuple]:
        letters, at = [], node
        while at is not self._root:
            letters.append(at.letter)
            at = at.up[0]
        node.up.clear()  # what lies before is final and may go
        self._root = node
        return [self._edit(letter) for letter in reversed(letters)]

    def _edit(self, letter: str) -> tuple:
        turn, role, text = (None, "", "") if letter == INSERT else self._pending.popleft()
        if letter == KEEP:
            self._out = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[:1]]
        elif letter != DELETE:
            self._out = _ASSISTANT if self._out == _USER else _USER
            role = _ROLE[self._out]
        return letter, turn, role, text


# ---- over all conversations -----------------------------------------------------


def _sorted_rows(rows: DataFrame, present: Column) -> DataFrame:
    """(conv_id, present, repeated, turn, role, text), each conversation in one partition and in order."""
    rows = rows.select(
        "conv_id", present.alias("present"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("digest", F.sha2("text", 256))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.filter("present").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"))
    first = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    later = (F.col("first") != place) & F.col("present")
    marked = rows.join(first, same, "left").select("conv_id", "present", F.coalesce(later, F.lit(False)).alias("repeated"), "turn", "role", "text")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    return marked.repartition("conv_id").sortWithinPartitions(*order)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, row or None at the end) over the sorted rows."""
    conv, begun = None, False
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if begun and row[0] != conv:
                yield conv, None
            conv, begun = row[0], True
            yield conv, row[1:]
    if begun:
        yield conv, None


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, edits, None) as they are decided and (conv_id, edits, (repair, gaps)) at the end of each conversation."""
    repair, before, low, high, turns = Repair(), None, None, None, 0
    for conv, row in _conversations(batches):
        if row is None:
            yield conv, repair.end(), (repair, high - low + 1 - turns if turns else 0)
            repair, before, low, high, turns = Repair(), None, None, None, 0
            continue
        present, repeated, turn, role, text = row
        if not present:
            continue
        if turn is not None and turn != high:
            low, high, turns = turn if low is None else low, turn, turns + 1
        same = before == (turn, role, text)  # rows of one turn are sorted, so equal ones are neighbours
        before = (turn, role, text)
        yield conv, repair.add(turn, role, text, repeated or same), None


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    for row in rows:
        waiting.append(row)
        if len(waiting) == _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting, strict=True), schema, strict=True)], schema=schema)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting, strict=True), schema, strict=True)], schema=schema)


_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURNS = "step long, edit string, turn long, role string, text string"


def _schema(conv: pa.DataType, tail: str) -> pa.Schema:
    types = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([("conv_id", conv), *((n, types[t]) for n, t in (x.split() for x in tail.split(", ")))])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind: list[pa.DataType] = []

    def seen() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind[:] = [batch.schema.field(0).type]
            yield batch

    def rows() -> Iterator[tuple]:
        audit, digest, some = [], hashlib.sha256(), False
        for conv, edits, done in _edits(seen()):
            for letter, _, role, text in edits:
                audit.append(letter)
                if letter != DELETE:
                    digest.update(f"{chr(10) * some}{role}:{text}".encode("utf-8", "surrogatepass"))
                    some = True
            if done:
                r, gaps = done
                yield conv, gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, "".join(audit), digest.hexdigest()
                audit, digest, some = [], hashlib.sha256(), False

    yield from _late(rows(), kind, _SUMMARY)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind: list[pa.DataType] = []

    def seen() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind[:] = [batch.schema.field(0).type]
            yield batch

    def rows() -> Iterator[tuple]:
        step = 0
        for conv, edits, done in _edits(seen()):
            for letter, turn, role, text in edits:
                yield conv, step, letter, turn, role, text
                step += 1
            if done:
                step = 0

    yield from _late(rows(), kind, _TURNS)


def _late(rows: Iterator[tuple], kind: list[pa.DataType], tail: str) -> Iterator[pa.RecordBatch]:
    """Batches of rows whose first column has the type that the input turns out to have."""
    first = next(rows, None)
    if first is not None:

        def all_rows() -> Iterator[tuple]:
            yield first
            yield from rows

        yield from _batches(all_rows(), _schema(kind[0], tail))


def _of(conversations: DataFrame, present: Column | None, run, tail: str) -> DataFrame:
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return _sorted_rows(conversations, F.lit(True) if present is None else present).mapInArrow(run, f"conv_id {kind}, {tail}")


def repair(conversations: DataFrame, present: Column | None = None) -> DataFrame:
    """One row for each conv_id: gaps in the turns, counts of faults, cost, audit and SHA-256 of the repaired rows.

    A row where ``present`` is false only names its conversation. Each row's first
    fault counts: blank, duplicate, truncated.
    """
    return _of(conversations, present, _summaries, _SUMMARY)


def repaired_turns(conversations: DataFrame, present: Column | None = None) -> DataFrame:
    """(conv_id, step, edit, turn, role, text): every edit with the row it leaves, or deletes (D)."""
    return _of(conversations, present, _turns, _TURNS)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with seeded damage, and ``present``: false for rows that are dropped.

    By CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2
    takes its ``.!?``, 3 repeats it, 4 makes its role user. Nulls are one space.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("present"), F.explode(copies).alias("copy"),
    )
