"""Repair of a conversation's structure by the cheapest edits, with an audit of them.

A sound conversation is empty, or an optional system turn followed by pairs of a user's and an
assistant's turn. A dynamic program walks over the turns; its four states are what the repaired
conversation ends with so far. Each state keeps its cheapest edits and, of several, those whose
initials come first in ASCII order.

The edits so far are not strings but linked nodes: a node is its parent plus what was done about
one more turn (inserts before it, and its own edit), so states share their common past. Equal
pasts are one node, found by a rolling hash and verified by parent and label. Every node knows its
ancestors 1, 2, 4, ... turns back, so two pasts of equal cost are compared by a search for the
last ancestor they share; what follows it decides. Inserts belong to the turn after them, so no
past is the beginning of another one over the same turns.

A conversation may hold a third of all turns. It is cut into segments, each of which answers for
all pairs of states at its ends; the same program then walks over segments instead of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.llm.groups import whole_units
from civicloom.llm.turns import in_order, mark_of
from civicloom.session import pin

SEGMENT = 2048

# The costs of the edits, and what a truncated turn adds unless it is deleted.
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1

# What the repaired conversation ends with.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_INITIALS = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}
_OTHER = 0
_AFTER_INSERT = (_USER, _USER, _ASSISTANT, _USER)
# Inserts that make a whole conversation of it: their cost and initials.
_ENDINGS = {_NOTHING: (0, b""), _SYSTEM: (2 * INSERT, b"II"), _USER: (INSERT, b"I"), _ASSISTANT: (0, b"")}
_LEGAL = {(_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER)}

_BASE, _MODULUS = 1_000_003, (1 << 61) - 1

Step = list[list[tuple[int, int, bytes]]]
State = tuple[int, int]


class Trails:
    """Edits so far as nodes; node 0 is the beginning. Nodes of one depth cover the same turns."""

    def __init__(self):
        self.parent, self.label, self.hash, self.ancestors = [0], [b""], [0], [()]
        self.known: dict[int, list[int]] = {}

    def extend(self, node: int, label: bytes) -> int:
        rolled = (self.hash[node] * _BASE + int.from_bytes(label, "big") + len(label)) % _MODULUS
        same = self.known.setdefault(rolled, [])
        for other in same:
            if self.parent[other] == node and self.label[other] == label:
                return other
        new = len(self.parent)
        same.append(new)
        chain, k = [node], 0
        while k < len(self.ancestors[chain[k]]):
            chain.append(self.ancestors[chain[k]][k])
            k += 1
        self.parent.append(node)
        self.label.append(label)
        self.hash.append(rolled)
        self.ancestors.append(chain)
        return new

    def before(self, a: int, b: int) -> bool:
        """Whether ``a``, another node of the depth of ``b``, comes first."""
        k = len(self.ancestors[a])
        while k:
            k -= 1
            if k < len(self.ancestors[a]) and self.ancestors[a][k] != self.ancestors[b][k]:
                a, b = self.ancestors[a][k], self.ancestors[b][k]
        return self.label[a] < self.label[b]

    def text(self, node: int) -> bytes:
        labels = []
        while node:
            labels.append(self.label[node])
            node = self.parent[node]
        return b"".join(reversed(labels))


def steps_of(initial: int, must_go: bool, truncated: bool) -> Step:
    """For each state after a turn, from which states it is reached: ``(state, cost, initials)``,
    the cheapest way from each, the first in ASCII order of several."""
    best: dict[tuple[int, int], tuple[int, bytes]] = {}
    extra = CUT_SHORT if truncated else 0
    for begin in range(4):
        state, cost, done = begin, 0, b""
        for _ in range(3):  # after two inserts a state comes back
            ways = [(state, DELETE, b"D")]
            if not must_go:
                due = _ASSISTANT if state == _USER else _USER
                ways.append((due, REROLE + extra, b"R"))
                if initial == due or (initial == _SYSTEM and state == _NOTHING):
                    ways.append((initial, extra, b"K"))
            for end, price, edit in ways:
                way = (cost + price, done + edit)
                best[begin, end] = min(best.get((begin, end), way), way)
            state, cost, done = _AFTER_INSERT[state], cost + INSERT, done + b"I"
    return [[(begin, *best[begin, end]) for begin in range(4) if (begin, end) in best] for end in range(4)]


# By 4 x initial + 2 x must go + truncated.
STEPS = [steps_of(kind >> 2, bool(kind & 2), bool(kind & 1)) for kind in range(16)]


def advance(trails: Trails, states: list[State | None], step: Step) -> list[State | None]:
    """The states after one more turn or segment: ``(cost, node)`` or None."""
    after: list[State | None] = []
    for ways in step:
        best = None
        for begin, price, label in ways:
            if states[begin] is None:
                continue
            cost, node = states[begin][0] + price, states[begin][1]
            if best is not None:
                if cost > best[0]:
                    continue
                if cost == best[0]:
                    first = label < best[2] if node == best[1] else trails.before(node, best[1])
                    if not first:
                        continue
            best = (cost, node, label)
        after.append(None if best is None else (best[0], trails.extend(best[1], best[2])))
    return after


def segment_paths(kinds: list[int], whole_start: bool) -> list[tuple[int, int, int, bytes]]:
    """``(first state, last state, cost, initials)`` of the best edits of a segment for all pairs
    of states at its ends; at the start of a conversation there is only one first state."""
    trails, found = Trails(), []
    for begin in [_NOTHING] if whole_start else range(4):
        states: list[State | None] = [None] * 4
        states[begin] = (0, 0)
        for kind in kinds:
            states = advance(trails, states, STEPS[kind])
        found.extend((begin, end, state[0], trails.text(state[1]))
                     for end, state in enumerate(states) if state is not None)
    return found


class Walk:
    """The best edits of a conversation, segment after segment."""

    def __init__(self):
        self.trails = Trails()
        self.states: list[State | None] = [(0, 0), None, None, None]

    def add(self, paths: list[tuple[int, int, int, bytes]]) -> None:
        step: Step = [[], [], [], []]
        for begin, end, cost, initials in paths:
            step[end].append((begin, cost, initials))
        self.states = advance(self.trails, self.states, step)

    def result(self) -> tuple[int, bytes]:
        best = None
        for state, (price, tail) in _ENDINGS.items():
            if self.states[state] is None:
                continue
            cost, node = self.states[state][0] + price, self.states[state][1]
            if best is None or cost < best[0] or (cost == best[0] and self.trails.before(node, best[1])):
                best = (cost, node, tail)
        return best[0], self.trails.text(best[1]) + best[2]


_PATHS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SEGMENTS = pa.schema([
    ("start", pa.int64()), ("segment", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
    ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("illegal", pa.int64()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("paths", _PATHS)])
_SEGMENTS_DDL = (
    "start long, segment long, first int, last int, low long, high long, turns long, illegal long, blank long, "
    "duplicate long, truncated long, paths array<struct<begin: int, end: int, cost: long, audit: string>>")
_FAULTS = {"blank": 1, "duplicate": 2, "truncated": 3}


def _illegal(pairs) -> int:
    return sum(pair not in _LEGAL for pair in pairs)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, bounds in whole_units(batches, ["start", "segment"], 2 * SEGMENT):
        start, segment = table["start"].to_numpy(), table["segment"].to_numpy()
        initials, faults = table["initial"].to_numpy(), table["fault"].to_numpy()
        there = np.asarray(table["turn"].is_valid())
        turns = table["turn"].fill_null(0).to_numpy()
        rows = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            initial, fault = initials[a:b], faults[a:b]
            kinds = initial * 4 + np.isin(fault, (1, 2)) * 2 + (fault == _FAULTS["truncated"])
            seen = np.unique(turns[a:b][there[a:b]])
            rows.append({
                "start": int(start[a]), "segment": int(segment[a]),
                "first": int(initial[0]), "last": int(initial[-1]),
                "low": int(seen[0]) if len(seen) else None, "high": int(seen[-1]) if len(seen) else None,
                "turns": len(seen), "illegal": _illegal(zip(initial[:-1].tolist(), initial[1:].tolist())),
                **{name: int((fault == code).sum()) for name, code in _FAULTS.items()},
                "paths": [dict(zip(("begin", "end", "cost", "audit"), (*path[:3], path[3].decode())))
                          for path in segment_paths(kinds.tolist(), segment[a] == 0)],
            })
        yield from pa.Table.from_pylist(rows, _SEGMENTS).to_batches()


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_AUDITS = pa.schema([("start", pa.int64()), ("gaps", pa.int64()), *((name, pa.int64()) for name in _COUNTS),
                     ("cost", pa.int64()), ("audit", pa.string())])
_AUDITS_DDL = "start long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its segments in order. Only the edits so far are kept."""

    def ended() -> dict:
        cost, audit = walk.result()
        low, high = facts["low"], facts["high"]
        gaps = 0 if low is None else high - low + 1 - facts["turns"]
        return {"start": facts["start"], "gaps": gaps, **{name: facts[name] for name in _COUNTS},
                "cost": cost, "audit": audit.decode()}

    facts, walk = None, None
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if facts is not None and row["start"] == facts["start"]:
                for name in _COUNTS:
                    facts[name] += row[name]
                facts["illegal"] += _illegal([(facts["last"], row["first"])])
                # Turns ascend, so only the one at the border can be in both.
                facts["turns"] += row["turns"] - (row["low"] is not None and row["low"] == facts["high"])
                facts["low"] = row["low"] if facts["low"] is None else facts["low"]
                facts["high"] = facts["high"] if row["high"] is None else row["high"]
                facts["last"] = row["last"]
            else:
                if facts is not None:
                    rows.append(ended())
                facts, walk = row, Walk()
            walk.add([tuple((p["begin"], p["end"], p["cost"], p["audit"].encode())) for p in row["paths"]])
        if rows:
            yield from pa.Table.from_pylist(rows, _AUDITS).to_batches()
    if facts is not None:
        yield from pa.Table.from_pylist([ended()], _AUDITS).to_batches()


def faults_of(text: Column) -> tuple[Column, Column]:
    """Whether a text is blank, and whether its last visible character ends no sentence."""
    return ~text.rlike(r"[^\x20\x09-\x0D]"), ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def audit(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """One row per conversation: ``conv_col``, ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost`` and ``audit``.

    Turns go by ``turn_col``, null first; equal ones by the SHA-256 of role and text. A null role
    or text is one space; rows without a conversation id are a conversation. A turn's first fault
    counts: blank, duplicate (role and text stood earlier in the conversation), truncated. ``gaps``
    are turn numbers missing between the least and the greatest. ``illegal`` counts neighbours
    whose roles' initials are not su, ua or au. ``audit`` has the initial of every edit: Keep,
    Rerole, Delete, Insert. An empty role has no initial that could stay. Other columns are not
    looked at. A row of the result holds a character per turn; besides that, a task holds
    ``segment`` turns.
    """
    role, text = F.coalesce(role_col, F.lit(" ")), F.coalesce(text_col, F.lit(" "))
    blank, truncated = faults_of(text)
    initial = F.lit(_OTHER)
    for letter, code in _INITIALS.items():
        initial = F.when(F.substring(role, 1, 1) == letter, code).otherwise(initial)
    turns = conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), mark_of(role, text).alias("mark"),
        initial.cast("int").alias("initial"), blank.alias("blank"), truncated.alias("truncated"))
    numbered, starts = in_order(turns, "conv", "turn", "mark")
    starts = pin(starts, "conversation-starts")
    again = numbered.groupBy("conv", "mark").agg(F.min("number").alias("first"), F.count("*").alias("times"))
    again = pin(again.where("times > 1").select(F.col("conv").alias("conv_again"), F.col("mark").alias("mark_again"), "first"),
                "turns-again")
    fault = (
        F.when(F.col("blank"), _FAULTS["blank"]).when(F.col("number") > F.col("first"), _FAULTS["duplicate"])
        .when(F.col("truncated"), _FAULTS["truncated"]).otherwise(0)
    )
    begun = starts.select(F.col("conv").alias("conv_begun"), "start")
    judged = (
        numbered
        .join(again, F.col("conv").eqNullSafe(F.col("conv_again")) & (F.col("mark") == F.col("mark_again")), "left")
        .join(begun, F.col("conv").eqNullSafe(F.col("conv_begun")))
        .select("start", F.expr(f"(number - start) div {int(segment)}").alias("segment"), "number", "turn", "initial",
                fault.cast("int").alias("fault"))
    )
    cut = judged.repartition("start", "segment").sortWithinPartitions("start", "segment", "number")
    segments = cut.mapInArrow(_segments, _SEGMENTS_DDL)
    walked = segments.repartition("start").sortWithinPartitions("start", "segment").mapInArrow(_audits, _AUDITS_DDL)
    return starts.join(walked, "start").select(
        F.col("conv").alias(conv_col), "gaps", *_COUNTS, "cost", "audit")


_ROLES = {_USER: "user", _ASSISTANT: "assistant"}


class _Repaired:
    """The lines of a repaired conversation, one turn at a time."""

    def __init__(self, audit_text: str):
        self.audit, self.place, self.state = audit_text, 0, _NOTHING

    def _due(self) -> str:
        self.state = _AFTER_INSERT[self.state]
        return _ROLES[self.state]

    def inserted(self) -> list[tuple[str, str]]:
        lines = []
        while self.audit[self.place:self.place + 1] == "I":
            self.place += 1
            lines.append((self._due(), ""))
        return lines

    def turn(self, role: str, text: str) -> list[tuple[str, str]]:
        lines = self.inserted()
        edit = self.audit[self.place]
        self.place += 1
        if edit == "R":
            lines.append((self._due(), text))
        elif edit == "K":
            self.state = _INITIALS[role[0]]
            lines.append((role, text))
        return lines


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, repaired, digest, empty = None, None, None, True

    def feed(lines) -> None:
        nonlocal empty
        for role, text in lines:
            digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
            empty = False

    kind = None
    for batch in batches:
        kind, done = batch.schema.field("conv").type, []
        for row in batch.to_pylist():
            if row["audit"] is not None:
                if repaired is not None:
                    feed(repaired.inserted())
                    done.append((conv, digest.hexdigest()))
                conv, repaired, digest, empty = row["conv"], _Repaired(row["audit"]), hashlib.sha256(), True
            else:
                feed(repaired.turn(row["role"], row["text"]))
        if done:
            yield pa.record_batch([pa.array([c for c, _ in done], kind), pa.array([d for _, d in done])],
                                  names=["conv", "repaired_sha256"])
    if repaired is not None:
        feed(repaired.inserted())
        yield pa.record_batch([pa.array([conv], kind), pa.array([digest.hexdigest()])],
                              names=["conv", "repaired_sha256"])


def digest_repaired(conversations: DataFrame, audits: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``audits`` with ``repaired_sha256``: the digest of the repaired turns as ``role:text``,
    joined by line feeds.

    A digest is sequential, so a conversation's turns pass through one task; the task keeps the
    audit and one batch of turns.
    """
    role, text = F.coalesce(role_col, F.lit(" ")), F.coalesce(text_col, F.lit(" "))
    none = F.lit(None)
    rows = conversations.select(
        F.col(conv_col).alias("conv"), F.lit(1).alias("kind"), F.col(turn_col).cast("long").alias("turn"),
        mark_of(role, text).alias("mark"), role.alias("role"), text.alias("text"), none.cast("string").alias("audit"))
    heads = audits.select(
        F.col(conv_col).alias("conv"), F.lit(0).alias("kind"), none.cast("long").alias("turn"),
        none.cast("binary").alias("mark"), none.cast("string").alias("role"), none.cast("string").alias("text"), "audit")
    dealt = rows.union(heads).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "mark")
    kind = audits.schema[conv_col].dataType.simpleString()
    found = dealt.select("conv", "role", "text", "audit").mapInArrow(_digests, f"conv {kind}, repaired_sha256 string")
    return audits.join(found, F.col(conv_col).eqNullSafe(F.col("conv"))).drop("conv")


def repair(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Audits of all conversations (see ``audit``) with the digests of the repaired ones."""
    names = {"conv_col": conv_col, "turn_col": turn_col, "role_col": role_col, "text_col": text_col}
    audits = pin(audit(conversations, **names), "audits")
    return digest_repaired(conversations, audits, **names)
