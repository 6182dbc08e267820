"""Conversation structure repair by depth-first branch-and-bound.

A conversation is repaired when the initials of its roles read ``(s?(ua)+)?``.  Every row is
kept, reroled or deleted and empty rows may be inserted; the cheapest edit sequence is searched
with an explicit stack.  A node is a prefix of rows and the state of the pattern.  Suffix lower
bounds (from a pattern relaxed to let a system row stand alone) cut nodes that cannot beat the
incumbent (cost, audit), and a dominance table keeps one best prefix per (row, state).  The
search ends when the stack is empty: then the incumbent is proved cheapest, and least of its cost.

Rows are sorted by conversation and turn and streamed twice: once to judge the rows and search,
holding a few bytes a row, and once to spell the repaired conversation out with the audit in
hand.  No conversation's texts are held together, so memory follows the number of rows of the
longest conversation, not its texts.

Nulls in role and text count as one space, in conversation and turn too where the key of the damage is
built; a null turn sorts first, and rows without conversation are one conversation.  Rows of one turn are
ordered by role and text.  Empty and blank texts are the fault ``blank``; very long texts are streamed.  Repeated
rows are duplicates.  Other columns are ignored, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import staged

DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: states of the pattern: nothing yet, after the system row, after a user row, after an assistant row
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_ADD = (USER, USER, ASSISTANT, USER)                    # state after a user/assistant row that fits
_KEEP = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
_END = (("", 0), ("II", 2 * INSERT), ("I", INSERT), ("", 0))
_NEED = (2, 0, 1, 0)                                    # relaxed state: 0 user next, 1 assistant next, 2 nothing yet
_WORD = re.compile(r"[^\x20\x09-\x0D]")
_LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")


def suffix_bounds(codes: list[tuple[str, str]]) -> list[tuple[int, int, int]]:
    """For every suffix of rows, a cost that no repair of it undercuts, by relaxed state.

    The relaxed pattern lets a system row stand alone."""
    low = [(0, INSERT, 0)] * (len(codes) + 1)
    for i in range(len(codes) - 1, -1, -1):
        initial, fault = codes[i]
        user, assistant, start = low[i + 1]
        base = [user + DELETE, assistant + DELETE, start + DELETE]
        if fault not in ("blank", "duplicate"):
            more = TRUNCATED if fault else 0
            base[0] = min(base[0], assistant + more + (0 if initial == "u" else REROLE))
            base[1] = min(base[1], user + more + (0 if initial == "a" else REROLE))
            base[2] = min(base[2], assistant + more + (0 if initial == "u" else REROLE), user + more if initial == "s" else base[2])
        low[i] = (min(base[0], base[1] + INSERT), min(base[1], base[0] + INSERT), min(base[2], base[1] + INSERT))
    return low


class _Audits:
    """Audits as linked chunks: inserts before a row and its edit.  Equal prefixes are shared."""

    def __init__(self):
        self.parent, self.chunk = [-1], [""]

    def add(self, parent: int, chunk: str) -> int:
        self.parent.append(parent)
        self.chunk.append(chunk)
        return len(self.parent) - 1

    def less(self, x: int, y: int) -> bool:
        """Whether audit x is smaller; both must cover the same rows.  Chunks end in an edit of a
        row, so none is a prefix of another and the first chunk that differs decides."""
        out = False
        while x != y:
            a, b = self.chunk[x], self.chunk[y]
            if a != b:
                out = a < b
            x, y = self.parent[x], self.parent[y]
        return out

    def text(self, x: int) -> str:
        out = []
        while x > 0:
            out.append(self.chunk[x])
            x = self.parent[x]
        return "".join(reversed(out))


def _children(state: int, initial: str, fault: str):
    """(chunk, next state, cost) of every edit of a row, with at most one row inserted before it.

    Two inserts before a row lead back to a state that is no better than the first."""
    for before, at, paid in (("", state, 0), ("I", _ADD[state], INSERT)):
        yield before + "D", at, paid + DELETE
        if fault in ("blank", "duplicate"):
            continue
        more = paid + (TRUNCATED if fault else 0)
        kept = _KEEP.get(initial, (None,) * 4)[at]
        if kept is not None:
            yield before + "K", kept, more
        yield before + "R", _ADD[at], more + REROLE


def cheapest_repair(codes: list[tuple[str, str]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of rows given as (role initial, fault)."""
    low, audits = suffix_bounds(codes), _Audits()
    best = {(0, EMPTY): (0, 0)}                          # dominance: (row, state) -> (cost, audit)
    incumbent, known = None, 0
    stack = [(0, EMPTY, 0, 0)]
    while stack:
        i, state, cost, node = stack.pop()
        if best[i, state][1] != node or (incumbent is not None and cost + low[i][_NEED[state]] > incumbent):
            continue
        if i == len(codes):
            chunk, more = _END[state]
            leaf = audits.add(node, chunk)
            if incumbent is None or cost + more < incumbent or (cost + more == incumbent and audits.less(leaf, known)):
                incumbent, known = cost + more, leaf
            continue
        found = []
        for chunk, then, paid in _children(state, *codes[i]):
            total = cost + paid
            bound = total + low[i + 1][_NEED[then]]
            if incumbent is not None and bound > incumbent:
                continue
            rival = best.get((i + 1, then))
            if rival is not None and rival[0] < total:
                continue
            child = audits.add(node, chunk)
            if rival is not None and rival[0] == total and not audits.less(child, rival[1]):
                continue
            best[i + 1, then] = (total, child)
            found.append((bound, chunk, (i + 1, then, total, child)))
        found.sort(key=lambda x: x[:2], reverse=True)     # the most promising child is popped first
        stack.extend(x[2] for x in found)
    return incumbent, audits.text(known)


def spell(audit: str):
    """A function that takes (role, text) row by row and gives the rows of the repair up to it; None ends it."""
    at, state = 0, EMPTY

    def added() -> str:
        nonlocal state
        state = _ADD[state]
        return "user" if state == USER else "assistant"

    def take(role: str | None, text: str | None = None):
        nonlocal at, state
        out = []
        while at < len(audit) and audit[at] == "I":
            out.append((added(), ""))
            at += 1
        if role is not None:
            edit, at = audit[at], at + 1
            if edit == "K":
                state = _KEEP[role[:1]][state]
                out.append((role, text))
            elif edit == "R":
                out.append((added(), text))
        return out

    return take


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone): rows damaged by the checksum of ``conv:turn``; a dropped row
    stays as a marker with ``gone`` set, so its conversation is not forgotten."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(said(conv), F.lit(":"), said(turn)).cast("binary")) % 20
    rows = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), said(role).alias("role"), said(text).alias("text"), hit.alias("hit"))
    rows = rows.select(
        "conv", "turn", F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit").isin(0, 1), F.lit("")).when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("hit") == 0).alias("gone"), F.when(F.col("hit") == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("conv", "turn", "role", "text", "gone")


_JUDGED = ("conv bigint, kind int, pos bigint, role string, text string, gaps bigint, blank bigint, duplicate bigint, "
           "truncated bigint, illegal bigint, cost bigint, audit string")
_REPAIRED = ("conv bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
             "audit string, repaired_sha256 string")


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in schema.split(", "))])


class _Conversation:
    """What is held of one conversation while its rows pass by."""

    def __init__(self):
        self.codes, self.seen, self.faults = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        self.first = self.last = self.before = None
        self.turns = self.illegal = 0

    def take(self, turn, role: str, text: str) -> None:
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        end = _LAST.search(text)
        fault = "" if end and end[1] in ".!?" else "truncated"
        if not _WORD.search(text):
            fault = "blank"
        elif mark in self.seen:
            fault = "duplicate"
        self.seen.add(mark)
        if fault:
            self.faults[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        self.codes.append((role[:1], fault))

    def verdict(self) -> dict:
        cost, audit = cheapest_repair(self.codes)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return {"gaps": gaps, **self.faults, "illegal": self.illegal, "cost": cost, "audit": audit}


def _judge(batches):
    """Rows sorted by conversation and turn: the rows (kind 1), and after them their verdict (kind 0)."""
    schema, held, conv = _arrow(_JUDGED), None, None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if held is None or row["conv"] != conv:
                if held is not None:
                    out.append({"conv": conv, "kind": 0, **held.verdict()})
                held, conv = _Conversation(), row["conv"]
            if not row["gone"]:
                out.append({"conv": conv, "kind": 1, "pos": len(held.codes), "role": row["role"], "text": row["text"]})
                held.take(row["turn"], row["role"], row["text"])
        yield pa.RecordBatch.from_pylist(out, schema)
    if held is not None:
        yield pa.RecordBatch.from_pylist([{"conv": conv, "kind": 0, **held.verdict()}], schema)


def _spelt(batches):
    """A verdict, then its rows in order: the verdict with the digest of the repaired conversation."""
    schema, held = _arrow(_REPAIRED), None

    def put(rows):
        nonlocal first
        for role, text in rows:
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False

    def done():
        put(take(None))
        return {**{n: held[n] for n in schema.names[:-1]}, "repaired_sha256": digest.hexdigest()}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["kind"] == 0:
                if held is not None:
                    out.append(done())
                held, take, digest, first = row, spell(row["audit"]), hashlib.sha256(), True
            else:
                put(take(row["role"], row["text"]))
        yield pa.RecordBatch.from_pylist(out, schema)
    if held is not None:
        yield pa.RecordBatch.from_pylist([done()], schema)


def repair(rows: DataFrame) -> DataFrame:
    """One row a conversation of (conv, turn, role, text, gone): its faults, the cheapest repair and its digest."""
    order = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    judged = staged(order.mapInArrow(_judge, _JUDGED), "judged")
    return judged.repartition("conv").sortWithinPartitions("conv", "kind", "pos").mapInArrow(_spelt, _REPAIRED)
