"""Conversation structure repair by Knuth's lightest derivations.

The rows of a conversation are to read ``(s?(ua)+)?`` by the initials of
their roles.  Edits and their costs: Keep 0, Rerole to user or assistant 2,
Delete 3 (required for a blank or duplicate row), Insert an empty user or
assistant row anywhere 2; a truncated row that stays adds 1.

Items of the deduction system: ``emit(i, x)``, row ``i`` gives the initial
``x`` or nothing, and ``at(i, q)``, the rows before ``i`` are repaired and the
grammar is in state ``q``.  Hyperedges: every edit of a row is an axiom of
``emit(i, x)``; ``at(i, q), emit(i, x) -> at(i + 1, step(q, x))``; ``at(i, q)
-> at(i, step(q, x))`` by an insertion; ``at(n, q) -> goal`` for accepting
states.  The value of an item is (cost, audit), the audit being the edits'
initials; a hyperedge adds costs and joins audits.  That is superior (no value
falls below its parts) and monotone: of two derivations of one item with equal
cost neither audit can be a proper prefix of the other, since both spell the
same rows and each further insertion costs.  So an agenda that pops the least
value finalises every item at its first pop and ends with the goal.

On Spark: damage and the search for duplicates are DataFrame functions (the
duplicates by a window over (conversation, role, text), which deals one large
conversation out over all tasks).  Then the rows are dealt by conversation,
sorted by turn and streamed; a task holds ``BLOCK`` rows, not a conversation:
each block is solved from every state it can be entered in and the blocks are
joined in (cost, audit) order, with one running hash for each state.  What
grows with a conversation in a task is its audit, one byte a row, which is a
column of the result; the hash of the repaired text must be read in order by
whoever computes it.

Defined results: nulls in role and text count as one space, null turns come
first, a null ``conv_id`` is a conversation of its own; rows of one turn are
ordered by role and text; a role without characters fits no state and is never
kept; a conversation whose rows all went has zeros, an empty audit and the
hash of the empty string; an empty table gives no rows; columns beyond the
four are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dichot.llm.spark import ready

#: rows that are solved as one deduction
BLOCK = 128
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: grammar states: nothing yet, after s, after u, after a
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTING = (0, 3)
ROLE = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
NOT_SPACE = r"[^\x20\x09-\x0D]"

#: a row in a task: (role, text, fault)
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"


def damage(convs: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: the rows damaged by crc32 of
    ``conv_id:turn`` modulo 20.  A dropped row stays as a mark (``gone``), so
    that its conversation is not forgotten."""
    def said(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = convs.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), hit.alias("hit"))
    text = (F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    return rows.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("hit") == 0).alias("gone"),
                       F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def fault(text: str, again: bool) -> str | None:
    """The first fault of a row: blank, duplicate, truncated."""
    if not re.search(NOT_SPACE, text):
        return BLANK
    if again:
        return DUPLICATE
    return None if text.rstrip(" \t\n\v\f\r")[-1] in ".!?" else CUT


def edits(role: str, wrong: str | None) -> list[tuple[str, int, str]]:
    """``(initial given, cost, letter)`` of the edits that a row allows."""
    out = [("", DELETE, "D")]
    if wrong not in (BLANK, DUPLICATE):
        more = TRUNCATED if wrong == CUT else 0
        if role[:1] in ("s", "u", "a"):
            out.append((role[0], KEEP + more, "K"))
        out += [(x, REROLE + more, "R") for x in ROLE]
    return out


def lightest(rows: list, entry: int, goal: tuple | None = None) -> dict[int, tuple[int, str]]:
    """``{exit state: (cost, audit)}`` of the lightest derivations of ``rows``
    entered in state ``entry``: all exits, or the first one in ``goal``."""
    n = len(rows)
    agenda, done = [], {}
    emitted = [[] for _ in range(n)]            # finalised emit(i, x), as (x, cost, letter)
    reached = [[] for _ in range(n + 1)]        # finalised at(i, q), as (q, cost, audit)
    for i, (role, _, wrong) in enumerate(rows):
        for x, cost, letter in edits(role, wrong):
            heappush(agenda, (cost, letter, 0, i, x))
    heappush(agenda, (0, "", 1, 0, entry))
    exits = {}

    def step(i, q, cost, audit, x, more, letter):
        q2 = STEP.get((q, x)) if x else q
        if q2 is not None and (1, i, q2) not in done:
            heappush(agenda, (cost + more, audit + letter, 1, i, q2))

    while agenda:
        cost, audit, kind, i, what = heappop(agenda)
        if (kind, i, what) in done:
            continue
        done[kind, i, what] = True
        if kind == 0:
            emitted[i].append((what, cost, audit))
            for q, c, a in reached[i]:
                step(i + 1, q, c, a, what, cost, audit)
            continue
        reached[i].append((what, cost, audit))
        for x in ROLE:
            step(i, what, cost, audit, x, INSERT, "I")
        if i < n:
            for x, c, letter in emitted[i]:
                step(i + 1, what, cost, audit, x, c, letter)
        else:
            exits[what] = (cost, audit)
            if goal is not None and what in goal or len(exits) == 4:
                break
    return exits


def repaired(rows: list, entry: int, audit: str) -> Iterator[tuple[str, str]]:
    """``(role, text)`` of what the edits of ``audit`` leave of ``rows``."""
    at, q = iter(rows), entry
    for letter in audit:
        if letter == "I":
            given, out = "a" if q == 2 else "u", None
        else:
            role, text, _ = next(at)
            if letter == "D":
                continue
            given, out = (role[0], (role, text)) if letter == "K" else ("a" if q == 2 else "u", None)
            if out is None:
                out = (ROLE[given], text)
        yield out or (ROLE[given], "")
        q = STEP[q, given]


class Conversation:
    """One conversation as its rows stream by, held ``BLOCK`` rows at a time."""

    def __init__(self, conv_id, texts: bool):
        self.conv_id, self.texts = conv_id, texts
        self.low = self.high = self.last = None
        self.turns = self.illegal = 0
        self.counts = {BLANK: 0, DUPLICATE: 0, CUT: 0}
        self.before = None
        self.block: list = []
        # per state: cost, pieces of the audit, running hash, nothing written yet, rows
        self.front = {0: (0, "", hashlib.sha256(), True, [])}

    def add(self, turn, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.last:
            self.low, self.high, self.last = turn if self.low is None else self.low, turn, turn
            self.turns += 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        wrong = fault(text, again)
        if wrong:
            self.counts[wrong] += 1
        if len(self.block) == BLOCK:
            self._solve(None)
        self.block.append((role, text, wrong))

    def _solve(self, goal) -> None:
        best = {}
        for q, (cost, audit, *_) in self.front.items():
            for q2, (more, tail) in lightest(self.block, q, goal).items():
                value = (cost + more, audit + tail)
                if q2 not in best or value < best[q2][0]:
                    best[q2] = (value, q, tail)
        front = {}
        for q2, ((cost, audit), q, tail) in best.items():
            _, _, digest, fresh, rows = self.front[q]
            digest, rows = digest.copy(), list(rows) if self.texts else rows
            for role, text in repaired(self.block, q, tail):
                digest.update(("" if fresh else "\n").encode() + f"{role}:{text}".encode())
                fresh = False
                if self.texts:
                    rows.append({"role": role, "text": text})
            front[q2] = (cost, audit, digest, fresh, rows)
        self.front, self.block = front, []

    def result(self) -> tuple:
        self._solve(ACCEPTING)
        cost, audit, digest, _, rows = min((self.front[q] for q in ACCEPTING if q in self.front), key=lambda v: v[:2])
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.counts.values(), self.illegal, cost, audit, digest.hexdigest(), rows)


def _stream(texts: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def flush():
            columns = list(zip(*out)) if out else [[]] * 10
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for conv_id, turn, role, text, gone, again in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        out.append(now.result())
                    now = Conversation(conv_id, texts)
                if not gone:
                    now.add(turn, role, text, again)
            if len(out) >= 1024:
                yield flush()
                out.clear()
        if now is not None:
            out.append(now.result())
        yield flush()
    return run


def repair(rows: DataFrame, texts: bool = True) -> DataFrame:
    """One row for each conversation of ``rows`` (``conv_id, turn, role, text,
    gone``, as :func:`damage` gives them): its counts, the lightest repair's
    cost and audit, the hash of the repaired text and, with ``texts``, the
    repaired rows as an array (leave them out where one conversation may be
    larger than a cell can be)."""
    ready(rows)
    # the same role and text at an earlier place; marks of dropped rows are kept apart
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    gone = F.col("gone")
    rows = rows.select("conv_id", "turn", F.when(gone, "").otherwise(F.col("role")).alias("role"),
                       F.when(gone, F.coalesce(F.col("turn").cast("string"), F.lit(""))).otherwise(F.col("text")).alias("text"), "gone")
    marked = rows.withColumn("again", F.row_number().over(same) > 1)
    dealt = marked.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "again")
    kind = rows.schema["conv_id"].dataType
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = (f"conv_id {kind.simpleString()}, {', '.join(f'{c} bigint' for c in counts)}, audit string, repaired_sha256 string, "
              "repaired array<struct<role: string, text: string>>")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    out = dealt.mapInArrow(_stream(texts, to_arrow_schema(StructType.fromDDL(schema))), schema)
    return out if texts else out.drop("repaired")
