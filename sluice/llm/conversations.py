"""Operator 12: repair the structure of conversations with the cheapest edits.

A repaired conversation is empty, or an optional system turn and then pairs of
user and assistant turns.  Edits: Keep a row (free), Rerole it to user or
assistant (3), Delete it (4), Insert an empty user or assistant turn (3).  Blank
and repeated rows must be deleted; a truncated row that stays costs 3 more.  Of
the cheapest edit lists the one whose initials come first in ASCII order is taken.

Method: secondary-sorted streaming.  Rows are dealt out by conversation once and
sorted inside the partitions; ``mapInPandas`` carries the state of the dynamic
program from one Arrow batch to the next.  What may follow depends only on the
last role, so the state is the cost still to come for each of four places in the
pattern.  Rows pass from the last turn to the first, and each gets a back pointer
of one byte: the best edit, two bits, for each place.  The rows with their bytes
then go through Spark's sorter, which spills, and pass once more from the first
turn to the last, where the pointers say what to do.  Neither pass holds more
than one Arrow batch and a few numbers, whatever the length of a conversation.

Equal rows of a conversation are found by a window inside the same partitions.

Defined cases: a null role or text counts as one space, a null turn comes first,
a null conversation id is a conversation like any other; rows of equal turn are
taken by role and text; an empty role, and any but system, user and assistant by
their initials, cannot be kept; repeated rows are duplicates; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import importable

RENAME, DROP, ADD, CUT = 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"

#: Places in the pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
#: Where a user or assistant turn put in at a place leads; which of the two it is follows from that.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Cost of completing the pattern after the last row, at each place.
_DONE = (0, 2 * ADD, ADD, 0)
_EDITS = "DIKR"          # ASCII order, which settles ties
_LEGAL = {"su", "ua", "au"}


@cache
def step(after: tuple[int, ...], kind: str) -> tuple[tuple[int, ...], int, int]:
    """Costs to come before a row, given those after it: (relative costs, what to add, back pointers).

    ``kind`` is the role's initial and ``!`` for a row that must go, ``~`` for a
    truncated one.  Costs are kept relative to their least, so that few differ.
    """
    initial, mark = kind[:-1], kind[-1]
    extra = CUT if mark == "~" else 0
    ways = []
    for place in range(4):
        way = {"D": DROP + after[place]}
        if mark != "!":
            way["R"] = RENAME + extra + after[_NEXT[place]]
            if (initial, place) in _AFTER:
                way["K"] = extra + after[_AFTER[initial, place]]
        ways.append(way)
    least = [min(w.values()) for w in ways]
    before = [0] * 4
    before[USER] = min(least[USER], ADD + least[ASSISTANT])
    before[ASSISTANT] = min(least[ASSISTANT], ADD + least[USER])
    for place in (START, SYSTEM):
        before[place] = min(least[place], ADD + before[USER])
    pointers = 0
    for place, way in enumerate(ways):
        way["I"] = ADD + before[_NEXT[place]]
        best = next(e for e in _EDITS if way.get(e) == before[place])
        pointers |= _EDITS.index(best) << 2 * place
    base = min(before)
    return tuple(c - base for c in before), base, pointers


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fault``: blank, duplicate (role and text were there before), truncated or null."""
    seen = Window.partitionBy("conv", "present", "role", "text").orderBy(F.asc_nulls_first("turn"))
    trimmed = F.rtrim("text", F.lit(SPACE))
    return rows.withColumn("copy", F.row_number().over(seen)).withColumn(
        "fault", F.when(trimmed == "", "blank").when(F.col("copy") > 1, "duplicate")
        .when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated"))


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: Column | None = None) -> DataFrame:
    """Every conversation's edits in order: ``conv, turn, role, text, edit, cost, initial, fault`` (all but ``cost`` text).

    A row comes out for each row that goes in and for each turn put in; ``role``
    is the one after the edit, ``initial`` the one before it (null for a turn put
    in).  Rows of a conversation follow one another inside one partition.  Where
    ``present`` is false a row only makes its conversation known, by one row
    without an edit.
    """
    importable(conversations.sparkSession)
    space = F.lit(" ")
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), space).alias("role"),
                                F.coalesce(F.col(text), space).alias("text"),
                                F.coalesce(F.lit(True) if present is None else present, F.lit(True)).alias("present"))
    kind = F.when(~F.col("present"), "").otherwise(F.concat(
        F.left("role", F.lit(1)), F.when(F.col("fault").isin("blank", "duplicate"), "!").when(F.col("fault") == "truncated", "~")
        .otherwise(".")))
    last_first = ["conv", F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"), F.desc("copy")]
    told = (faults(rows.repartition("conv")).sortWithinPartitions(*last_first)
            .select(F.col("conv").cast("string"), F.col("turn").cast("string"), "role", "text", "fault", kind.alias("kind")))

    def backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The carried state: conversation, rows seen, relative costs to come.
        now, n, costs = (), 0, _DONE
        for batch in batches:
            places, pointers = [], []
            for c, k in zip(batch["conv"], batch["kind"]):
                if c != now:
                    now, n, costs = c, 0, _DONE
                n += 1
                pointer = 0
                if k:
                    costs, _, pointer = step(costs, k)
                places.append(n)
                pointers.append(pointer)
            yield batch.assign(back=places, pointers=pointers)

    def forward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, place, ghost = (), START, False
        out: list[tuple] = []

        def close() -> None:
            nonlocal place
            while place in (SYSTEM, USER):
                place = _NEXT[place]
                out.append((now, None, _ROLE[place], "", "I", ADD, None, None))
            if ghost:
                out.append((now, None, None, None, None, 0, None, None))

        for batch in batches:
            columns = [batch[c] for c in ("conv", "turn", "role", "text", "fault", "kind", "pointers")]
            for c, t, r, x, fault, k, pointers in zip(*columns):
                if c != now:
                    close()
                    now, place, ghost = c, START, True
                if not k:
                    continue
                ghost = False
                while (edit := _EDITS[pointers >> 2 * place & 3]) == "I":
                    place = _NEXT[place]
                    out.append((c, None, _ROLE[place], "", "I", ADD, None, None))
                cost = CUT if fault == "truncated" and edit != "D" else 0
                if edit == "D":
                    cost, to = DROP, r
                elif edit == "R":
                    place = _NEXT[place]
                    cost, to = cost + RENAME, _ROLE[place]
                else:
                    place, to = _AFTER[k[:-1], place], r
                out.append((c, t, to, x, edit, cost, k[:-1], fault))
            yield pd.DataFrame(out, columns=_REPAIRED)
            out = []
        close()
        yield pd.DataFrame(out, columns=_REPAIRED)

    return (told.mapInPandas(backward, "conv string, turn string, role string, text string, fault string, kind string, "
                                       "back long, pointers int")
            .sortWithinPartitions("conv", F.desc("back"))
            .mapInPandas(forward, "conv string, turn string, role string, text string, edit string, cost int, "
                                  "initial string, fault string"))


_REPAIRED = ["conv", "turn", "role", "text", "edit", "cost", "initial", "fault"]
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Report:
    """What is told of one conversation, row by row."""

    def __init__(self, conv):
        self.conv, self.n = conv, dict.fromkeys(_COUNTS, 0)
        self.first = self.turn = self.initial = None
        self.distinct, self.audit, self.hash, self.empty = 0, bytearray(), hashlib.sha256(), True

    def add(self, turn, role, text, edit, cost, initial, fault) -> None:
        if edit is None:
            return
        self.audit += edit.encode()
        self.n["cost"] += cost
        if edit != "D":
            self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False
        if edit == "I":
            return
        if fault is not None:
            self.n[fault] += 1
        if self.initial is not None and self.initial + initial not in _LEGAL:
            self.n["illegal"] += 1
        self.initial = initial
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn = turn
            self.distinct += 1

    def row(self) -> tuple:
        if self.distinct:
            self.n["gaps"] = int(self.turn) - int(self.first) + 1 - self.distinct
        return self.conv, *self.n.values(), self.audit.decode(), self.hash.hexdigest()


def report(repaired: DataFrame, conv: str = "conv_id", conv_type: str = "long") -> DataFrame:
    """One row per conversation of :func:`repair`, in the same partitions.

    ``gaps`` (turn numbers missing), ``blank``, ``duplicate``, ``truncated``
    (rows by fault), ``illegal`` (neighbours that may not follow each other),
    ``cost``, ``audit`` (initials of the edits) and ``repaired_sha256`` (digest of
    the repaired ``role:text`` lines).
    """
    columns = ["conv", *_COUNTS, "audit", "repaired_sha256"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, done = None, []
        for batch in batches:
            for c, *rest in zip(*[batch[name] for name in _REPAIRED]):
                if now is None or c != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Report(c)
                now.add(*rest)
            yield pd.DataFrame(done, columns=columns)
            done = []
        if now is not None:
            yield pd.DataFrame([now.row()], columns=columns)

    schema = "conv string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    return (repaired.mapInPandas(run, schema)
            .select(F.col("conv").cast(conv_type).alias(conv), *columns[1:]))


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with planted faults, by ``crc32(conv:turn) % 20``; ``kept`` is false for a row that is dropped.

    0 drops a row, 1 empties its text, 2 removes ``[.!?]`` from it, 3 repeats the
    row, 4 makes its role user.  Nulls count as one space.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    return (conversations.select(conv, turn, F.coalesce(F.col(role), space).alias(role), F.coalesce(F.col(text), space).alias(text),
                                 (F.crc32(key.cast("binary")) % 20).alias("_how"))
            .select(conv, turn, F.when(F.col("_how") == 4, "user").otherwise(F.col(role)).alias(role),
                    F.when(F.col("_how").isin(0, 1), "").when(F.col("_how") == 2, F.regexp_replace(text, "[.!?]", ""))
                    .otherwise(F.col(text)).alias(text),
                    (F.col("_how") != 0).alias("kept"),
                    F.explode(F.sequence(F.lit(1), F.when(F.col("_how") == 3, 2).otherwise(1))).alias("_copy"))
            .drop("_copy"))
