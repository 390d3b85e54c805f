"""Operator 12 against a brute-force search over all edit lists."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F

from sluice.llm import conversations as C
from sluice.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]")
ROLES = {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if how:
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            out += [(turn, "user" if how == 4 else role, text)] * (1 + (how == 3))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def told(rows):
    """Counts and faults of one conversation's rows in order."""
    seen, kinds = set(), []
    for _, role, text in rows:
        last = BLANK.findall(text)
        kinds.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal), kinds


def cheapest(rows, kinds):
    """Least (cost, audit) and its repaired turns, by search from every place with every edit."""
    @lru_cache(None)
    def best(i, state, added):
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            _, role, text = rows[i]
            extra = 3 if kinds[i] == "truncated" else 0
            cost, audit, rest = best(i + 1, state, 0)
            options.append((cost + 4, "D" + audit, rest))
            if kinds[i] not in ("blank", "duplicate"):
                ways = [("R", 3 + extra, ROLES[x], x) for x in "ua"] + ([("K", extra, role, role[0])] if role else [])
                for edit, price, to, initial in ways:
                    if follows(state, initial):
                        cost, audit, rest = best(i + 1, initial, 0)
                        options.append((cost + price, edit + audit, ((to, text), *rest)))
        if added < 3:
            for initial, role in ROLES.items():
                if follows(state, initial):
                    cost, audit, rest = best(i, initial, added + 1)
                    options.append((cost + 3, "I" + audit, ((role, ""), *rest)))
        return min(options, default=(10 ** 9, "~", ()))

    def follows(state, initial):
        return (state, initial) in (("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u"))

    return best(0, "", 0)


def expected(rows):
    counts, kinds = told(rows)
    cost, audit, turns = cheapest(tuple(rows), tuple(kinds))
    return (*counts, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())


def by_conversation(rows):
    out = {}
    for row in rows:
        out.setdefault(row[0], []).append(row)
    return {conv: expected(damaged(own)) for conv, own in out.items()}


def test_query_equals_brute_force(spark):
    table = pd.read_parquet(f"{SMALL}/conversations.parquet")
    rows = [(int(r.conv_id), int(r.turn), r.role, r.text) for r in table.itertuples()]
    got = {r.conv_id: tuple(r[1:]) for r in QUERIES["op12_conversation_repair"](spark, SMALL).collect()}
    assert got == by_conversation(rows)


def test_random_conversations(spark):
    rng = random.Random(5)
    texts = ["One.", "Two!", "three", " ", "", "Four? \n", ".", None, "five .x", " "]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, rng.randint(-3, 9), rng.randint(0, 40)]),
             rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]), rng.choice(texts)) for _ in range(500)]
    rows += rows[:40]
    schema = "conv_id long, turn long, role string, text string, kind string, back int, conv string"
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema).repartition(5)
    d = C.damage(frame)
    got = {r.conv_id: tuple(r[1:]) for r in C.report(C.repair(d, present=F.col("kept"))).collect()}
    assert got == by_conversation(rows)


def test_state_is_carried_across_batches(spark):
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", ""]) + rng.choice([".", f"{t}.", ""]))
            for t in range(400)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        report = C.report(C.repair(frame)).collect()
        edits = C.repair(frame).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    plain = [(t, r, x) for _, t, r, x in rows]
    assert [tuple(r[1:]) for r in report] == [expected(plain)]
    # The operator's own rows: the repaired turns in order.
    kept = [r for r in edits if r.edit != "D"]
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in kept))
    assert "".join(r.edit for r in edits) == report[0].audit and sum(r.cost for r in edits) == report[0].cost


def test_huge_integers_and_nothing_left(spark):
    big = 2 ** 62 + 1
    frame = spark.createDataFrame([(big, big, "user", "A."), (big, big + 2, "assistant", "B."), (None, None, None, None)],
                                  "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in C.report(C.repair(frame)).collect()}
    assert got[big].gaps == 1 and got[big].audit == "KK" and got[None].audit == "D"
    gone = C.report(C.repair(frame, present=F.lit(False))).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(tuple(r[1:]) for r in gone) == [(0, 0, 0, 0, 0, 0, "", empty)] * 2
    assert C.report(C.repair(frame.where("turn = 0"))).collect() == []
