"""Joins whose sides Spark sizes too low must not be broadcast."""

import numpy as np
from pyspark.sql import functions as F

from sluice.llm import fingerprint
from sluice.llm.blocks import blocks


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_members_of_buckets_are_not_broadcast(spark):
    members = (spark.range(300).select(F.col("id").alias("v"), F.explode(F.sequence(F.lit(0), F.lit(44))).alias("t"))
               .select("t", (F.col("v") % 7).alias("k"), "v"))
    found = blocks(members, ["t", "k"], ["v"], 10)
    assert "Broadcast" not in final_plan(found)
    # Every two values of a bucket meet in exactly one row.
    met = {}
    for r in found.collect():
        sides = [[m["v"] for m in r["members"] if m["side"] == s] for s in (False, True)]
        pairs = [(a, b) for a in sides[0] for b in sides[0] if a < b] if r["same"] else [(a, b) for a in sides[0] for b in sides[1]]
        for a, b in pairs:
            key = (r["t"], min(a, b), max(a, b))
            met[key] = met.get(key, 0) + 1
    assert met == {(t, a, b): 1 for t in range(45) for a in range(300) for b in range(a + 1, 300) if a % 7 == b % 7}


def test_fingerprint_search_broadcasts_no_table(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-2**62, 2**62, (40, 2))
    rows = [(int(a), int(b), k % 3 == 0) for k, (a, b) in enumerate(base)]
    rows += [(a ^ 5, b ^ 1, False) for a, b, _ in rows]                 # three bits away
    found = fingerprint.neighbours(spark.createDataFrame(rows, "_hi long, _lo long, _query boolean"))
    assert "Broadcast" not in final_plan(found)
    asked = {(a, b): (a ^ 5, b ^ 1) for a, b, q in rows if q}
    assert {(r["_hi"], r["_lo"]): (r["_fhi"], r["_flo"]) for r in found.collect()} == asked
    assert found.count() == len(asked) and {r["bits"] for r in found.collect()} == {3}


def test_texts_at_the_ends_of_ranges_are_not_broadcast(spark):
    docs = spark.createDataFrame([(i, f"word{i} and some more") for i in range(100)], "doc_id long, text string")
    found = fingerprint.with_next(docs)
    assert "Broadcast" not in final_plan(found)
    assert sorted(r["doc_id"] for r in found.collect()) == list(range(100))
