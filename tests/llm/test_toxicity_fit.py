"""Operator 7 learns from every labelled row of its learning part, whatever its length and number."""

import random

import numpy as np
from pyspark.sql import functions as F

from sluice.llm import toxicity
from sluice.llm.common import texts


def tables(spark, rows):
    """``rows``: (id, text, lang, toxic)."""
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")


def some_rows(n, words=("vile",), filler=8):
    rng = random.Random(3)
    plain = ["one", "two", "three", "four", "five", "six", "seven", "eight"]
    out = []
    for k in range(n):
        text = [rng.choice(plain) for _ in range(filler)]
        if k % 4 == 0:
            text[rng.randrange(len(text))] = words[k // 4 % len(words)]
        out.append((k, " ".join(text), "en" if k % 2 else "de", int(k % 4 == 0)))
    return out


def predicted(docs, labels):
    got = toxicity.score_toxicity(docs, labels, F.lit(True), F.lit(False)).toPandas().set_index("doc_id")
    return got.predicted


def test_long_texts_are_learnt_from(spark):
    rows = [(k, t + " plain" * 8_000, lang, y) for k, t, lang, y in some_rows(160)]
    got = predicted(*tables(spark, rows))
    assert np.mean([got[r[0]] == r[3] for r in rows]) > 0.95


def test_every_shard_is_learnt_from(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 250)
    rows = some_rows(2000, words=("vile", "foul", "nasty", "rotten"))
    docs, labels = tables(spark, rows)
    got = predicted(docs, labels)
    assert np.mean([got[r[0]] == r[3] for r in rows]) > 0.95
    first, again = (toxicity.fit(docs, labels, F.lit(True)) for _ in range(2))
    assert all((a == b).all() for a, b in zip(first.net.parameters().values(), again.net.parameters().values()))
    assert (first.shift == again.shift).all()


def test_one_shard_is_plain_training(spark):
    rows = some_rows(300)
    docs, labels = tables(spark, rows)
    model = toxicity.fit(docs, labels, F.lit(True))
    order = {r.doc_id: r.o for r in docs.select("doc_id", F.xxhash64("doc_id").alias("o")).collect()}
    rows.sort(key=lambda r: order[r[0]])
    pa_text = spark.createDataFrame([(r[1],) for r in rows], "t string").toArrow().column("t")
    ids, counts = toxicity.word_ids(*texts(pa_text))
    ends = np.cumsum(counts)
    aside = np.array([(order[r[0]] % 2**64 >> 11) % 1000 < 200 for r in rows])
    plain = toxicity.Model([ids[e - n:e] for n, e in zip(counts, ends)], np.array([r[3] for r in rows]), [r[2] for r in rows], aside)
    assert aside.any() and all(np.allclose(a, b, atol=1e-3) for a, b in zip(model.net.parameters().values(), plain.net.parameters().values()))
    assert np.allclose(model.shift, plain.shift, atol=1e-2)


def test_long_runs_pool_piecewise(monkeypatch):
    from sluice.llm import nets
    net = nets.TextCNN([50, 50], 4, (1, 2, 3), 5, {"y": 2}, 1)
    rng = np.random.default_rng(2)
    counts = np.array([40, 0, 3, 70, 1])
    size = counts + net.pad
    starts = np.cumsum(size) - size
    ids = rng.integers(0, 50, (int(size.sum()), 2))
    for s, n in zip(starts, counts):
        ids[s + n:s + n + net.pad] = 50
    whole, won = net.pooled(ids, starts, places=True)
    monkeypatch.setattr(nets, "CHUNK", 7)
    pieces, at = net.pooled(ids, starts, places=True)
    assert np.allclose(whole, pieces, atol=1e-5) and (won == at)[counts > 0].all()
    assert np.allclose(whole, net.pooled(ids, starts), atol=1e-5)
