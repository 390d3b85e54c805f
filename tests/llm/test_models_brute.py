"""The registered classifiers against plain forward passes, document by document, with models fitted apart."""

import math
import re

import numpy as np
import pandas as pd
import pytest

from sluice.llm import langid, quality, toxicity
from sluice.llm.common import Words, fold
from sluice.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels")]


def rows_of(spark, name, step):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet").set_index("doc_id").text
    got = QUERIES[name](spark, SMALL).toPandas().set_index("doc_id")
    return [(docs[i], got.loc[i]) for i in list(docs.index)[::step]]


def pooled(net, rows):
    """Largest response of each filter over all places; ``rows``: table rows of each place."""
    out = np.zeros(net.conv.shape[1])
    if not len(rows):
        return out
    x = [np.concatenate([t[r[k]] for k, t in enumerate(net.tables)]) for r in rows]
    each, filters = len(x[0]), len(out) // len(net.widths)
    for n, width in enumerate(net.widths):
        for f in range(n * filters, (n + 1) * filters):
            best = -math.inf
            for p in range(len(x)):
                best = max(best, sum(float(x[p + j] @ net.conv[j * each:(j + 1) * each, f]) for j in range(width) if p + j < len(x)))
            out[f] = max(0.0, best + net.bias[f])
    return out


def logits(net, features, head):
    w, b = net.heads[head]
    return features @ w + b


def test_language(spark, tables):
    model = langid.fit(tables[0], fold("doc_id", 4) != 2)
    for text, got in rows_of(spark, "op5_language", 23):
        data = text.encode()[:20 * langid.WINDOW]
        if not re.search(r"[^\W\d_]", text) or len(data) < len(text.encode()):
            continue
        logs, mass = 0.0, 0.0
        for at in range(0, len(data), langid.WINDOW):
            window = data[at:at + langid.WINDOW]
            z = logits(model.net, pooled(model.net, [[b] for b in window]), "lang")
            p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
            logs, mass = logs + np.log(p + 1e-12) * len(window), mass + p * len(window)
        best = int(np.argmax(logs))
        assert got.lang_pred == model.languages[best] and abs(got.score - mass[best] / len(data)) < 1e-3


def test_toxicity(spark, tables):
    model = toxicity.fit(*tables, fold("doc_id", 3) != 1)
    for text, got in rows_of(spark, "op7_toxicity", 17):
        data = np.frombuffer((text or "").encode(), np.uint8)
        ids, _ = toxicity.word_ids(data, np.array([0, len(data)]))
        if len(ids) > 600:
            continue
        rows = [[int(i) >> 16 * k & 0xFFFF for k in range(toxicity.TABLES)] for i in ids]
        features = pooled(model.net, rows)
        z, lang = logits(model.net, features, "toxic"), int(np.argmax(logits(model.net, features, "lang")))
        odds = float(z[1] - z[0]) - model.shift[lang] + math.log(toxicity.DECISION / (1 - toxicity.DECISION))
        assert abs(got.score - 1 / (1 + math.exp(-odds))) < 1e-3
        assert got.predicted == int(got.score >= toxicity.DECISION)


def test_quality(spark, tables):
    model = quality.fit(*tables, fold("doc_id", 5) != 0)
    net = model.net
    for text, got in rows_of(spark, "op1_quality", 7):
        words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())
        x = np.zeros(quality.FEATURES)
        if words:
            hashes = [Words(np.frombuffer(w, np.uint8), np.array([0, len(w)])).hash for w in words]
            v = np.array([model.vectors[int(quality._bucket(h)[0])] for h in hashes], float)
            steps = np.abs(np.diff(v, axis=0)).sum(axis=0) / max(1, len(v) - 1)
            x = np.concatenate([v.mean(axis=0), v.std(axis=0), steps, [math.log1p(len(v))]])
        hidden = np.tanh((x - net.mean) / net.scale @ net.w1 + net.b1)
        logit = float((hidden @ net.w2 + net.b2)[0]) / net.temperature
        assert abs(got.score - 1 / (1 + math.exp(-logit))) < 5e-3
        assert got.predicted == int(got.score >= 0.3)
