"""Operator 11 against whole-text encoding and a plain double loop."""

import hashlib
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.llm import alignment as A
from sluice.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
ODD = ["a  b\n\n c\t d", "x▁ y z", "▁ y", "日本語 テスト  <s> </s> <|endoftext|> <unk>", "\x00 \x1c a \x1f b\x85c d", "é à  b",
       "'s 't  it's don't 12 34½ ２ a​ b", "😀 😀👍🏽 ", " ", " a", "a ", "\r\n", "١٢ x́ ́ y", "﻿a b", "ﬁ ½ Ⅳ ｱ", "<0x41> <0xE2>"]


def brute(texts):
    a, b = A.tokenizer(A.TOKENIZER_A), A.tokenizer(A.TOKENIZER_B)
    rows, links = [], Counter()
    for text in texts:
        found, groups, n = [], [], (0, 0)
        if text:
            x = a.encoder.encode(" " + text, add_special_tokens=False).ids
            y = b.encoder.encode(text)
            whole = (" " + text).encode()
            if b"".join(a.bytes[i] for i in x) == whole == b"".join(b.bytes[i] for i in y):
                n = len(x), len(y)
                spans = []
                for ids, size in ((x, a), (y, b)):
                    at, own = 0, []
                    for i in ids:
                        own.append((at, at + len(size.bytes[i])))
                        at = own[-1][1]
                    spans.append(own)
                j = 0
                for i, (s, e) in enumerate(spans[0]):
                    while j and spans[1][j][0] > s:
                        j -= 1
                    while j < len(y) and spans[1][j][0] < e:
                        if spans[1][j][1] > s:
                            found.append((x[i], y[j]))
                        j += 1
                    j -= 1
                ends = [{e for _, e in own} for own in spans]
                low = 0
                for end in sorted(ends[0] & ends[1]):
                    groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, own) if low <= s and e <= end)
                                           for ids, own in ((x, spans[0]), (y, spans[1]))) if len(whole) < 4000 else "")
                    low = end
        links.update(found)
        rows.append((n, found, groups))
    best = Counter()
    for (_, y), c in links.items():
        best[y] = max(best[y], c)
    return [(*n, len(g), len(f), sum(links[p] == best[p[1]] for p in f), sum(links[p] for p in f), g) for n, f, g in rows]


def check(rows, texts):
    expected = brute([texts[r.doc_id] for r in rows])
    for r, (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) in zip(rows, expected):
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == (n_a, n_b, n_groups, n_links, n_best, count_sum)
        if "" not in groups:
            assert r.groups_sha256 == (hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        if n_a:
            assert n_links >= max(n_a, n_b)


def test_query_equals_brute_force(spark):
    rows = QUERIES["op11_token_alignment"](spark, SMALL).collect()
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    assert sorted(r.doc_id for r in rows) == sorted(docs.doc_id)
    check(rows, dict(zip(docs.doc_id, docs.text)))


@pytest.mark.parametrize("heavy", [1, 1 << 20])
def test_odd_texts_with_and_without_the_join(spark, monkeypatch, heavy):
    monkeypatch.setattr(A, "HEAVY", heavy)
    texts = dict(enumerate([*ODD, None, "", "the same text", "the same text", "Aé" * 3000, " ".join(f"w{i % 91}" for i in range(30000))]))
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts.items()], "doc_id long, text string, pair int, n_a string").repartition(3)
    rows = A.align_corpus(docs).withColumn("groups_sha256", F.coalesce("groups", F.lit(""))).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_groups_as_text_repeats_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "low lower"), (1, "low lower"), (1, "low lower")], "doc_id long, text string")
    rows = A.align_corpus(docs, digest=False).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"] and len({r[1:] for r in rows}) == 1
    assert all("|" in g for g in rows[0].groups.split(";")) and rows[0].n_best == rows[0].n_links
    assert A.align_corpus(docs.where("doc_id = 7")).collect() == []


def test_slices_and_overlaps():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 12)
        cuts = [sorted({n, *rng.sample(range(1, n + 1), rng.randint(1, n))}) for _ in range(2)]
        lengths = [[b - a for a, b in zip([0, *c], c)] for c in cuts]
        groups = A.common_slices(*lengths)
        links = [(i + x, j + y) for _, i, k, j, m in groups for x, y in A.overlaps(lengths[0][i:k], lengths[1][j:m])]
        spans = [list(zip([0, *c], c)) for c in cuts]
        assert links == [(x, y) for x, (s, e) in enumerate(spans[0]) for y, (t, f) in enumerate(spans[1]) if s < f and t < e]


def test_pieces_that_are_forgotten_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").coalesce(1)
    names = ("n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times")
    first = {r.doc_id: [r[n] for n in names] for r in A.align_texts(docs, digest=True).collect()}
    monkeypatch.setattr(A, "SLICE_BYTES", 2000)
    # Workers import the module anew, so the small table is set inside the task.
    small = A.Pieces(A.tokenizer(A.TOKENIZER_A), A.tokenizer(A.TOKENIZER_B))
    for r in docs.limit(20).collect():
        small.forget()
        pieces = small.split(r.text) if r.text else []
        small.learn(pieces)
        said = [small.groups[small.known[p]] for p in pieces]
        whole = hashlib.sha256(";".join(said).encode()).hexdigest() if said and None not in said else None
        assert whole == first[r.doc_id][4]
