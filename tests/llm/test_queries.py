"""The registered queries against brute force, DuckDB or held-out labels."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from sluice.llm import decontaminate, fingerprint, line_dedup, simhash_dedup, token_counts
from sluice.llm.blocks import blocks
from sluice.llm.graph import components
from sluice.llm.queries import ORACLE_SQL, QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def documents(folder):
    return pd.read_parquet(f"{folder}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


def result(spark, name, folder):
    return QUERIES[name](spark, folder).toPandas().sort_values("doc_id").reset_index(drop=True)


def remainder(ids, mod):
    return np.array([zlib.crc32(str(i).encode()) % mod for i in ids])


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components_of_chains_stars_and_pairs(spark):
    rng = np.random.default_rng(0)
    ids = rng.permutation(400).tolist()
    edges = [(ids[i], ids[i + 1]) for i in range(150)] + [(ids[200], x) for x in ids[201:260]] + [(ids[300], ids[301])] * 3
    sets = Sets()
    for a, b in edges:
        sets.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: sets.find(x) for x in {v for e in edges for v in e}}


def test_blocks_bring_every_pair_together_once(spark):
    rows = [(k, v) for k, n in ((0, 57), (1, 2), (2, 1), (3, 10)) for v in range(n)]
    out = blocks(spark.createDataFrame(rows, "k int, v long"), ["k"], ["v"], 10).collect()
    met = Counter()
    for r in out:
        assert len(r.members) <= 57
        for i, x in enumerate(r.members):
            for y in r.members[i + 1:]:
                if r.same or x.side != y.side:
                    met[r.k, *sorted((x.v, y.v))] += 1
    assert met == Counter((k, a, b) for k, n in ((0, 57), (1, 2), (3, 10)) for a in range(n) for b in range(a + 1, n))


def test_token_counts(spark):
    docs, got = documents(SMALL), result(spark, "op2_token_counts", SMALL)
    encode = token_counts.encoder().encode_ordinary
    assert got.doc_id.tolist() == docs.doc_id.tolist()
    assert got.n_tokens.tolist() == [len(encode(t)) for t in docs.text]


def test_token_scan_stitches_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "RUN", 5)
    rng, want = np.random.default_rng(0), []
    for k in range(4):
        a = rng.integers(0, 9, 700).astype("<u2")
        a[a == 8] = token_counts.END
        if k == 1:
            a[-1] = token_counts.END
        if k == 2:
            a[:] = 3                         # one document over all blocks, never closed
        if k == 3:
            a = a[:0]
        a.tofile(tmp_path / f"x{k}.bin")
        stops = np.flatnonzero(a == token_counts.END).tolist()
        if len(a) and a[-1] != token_counts.END:
            stops.append(len(a))
        starts = [0, *[s + 1 for s in stops]]
        want += [(f"x{k}.bin", i, s, e - s, e < len(a)) for i, (s, e) in enumerate(zip(starts, stops))]
    for tokens in (7, 64, 10_000):
        got = token_counts.scan_tokens(spark, str(tmp_path), block_tokens=tokens).collect()
        assert sorted(tuple(r) for r in got) == sorted(want)


def classes(fingerprints, ids, bits):
    sets = Sets()
    for i, x in enumerate(fingerprints):
        for j in range(i):
            if (x ^ fingerprints[j]).bit_count() <= bits:
                sets.join(i, j)
    least = {}
    for i, d in enumerate(ids):
        least[sets.find(i)] = min(d, least.get(sets.find(i), d))
    return [least[sets.find(i)] for i in range(len(ids))]


def test_simhash_dedup(spark, monkeypatch):
    docs, got = documents(SMALL), result(spark, "op3_simhash_dedup", SMALL)
    fp = [simhash_dedup.simhash(t.encode()) for t in docs.text]
    assert got.fingerprint.tolist() == [f"{x:016x}" for x in fp]
    assert got.component_id.tolist() == classes(fp, docs.doc_id, 3)
    # Near copies whose posting lists are dealt into many blocks.
    monkeypatch.setattr(simhash_dedup, "BLOCK", 3)
    long = " ".join(f"w{i % 911}" for i in range(4000)).split()
    rows = [(i, " ".join(long[:i * 5] + ["other"] + long[i * 5:])) for i in range(40)] + [(100 + i, f"a{i} b c{i} d") for i in range(20)]
    got = simhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).toPandas().sort_values("doc_id")
    fp = [simhash_dedup.simhash(t.encode()) for _, t in rows]
    assert got.component_id.tolist() == classes(fp, [i for i, _ in rows], 3)


def test_fingerprints(spark):
    docs, got = documents(SMALL), result(spark, "op4_fingerprints", SMALL)
    text = docs.text.tolist()
    for i, t in enumerate(text):
        q = len(t) // 4
        edited = t[:len(t) - q] + text[(i + 1) % len(text)][:q]
        assert got.n_chars[i] == len(t) and got.edited_sha256[i] == hashlib.sha256(edited.encode()).hexdigest()
    fp = [int(x, 16) for x in got.fingerprint]
    least = {}
    for x, d in zip(fp, docs.doc_id):
        least[x] = min(d, least.get(x, d))
    assert got.fingerprint_id.tolist() == [least[x] for x in fp]
    asked = np.flatnonzero(docs.doc_id % 20 == 0)
    for i in asked:
        near = {x for x in fp if (fp[i] ^ x).bit_count() <= fingerprint.RADIUS}
        assert got.n_within[i] == sum(x in near for x in fp)
        assert list(got.near_ids[i]) == sorted(least[x] for x in near - {fp[i]})
    assert got.n_within.notna().sum() == len(asked) == got.near_ids.notna().sum()
    assert (got.near_edited > got.near_next).mean() > 0.97
    for i in range(len(fp)):
        near = max(0.0, math.cos(math.pi * (fp[i] ^ fp[(i + 1) % len(fp)]).bit_count() / 128))
        assert abs(got.near_next[i] - near) < 1e-9


def test_leaks_equal_sql_and_blocks_of_items(spark, monkeypatch):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{MIDDLE}/{t}.parquet'")
    want = sorted(db.execute(ORACLE_SQL["op6_decontaminate"]).fetchall())
    run = lambda: sorted(tuple(r) for r in QUERIES["op6_decontaminate"](spark, MIDDLE).collect())
    assert run() == want and want
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    assert run() == want


def test_line_dedup(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 4)
    rng = np.random.default_rng(2)
    letters = np.array(list("abcdefgh xyzé"))
    base = ["".join(rng.choice(letters, n)) for n in rng.integers(19, 60, 30)]
    lines = []
    for _ in range(400):
        line = list(base[rng.integers(len(base))])
        for _ in range(rng.integers(0, 3)):
            line[rng.integers(len(line))] = "Q" if rng.random() < 0.5 else ""
        lines.append("".join(line))
    rows = [(i, "\n".join(lines[i * 8:i * 8 + 8] + ["short", ""])) for i in range(50)]
    got = line_dedup.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    at = [(d, n, x) for d, t in rows for n, x in enumerate(t.split("\n")) if len(x) >= line_dedup.LEAST]
    from test_methods import edit_distance
    distinct, sets = list(dict.fromkeys(x for _, _, x in at)), Sets()
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= 2:
                sets.join(a, b)
    first, want = {}, {}
    for d, n, x in at:
        stays = first.setdefault(sets.find(x), (d, n))
        if stays != (d, n):
            want[d, n] = stays
    assert {(r.doc_id, x.line_no): (x.first_doc_id, x.first_line_no) for r in got for x in r.removed} == want
    for r in got:
        kept = [x for n, x in enumerate(dict(rows)[r.doc_id].split("\n")) if (r.doc_id, n) not in want]
        assert r.text == "\n".join(kept) and r.n_removed == 10 - len(kept)


def test_lm_base_score_and_probability(spark):
    docs, got = documents(SMALL), result(spark, "op9_lm_score", SMALL)
    held = remainder(docs.doc_id, 10) == 0
    words = [t.encode().lower().split() + [None] for t in docs.text]
    c = Counter(w for x, h in zip(words, held) if not h for w in x)
    n, v = sum(c.values()), len(c)
    assert (got.held_out == held).all() and (got.train_tokens == n).all()
    assert got.n_tokens.tolist() == [len(x) for x in words]
    assert got.n_known.tolist() == [sum(c[w] > 0 for w in x) for x in words]
    base = [sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x) for x in words]
    assert np.allclose(got.base_score, base, atol=1e-6)
    # A probability: no more than the counted words' share and what the pieces give the rest.
    per_token = got.score / got.n_tokens
    assert (got.score < 0).all() and per_token.mean() > (got.base_score / got.n_tokens).mean() - 1.0


@pytest.mark.parametrize("heavy", [1 << 20, 50])
def test_lm_score_against_a_plain_lattice(spark, monkeypatch, heavy):
    """The score of whole documents, each word's segmentations summed one by one."""
    from sluice.llm import lm
    from sluice.llm.common import fold
    monkeypatch.setattr(lm, "HEAVY", heavy)
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = result(spark, "op9_lm_score", SMALL)
    learnt = table.where(fold("doc_id", 10) != 0)
    pieces, weights = lm.vocabulary()
    counts, ends = lm.word_counts(learnt), learnt.count()
    lattice = lm._fit(counts, ends, pieces, weights, lm.ROUNDS)
    logp = dict(zip(pieces, lattice.logp))
    c = {r.word.encode(): r.c for r in counts.collect()}
    n, k = sum(c.values()) + ends, len(c) + 1
    known = {}

    def spelled(word):
        if word not in known:
            data = b" " + word
            ways = [0.0] + [-math.inf] * len(data)
            for j in range(1, len(data) + 1):
                for i in range(max(0, j - lattice.longest), j):
                    if data[i:j] in logp:
                        ways[j] = np.logaddexp(ways[j], ways[i] + logp[data[i:j]])
            known[word] = ways[-1]
        return known[word]

    end = math.log10((ends + k * math.exp(lattice.end)) / (n + k))
    for doc_id, text in documents(SMALL)[["doc_id", "text"]].iloc[::7].itertuples(index=False):
        words = re.findall(rb"[^\x20\x09-\x0d]+", text.encode().lower())
        want = end + sum(math.log10((c.get(w, 0) + k * math.exp(spelled(w))) / (n + k)) for w in words)
        assert abs(got.score[got.doc_id == doc_id].iloc[0] - want) < 1e-6 * max(1, abs(want))


def test_lm_light_words_join_equals_the_broadcast(spark, monkeypatch):
    from sluice.llm import lm
    whole = result(spark, "op9_lm_score", SMALL)
    monkeypatch.setattr(lm, "HEAVY", 50)       # nearly all words go through the join
    split = result(spark, "op9_lm_score", SMALL)
    assert np.allclose(whole.base_score, split.base_score, atol=1e-6) and (whole.n_known == split.n_known).all()
    assert np.allclose(whole.score, split.score, rtol=1e-10)


def water_level(sizes, weights, total, cap):
    capped = set()
    while True:
        free = sum(w for s, w in weights.items() if s not in capped)
        level = (total - sum(cap * sizes[s] for s in capped)) / free if free else 0.0
        over = {s for s, w in weights.items() if s not in capped and w * level > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in capped else w * level for s, w in weights.items()}
        capped |= over


def test_source_mix(spark):
    docs, got = documents(MIDDLE), result(spark, "op10_source_mix", MIDDLE)
    again = result(spark, "op10_source_mix", MIDDLE)
    assert (got.taken == again.taken).all()
    size = np.array([len(t.encode().split()) for t in docs.text])
    assert (got["size"] == size).all() and (got.taken <= 2 * size).all()
    by = pd.Series(size).groupby(docs.source).sum()
    names = sorted(by.index, key=lambda s: s.encode())
    goal = water_level(by.to_dict(), {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}, 1.5 * size.sum(), 2)
    assert np.allclose(got.target, docs.source.map(goal)) and (got.source_size == docs.source.map(by)).all()
    taken = got.taken.groupby(docs.source).sum()
    assert all(abs(taken[s] - goal[s]) <= max(60, 0.005 * goal[s]) for s in names)
    # The rates are an exponential tilt that meets the token constraint.
    for s in names:
        rows = (docs.source == s) & (size > 0)
        rate, z = got.rate[rows], size[rows]
        assert abs((rate * z).sum() - goal[s]) <= 1e-6 * goal[s]
        if 0 < goal[s] < 2 * by[s] and (rate < 2).any():
            slope = np.log(rate[rate < 2]) / z[rate < 2]
            assert np.ptp(slope) <= 1e-9 + 1e-6 * abs(slope.mean())


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


@pytest.mark.parametrize("name,label,mod,rest,decision,least", [
    ("op1_quality", "quality", 5, 0, 0.3, 0.9), ("op7_toxicity", "toxic", 3, 1, 0.7, 0.6)])
def test_classifiers_on_held_out_labels(spark, name, label, mod, rest, decision, least):
    labels = pd.read_parquet(f"{MIDDLE}/labels.parquet")
    got = result(spark, name, MIDDLE)
    assert (got.held_out == (remainder(got.doc_id, mod) == rest)).all()
    assert (got.predicted == (got.score >= decision)).all() and got.score.between(0, 1).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert auc(held.score.values, held[label].values) > least


def test_language_on_held_out_documents(spark):
    docs, got = documents(MIDDLE), result(spark, "op5_language", MIDDLE)
    held = remainder(docs.doc_id, 4) == 2
    assert (got.held_out == held).all() and got.score.between(0, 1).all()
    assert (got.lang_pred == docs.lang)[held].mean() > 0.97


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = docs.selectExpr("*", "1 AS size", "2 AS removed", "'x' AS _row", "3 AS _key")     # clashing extra columns
    names, columns = [n for n, _ in corpus_pipeline.STAGES], docs.columns
    assert names == ["quality", "line_dedup", "simhash_dedup", "decontaminate", "source_mix"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.toPandas()
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.toPandas()
        if name != "source_mix":
            assert docs.columns == columns and set(after.doc_id) <= set(before.doc_id) and after.doc_id.is_unique
        if name == "line_dedup":
            assert len(after) == len(before) and (after.n_chars == after.text.str.len()).all()
            seen = Counter(x for t in after.text for x in t.split("\n") if len(x) >= line_dedup.LEAST)
            assert not seen or max(seen.values()) == 1
        if name == "simhash_dedup":
            fp = [simhash_dedup.simhash(t.encode()) for t in before.text]
            assert sorted(after.doc_id) == sorted(set(classes(fp, before.doc_id, 3)))
        if name == "decontaminate":
            assert docs.count() == len(before) - decontaminate.leaks(
                spark.createDataFrame(before[["doc_id", "text"]]), spark.read.parquet(f"{SMALL}/benchmark.parquet")
            ).select("doc_id").distinct().count()
        if name == "source_mix":
            taken = after.groupby("doc_id").agg(rows=("copy_no", "count"), copies=("copies", "first"))
            assert (taken.rows == taken.copies).all() and (after.copies <= 2).all()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0
