"""The methods' own guarantees, without Spark: filters lose nothing, recursions equal brute force."""

import math
import random
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import decontaminate, fingerprint, langid, line_dedup, lm, quality, simhash_dedup, toxicity
from sluice.llm.common import Words, grams, slices, texts


def arrays(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def edit_distance(a, b):
    row = list(range(len(a) + 1))
    for j, c in enumerate(b, 1):
        new = [j]
        for i in range(1, len(a) + 1):
            new.append(min(new[i - 1] + 1, row[i] + 1, row[i - 1] + (a[i - 1] != c)))
        row = new
    return row[-1]


@given(st.lists(st.text(alphabet="ab \t\né漢", max_size=12), max_size=6))
@settings(max_examples=200, deadline=None)
def test_words_are_split_and_hashed_alike(texts):
    data, off = arrays(texts)
    w = Words(data, off)
    want = [t.encode().split() for t in texts]
    assert w.counts.tolist() == [len(x) for x in want]
    flat = [x for t in want for x in t]
    assert [data[s:e].tobytes() for s, e in zip(w.start, w.end)] == flat
    assert len(set(w.hash.tolist())) == len(set(flat))
    assert grams(w, 2)[1].tolist() == [i for i, x in enumerate(want) for _ in range(max(0, len(x) - 1))]


@pytest.mark.parametrize("bits", range(8))
def test_byte_lists_meet_every_pair_within_the_radius(bits):
    for differing in combinations(range(8), bits):
        assert any(not set(c) & set(differing) for c in simhash_dedup.choices(bits))


def test_simhash_is_the_contract_s():
    for text in ("", "One", "one TWO", "A b C d a B c", "é É x y z " * 50):
        words = text.encode().lower().split()
        shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash_dedup.simhash(text.encode()) == want


def test_simhash_of_pieces_is_that_of_the_whole(monkeypatch):
    data = " ".join(f"w{i * 7919 % 1013}" for i in range(5000)).encode()
    whole = simhash_dedup.simhash(data)
    monkeypatch.setattr(simhash_dedup, "_PIECE", 97)
    assert simhash_dedup.simhash(data) == whole


def test_forest_spans_the_links():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 20, dtype=np.uint64)
    fp = np.unique(np.concatenate([base ^ (np.uint64(1) << np.uint64(k)) for k in range(0, 12, 3)] + [base]))
    edges = simhash_dedup.forest(fp, 3)
    assert len(edges) == len(fp) - 20
    assert all(np.bitwise_count(fp[a] ^ fp[b]) <= 3 for a, b in edges)


@pytest.mark.parametrize("radius,cuts", [(0, None), (3, None), (3, 6), (5, 8)])
def test_block_tables_meet_every_pair_within_the_radius(radius, cuts):
    rng = random.Random(radius)
    masks = [(a % 2**64) | (b % 2**64) << 64 for a, b in fingerprint.tables(radius, cuts)]
    for _ in range(300):
        x = sum(1 << b for b in rng.sample(range(128), radius))
        assert any(x & m == 0 for m in masks)


def test_likeness_of_equal_unlike_and_empty_texts():
    texts = ["a b c d e f g h", "a b c d e f g h", "", "p q r s t u v w x", "word"]
    fp = fingerprint.simhashes(*arrays(texts))
    assert (fp[0] == fp[1]).all() and (fp[2] == 0).all()
    assert fingerprint.likeness(fp[:1], fp[1:2])[0] == 1.0
    assert fingerprint.likeness(fp[:1], fp[3:4])[0] < 0.6


@given(st.text(alphabet="abc", max_size=16), st.lists(st.tuples(st.integers(0, 15), st.sampled_from("abc-")), max_size=5),
       st.integers(1, 4))
@settings(max_examples=1500, deadline=None)
def test_banded_distance_equals_the_table(a, edits, k):
    b = list(a)
    for at, c in edits:
        if c == "-" and at < len(b):
            b.pop(at)
        elif at < len(b) and (at + len(b)) % 2:
            b[at] = c
        else:
            b.insert(at, c)
    b = "".join(b)
    assert line_dedup.within(a, b, k) == (edit_distance(a, b) <= k)


@given(st.text(alphabet="ab", min_size=6, max_size=20), st.lists(st.tuples(st.integers(0, 30), st.sampled_from("ab-+")), max_size=3))
@settings(max_examples=800, deadline=None)
def test_lines_within_the_threshold_share_a_key(a, edits):
    b = list(a)
    for at, c in edits[:line_dedup.THRESHOLD]:
        at %= len(b)
        if c == "-" and len(b) > 6:
            b.pop(at)
        elif c == "+":
            b.insert(at, "a")
        else:
            b[at] = "b"
    b = "".join(b)
    lines = line_dedup.Lines([a, b])
    if a == b or min(len(a), len(b)) < 6:
        return
    key, value = line_dedup.keys(lines, np.arange(2), line_dedup.THRESHOLD, 6)
    one, two = (set(key[(value >> np.uint64(1)) == h].tolist()) for h in lines.hash)
    index = set(key[value & np.uint64(1) == 0].tolist())
    assert one & two & index


def test_every_segmentation_counts():
    pieces = [b" ", b" a", b"a", b"b", b"ab", b"ba", b" ab", b"aba"]
    weights = np.arange(1.0, 9.0)
    lattice = lm.Lattice(pieces, weights, 2.0)
    p = dict(zip(pieces, weights / (weights.sum() + 2.0)))

    def brute(word):
        return 1.0 if not word else sum(q * brute(word[len(s):]) for s, q in p.items() if word.startswith(s))

    words = [b"a", b"ab", b"aba", b"ababab", b"bb"]
    data, off = arrays([w.decode() for w in words])
    got = lattice.words(data, off[:-1], off[1:])
    assert np.allclose(np.exp(got), [brute(b" " + w) for w in words], rtol=1e-12)
    sums = np.zeros(len(pieces))
    lattice.words(data, off[:-1], off[1:], np.ones(len(words)), sums)
    assert np.isclose((sums * [len(s) for s in pieces]).sum(), sum(len(w) + 1 for w in words))   # bytes are covered once


def test_a_long_word_is_scored_as_a_short_one(monkeypatch):
    pieces, weights = lm.vocabulary()
    lattice = lm.Lattice(pieces, weights, 1.0)
    data, off = arrays(["unbelievable漢字abc", "x" * 150])
    short_sums, long_sums = np.zeros(len(pieces)), np.zeros(len(pieces))
    short = lattice.words(data, off[:-1], off[1:], np.ones(2), short_sums)
    monkeypatch.setattr(lm, "LONG", 1)
    assert np.allclose(lattice.words(data, off[:-1], off[1:], np.ones(2), long_sums), short)
    assert np.allclose(short_sums, long_sums) and np.isfinite(short).all()


def test_no_leak_is_lost_by_the_sketches():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(3, 60)))) for i in range(40)]
    docs = []
    for _, item in items * 3:
        words = item.split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = "other"
        docs.append(" ".join(rng.choices(vocabulary, k=50) + words + rng.choices(vocabulary, k=30)))
    sketches = decontaminate.Sketches(items, 5, 0.8)
    got = {(d, sketches.items[i][0]) for d, i, _ in sketches.leaks(*arrays(docs))}
    shingles = lambda t: {" ".join(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)}
    want = {(d, i) for d, t in enumerate(docs) for i, x in items
            if shingles(x) and len(shingles(x) & shingles(t)) >= 0.8 * len(shingles(x)) - 1e-9}
    assert got == want and want


def test_language_windows_cover_the_text_and_tables_equal_the_filters():
    texts = ["der die das und nicht " * 20, "the and of that with " * 20]
    model = langid.Model([(t.encode(), k) for t, k in zip(texts * 8, ["de", "en"] * 8)])
    block = langid.windows(np.frombuffer((texts[0] * 3 + "abc").encode(), np.uint8))
    assert (block[block < 256] == np.frombuffer((texts[0] * 3 + "abc").encode(), np.uint8)).all()
    ids, starts = langid._flat(block, model.net.pad)
    z = model.net.logits(model.net.pooled(ids, starts), "lang")
    assert np.allclose(z - np.log(np.exp(z).sum(1, keepdims=True)),
                       model.window_logs(block), atol=1e-4)
    assert model.predict(*arrays(texts))[0] == ["de", "en"]


def test_word_vectors_and_pooling_follow_their_definition():
    table = np.zeros((quality.BUCKETS, 1 + quality.DIM))
    texts = ["a b c", "", "b"]
    quality.add_contexts(table, *arrays(texts))
    h = {x: Words(*arrays([x])).hash for x in "abc"}
    index = {}
    for x in "abc":
        v = np.zeros(quality.DIM)
        for place, sign in zip(*quality._index(h[x])):
            np.add.at(v, place, sign)
        index[x] = v
    row = lambda x: table[quality._bucket(h[x])[0]]
    assert row("b")[0] == 2 and np.allclose(row("b")[1:], index["a"] + index["c"])
    assert np.allclose(row("a")[1:], index["b"] + index["c"])
    vectors = np.random.default_rng(0).normal(size=(quality.BUCKETS, quality.DIM)).astype(np.float32)
    x = np.stack([vectors[quality._bucket(h[k])[0]] for k in "abc"])
    got = quality.pooled(vectors, *arrays(texts))
    assert np.allclose(got[0], np.concatenate([x.mean(0), x.std(0), np.abs(np.diff(x, axis=0)).mean(0), [math.log(4)]]), atol=1e-5)
    assert (got[1] == 0).all()


def test_toxicity_learns_a_word_wherever_it_stands():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    texts, toxic = [], []
    for k in range(600):
        t = rng.choices(words, k=rng.randint(5, 40))
        if k % 4 == 0:
            t[rng.randrange(len(t))] = rng.choice(["nasty!", "Nasty,", "vile"])
        texts.append(" ".join(t))
        toxic.append(int(k % 4 == 0))
    ids = [toxicity.word_ids(*arrays([t]))[0] for t in texts]
    model = toxicity.Model(ids[:500], np.array(toxic[:500]), ["en"] * 500, np.arange(500) % 5 == 0)
    score = model.score(*toxicity.word_ids(*arrays(texts[500:])))
    assert ((score >= toxicity.DECISION) == np.array(toxic[500:])).mean() > 0.95


def test_long_lines_within_their_threshold_share_a_key_and_link():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["中", "语"]
    for _ in range(600):
        a = rng.choices(words, k=rng.choice([19, 20, 38, 39, 40, 41, 44, 55, 56, 59, 60, 110, 200]))
        b = list(a)
        for _ in range(rng.randint(1, max(1, len(a) // line_dedup.WORDS))):
            at = rng.randrange(len(b))
            b[at:at + rng.randint(0, 1)] = ["another"] * rng.randint(0, 1)
        allowed = min(len(a), len(b)) // line_dedup.WORDS
        linked = edit_distance(a, b) <= allowed
        a, b = " ".join(a), " ".join(b)
        if rng.random() < 0.3:                     # also code point edits that split, join and touch wide ones
            b = list(a)
            for _ in range(2):
                at = rng.randrange(len(b))
                b[at:at + 1] = rng.choice([[], [" "], ["x"], [b[at], "中"]])
            b, linked = "".join(b), True
        if a == b:
            continue
        assert not linked or len(line_dedup.forest([a, b], line_dedup.THRESHOLD)) == 1
        lines = line_dedup.Lines([a, "", b])
        key, value = line_dedup.all_keys(lines, np.array([0, 2]), line_dedup.THRESHOLD, line_dedup.EDITED)
        one, two = (set(key[(value >> np.uint64(1)) == h].tolist()) for h in lines.hash[[0, 2]])
        assert not linked or one & two & set(key[value & np.uint64(1) == 0].tolist())


def test_unlike_lines_with_one_hash_both_stay(spark):
    word = ["a"]
    while len(word) < 1024:
        word += ["b" if c == "a" else "a" for c in word]
    one, other = "".join(word), "".join("b" if c == "a" else "a" for c in word)
    hashes = line_dedup.Lines([one, other]).hash
    assert hashes[0] == hashes[1] and one != other
    rows = [(1, one), (2, other), (3, other), (4, one + "\n" + one)]
    got = {r.doc_id: r.text for r in line_dedup.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: one, 2: other, 3: "", 4: ""}


def test_forest_with_sketches_links_what_all_pairs_link(monkeypatch):
    rng = np.random.default_rng(11)
    words = ["w%d" % i for i in range(60)]
    lines = []
    for _ in range(12):
        base = list(rng.choice(words, rng.integers(3, 70)))
        for _ in range(rng.integers(1, 12)):
            line = list(base)
            for _ in range(rng.integers(0, 5)):
                line[rng.integers(len(line))] = str(rng.choice(words)) if rng.random() < 0.7 else ""
            lines.append(" ".join(line)[rng.integers(0, 3):])
    lines = list(dict.fromkeys(lines))

    def linked(a, b):
        x, y = line_dedup._WORD.findall(a), line_dedup._WORD.findall(b)
        most = min(len(x), len(y)) // line_dedup.WORDS
        return edit_distance(a, b) <= 2 or most > 0 and edit_distance(x, y) <= most

    def parts(edges):
        up = list(range(len(lines)))

        def find(i):
            while up[i] != i:
                i = up[i]
            return i
        for a, b in edges:
            up[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in range(len(lines))]

    pairs = [(i, j) for i in range(len(lines)) for j in range(i) if linked(lines[i], lines[j])]
    found = line_dedup.Lines(lines)
    words, n = line_dedup.InWords(found), len(lines)
    assert [*(words.end - words.start)] == [len(line_dedup._WORD.findall(x)) for x in lines]
    sketch = line_dedup.sketches(found, words, np.arange(n))
    block = line_dedup.Block(found.end - found.start, words.end - words.start, sketch, 2)
    whole = np.array([0]), np.array([n])
    none = [frozenset()] * n
    for few in (line_dedup.FEW, 4):                  # all pairs at once, and line by line
        monkeypatch.setattr(line_dedup, "FEW", few)
        assert pairs and parts(line_dedup.block_forest(block, *whole, lines.__getitem__, none)) == parts(pairs)
    assert parts(line_dedup.forest(lines, 2)) == parts(pairs)
    # A pair that shares an earlier key is left to it.
    keyed = [frozenset([7]) if i in pairs[0] else frozenset() for i in range(n)]
    assert set(line_dedup.block_forest(block, *whole, lines.__getitem__, keyed)).isdisjoint({pairs[0], pairs[0][::-1]})
    assert [line_dedup._pairs(np.array([2, 9]), np.array([5, 10]))[k].tolist() for k in (0, 1)] == [[2, 2, 3], [3, 4, 4]]


def test_quality_works_on_a_bounded_piece_of_text_at_a_time():
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(f"w{(i * j) % 997}" for j in range(400)) for i in range(3000)]})
    vectors = np.ones((quality.BUCKETS, quality.DIM), np.float32)
    table = np.zeros((quality.BUCKETS, 1 + quality.DIM))
    for work in (lambda *x: quality.add_contexts(table, *x), lambda *x: quality.pooled(vectors, *x)):
        tracemalloc.start()
        for part in slices(batch, "text", quality._SLICE):
            work(*texts(part.column("text")))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 60 << 20


def test_written_lines_and_their_hashes():
    values = ["", None, "a\n\n  \nbb cc", "　\nกข x\n", "\U0001F600 a\U0001F600\nbb cc", "\x85 \nend"]
    of, number, rows, said = line_dedup.written(values, 2)
    lines = line_dedup.Lines(values)
    assert list(zip(of, number, said)) == [(2, 3, "bb cc"), (3, 1, "กข x"), (4, 0, "\U0001F600 a\U0001F600"), (4, 1, "bb cc"), (5, 1, "end")]
    assert [lines.cp[lines.start[r]:lines.end[r]].tobytes().decode("utf-32-le") for r in rows] == said
    hashes = line_dedup.hashes(line_dedup.digests(said))
    assert hashes[0] == hashes[3] and len(set(hashes.tolist())) == 4 and int(hashes.max()) < 1 << 63
    assert line_dedup.hashes([]).tolist() == []


def test_only_repeated_or_linked_lines_are_stored_with_their_class(spark, monkeypatch):
    kept = {}

    def stored(df, name, *rest):
        done = real(df, name, *rest)
        kept.setdefault(name, []).append(done.count())
        return done

    real = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", stored)
    rows = [(i, f"only here {i}\nthe same line in all\nnearly the same line {i % 2}") for i in range(40)]
    got = {r.doc_id: r.n_removed for r in line_dedup.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 2 if i else 0 for i in range(40)}
    assert len(kept["lines"]) == 1 and kept["line-classes"] == [3] and kept["repeated-lines"] == [80]


def test_linked_lines_share_a_key_at_every_range_of_sizes():
    rng = random.Random(12)
    sizes = [*range(3, 14), *range(18, 28), *range(37, 46), *range(58, 66), *range(78, 86), *range(98, 107), *range(118, 128),
             *range(138, 150), 160, 200, 279, 280, 290]
    pairs = []
    for n in sizes * 40:
        a = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(n)]
        if rng.random() < 0.5 and n >= line_dedup.WORDS:
            b = list(a)
            first = rng.random() < 0.5               # all between some two places, or anywhere
            low, high = sorted(rng.sample(range(n), 2)) if first else (0, n - 1)
            for _ in range(n // line_dedup.WORDS):
                at = min(rng.randint(low, high), len(b) - 1)
                b[at:at + rng.randint(0, 1)] = ["other"] * rng.randint(0, 1)
            if min(len(a), len(b)) // line_dedup.WORDS < n // line_dedup.WORDS:
                continue
            a, b = " ".join(a), " ".join(b)
        else:
            a = "".join(w + rng.choice(["\u4e2d", "\u8a9e"]) if rng.random() < 0.1 else w + " " for w in a)
            b = list(a)
            for _ in range(2):
                at = rng.choice([0, len(b) - 1, rng.randrange(len(b)), rng.randrange(len(b))])
                b[at:at + rng.randint(0, 1)] = rng.choice([[], [" "], ["x"], ["\u4e2d"]])
            b = "".join(b)
        if a != b and min(len(a), len(b)) >= line_dedup.EDITED:
            pairs.append((a, b))
    lines = line_dedup.Lines([x for pair in pairs for x in pair])
    key, value = line_dedup.all_keys(lines, np.arange(2 * len(pairs)), line_dedup.THRESHOLD, line_dedup.EDITED)
    held = {h: set() for h in lines.hash.tolist()}
    for k, v in zip(key.tolist(), value.tolist()):
        held[v >> 1].add((k, v & 1))
    for at, (one, two) in enumerate(lines.hash.reshape(-1, 2).tolist()):
        assert any((k, 1 - p) in held[two] or p == 0 and (k, 0) in held[two] for k, p in held[one]), pairs[at]


def test_lines_have_few_keys():
    rng = random.Random(3)
    for n, most in ((10, 8), (30, 12), (50, 5), (70, 7), (90, 9), (110, 12), (130, 16), (170, 60)):
        lines = line_dedup.Lines([" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n)) for _ in range(50)])
        key, value = line_dedup.all_keys(lines, np.arange(50), line_dedup.THRESHOLD, line_dedup.EDITED)
        assert len(key) <= most * 50
    lines = line_dedup.Lines(["so it goes on " * 1000])
    key, value = line_dedup.all_keys(lines, np.arange(1), line_dedup.THRESHOLD, line_dedup.EDITED)
    assert len(key) == len(set(key.tolist())) < 50
