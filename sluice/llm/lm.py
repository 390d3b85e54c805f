"""Operator 9: subword lattice likelihood under an existing vocabulary, beside a word unigram base.

Model.  A text is its words (A-Z lower-cased, each with the vocabulary's word
mark before it) and an end.  The lattice of a word holds all its segmentations
into the vocabulary's pieces, drawn independently (single bytes are pieces of
last resort), and forward recursion in log space sums them.  The vocabulary
file's scores (ranks) give the first piece weights; ``ROUNDS`` of expectation
maximisation over the distinct words of all training texts refine them.  The
vocabulary itself is never changed.  A word that training texts hold ``c`` times
has one more edge, from its start to its end: with ``N`` training tokens and
``k`` distinct ones (the Witten-Bell weight of new words),

    P(word) = (c + k * P(all segmentations)) / (N + k)

and a text's probability is the product over its words and its end, which is a
probability over all texts.

Scale.  Training words are counted by a distributed aggregate and stay a
distributed table.  At most ``HEAVY`` words can have a share of ``1 / HEAVY`` of
all training tokens: those, with their counts and probabilities, are sent to
the tasks (so the size is bounded whatever the corpus), and cover most tokens.
A text's other words go, as hashes, to a join with the counted words.

Defined cases: a null or empty text is its end alone; a null id is scored,
never learnt from and ``held_out`` false; repeated rows are scored each, and
learnt from each; without training texts every count and ``train_tokens`` is 0,
``base_score`` is ``tokens * log10(0.1 / 0.1)``, that is 0, and ``score`` is the
lattice's alone, with the file's weights; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _BYTE, _LOWER, Words, mix, powers, slices, stored, texts

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROUNDS = 2
HEAVY = 1 << 20
ADD = 0.1            # added to a word's count
PIECE_ADD = 0.01     # added to a piece's expected count
LONG = 200           # bytes from which a word is worked on alone
_SLICE = 4 << 20
_MARK = "▁"


def vocabulary(path: str = VOCABULARY) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, the word mark as a space, and their first weights from the file's ranks."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: dict[bytes, float] = {}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            continue
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            raw = bytes([int(name[3:5], 16)])
        else:
            raw = name.replace(_MARK, " ").encode()
            if b" " in raw[1:]:
                continue                      # a word has its mark in front only
        weight = 1.0 / (10.0 + abs(sp.get_score(i))) if not sp.is_byte(i) else 1e-7
        pieces[raw] = max(weight, pieces.get(raw, 0.0))
    weights = np.array(list(pieces.values()))
    return list(pieces), weights


class Lattice:
    """All segmentations of words into pieces, many words at once."""

    def __init__(self, pieces: list[bytes], weights: np.ndarray, end: float):
        total = weights.sum() + end
        self.logp = np.log(weights / total)
        self.end = math.log(end / total) if end else -math.inf
        self.longest = max(map(len, pieces))
        h = np.empty(len(pieces), np.uint64)
        up = powers(self.longest)[0]
        for k, p in enumerate(pieces):
            b = np.frombuffer(p, np.uint8)
            h[k] = (_BYTE[b] * up[:len(b)]).sum(dtype=np.uint64) + np.uint64(len(b))
        self.hash = mix(h)
        self.bits = max(8, (4 * len(pieces)).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int32)
        for k, s in enumerate((self.hash >> np.uint64(64 - self.bits)).tolist()):
            while self.slot[s] >= 0:
                s = (s + 1) & ((1 << self.bits) - 1)
            self.slot[s] = k

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of substring hashes; -1 where there is none."""
        at = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        k = self.slot[at]
        out = np.where((k >= 0) & (self.hash[k] == h), k, -1)
        more = np.flatnonzero((k >= 0) & (out < 0))
        while len(more):
            at[more] = (at[more] + 1) & ((1 << self.bits) - 1)
            k = self.slot[at[more]]
            hit = (k >= 0) & (self.hash[k] == h[more])
            out[more[hit]] = k[hit]
            more = more[(k >= 0) & ~hit]
        return out

    def _edges(self, block: np.ndarray):
        """``(i, j, rows, pieces)`` of words of one length: what spans bytes i to j in which rows."""
        n = block.shape[1]
        up, down = powers(n + 1)
        total = np.zeros((len(block), n + 1), np.uint64)
        np.cumsum(_BYTE[block] * up[:n], axis=1, out=total[:, 1:])
        total = np.ascontiguousarray(total.T)
        for j in range(1, n + 1):
            for i in range(max(0, j - self.longest), j):
                k = self.find(mix((total[j] - total[i]) * down[i] + np.uint64(j - i)))
                rows = np.flatnonzero(k >= 0)
                if len(rows):
                    yield i, j, rows, k[rows]

    def _block(self, block: np.ndarray, times: np.ndarray | None, sums: np.ndarray | None) -> np.ndarray:
        n = block.shape[1]
        forward = np.full((n + 1, len(block)), -np.inf)
        forward[0] = 0.0
        edges = []
        for i, j, rows, k in self._edges(block):
            forward[j][rows] = np.logaddexp(forward[j][rows], forward[i][rows] + self.logp[k])
            if sums is not None:
                edges.append((i, j, rows, k))
        if sums is not None:
            back = np.full((n + 1, len(block)), -np.inf)
            back[n] = 0.0
            for i, j, rows, k in reversed(edges):
                after = back[j][rows] + self.logp[k]
                expected = np.exp(forward[i][rows] + after - forward[n][rows]) * times[rows]
                sums += np.bincount(k, expected, len(sums))
                back[i][rows] = np.logaddexp(back[i][rows], after)
        return forward[n]

    def _alone(self, word: np.ndarray, times: float, sums: np.ndarray | None) -> float:
        """One long word: substrings are looked up by length, the recursion runs edge by edge."""
        n = len(word)
        up, down = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[word] * up[:n], out=total[1:])
        start, stop, piece = [], [], []
        for m in range(1, min(self.longest, n) + 1):
            k = self.find(mix((total[m:] - total[:-m]) * down[:n - m + 1] + np.uint64(m)))
            i = np.flatnonzero(k >= 0)
            start.append(i)
            stop.append(i + m)
            piece.append(k[i])
        start, stop, piece = map(np.concatenate, (start, stop, piece))
        order = np.lexsort((start, stop))
        start, stop, piece = start[order].tolist(), stop[order].tolist(), piece[order]
        logp = self.logp[piece].tolist()
        add = lambda a, b: b if a == -math.inf else a if b == -math.inf else max(a, b) + math.log1p(math.exp(-abs(a - b)))
        forward = [0.0] + [-math.inf] * n
        for i, j, p in zip(start, stop, logp):
            forward[j] = add(forward[j], forward[i] + p)
        if sums is not None:
            back = [-math.inf] * n + [0.0]
            expected = np.zeros(len(start))
            order = np.lexsort((stop, start))[::-1].tolist()
            for e in order:
                i, after = start[e], back[stop[e]] + logp[e]
                expected[e] = math.exp(forward[i] + after - forward[n]) * times
                back[i] = add(back[i], after)
            sums += np.bincount(piece, expected, len(sums))
        return forward[n]

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, times: np.ndarray | None = None,
              sums: np.ndarray | None = None) -> np.ndarray:
        """Log probability of the words ``data[start:end]``; adds expected piece counts to ``sums``."""
        out = np.zeros(len(start))
        length = end - start
        order = np.argsort(length, kind="stable")
        bounds = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            n = int(length[order[lo]])
            for at in range(lo, hi, 1 << 16):
                rows = order[at:min(hi, at + (1 << 16))]
                if n < LONG:
                    block = np.full((len(rows), n + 1), 0x20, np.uint8)
                    block[:, 1:] = data[start[rows][:, None] + np.arange(n)]
                    out[rows] = self._block(block, None if times is None else times[rows], sums)
                else:
                    for r in rows.tolist():
                        word = np.concatenate([np.array([0x20], np.uint8), data[start[r]:end[r]]])
                        out[r] = self._alone(word, 0.0 if times is None else float(times[r]), sums)
        return out


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Arrow strings of byte ranges."""
    length = end - start
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(length, out=offsets[1:])
    at = np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at])))


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Batches of about ``rows`` rows: words of one length are worked on together."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.concat_batches(held)
            held, count = [], 0
    if held:
        yield pa.concat_batches(held)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, c)``: all words of ``docs`` and how often they occur."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                data, offsets = texts(part.column(text))
                w = Words(data, offsets, lower=True)
                _, first, count = np.unique(w.hash, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [_strings(_LOWER[data], w.start[first], w.end[first]), pa.array(count)], names=["word", "c"])

    return docs.select(text).mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _fit(counts: DataFrame, docs: int, pieces: list[bytes], weights: np.ndarray, rounds: int) -> Lattice:
    """Piece weights after some rounds of expectation maximisation over the distinct words."""
    spark = counts.sparkSession
    lattice = Lattice(pieces, weights, weights.sum() / 100)
    if not docs:
        return lattice
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(lattice)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(len(sent.value.logp))
            for batch in _gathered(batches):
                data, offsets = texts(batch.column(0))
                sent.value.words(data, offsets[:-1], offsets[1:], np.ones(batch.num_rows), sums)
            k = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(sums[k])], names=["piece", "n"])

        rows = counts.select("word").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        expected = np.full(len(pieces), PIECE_ADD)
        for r in rows:                        # one row per piece of the vocabulary at most
            expected[r[0]] += r[1]
        lattice = Lattice(pieces, expected, 1.0)
    return lattice


class Heavy:
    """The words of a share of ``1 / HEAVY`` or more, sorted by hash."""

    def __init__(self, h: np.ndarray, c: np.ndarray, lattice: Lattice, log10: np.ndarray, tokens: int, distinct: int,
                 ends: int):
        order = np.argsort(h)
        divisor, new = tokens + ADD * (distinct + 1), max(1, distinct)
        self.hash = np.append(h[order], np.uint64(2**64 - 1))     # a guard for searches past the last
        self.base = np.append(np.log10((c[order] + ADD) / divisor), 0.0)
        self.log10 = np.append(np.log10((c[order] + new * 10.0 ** log10[order]) / (tokens + new)), 0.0)
        self.known = len(order)
        self.lattice, self.ends = lattice, ends
        self.end_base = math.log10((ends + ADD) / divisor)
        self.end = math.log10((ends + new * math.exp(lattice.end)) / (tokens + new))


_SCORED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                        T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType()),
                        T.StructField("rare", T.ArrayType(T.LongType())),
                        T.StructField("spelled", T.ArrayType(T.DoubleType()))])


def _score(rows: DataFrame, text: str, sent) -> DataFrame:
    keep = [f for f in rows.schema.fields if f.name != text]
    schema = T.StructType([*keep, *_SCORED.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy: Heavy = sent.value
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                data, offsets = texts(part.column(text))
                w = Words(data, offsets, lower=True)
                n = part.num_rows
                of = np.repeat(np.arange(n), w.counts)
                at = np.searchsorted(heavy.hash[:heavy.known], w.hash)
                frequent = (heavy.hash[at] == w.hash) & (at < heavy.known)
                at[~frequent] = heavy.known
                rare = np.flatnonzero(~frequent)
                h, first, back = np.unique(w.hash[rare], return_index=True, return_inverse=True)
                spelled = heavy.lattice.words(_LOWER[data], w.start[rare[first]], w.end[rare[first]]) / math.log(10)
                lists = np.zeros(n + 1, np.int32)
                np.cumsum(np.bincount(of[rare], minlength=n), out=lists[1:])
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(f.name) for f in keep], pa.array(w.counts + 1),
                     pa.array(np.bincount(of, frequent, n).astype(np.int64) + (heavy.ends > 0)),
                     pa.array(np.bincount(of, heavy.base[at], n) + heavy.end_base),
                     pa.array(np.bincount(of, heavy.log10[at], n) + heavy.end),
                     pa.ListArray.from_arrays(pa.array(lists), pa.array(w.hash[rare].view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(lists), pa.array(spelled[back]))],
                    names=schema.names)

    return rows.mapInArrow(run, schema)


def _hashed(counts: DataFrame, sent=None) -> DataFrame:
    """``(h, c)`` of counted words, and their lattice ``log10`` if a lattice is sent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            data, offsets = texts(batch.column(0))
            w = Words(data, offsets)
            columns = [pa.array(w.hash.view(np.int64)), batch.column(1)]
            if sent is not None:
                columns.append(pa.array(sent.value.words(data, offsets[:-1], offsets[1:]) / math.log(10)))
            yield pa.RecordBatch.from_arrays(columns, names=["h", "c", "log10"][:len(columns)])

    return counts.mapInArrow(run, "h long, c long" + (", log10 double" if sent is not None else ""))


def score_documents(docs: DataFrame, train: Column, held_out: Column, id_col: str = "doc_id", text: str = "text",
                    path: str = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """Token counts, base score and lattice score of every text, learning from the rows of ``train``."""
    spark = docs.sparkSession
    pieces, weights = vocabulary(path)
    learnt = docs.where(F.coalesce(train, F.lit(False)))
    counts = stored(word_counts(learnt, text), "words")
    ends = learnt.count()
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = totals[0] + ends, totals[1] + (ends > 0)
    divisor = tokens + ADD * (distinct + 1)
    lattice = _fit(counts, ends, pieces, weights, rounds)
    least = tokens / HEAVY
    sent = spark.sparkContext.broadcast(lattice)
    top = _hashed(counts.where(F.col("c") >= least), sent).toArrow()
    column = lambda k: top.column(k).to_numpy()
    heavy = Heavy(column("h").astype(np.int64).view(np.uint64), column("c").astype(np.int64), lattice,
                  column("log10").astype(float), tokens, distinct, ends)
    rows = docs.select(id_col, F.coalesce(held_out, F.lit(False)).alias("held_out"), text,
                       F.monotonically_increasing_id().alias("_row"))
    scored = stored(_score(rows, text, spark.sparkContext.broadcast(heavy)), "scored")
    light = _hashed(counts.where(F.col("c") < least))
    new = max(1, distinct)
    spelled = F.col("r.spelled")
    word = (F.when(F.col("c").isNull(), spelled + math.log10(new / (tokens + new)))
            .otherwise(F.log10((F.col("c") + new * F.pow(F.lit(10.0), spelled)) / (tokens + new))))
    met = (scored.select("_row", F.explode(F.arrays_zip("rare", "spelled")).alias("r"))
           .select("_row", F.col("r.rare").alias("h"), "r").join(light, "h", "left")
           .groupBy("_row").agg(F.sum(F.log10((F.coalesce("c", F.lit(0)) + ADD) / F.lit(divisor))).alias("_base"),
                                F.count("c").alias("_known"), F.sum(word).alias("_score")))
    return scored.drop("rare", "spelled").join(met, "_row", "left").select(
        id_col, "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("_score", F.lit(0.0))).alias("score"))
