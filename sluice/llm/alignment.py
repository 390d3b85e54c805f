"""Operator 11: align the tokens that two tokenizers make of the same texts.

Method.  Both tokenizers encode one space and the text.  Each token list is
turned into a dictionary from the byte offset at which a token ends to its
index; the hash-set intersection of the two key sets holds the offsets where
tokens of both end.  Sorted, they slice both id lists into groups, and inside a
slice two pointers expand the links: the pairs of tokens whose bytes overlap.

Texts are encoded in pieces cut at single spaces between two characters that
are not white space.  No token of either vocabulary crosses such a place (the
byte-level pattern never takes a space after another character, and a piece
vocabulary that has a piece with an inner space mark is not cut), so pieces can
be encoded apart and put together again, and a piece that came before need not be
encoded again: workers keep the pieces they have met in a table of bounded size.

Corpus-wide counts.  One pass stores each text's distinct id pairs with their
number.  They are summed in every task before the shuffle.  Pairs that hold a
share of ``1 / HEAVY`` of all links or more, ``HEAVY`` at most, are sent to the
tasks together with the highest count of each B id (bounded by the vocabulary);
links of other pairs, each with few rows, are joined with the counts by shuffle.

Defined cases: a text that is null or empty, or that either tokenizer does not
give back byte for byte (such as one with U+2581), has no tokens: zeros and an
empty digest.  Special tokens' strings inside texts are ordinary text.  A null
id is kept; repeated rows count each; an empty table gives an empty result;
other columns are not read.  One piece without a cut is encoded as a whole,
whatever its length.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable, stored

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
HEAVY = 1 << 20          # pairs sent to the tasks, at most
PIECES = 1 << 19         # pieces that a worker keeps
PACKED = 4096            # characters encoded in one call
SLICE_BYTES = 1 << 19    # text worked on at a time
PARTIAL = 1 << 21        # summed pairs that a task holds

_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARK = "▁"


class ByteTokenizer:
    """A byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.encoder.encode_special_tokens = True
        # Byte-level alphabet: printable bytes stand for themselves, the others for U+0100 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(plain)]
        of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        names = {i: t for t, i in self.encoder.get_vocab(with_added_tokens=False).items()}
        self.size = max(names, default=-1) + 1
        self.bytes = [bytes(of[c] for c in names[i]) if i in names else b"" for i in range(self.size)]
        self.crosses = False

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.encoder.encode_batch([" " + t for t in texts], add_special_tokens=False)]


class PieceTokenizer:
    """A ``sentencepiece`` model; it puts the space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.encoder = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.encoder.get_piece_size()
        names = [self.encoder.id_to_piece(i) for i in range(self.size)]
        self.bytes = [bytes([int(n[3:5], 16)]) if self.encoder.is_byte(i) else n.replace(_MARK, " ").encode()
                      for i, n in enumerate(names)]
        self.crosses = any(_MARK in n.lstrip(_MARK) for n in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.encoder.encode(texts, num_threads=1)


_LOADED: dict[str, object] = {}


def tokenizer(path: str):
    """The tokenizer of a file, loaded once in a worker: ``.model`` is a piece model, else byte-level JSON."""
    if path not in _LOADED:
        _LOADED[path] = (PieceTokenizer if path.endswith(".model") else ByteTokenizer)(path)
    return _LOADED[path]


def common_slices(a_lengths: list[int], b_lengths: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Groups ``(end, a_start, a_stop, b_start, b_stop)`` of two token lists over the same bytes."""
    a_ends = dict(zip(accumulate(a_lengths), count(1)))
    b_ends = dict(zip(accumulate(b_lengths), count(1)))
    i = j = 0
    groups = []
    for end in sorted(a_ends.keys() & b_ends.keys()):
        to_i, to_j = a_ends[end], b_ends[end]
        groups.append((end, i, to_i, j, to_j))
        i, j = to_i, to_j
    return groups


def overlaps(a_lengths: list[int], b_lengths: list[int]) -> list[tuple[int, int]]:
    """Index pairs of the tokens of one group whose bytes overlap; only its last ends are common."""
    links, x, y, a, b = [], 0, 0, a_lengths[0], b_lengths[0]
    while True:
        links.append((x, y))
        if a < b:                # the token that ends first makes way for its successor
            x += 1
            a += a_lengths[x]
        elif b < a:
            y += 1
            b += b_lengths[y]
        else:
            return links


class Pieces:
    """Aligned pieces of texts, each kept under a number."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.cut = not (a.crosses or b.crosses)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str | None] = []      # None: the tokens do not give the text back
        self.sizes = array("q")                 # tokens of A, of B, groups
        self.links = array("q")                 # linked id pairs of all pieces, one after the other
        self.ends = array("q", [0])             # where each piece's links end

    def split(self, text: str) -> list[str]:
        return _CUT.split(text) if self.cut else [text]

    def learn(self, pieces: list[str]) -> None:
        """Encode and align pieces that are not known."""
        fresh = [p for p in dict.fromkeys(pieces) if p not in self.known]
        packs: list[list[str]] = []
        room = 0
        for p in fresh:
            # At white space at an end, or a literal mark, the next piece could run on.
            if _MARK in p or not self.cut or p[0].isspace() or p[-1].isspace():
                packs.append([p])
                room = 0
                continue
            if room < len(p) + 1:
                packs.append([])
                room = max(PACKED, len(p) + 1)
            packs[-1].append(p)
            room -= len(p) + 1
        lines = [" ".join(p) for p in packs]
        for pack, line, a, b in zip(packs, lines, self.a.encode(lines), self.b.encode(lines)):
            self._place(pack, line, a, b)

    def _place(self, pack: list[str], line: str, a: list[int], b: list[int]) -> None:
        whole = b" " + line.encode()
        a_bytes, b_bytes = [self.a.bytes[i] for i in a], [self.b.bytes[i] for i in b]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            if len(pack) == 1:
                self._keep(pack[0], None, 0, 0, [])
                return
            for p in pack:                       # one of them is at fault
                self._place([p], p, self.a.encode([p])[0], self.b.encode([p])[0])
            return
        a_lengths, b_lengths = [*map(len, a_bytes)], [*map(len, b_bytes)]
        a_words, b_words, size = [*map(str, a)], [*map(str, b)], self.b.size
        todo = iter(pack)
        piece = next(todo)
        # A piece ends where its bytes do; that is a common end.
        stop, said, codes, first_a, first_b = 1 + len(piece.encode()), [], [], 0, 0
        for end, i, k, j, m in common_slices(a_lengths, b_lengths):
            if k - i == 1:
                first = a[i] * size
                if m - j == 1:
                    codes.append(first + b[j])
                    said.append(f"{a_words[i]}|{b_words[j]}")
                else:
                    codes += [first + y for y in b[j:m]]
                    said.append(f"{a_words[i]}|{','.join(b_words[j:m])}")
            else:
                if m - j == 1:
                    codes += [x * size + b[j] for x in a[i:k]]
                else:
                    codes += [a[i + x] * size + b[j + y] for x, y in overlaps(a_lengths[i:k], b_lengths[j:m])]
                said.append(f"{','.join(a_words[i:k])}|{','.join(b_words[j:m])}")
            if end == stop:
                self._keep(piece, said, k - first_a, m - first_b, codes)
                said, codes, first_a, first_b = [], [], k, m
                piece = next(todo, "")
                stop += 1 + len(piece.encode())

    def _keep(self, piece: str, said: list[str] | None, n_a: int, n_b: int, codes: list[int]) -> None:
        self.known[piece] = len(self.groups)
        self.sizes.extend((n_a, n_b, len(said or ())))
        self.links.extend(codes)
        self.ends.append(len(self.links))
        self.groups.append(None if said is None else ";".join(said))

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes, links and their ends as views; let go of them before the tables grow on."""
        return (np.frombuffer(self.sizes, np.int64).reshape(-1, 3), np.frombuffer(self.links, np.int64),
                np.frombuffer(self.ends, np.int64))


_PIECES: dict[tuple[str, str], Pieces] = {}


def known_pieces(path_a: str, path_b: str) -> Pieces:
    """The pieces that this worker has met with two tokenizers, in whatever task."""
    if (path_a, path_b) not in _PIECES:
        _PIECES[path_a, path_b] = Pieces(tokenizer(path_a), tokenizer(path_b))
    return _PIECES[path_a, path_b]


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sum of each one's counts."""
    if len(codes) == 0:
        return codes, counts
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[first], np.add.reduceat(counts, first)


def _parts(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Row slices whose values of a text or binary column hold about ``max_bytes``; a longer value is alone."""
    stops = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(stops):
        before = stops[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(stops, before + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def align_texts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path_a: str = TOKENIZER_A,
                path_b: str = TOKENIZER_B, digest: bool = False) -> DataFrame:
    """One row per text: ``_row`` (its place), id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``, ``pairs``, ``times``.

    ``groups`` writes the groups as ``a1,a2|b1;a3|b2,b3`` (ids in order; null:
    no tokens); with ``digest`` it is the SHA-256 of that.  ``pairs`` holds the
    distinct linked id pairs ``a * |B| + b`` as little-endian 64-bit numbers in
    order, ``times`` how often each is linked, as 32-bit numbers.
    """
    importable(docs.sparkSession)
    schema = T.StructType([T.StructField("_row", T.LongType()), docs.schema[id_col]]
                          + [T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]
                          + [T.StructField("groups", T.StringType()), T.StructField("pairs", T.BinaryType()),
                             T.StructField("times", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = known_pieces(path_a, path_b)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in _parts(batch, text, SLICE_BYTES):
                if len(pieces.groups) > PIECES:
                    pieces.forget()
                rows = [[] if not t else pieces.split(t) for t in part.column(text).to_pylist()]
                pieces.learn([p for row in rows for p in row])
                known = pieces.known
                sizes, links, ends = pieces.tables()
                done = []
                for row in rows:
                    slots = [known[p] for p in row]
                    said = [pieces.groups[s] for s in slots]
                    if not slots or None in said:
                        done.append((0, 0, 0, 0, None, b"", b""))
                        continue
                    joined = ";".join(said)
                    slot, times = np.unique(np.array(slots), return_counts=True)
                    width = ends[slot + 1] - ends[slot]
                    within = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
                    codes, counts = summed(links[np.repeat(ends[slot], width) + within], np.repeat(times, width))
                    n = times @ sizes[slot]
                    done.append((*n.tolist(), int(counts.sum()),
                                 hashlib.sha256(joined.encode()).hexdigest() if digest else joined,
                                 codes.astype("<i8").tobytes(), counts.astype("<u4").tobytes()))
                del sizes, links, ends
                n = len(rows)
                columns = list(zip(*done))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + n)), part.column(id_col)]
                    + [pa.array(c, pa.int64()) for c in columns[:4]]
                    + [pa.array(columns[4], pa.string()), pa.array(columns[5], pa.binary()), pa.array(columns[6], pa.binary())],
                    names=schema.names)
                number += n

    return docs.select(id_col, text).mapInArrow(run, schema)


def _links(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, counts and row numbers in the batch of all stored pairs."""
    codes = [np.frombuffer(v.as_py(), "<i8") for v in batch.column("pairs")]
    counts = [np.frombuffer(v.as_py(), "<u4") for v in batch.column("times")]
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return (np.concatenate(codes), np.concatenate(counts).astype(np.int64),
            np.repeat(np.arange(len(codes)), [*map(len, codes)]))


def _emit(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["pair", "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n)``: how many links of all texts hold each id pair; summed in the tasks first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for part in _parts(batch, "pairs", 1 << 22):
                c, n, _ = _links(part)
                codes, counts = summed(np.concatenate([codes, c]), np.concatenate([counts, n]))
                if len(codes) > PARTIAL:
                    yield _emit(codes, counts)
                    codes, counts = codes[:0], counts[:0]
        yield _emit(codes, counts)

    return aligned.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def align_corpus(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path_a: str = TOKENIZER_A,
                 path_b: str = TOKENIZER_B, digest: bool = True) -> DataFrame:
    """Every text's groups and how its links stand in the corpus.

    Beside the columns of :func:`align_texts` (without pairs): ``n_best``, the
    links whose pair is the commonest of its B id (ties included), and
    ``count_sum``, the corpus-wide counts of its links' pairs, added up.
    """
    spark = docs.sparkSession
    aligned = stored(align_texts(docs, id_col, text, path_a, path_b, digest), "aligned", compression="zstd")
    pairs = stored(pair_counts(aligned), "pairs")
    size_b = tokenizer(path_b).size
    b_id = F.col("pair") % size_b
    total = pairs.agg(F.sum("n")).first()[0] or 0
    best = np.zeros(size_b, np.int64)
    for row in pairs.groupBy(b_id.alias("b")).agg(F.max("n").alias("n")).toLocalIterator():
        best[row.b] = row.n
    heavy = pairs.where(F.col("n") * HEAVY >= total).toPandas().sort_values("pair")
    sent = spark.sparkContext.broadcast((heavy["pair"].to_numpy(np.int64), heavy["n"].to_numpy(np.int64), best))
    names = ["_row", id_col, "n_a", "n_b", "n_groups", "n_links", "groups"]
    schema = T.StructType([aligned.schema[c] for c in names] + [
        T.StructField("count_sum", T.LongType()), T.StructField("n_best", T.LongType()),
        T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("rare_n", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, most = sent.value
        for batch in batches:
            for part in _parts(batch, "pairs", 1 << 22):
                codes, times, of = _links(part)
                at = np.minimum(np.searchsorted(keys, codes), max(len(keys) - 1, 0))
                known = keys[at] == codes if len(keys) else np.zeros(len(codes), bool)
                c = counts[at[known]]
                # Whole numbers all through: weights of bincount would be floats.
                sums, bests = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                np.add.at(sums, of[known], c * times[known])
                np.add.at(bests, of[known], np.where(c == most[codes[known] % size_b], times[known], 0))
                offsets = pa.array(np.append(0, np.cumsum(np.bincount(of[~known], minlength=part.num_rows))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names] + [pa.array(sums), pa.array(bests),
                     pa.ListArray.from_arrays(offsets, pa.array(codes[~known])),
                     pa.ListArray.from_arrays(offsets, pa.array(times[~known]))], names=schema.names)

    scored = stored(aligned.mapInArrow(run, schema), "scored", compression="zstd")
    sent.destroy()
    most = pairs.groupBy(b_id.alias("_b")).agg(F.max("n").alias("_most"))
    standing = (pairs.where(F.col("n") * HEAVY < total).withColumn("_b", b_id).join(F.broadcast(most), "_b")
                .select("pair", "n", (F.col("n") == F.col("_most")).alias("_is_best")))
    rest = (scored.select("_row", F.inline(F.arrays_zip(F.col("rare").alias("pair"), F.col("rare_n").alias("_times"))))
            .join(standing, "pair").groupBy("_row")
            .agg(F.sum(F.col("n") * F.col("_times")).alias("_sum"),
                 F.sum(F.when(F.col("_is_best"), F.col("_times")).otherwise(0)).alias("_bests")))
    return (scored.drop("rare", "rare_n").join(rest, "_row", "left")
            .select(*names[1:], (F.col("n_best") + F.coalesce("_bests", F.lit(0))).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum")))
