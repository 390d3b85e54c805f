"""Operator 3: SimHash near-duplicates through a byte-position inverted index.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints within ``d``
bits differ in ``d`` bytes at most, so they share ``T = 8 - d`` positional
bytes: the guaranteed minimum of the count filter.  A posting list of one
positional byte holds 1/256 of all fingerprints, and merging such lists would
meet every pair, so the lists opened are those of several bytes together: the
eight positions fall into two halves, one of which holds ``ceil(T / 2)`` of
the shared bytes, and a list is kept for every such choice of positions in a
half (for ``d = 3``: eight lists of three bytes each, 2**24 values).  Inside a
list the shared positional bytes of each pair are tallied, pairs under ``T``
go, and the rest are verified by counting differing bits.

Defined cases: a null text is an empty text; a text without words has
fingerprint zero and links like any other; a null doc_id is fingerprinted and
linked but never becomes a ``component_id`` unless its whole component has
null ids (then it is null); rows that repeat are fingerprinted each; an empty
table gives an empty result; other columns are not read (``near_duplicates``) or
passed through (``keep_first``, but for columns named ``_fp`` or ``_row``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import blocks
from .common import others, stored, texts
from .graph import components

SHINGLE = 3          # words per shingle
MAX_BITS = 3         # fingerprints link at so many differing bits or fewer
SEED = 42
BLOCK = 4096         # fingerprints of one posting list compared in one row
_PIECE = 1 << 20     # bytes of a text tokenised at once

_GAP = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(data: bytes) -> Iterator[bytes]:
    """The text in pieces cut at white space, so that a very long text needs bounded memory."""
    at = 0
    while len(data) - at > _PIECE:
        cut = _GAP.search(data, at + _PIECE)
        if cut is None:
            break
        yield data[at:cut.start()]
        at = cut.start()
    yield data[at:]


def _votes(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def simhash(data: bytes, shingle: int = SHINGLE) -> int:
    """Majority SimHash of a UTF-8 text over XXH64 (seed 42) of its word shingles."""
    digest = xxhash.xxh64_intdigest
    ones, total, carry = np.zeros(64, np.int64), 0, []
    for piece in _pieces(data):
        words = carry + piece.lower().split()
        carry = words
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = (ends[:len(words) - shingle + 1] - [len(w) + 1 for w in words[:len(words) - shingle + 1]]).tolist()
            stops = (ends[shingle - 1:] - 1).tolist()
            h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, stops)), np.uint64, len(starts))
            ones += _votes(h)
            total += len(h)
            carry = words[len(words) - shingle + 1:]
    if total == 0:
        if not carry:
            return 0
        return digest(b" ".join(carry), SEED)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` and ``_fp``, the fingerprint as a signed long."""
    schema = T.StructType([*docs.schema.fields, T.StructField("_fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = texts(batch.column(text))
            raw = data.tobytes()
            fp = np.fromiter((simhash(raw[a:b], shingle) for a, b in zip(off[:-1].tolist(), off[1:].tolist())),
                             np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp.view(np.int64))],
                                             names=[*batch.schema.names, "_fp"])

    return docs.mapInArrow(run, schema)


def choices(max_bits: int) -> list[tuple[int, ...]]:
    """Choices of byte positions, one of which any two fingerprints within ``max_bits`` share."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be 0 to 7")
    least = 8 - max_bits
    each = -(-least // 2)
    return [c for half in (range(4), range(4, 8)) for c in combinations(half, each)]


def _masks(max_bits: int) -> list[int]:
    masks = [sum(0xFF << (8 * p) for p in c) for c in choices(max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among ``fp`` (breadth first)."""
    left = np.arange(len(fp))
    edges = []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            u = queue.pop()
            x = fp[left] ^ fp[u]
            shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)        # the tally
            hit = shared >= 8 - max_bits                                        # the count filter
            hit[hit] = np.bitwise_count(x[hit]) <= max_bits                     # the verification
            found = left[hit].tolist()
            edges += [(u, v) for v in found]
            queue += found
            left = left[~hit]
    return edges


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: links among the distinct fingerprints ``_fp`` that span every class of them.

    Only a spanning forest of each posting-list block is returned: no link
    between classes is lost, and a group of ``m`` near copies gives some
    ``m`` rows and not ``m * m``.
    """
    lists = F.array(*[F.struct(F.lit(k).alias("k"), F.col("_fp").bitwiseAND(F.lit(m).cast("long")).alias("v"))
                      for k, m in enumerate(_masks(max_bits))])
    postings = distinct.select("_fp", F.explode(lists).alias("p")).select("_fp", "p.k", "p.v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            off = column.offsets.to_numpy()
            values = column.values.field(0).to_numpy().view(np.uint64)
            a, b = [], []
            for s, e in zip(off[:-1], off[1:]):
                fp = values[s:e]
                for u, v in forest(fp, max_bits):
                    a.append(fp[u])
                    b.append(fp[v])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)],
                                             names=["a", "b"])

    return blocks(postings, ["k", "v"], ["_fp"], BLOCK).select("members").mapInArrow(run, "a long, b long")


def classes(prints: DataFrame, id_col: str, max_bits: int = MAX_BITS) -> DataFrame:
    """``(_fp, _cls, component_id)`` for every distinct fingerprint of the stored ``prints``."""
    distinct = prints.groupBy("_fp").agg(F.min(id_col).alias("_least"))
    found = components(links(distinct.select("_fp"), max_bits))
    of = (distinct.join(found, distinct["_fp"] == found["node"], "left")
          .select("_fp", "_least", F.coalesce("component", "_fp").alias("_cls")))
    least = of.groupBy("_cls").agg(F.min("_least").alias("component_id"))
    return stored(of.select("_fp", "_cls").join(least, "_cls").select("_fp", "_cls", "component_id"), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """``(id, fingerprint, component_id)`` for every row of ``docs``."""
    prints = stored(fingerprints(docs.select(id_col, text), text, shingle).select(id_col, "_fp"), "prints")
    of = classes(prints, id_col, max_bits)
    return prints.join(of, "_fp", "left").select(
        F.col(id_col), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one row of each near-duplicate class: the one of the smallest id.

    Of rows that share that id, one stays.  Fingerprints and row numbers are
    written once with the rows, so that the choice holds for the very rows it
    was made for.
    """
    columns = others(docs, "_fp", "_row")
    whole = stored(fingerprints(docs.select(*columns), text, shingle)
                   .withColumn("_row", F.monotonically_increasing_id()), "rows")
    of = classes(whole.select(id_col, "_fp"), id_col, max_bits)
    narrow = whole.select(F.col(id_col).alias("_id"), "_fp", "_row")
    kept = (narrow.join(of, "_fp").groupBy("_cls")
            .agg(F.min(F.struct(F.col("_id").isNull().alias("n"), "_id", "_row")).alias("m")).select("m._row"))
    return whole.join(kept, "_row", "left_semi").select(*columns)
