"""Operator 4: document fingerprints by SimHash, and their search by permuted block tables.

A term is a pair of adjacent words (A-Z lower-cased; the word itself where a
text has one).  Every occurrence of a term votes with the sign of each bit of
its hash, weighted by the logarithm of the term's length: long terms are rarer
and tell more.  A bit of the 128-bit fingerprint is set where the votes are
positive.  The angle between two texts' term vectors is near ``pi * d / 128``
at ``d`` differing bits, so their likeness is ``max(0, cos(pi * d / 128))``.

Search: fingerprints are cut into ``radius + 1`` blocks or more; two within
``radius`` bits agree on ``blocks - radius`` of them, so a table is kept for
every such choice of blocks, keyed by their bits.  A query meets its table
buckets only, buckets without a query are not opened, and each pair is told by the
first table that holds it.  What is found are pairs of different fingerprints;
rows with equal ones are told by the least id among them, not expanded.

Defined cases: a null text is empty; a text without words has fingerprint zero;
equal texts have equal fingerprints; documents with the same id (or null, which
sorts first) follow each other in the order of a hash of their text; a single
document is its own next one; an empty table gives an empty result; columns
that clash with a result's name are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import blocks
from .common import Words, importable, mix, slices, stored, texts

BITS = 128
RADIUS = 8            # a likeness of 0.98; near copies of 0.8 in word shingles differ by 5 to 18 bits, 10 in the middle
CUTS = 10             # two blocks of ten agree: 45 tables keyed by 25 bits
BLOCK = 4096
_SECOND = np.uint64(0xA0761D6478BD642F)
_SIGNS = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little") * 2.0 - 1.0)


def simhashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``(texts, 2)`` 64-bit halves of the fingerprint of every text of a run."""
    w = Words(data, offsets, lower=True)
    n = len(offsets) - 1
    of = np.repeat(np.arange(n), w.counts)
    length = (w.end - w.start).astype(np.float64)
    pair = of[1:] == of[:-1]
    alone = w.counts[of] == 1
    h = np.concatenate([mix(w.hash[:-1][pair] * np.uint64(0x9E3779B97F4A7C15) + w.hash[1:][pair]), w.hash[alone]])
    doc = np.concatenate([of[:-1][pair], of[alone]])
    weight = np.log1p(np.concatenate([length[:-1][pair] + length[1:][pair], length[alone]]))
    out = np.zeros((n, BITS // 8), np.uint8)
    for half, hashes in enumerate((h, mix(h ^ _SECOND))):
        for k in range(8):
            byte = (hashes >> np.uint64(8 * k)).astype(np.int64) & 0xFF
            votes = np.bincount(doc * 256 + byte, weight, n * 256).reshape(n, 256) @ _SIGNS
            out[:, half * 8 + k] = np.packbits(votes > 1e-9, axis=1, bitorder="little")[:, 0]
    return out.view(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = np.bitwise_count(a ^ b).sum(axis=1)
    return np.clip(np.cos(np.pi * d / BITS), 0.0, 1.0)


_RESULT = T.StructType([
    T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
    T.StructField("_hi", T.LongType()), T.StructField("_lo", T.LongType()),
    T.StructField("_ehi", T.LongType()), T.StructField("_elo", T.LongType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def _edited(text: str, following: str) -> bytes:
    """The text with its last quarter replaced by the beginning of the following one."""
    q = len(text) // 4
    return (text[:len(text) - q] + following[:q]).encode()


def _compare(texts_: list[str], following: list[str]) -> list[pa.Array]:
    """Result columns of texts and the texts that follow them."""
    def run(parts: list[bytes]) -> np.ndarray:
        return simhashes(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))

    edited = [_edited(a, b) for a, b in zip(texts_, following)]
    whole = [t.encode() for t in texts_]
    chain = len(texts_) > 1 and texts_[1:] == following[:-1]      # consecutive documents: hash each once
    own = run(whole + [following[-1].encode()] if chain else whole)
    after = own[1:] if chain else run([t.encode() for t in following])
    own, new = own[:len(whole)], run(edited)
    signed = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
    return [pa.array([len(t) for t in texts_], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
            signed(own[:, 0]), signed(own[:, 1]), signed(new[:, 0]), signed(new[:, 1]),
            pa.array(likeness(own, new)), pa.array(likeness(own, after))]


def with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses (stored).

    Texts are dealt into ranges of ascending id and sorted inside; a task meets
    each text with the one after it.  Only the last text of a range needs the
    first one of the following range: those two per range come back with their
    texts and are joined by range number in a second, small step.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), *_RESULT.fields,
                           T.StructField("_kind", T.IntegerType()), T.StructField("_range", T.IntegerType()),
                           T.StructField("_text", T.StringType())])
    empty = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), *[pa.int64()] * 4, pa.float64(), pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        held_id = held = None

        def edge(kind: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([held_id, *empty, pa.array([kind], pa.int32()),
                                               pa.array([number], pa.int32()), pa.array([held])], names=schema.names)

        for batch in batches:
            for part in slices(batch, text):
                ids, values = part.column(id_col), [t or "" for t in part.column(text).to_pylist()]
                if held is None:
                    held_id, held = ids.slice(0, 1), values[0]
                    yield edge(1)
                    ids, values = ids.slice(1), values[1:]
                if not values:
                    continue
                known = pa.concat_arrays([held_id, ids.slice(0, len(ids) - 1)])
                n = len(known)
                yield pa.RecordBatch.from_arrays(
                    [known, *_compare([held, *values[:-1]], values), pa.array(np.zeros(n, np.int32)),
                     pa.array(np.full(n, number, np.int32)), pa.nulls(n, pa.string())], names=schema.names)
                held_id, held = ids.slice(len(ids) - 1), values[-1]
        if held is not None:
            yield edge(2)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(id_col), F.xxhash64(text)]
    rows = stored(docs.select(id_col, text).repartitionByRange(parts, *order).sortWithinPartitions(*order)
                  .mapInArrow(run, schema), "fingerprints")
    heads = rows.where("_kind = 1").select("_range", F.col("_text").alias("_next"))
    tails = rows.where("_kind = 2").select(id_col, "_range", "_text")
    # One row per range, without texts: which range follows, the first after the last.
    ring = heads.select("_range").withColumn("_after", F.coalesce(
        F.lead("_range").over(Window.orderBy("_range")), F.min("_range").over(Window.partitionBy())))
    # Texts are of any length and their size in a file says little: neither side is broadcast.
    ends = (tails.join(ring.hint("merge"), "_range").join(heads.withColumnRenamed("_range", "_after").hint("merge"), "_after")
            .select(id_col, "_text", "_next"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [row.column(0), *_compare([row.column(1)[0].as_py()], [row.column(2)[0].as_py()])],
                    names=[id_col, *_RESULT.names])

    closing = ends.mapInArrow(close, T.StructType([schema.fields[0], *_RESULT.fields]))
    return rows.where("_kind = 0").select(id_col, *_RESULT.names).union(closing)


def tables(radius: int, cuts: int | None = None) -> list[tuple[int, int]]:
    """Masks (of the two halves) of the block choices that any two prints within ``radius`` share."""
    cuts = cuts or radius + 1
    edges = [BITS * i // cuts for i in range(cuts + 1)]
    spans = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(cuts)]
    masks = [sum(c) for c in combinations(spans, cuts - radius)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    return [(signed(m & (2**64 - 1)), signed(m >> 64)) for m in masks]


def neighbours(prints: DataFrame, radius: int = RADIUS, cuts: int = CUTS) -> DataFrame:
    """``(_hi, _lo, _fhi, _flo, bits)``: for every query print all other prints within ``radius`` bits, and how many differ.

    ``prints(_hi, _lo, _query)`` holds each fingerprint once.  A table's bucket is
    opened only if it holds a query print.
    """
    masks = tables(radius, cuts)
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.xxhash64(F.lit(t), F.col("_hi").bitwiseAND(F.lit(a).cast("long")),
                                                              F.col("_lo").bitwiseAND(F.lit(b).cast("long"))).alias("k"))
                     for t, (a, b) in enumerate(masks)])
    value = ["_hi", "_lo", "_query"]
    members = prints.select(*value, F.inline(keys))
    mask = np.array(masks, np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, bits = [np.zeros((0, 4), np.uint64)], [np.zeros(0, np.int64)]
            column = batch.column("members")
            off = column.offsets.to_numpy()
            hi, lo, asked, side = (column.values.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            prints_ = np.stack([hi, lo], axis=1).view(np.uint64)
            for t, same, s, e in zip(batch.column("t").to_pylist(), batch.column("same").to_pylist(), off[:-1], off[1:]):
                fp = prints_[s:e]
                for q in np.flatnonzero(asked[s:e]).tolist():
                    x = fp ^ fp[q]
                    differ = np.bitwise_count(x).sum(axis=1)
                    near = differ <= radius
                    near[q] = False
                    if not same:
                        near &= side[s:e] != side[s + q]
                    k = np.flatnonzero(near)
                    if len(k) and t:              # a pair is found in its first table only
                        k = k[((x[k, None, :] & mask[None, :t]) != 0).any(axis=2).all(axis=1)]
                    if len(k):
                        found.append(np.concatenate([np.repeat(fp[q:q + 1], len(k), axis=0), fp[k]], axis=1))
                        bits.append(differ[k].astype(np.int64))
            four = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(four[:, c])) for c in range(4)]
                                             + [pa.array(np.concatenate(bits))], names=["_hi", "_lo", "_fhi", "_flo", "bits"])

    return (blocks(members, ["t", "k"], value, BLOCK, "_query").select("t", "same", "members")
            .mapInArrow(run, "_hi long, _lo long, _fhi long, _flo long, bits long"))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS,
                          cuts: int = CUTS, every: int = 20) -> DataFrame:
    """Fingerprints and likenesses of all rows, and the search for ids divisible by ``every``.

    ``fingerprint_id`` is the least id of the rows with a row's fingerprint.  For
    the searched ids ``near_ids`` lists, in order, that id of every other
    fingerprint within ``radius`` bits, and ``n_within`` counts all rows within it,
    the row itself included; elsewhere both are null.
    """
    importable(docs.sparkSession)
    rows = stored(with_next(docs, id_col, text), "likenesses")
    query = F.coalesce(F.col(id_col) % every == 0, F.lit(False))
    prints = stored(rows.groupBy("_hi", "_lo").agg(F.count(F.lit(1)).alias("_n"), F.min(id_col).alias("_least"),
                                                   F.max(query).alias("_query")), "prints")
    pairs = stored(neighbours(prints, radius, cuts), "neighbours")
    found = prints.select(F.col("_hi").alias("_fhi"), F.col("_lo").alias("_flo"), F.col("_n").alias("_fn"), F.col("_least").alias("_fid"))
    near = (pairs.join(found, ["_fhi", "_flo"]).groupBy("_hi", "_lo")
            .agg(F.sort_array(F.collect_list("_fid")).alias("_near"), F.sum("_fn").alias("_more")))
    ids = docs.schema[id_col].dataType
    none = F.array().cast(T.ArrayType(ids))
    known = prints.join(near, ["_hi", "_lo"], "left").select(
        "_hi", "_lo", F.col("_least").alias("fingerprint_id"),
        F.when(F.col("_query"), F.coalesce("_near", none)).alias("_near"),
        F.when(F.col("_query"), F.col("_n") + F.coalesce("_more", F.lit(0))).alias("_within"))
    text_of = lambda a, b: F.concat(*[F.lpad(F.lower(F.hex(c)), 16, "0") for c in (a, b)])
    return rows.join(known, ["_hi", "_lo"]).select(
        id_col, "n_chars", "edited_sha256", text_of("_hi", "_lo").alias("fingerprint"),
        text_of("_ehi", "_elo").alias("edited_fingerprint"), "near_edited", "near_next", "fingerprint_id",
        F.when(query, F.col("_within")).alias("n_within"), F.when(query, F.col("_near")).alias("near_ids"))
