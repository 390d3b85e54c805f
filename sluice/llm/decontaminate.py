"""Operator 6: size-partitioned MinHash containment search for benchmark leaks.

A test item leaks into a document if at least ``CONTAINMENT`` of the item's
distinct shingles (``SHINGLE`` words, A-Z lower-cased) occur in the document,
wherever they stand.  A Jaccard sketch of a long document says nothing about a
short item, so items are partitioned by size and each keeps a bottom-k MinHash
sketch: its ``k`` least shingle hashes, with ``k = m - ceil(c * m) + 1`` for
``m`` shingles.  A document that misses all ``k`` lacks too many shingles to
hold the item, so no leak is lost.  Documents are sketched for each partition
by their hashes up to the partition's largest kept hash; a shared hash makes a
candidate, which exact comparison of the shingles' text then accepts or not.

Items are few against documents.  They are read in blocks of ``BLOCK_BYTES`` of
text, and only one block is held by the driver and sent to the tasks at a time;
with several, each block's step is stored and the block destroyed before the
next is read.  Documents are never shuffled.

Defined cases: a null or empty text, and one of fewer than five words, has no
shingle: such an item never leaks and such a document never holds one; null ids
are kept as they are; repeated items and repeated documents are each reported;
an empty table on either side gives no leaks; other columns are ignored (by
``leaks``) or passed through untouched (by ``decontaminate``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, grams, importable, slices, stored, texts

SHINGLE = 5
CONTAINMENT = 0.8
BLOCK_BYTES = 8 << 20


def _least(m: int, containment: float) -> int:
    """Shingles of ``m`` that a document must hold."""
    return max(1, math.ceil(containment * m - 1e-9))


def _shingles(data: bytes, n: int) -> list[bytes]:
    words = data.lower().split()
    return list(dict.fromkeys(b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)))


class Sketches:
    """Bottom-k sketches of one block of items, partitioned by size."""

    def __init__(self, items: list[tuple], n: int, containment: float):
        self.n, self.items, self.parts = n, [], []
        by_size: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item_id, text in items:
            data = (text or "").encode()
            shingles = _shingles(data, n)
            if not shingles:
                continue
            need = _least(len(shingles), containment)
            words = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), lower=True)
            kept = np.unique(grams(words, n)[0])[:len(shingles) - need + 1]
            by_size.setdefault(len(shingles).bit_length(), []).append((kept, len(self.items)))
            self.items.append((item_id, shingles, need))
        for group in by_size.values():
            hashes = np.concatenate([h for h, _ in group])
            owner = np.concatenate([np.full(len(h), i) for h, i in group])
            order = np.argsort(hashes, kind="stable")
            self.parts.append((hashes[order], owner[order], min(self.items[i][2] for _, i in group)))

    def candidates(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """``(document, item)`` pairs that share a sketch hash."""
        g, of = grams(Words(data, offsets, lower=True), self.n)
        size = np.bincount(of, minlength=len(offsets) - 1)
        found = []
        for hashes, owner, need in self.parts:
            near = np.flatnonzero((g <= hashes[-1]) & (size[of] >= need))
            lo = np.searchsorted(hashes, g[near], "left")
            hits = np.searchsorted(hashes, g[near], "right") - lo
            some = hits > 0
            lo, hits, doc = lo[some], hits[some], of[near[some]]
            at = np.repeat(lo - np.cumsum(hits) + hits, hits) + np.arange(hits.sum())
            found.append(np.stack([np.repeat(doc, hits), owner[at]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def leaks(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """``(document, item, shared shingles)``: candidates that exact containment accepts."""
        found, at, line = [], -1, b""
        for doc, item in self.candidates(data, offsets).tolist():
            if doc != at:
                at = doc
                line = b" " + b" ".join(data[offsets[doc]:offsets[doc + 1]].tobytes().lower().split()) + b" "
            _, shingles, need = self.items[item]
            shared = sum(b" " + s + b" " in line for s in shingles)
            if shared >= need:
                found.append((doc, item, shared))
        return found


def _blocks(items: DataFrame, id_col: str, text: str, n: int, containment: float) -> tuple[int, Iterator[Sketches]]:
    """How many blocks the items make, and their sketches; a block is collected when it is asked for."""
    size = items.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    count = max(1, math.ceil(size / BLOCK_BYTES))
    block = F.pmod(F.xxhash64(id_col, text), F.lit(count))

    def one(b: int) -> Sketches:
        rows = items.where(block == b).select(id_col, text).collect()
        return Sketches([(r[0], r[1]) for r in rows], n, containment)

    return count, map(one, range(count))


def _each(docs: DataFrame, blocks: tuple[int, Iterator[Sketches]], step: Callable, chained: bool) -> list[DataFrame]:
    """``step(docs, sent block)`` for every block, each on the last one's result if ``chained``.

    A lone block is sent and its step left to the caller's job.  Of several only
    one is held at a time: its step is stored and the block destroyed before the
    next is collected.
    """
    count, sketches = blocks
    done = []
    for one in sketches:
        sent = docs.sparkSession.sparkContext.broadcast(one)
        out = step(docs, sent)
        if count > 1:
            out = stored(out, "decontaminate")
            sent.destroy()
        done.append(out)
        docs = out if chained else docs
    return done


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", shingle: int = SHINGLE, containment: float = CONTAINMENT) -> DataFrame:
    """``(id, item id, item_shingles, shared, containment)`` of every leak."""
    importable(docs.sparkSession)
    fields = [docs.schema[id_col], items.schema[item_id]]
    schema = T.StructType([*fields, T.StructField("item_shingles", T.LongType()), T.StructField("shared", T.LongType()),
                           T.StructField("containment", T.DoubleType())])

    def step(rows: DataFrame, sent) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = sent.value
            arrow = None
            for batch in batches:
                for part in slices(batch, text):
                    found = index.leaks(*texts(part.column(text)))
                    if not found:
                        continue
                    doc, item, shared = zip(*found)
                    m = [len(index.items[i][1]) for i in item]
                    arrow = arrow or pa.array([x[0] for x in index.items]).type
                    yield pa.RecordBatch.from_arrays(
                        [part.column(id_col).take(pa.array(doc)), pa.array([index.items[i][0] for i in item], arrow),
                         pa.array(m, pa.int64()), pa.array(shared, pa.int64()),
                         pc.divide(pa.array(shared, pa.float64()), pa.array(m, pa.float64()))], names=schema.names)

        return rows.mapInArrow(run, schema)

    blocks = _blocks(items, item_id, item_text, shingle, containment)
    first, *rest = _each(docs.select(id_col, text), blocks, step, False)
    for part in rest:
        first = first.union(part)
    return first


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", shingle: int = SHINGLE, containment: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    importable(docs.sparkSession)

    def step(rows: DataFrame, sent) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text):
                    clean = np.ones(part.num_rows, bool)
                    clean[[doc for doc, _, _ in sent.value.leaks(*texts(part.column(text)))]] = False
                    yield part.filter(pa.array(clean))

        return rows.mapInArrow(run, rows.schema)

    return _each(docs, _blocks(items, item_id, item_text, shingle, containment), step, True)[-1]
