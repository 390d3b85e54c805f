"""Operator 1: quality classifier on random-indexing word vectors.

Word vectors.  Every word has a sparse random index vector (``NONZERO`` signs in
``DIM`` places, drawn from its hash); a word's vector is the sum of the index
vectors of the words up to ``REACH`` places from it, over all documents.  Words
share ``BUCKETS`` vectors by hash, so the table's size is fixed; each task adds
up its own and the tables are summed by bucket.  Vectors lose the mean of all
occurrences and get unit length.

Pooling.  A document is the mean, the standard deviation and the mean absolute
step from word to word of its words' vectors, with the logarithm of their number:
what its words are like, how much they vary, and how they follow each other.

Network.  A two-layer numpy network on at most ``PER_CLASS`` labelled documents
of each label (those of least id hash, with texts of at most ``MAX_BYTES``);
``ASIDE`` of them set the temperature of its probabilities.

Defined cases: a null, empty or blank text pools to zeros and is scored as
such; a null id is scored, never learnt from and ``held_out`` false; ids with a
null label or labelled both ways are not learnt from; without both labels every
score is ``NO_MODEL``; repeated rows are scored each; an empty table gives an
empty result; other columns are not read (by ``score_quality``) or passed
through (by ``keep_good``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, mix, slices, texts
from .nets import TwoLayer
from .samples import labelled, rows_of

BUCKETS = 1 << 14
DIM = 32
NONZERO = 4
REACH = 2
PER_CLASS = 8000
MAX_BYTES = 1 << 18
FEATURES = 3 * DIM + 1
ASIDE = 0.2
DECISION = 0.3
NO_MODEL = 1.0
_SLICE = 1 << 19            # bytes of text that a task works on at a time: its arrays take some fifty times as much


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(40)).astype(np.int64) % BUCKETS


def _index(h: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Places and signs of the index vectors of word hashes."""
    x = mix(h ^ np.uint64(0x5851F42D4C957F2D))
    bits = (DIM - 1).bit_length()
    place = [((x >> np.uint64(16 * k)) & np.uint64(DIM - 1)).astype(np.int64) for k in range(NONZERO)]
    sign = [1.0 - 2.0 * ((x >> np.uint64(16 * k + bits)) & np.uint64(1)).astype(np.float64) for k in range(NONZERO)]
    return place, sign


def add_contexts(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Add to ``table`` (buckets x (1 + DIM); column 0 counts words) the contexts of a run of texts."""
    w = Words(data, offsets)
    if not len(w.hash):
        return
    of = np.repeat(np.arange(len(w.counts)), w.counts)
    bucket = _bucket(w.hash)
    table[:, 0] += np.bincount(bucket, minlength=BUCKETS)
    place, sign = _index(w.hash)
    sums = np.zeros(BUCKETS * DIM)
    for step in range(1, min(REACH, len(of) - 1) + 1):
        near = np.flatnonzero(of[step:] == of[:-step])
        for a, b in ((near, near + step), (near + step, near)):
            base = bucket[a] * DIM
            for k in range(NONZERO):
                sums += np.bincount(base + place[k][b], sign[k][b], BUCKETS * DIM)
    table[:, 1:] += sums.reshape(BUCKETS, DIM)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The unit word vectors by bucket, from all documents.  The result has a fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((BUCKETS, 1 + DIM))
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                add_contexts(table, *texts(part.column(text)))
        used = np.flatnonzero(table[:, 0])
        rows = np.ascontiguousarray(table[used], np.float32)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([r.tobytes() for r in rows], pa.binary())],
                                         names=["bucket", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = np.frombuffer(v, np.float32).astype(np.float64)
                total[k] = total[k] + row if k in total else row
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()),
                                          pa.array([r.tobytes() for r in total.values()], pa.binary())], names=["bucket", "v"])

    schema = "bucket long, v binary"
    parts = min(BUCKETS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(text).mapInArrow(run, schema).repartition(parts, "bucket").mapInArrow(add, schema).collect()
    table = np.zeros((BUCKETS, 1 + DIM))
    for r in rows:                      # one row per bucket
        table[r[0]] = np.frombuffer(r[1], np.float64)
    words = max(1.0, table[:, 0].sum())
    contexts = table[:, 1:] / np.maximum(1.0, table[:, :1])
    contexts -= (contexts * table[:, :1]).sum(axis=0) / words
    contexts[table[:, 0] == 0] = 0.0
    return (contexts / np.maximum(1e-9, np.linalg.norm(contexts, axis=1, keepdims=True))).astype(np.float32)


def pooled(vectors: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Pooled features of every text of a run."""
    w = Words(data, offsets)
    out = np.zeros((len(w.counts), FEATURES), np.float32)
    if not len(w.hash):
        return out
    v = vectors.take(_bucket(w.hash), axis=0, mode="clip")
    one = np.ones(max(1, int(w.counts.max())), np.float32)
    ends = np.cumsum(w.counts)
    for i in np.flatnonzero(w.counts).tolist():
        k = int(w.counts[i])
        x = v[ends[i] - k:ends[i]]
        step = x[1:] - x[:-1]
        np.abs(step, out=step)
        mean = one[:k] @ x / k
        out[i, :DIM] = mean
        out[i, DIM:2 * DIM] = np.sqrt(np.maximum(0, one[:k] @ (x * x) / k - mean * mean))
        out[i, 2 * DIM:3 * DIM] = one[1:k] @ step / max(1, k - 1)
        out[i, 3 * DIM] = np.log1p(k)
    return out


class Model:
    def __init__(self, vectors: np.ndarray, x: np.ndarray, y: np.ndarray, aside: np.ndarray):
        self.vectors = vectors
        self.net = TwoLayer(x, y, aside) if len(np.unique(y[~aside])) == 2 else None

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.net is None:
            return np.full(len(offsets) - 1, NO_MODEL)
        return self.net.probability(pooled(self.vectors, data, offsets))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text",
        label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Word vectors of all documents and a network fitted on the bounded labelled sample."""
    spark = docs.sparkSession
    vectors = word_vectors(docs, text)
    sent = spark.sparkContext.broadcast(vectors)
    rows = rows_of(docs.select(id_col, text), labelled(labels, label, learn, per_class, id_col), text, MAX_BYTES, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                x = pooled(sent.value, *texts(part.column(text)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1),
                                                  pa.array([r.tobytes() for r in x], pa.binary())], names=["o", "y", "x"])

    # Rows of one id share its place in the order; a repeated id may bring more rows than labels.
    taken = rows.select("_order", "y", text).mapInArrow(run, "o long, y int, x binary").limit(4 * per_class).collect()
    taken = sorted(taken, key=lambda r: (r.o, bytes(r.x)))
    order = np.array([r.o for r in taken], np.int64)
    x = np.array([np.frombuffer(bytes(r.x), np.float32) for r in taken]).reshape(len(taken), FEATURES)
    aside = (order.view(np.uint64) >> np.uint64(11)) % np.uint64(1000) < ASIDE * 1000
    return Model(vectors, x, np.array([r.y for r in taken], np.int64), aside)


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, held_out: Column, id_col: str = "doc_id",
                  text: str = "text", label: str = "quality") -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(fit(docs, labels, learn, id_col, text, label))
    rows = docs.select(id_col, F.coalesce(held_out, F.lit(False)).alias("held_out"), text)
    fields = [f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}", "held_out boolean", "score double", "predicted int"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                score = sent.value.score(*texts(part.column(text)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), part.column("held_out"), pa.array(score),
                     pa.array((score >= DECISION).astype(np.int32))], names=[id_col, "held_out", "score", "predicted"])

    return rows.mapInArrow(run, ", ".join(fields))


def keep_good(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text",
              label: str = "quality", decision: float = DECISION) -> DataFrame:
    """The rows of ``docs`` that score ``decision`` or more."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, learn, id_col, text, label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                yield part.filter(pa.array(sent.value.score(*texts(part.column(text))) >= decision))

    return docs.mapInArrow(run, docs.schema)
