"""Operator 7: toxicity by a convolutional text classifier over hashed word embeddings.

Words (A-Z lower-cased, ASCII punctuation taken as white space) are looked up
in two embedding tables by two independent hashes, so that a rare word that
shares a bucket with a telling word in one table does not share it in the
other, and in a third by their first ``PREFIX`` bytes, so that inflected forms
of a word share what is learnt.  Filters of widths ``WIDTHS`` slide over the words of the whole text,
the largest response of each is kept, and two heads read them: toxic or not,
and the language (a training target only, learnt from the same rows).

Thresholds are calibrated by language: on training rows kept aside, each
language the network itself assigns gets the threshold with the best F1, and
probabilities are shifted (in log odds) so that this threshold becomes
``DECISION``.  Labels, language, source and id are no inputs of a score.

The network is trained on every labelled row of the learning part, with its whole
text; ``ASIDE`` of them, by id hash, calibrate instead.  The rows are dealt by id
into shards of about ``SHARD_ROWS`` rows or ``SHARD_BYTES`` of text.  An epoch is one
Spark job: each task starts from the shared network and its Adagrad sums and learns
from its shard, and the shards' parameters are averaged (each over the shards that
changed it), so what the driver gets has the size of the network.  One shard is plain
stochastic gradient descent.  Thresholds are found by running sums over the sorted
responses of all rows kept aside.

Defined cases: a null or empty text is scored as a text without words; a null
id is scored, never learnt from and ``held_out`` false; ids with a null label or
labelled both ways are not learnt from; without both labels every score is
``NO_MODEL``; repeated rows are scored each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .common import Words, importable, slices, texts
from .nets import Adagrad, TextCNN, softmax
from .samples import labelled

BUCKETS = 1 << 16
TABLES = 3
PREFIX = 4
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 16
EPOCHS = 6
RATE = 0.05
BATCH = 32
SHARD_ROWS = 48_000
SHARD_BYTES = 128 << 20
ASIDE = 0.2
DECISION = 0.7
SHRINK = 20           # toxic rows of a language at which its own threshold and the general one weigh the same
NO_MODEL = 0.0
EVERY = -1            # all languages together
SEED = 7
_BLOCK = 1 << 12      # parameters a row when shards are averaged
_BIN = 256            # bins a unit of log odds for running sums

_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[65:91] += 32
_CLEAN[[b for b in range(33, 127) if not chr(b).isalnum()]] = 0x20


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16 hash bits of every word for each table, and words per text."""
    w = Words(_CLEAN[data], offsets, prefix=PREFIX)
    return (w.hash & np.uint64(0xFFFFFFFF)) | ((w.prefix & np.uint64(0xFFFF)) << np.uint64(32)), w.counts


def flat(ids: np.ndarray, counts: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of a run of texts, each followed by ``pad`` empty rows; where each starts."""
    size = counts + pad
    starts = np.cumsum(size) - size
    out = np.full((int(size.sum()), TABLES), BUCKETS, np.int64)
    at = np.arange(len(ids)) + np.repeat(np.arange(len(counts)) * pad, counts)
    for k in range(TABLES):
        out[at, k] = (ids >> np.uint64(16 * k)) & np.uint64(0xFFFF)
    return out, starts


def _log_odds(p):
    return np.log(p) - np.log1p(-p)


def _learn(net: TextCNN, opt: Adagrad, ids: list[np.ndarray], toxic: np.ndarray, code: np.ndarray,
           balance: np.ndarray, epoch: int) -> None:
    """One pass over rows in the order of this epoch."""
    rng = np.random.default_rng(SEED)
    for _ in range(epoch):
        rng.permutation(len(ids))
    order = rng.permutation(len(ids))
    for at in range(0, len(order), BATCH):
        k = order[at:at + BATCH]
        run, starts = flat(np.concatenate([ids[i] for i in k]), np.array([len(ids[i]) for i in k]), net.pad)
        net.step(opt, run, starts, {"toxic": (toxic[k], balance[toxic[k]].astype(np.float32)),
                                    "lang": (code[k].clip(0), np.where(code[k] >= 0, 0.3, 0.0).astype(np.float32))})


class Model:
    """The trained network with a log-odds shift for every language it tells apart."""

    def __init__(self, ids: list[np.ndarray], toxic: np.ndarray, lang: list[str | None], aside: np.ndarray):
        """Trained on rows at hand; :func:`fit` does the same over shards of a table."""
        self._begin({x for x in lang if x is not None}, np.bincount(toxic[~aside], minlength=2))
        if self.net is None:
            return
        code, opt, rows = self._codes(lang), Adagrad(RATE), np.flatnonzero(~aside)
        for epoch in range(EPOCHS):
            _learn(self.net, opt, [ids[i] for i in rows], toxic[rows], code[rows], self.balance, epoch)
        self._calibrate([ids[i] for i in np.flatnonzero(aside)], toxic[aside])

    @classmethod
    def untrained(cls, languages: set[str], counts: np.ndarray) -> Model:
        """``counts``: rows to learn from that are not toxic, and toxic; without both there is no network."""
        model = cls.__new__(cls)
        model._begin(languages, counts)
        return model

    def _begin(self, languages: set[str], counts: np.ndarray) -> None:
        self.languages, self.net = sorted(languages), None
        self.shift = np.zeros(max(1, len(self.languages)))
        if counts.all():
            self.net = TextCNN([BUCKETS] * TABLES, DIM, WIDTHS, FILTERS, {"toxic": 2, "lang": len(self.shift)}, SEED)
            self.balance = counts.sum() / (2.0 * counts)

    def _codes(self, lang: list[str | None]) -> np.ndarray:
        place = {x: k for k, x in enumerate(self.languages)}
        return np.array([place.get(x, -1) for x in lang], np.int64)

    def _calibrate(self, ids: list[np.ndarray], toxic: np.ndarray) -> None:
        if not len(ids):
            return
        parts = [ids[k:k + 64] for k in range(0, len(ids), 64)]      # a few texts at a time
        raw = [self._raw(np.concatenate(p), np.array([len(i) for i in p])) for p in parts]
        odds, lang = np.concatenate([r[0] for r in raw]), np.concatenate([r[1] for r in raw])

        def threshold(rows: np.ndarray) -> float:
            """The middle of the gap at the best F1."""
            order = np.argsort(-odds[rows])
            z, y = odds[rows][order], toxic[rows][order]
            f1 = 2 * np.cumsum(y) / (np.arange(1, len(y) + 1) + y.sum())
            k = int(f1.argmax())
            below = z[k + 1] if k + 1 < len(z) else z[k] - 2.0
            return float((z[k] + below) / 2)

        every = np.arange(len(toxic))
        groups = {k: every[lang == k] for k in range(len(self.shift))} | {EVERY: every}
        self._shifts({k: (int(toxic[own].sum()), threshold(own)) for k, own in groups.items() if toxic[own].any()})

    def _shifts(self, found: dict[int, tuple[int, float]]) -> None:
        """From toxic rows and the best threshold of each language, and of ``EVERY``: a few rows weigh little."""
        general = found[EVERY][1] if EVERY in found else 0.0
        for k in range(len(self.shift)):
            n, own = found.get(k, (0, general))
            self.shift[k] = general + (own - general) * n / (n + SHRINK)

    def _raw(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pooled = self.net.pooled(*flat(ids, counts, self.net.pad))
        z = self.net.logits(pooled, "toxic")
        return (z[:, 1] - z[:, 0]).astype(np.float64), softmax(self.net.logits(pooled, "lang")).argmax(axis=1)

    def score(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.net is None:
            return np.full(len(counts), NO_MODEL)
        odds, lang = self._raw(ids, counts)
        return 1.0 / (1.0 + np.exp(-(odds - self.shift[lang] + _log_odds(DECISION))))


def _sections(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """``(rows, languages)`` of bounded runs of a shard, most often all of it; rows are ``(order, ids as bytes, label)``."""
    rows, size = [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            ids, counts = word_ids(*texts(part.column("text")))
            ends = np.cumsum(counts)
            packed = [ids[e - n:e].tobytes() for n, e in zip(counts.tolist(), ends.tolist())]
            rows += zip(part.column("o").to_pylist(), packed, part.column("y").to_pylist(), part.column("lang").to_pylist())
            size += part.column("text").nbytes
            if len(rows) >= 2 * SHARD_ROWS or size >= 2 * SHARD_BYTES:
                yield _split(rows)
                rows, size = [], 0
    if rows:
        yield _split(rows)


def _split(rows: list) -> tuple[list, list]:
    rows.sort(key=lambda r: r[:2])
    return [r[:3] for r in rows], [r[3] for r in rows]


def _epoch(data: DataFrame, model: Model, opt: Adagrad, epoch: int) -> None:
    """Every shard learns from its rows; the network and ``opt`` become the average of the shards'."""
    spark = data.sparkSession
    sent = spark.sparkContext.broadcast((model, opt))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, sums = sent.value
        net, own = copy.deepcopy(shared.net), copy.deepcopy(sums)
        for rows, lang in _sections(batches):
            _learn(net, own, [np.frombuffer(r[1], np.uint64) for r in rows], np.array([r[2] for r in rows], np.int64),
                   shared._codes(lang), shared.balance, epoch)
        now, state = _packed(net.parameters()), _packed(own.state)
        changed = (state != _packed(sums.state)) | (now != _packed(shared.net.parameters()))
        shard = TaskContext.get().partitionId()
        for at in range(0, len(now), _BLOCK):
            c = changed[at:at + _BLOCK]
            if c.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at // _BLOCK], pa.int32()), pa.array([shard], pa.int32()),
                     *(pa.array([np.where(c, x[at:at + _BLOCK], np.float32(0)).tobytes()], pa.binary()) for x in (now, state))],
                    names=["block", "shard", "value", "state"])

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks come sorted, so that shards are added in one order whatever ran first."""
        at, total, n = None, None, None

        def done():
            value = (total / np.maximum(1, n)).astype(np.float32)
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in value)],
                                              names=["block", "value", "state"])

        for batch in batches:
            for block, value, state in zip(*(batch.column(c).to_pylist() for c in ("block", "value", "state"))):
                both = np.array([np.frombuffer(value, np.float32), np.frombuffer(state, np.float32)], np.float64)
                if block != at:
                    if at is not None:
                        yield done()
                    at, total, n = block, np.zeros(both.shape), np.zeros(both.shape[1], np.int64)
                total += both
                n += both[1] > 0
        if at is not None:
            yield done()

    values, states = _packed(model.net.parameters()), _packed(opt.state)
    parts = min(math.ceil(len(values) / _BLOCK), int(spark.conf.get("spark.sql.shuffle.partitions")))
    shards = data.mapInArrow(run, "block int, shard int, value binary, state binary")
    for r in (shards.repartition(parts, "block").sortWithinPartitions("block", "shard")
              .mapInArrow(mean, "block int, value binary, state binary").collect()):      # the network's size
        value, state = np.frombuffer(bytes(r.value), np.float32), np.frombuffer(bytes(r.state), np.float32)
        place = slice(r.block * _BLOCK, r.block * _BLOCK + len(value))
        values[place] = np.where(state > 0, value, values[place])
        states[place] = np.where(state > 0, state, states[place])
    _unpack(values, model.net.parameters())
    _unpack(states, opt.state)
    sent.destroy()


def _packed(arrays: dict) -> np.ndarray:
    return np.concatenate([a.ravel() for a in arrays.values()])


def _unpack(packed: np.ndarray, arrays: dict) -> None:
    at = 0
    for a in arrays.values():
        a[...] = packed[at:at + a.size].reshape(a.shape)
        at += a.size


def _thresholds(aside: DataFrame, model: Model) -> dict[int, tuple[int, float]]:
    """Toxic rows and best threshold of every language the network assigns, and of ``EVERY``, from ``(text, y)`` rows.

    Equal responses are one step; steps are summed inside bins of log odds, and bins
    before them, so no task sorts all of them.
    """
    spark = aside.sparkSession
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                odds, lang = sent.value._raw(*word_ids(*texts(part.column("text"))))
                yield pa.RecordBatch.from_arrays([pa.array(odds), pa.array(lang.astype(np.int32)), part.column("y")],
                                                 names=["odds", "lang", "y"])

    raw = aside.select("text", "y").mapInArrow(run, "odds double, lang int, y int")
    steps = (raw.select("odds", "y", F.explode(F.array(F.lit(EVERY), "lang")).alias("g"))
             .groupBy("g", "odds").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("tp"))
             .withColumn("bin", F.floor(F.col("odds") * _BIN))).persist()
    bins = steps.groupBy("g", "bin").agg(F.sum("n").alias("n"), F.sum("tp").alias("tp"))
    before = Window.partitionBy("g").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("g")
    bins = bins.select("g", "bin", F.sum("tp").over(whole).alias("toxic"),
                       *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "tp")))
    inside = Window.partitionBy("g", "bin").orderBy(F.desc("odds"))
    run_to = [(F.sum(c).over(inside) + F.col(f"{c}_before")).alias(f"{c}_to") for c in ("n", "tp")]
    cuts = steps.join(bins, ["g", "bin"]).where("toxic > 0").select("g", "odds", "toxic", *run_to)
    f1 = 2 * F.col("tp_to") / (F.col("n_to") + F.col("toxic"))
    best = cuts.groupBy("g").agg(F.max("toxic").alias("toxic"), F.max(F.struct(f1.alias("f1"), "odds"))["odds"].alias("cut"))
    found = (best.join(steps, "g").groupBy("g", "toxic", "cut")
             .agg(F.max(F.when(F.col("odds") < F.col("cut"), F.col("odds"))).alias("below")).collect())
    steps.unpersist()
    sent.destroy()
    return {r.g: (r.toxic, (r.cut + (r.cut - 2.0 if r.below is None else r.below)) / 2) for r in found}


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text",
        label: str = "toxic", lang: str | None = "lang") -> Model:
    """A model fitted on all labelled rows of ``learn`` (a condition on the id) with a text."""
    known = labelled(labels, label, learn, None, id_col)
    named = F.col(lang) if lang else F.lit(None).cast("string")
    given = docs.where(learn & F.col(text).isNotNull())
    aside = F.shiftrightunsigned("_order", 11) % 1000 < int(ASIDE * 1000)
    sizes = (given.select(id_col, named.alias("_lang"), F.octet_length(text).alias("_bytes")).join(known, id_col)
             .groupBy("y", aside.alias("aside"), "_lang").agg(F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("bytes")).collect())
    counts = np.array([sum(r.n for r in sizes if r.y == y and not r.aside) for y in (0, 1)], np.int64)
    model = Model.untrained({r._lang for r in sizes if r._lang is not None}, counts)
    if model.net is None:
        return model
    shards = max(math.ceil(sum(r.n for r in sizes) / SHARD_ROWS), math.ceil(sum(r.bytes for r in sizes) / SHARD_BYTES))
    checkpoint_root(docs.sparkSession)
    # Labels grow with the documents, so they are not broadcast, whatever their size here.
    rows = given.select(id_col, text, named.alias("_lang")).join(known.hint("merge"), id_col)
    rows = rows.select(F.col("_order").alias("o"), F.col("y").cast("int").alias("y"), F.col("_lang").alias("lang"),
                       F.col(text).alias("text"), aside.alias("aside"))
    shard = F.pmod("o", F.lit(shards)).cast("int")        # as many as rows need, whatever the session's partitions
    rows = rows.repartitionById(shards, shard).sortWithinPartitions("o").checkpoint(eager=True)
    opt = Adagrad(RATE)
    opt.state = {k: np.full(a.shape, opt.FIRST, np.float32) for k, a in model.net.parameters().items()}
    for epoch in range(EPOCHS):
        _epoch(rows.where(~F.col("aside")), model, opt, epoch)
    model._shifts(_thresholds(rows.where("aside"), model))
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, held_out: Column, id_col: str = "doc_id",
                   text: str = "text", label: str = "toxic", lang: str | None = "lang") -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row."""
    importable(docs.sparkSession)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(fit(docs, labels, learn, id_col, text, label, lang))
    rows = docs.select(id_col, F.coalesce(held_out, F.lit(False)).alias("held_out"), text)
    fields = [f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}", "held_out boolean", "score double", "predicted int"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                score = sent.value.score(*word_ids(*texts(part.column(text))))
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), part.column("held_out"), pa.array(score),
                     pa.array((score >= DECISION).astype(np.int32))], names=[id_col, "held_out", "score", "predicted"])

    return rows.mapInArrow(run, ", ".join(fields))
