"""Operator 5: language identification by a byte convolutional network.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes, all of them, the
last one shorter.  Bytes are embedded, filters of widths ``WIDTHS`` slide over a
window, the largest response of each filter is kept, and a softmax over the
learned languages follows.  A text's language is that of the largest sum of its
windows' log probabilities, weighted by their bytes; its score is the
byte-weighted mean probability of that language.

The network is trained in numpy on ``PER_LANGUAGE`` documents of each language
(those of least id hash among the rows learnt from), up to ``TRAIN_WINDOWS``
windows of each, spread over the whole text and cut out where it is read: that
is all that reaches the driver (a KB a document).  A language beyond the
``MAX_LANGUAGES`` commonest is not learnt.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text if no row has a language to learn; a null id is predicted, never
learnt from and ``held_out`` false; ties go to the first language in code-point
order; repeated rows are predicted each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import importable, texts
from .nets import TextCNN, softmax

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
DIM = 8
EPOCHS = 6
PER_LANGUAGE = 1000
TRAIN_WINDOWS = 4
MAX_LANGUAGES = 256
UNDETERMINED = "und"


def windows(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """All windows of a text's bytes, padded with 256."""
    n = max(1, -(-len(data) // window))
    out = np.full(n * window, 256, np.int64)
    out[:len(data)] = data
    return out.reshape(n, window)


def _flat(block: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    wide = np.full((len(block), block.shape[1] + pad), 256, np.int64)
    wide[:, :block.shape[1]] = block
    return wide.reshape(-1, 1), np.arange(len(block)) * wide.shape[1]


class Model:
    def __init__(self, rows: list[tuple[bytes, str]], seed: int = 5):
        self.languages = sorted({lang for _, lang in rows})
        if not self.languages:
            return
        code = {lang: k for k, lang in enumerate(self.languages)}
        blocks, goal = [], []
        for data, lang in rows:
            w = windows(np.frombuffer(data, np.uint8))
            w = w[np.unique(np.linspace(0, len(w) - 1, TRAIN_WINDOWS).astype(int))]
            blocks.append(w)
            goal += [code[lang]] * len(w)
        block, goal = np.concatenate(blocks), np.array(goal)
        weight = (len(goal) / np.bincount(goal, minlength=len(code)).clip(1))[goal].astype(np.float32)
        self.net = TextCNN([256], DIM, WIDTHS, FILTERS, {"lang": len(code)}, seed)
        rng = np.random.default_rng(seed)

        def batches(_):
            order = rng.permutation(len(block))
            for at in range(0, len(order), 64):
                k = order[at:at + 64]
                yield *_flat(block[k], self.net.pad), {"lang": (goal[k], weight[k])}

        self.net.train(batches, EPOCHS, 0.05)

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Filter responses to every pair of bytes, as the first two and as the last two of a patch.

        A byte has 257 values, so a filter's sum over a patch of up to four
        bytes is a sum of two looked-up rows; the products are done once.
        """
        if not hasattr(self, "_pairs"):
            e, d = self.net.tables[0], DIM
            one = [e @ self.net.conv[k * d:(k + 1) * d] for k in range(4)]
            self._pairs = tuple((one[k][:, None, :] + one[k + 1][None, :, :]).reshape(257 * 257, -1) for k in (0, 2))
        return self._pairs

    def window_logs(self, block: np.ndarray) -> np.ndarray:
        """Log probabilities of the languages for fixed-length windows."""
        n, length = block.shape
        wide = np.full((n, length + 3), 256, np.int64)
        wide[:, :length] = block
        pair = wide[:, :-1] * 257 + wide[:, 1:]
        first, last = self._tables()
        z = first.take(pair[:, :length].ravel(), axis=0, mode="clip")
        z += last.take(pair[:, 2:].ravel(), axis=0, mode="clip")
        if (block[:, -1] == 256).any():      # a filter must not start past a window's text
            z[(block == 256).ravel()] = -np.inf
        top = z.reshape(n, length, -1).max(axis=1)
        top[np.isneginf(top)] = -1e30
        return np.log(softmax(self.net.logits(np.maximum(top + self.net.bias, 0), "lang")) + 1e-12)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of every text of a run, windows batched across texts."""
        count = -(-np.diff(offsets) // WINDOW)
        of = np.repeat(np.arange(len(count)), count)
        begin = np.repeat(offsets[:-1] - WINDOW * (np.cumsum(count) - count), count) + WINDOW * np.arange(len(of))
        size = np.minimum(WINDOW, offsets[1:][of] - begin)
        logs = np.zeros((len(count), len(self.languages)))
        mass = np.zeros_like(logs)
        for at in range(0, len(of), 32):
            k = slice(at, at + 32)
            where = begin[k, None] + np.arange(WINDOW)
            block = np.where(np.arange(WINDOW) < size[k, None], data[np.minimum(where, len(data) - 1)], 256)
            log = self.window_logs(block)
            np.add.at(logs, of[k], log * size[k, None])
            np.add.at(mass, of[k], np.exp(log) * size[k, None])
        best = logs.argmax(axis=1)
        return [self.languages[k] for k in best], mass[np.arange(len(best)), best] / np.maximum(1, np.diff(offsets))


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = PER_LANGUAGE) -> Model:
    """A model fitted on a bounded sample of the rows of ``learn`` that have a language."""
    rows = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) > 0))
    common = rows.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), lang).limit(MAX_LANGUAGES).collect()
    draw = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / float(1 << 30)
    wanted = F.lit(False)
    for name, n in common:      # about per_language documents of each language, by the hash of their ids
        wanted |= (F.col(lang) == name) & (draw < 1.1 * per_language / n)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows that a text is learnt by, from all over it, cut out where the text is read."""
        for batch in batches:
            cut = []
            for value in batch.column(0):
                data = value.as_py().encode()
                last = -(-len(data) // WINDOW) - 1
                places = np.unique(np.linspace(0, last, TRAIN_WINDOWS).astype(int)).tolist()
                cut.append(b"".join(data[k * WINDOW:(k + 1) * WINDOW] for k in places))
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary()), batch.column(1), batch.column(2)], names=["t", "l", "o"])

    sample = rows.where(wanted).select(text, lang, F.xxhash64(id_col).alias("o")).mapInArrow(spread, "t binary, l string, o long")
    taken = sample.orderBy("o", "t", "l").limit(2 * per_language * max(1, len(common))).collect()
    return Model([(bytes(r.t), r.l) for r in taken])


def predict_language(docs: DataFrame, learn: Column, held_out: Column, id_col: str = "doc_id", text: str = "text",
                     lang: str = "lang") -> DataFrame:
    """``(id, held_out, lang_pred, score)`` of every row."""
    importable(docs.sparkSession)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(fit(docs, F.coalesce(learn, F.lit(False)), id_col, text, lang))
    letter = F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False))
    rows = docs.select(id_col, F.coalesce(held_out, F.lit(False)).alias("held_out"), letter.alias("_letter"), text)
    fields = [f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}", "held_out boolean", "lang_pred string", "score double"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for batch in batches:
            known = batch.column("_letter").to_numpy(zero_copy_only=False).astype(bool)
            name, score = [UNDETERMINED] * len(known), np.zeros(len(known))
            if model.languages:
                found, s = model.predict(*texts(batch.column(text)))
                name = [f if k else UNDETERMINED for f, k in zip(found, known)]
                score = np.where(known, np.clip(s, 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column("held_out"),
                                              pa.array(name, pa.string()), pa.array(score)],
                                             names=[id_col, "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, ", ".join(fields))
