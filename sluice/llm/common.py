"""Helpers shared by the training-data operators: tables, folds, stored steps, Arrow text."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Words are runs of anything but ASCII white space (``[^\\x20\\x09-\\x0D]+``).
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it, whatever its working folder.

    Executors on machines without the package get it the usual way (``--py-files``).
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column | str, mod: int) -> Column:
    """``crc32(doc_id as text) mod m``; NULL for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(mod)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage: later jobs, and retries after a lost executor, read
    the files instead of computing the step again.
    """
    path = scratch_path(df.sparkSession, name) + "/data"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def others(df: DataFrame, *names: str) -> list[str]:
    """Columns of ``df`` but those that clash (case-insensitively) with ``names``."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    lo, hi = int(offsets[0]), int(offsets[-1])
    return np.frombuffer(data, np.uint8, hi - lo, lo), offsets - lo


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20):
    """Row slices of a batch whose text holds about ``max_bytes``; a longer text is alone."""
    lengths = np.diff(texts(batch.column(column))[1])
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield batch.slice(start, len(lengths) - start)


# --- vectorised word hashing -------------------------------------------------
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64), element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _POWERS[k] = np.multiply.accumulate(step)
    return _POWERS[0][:n], _POWERS[1][:n]


class Words:
    """The words of a run of texts: 64-bit hash, byte range, and words per text."""

    __slots__ = ("hash", "start", "end", "counts", "prefix")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, prefix: int = 0):
        """``prefix``: also hash the first so many bytes of every word."""
        if lower:
            data = _LOWER[data]
        n = len(data)
        if n == 0:
            self.hash = self.prefix = np.zeros(0, np.uint64)
            self.start = self.end = np.zeros(0, np.int64)
            self.counts = np.zeros(len(offsets) - 1, np.int64)
            return
        word = ~_SPACE[data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | cut[1:-1]
        last[:-1] &= ~word[1:] | cut[1:-1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = powers(n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * up, out=total[1:])
        self.hash = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        if prefix:
            self.prefix = mix((total[np.minimum(s + prefix, e)] - total[s]) * down[s])
        self.start, self.end = s, e
        self.counts = np.diff(np.searchsorted(s, offsets))


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a text, and the text number of each."""
    of = np.repeat(np.arange(len(words.counts)), words.counts)
    m = len(of) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(m, np.uint64)
    for j in range(n):
        total = total * np.uint64(_BASE) + words.hash[j:j + m]
    inside = of[:m] == of[n - 1:]
    return mix(total[inside]), of[:m][inside]
