"""Operator 2: token counts by a separator scan over flat, unindexed token files.

A token file is nothing but identifiers of one width, each document's followed
by the end-of-document identifier.  Files are cut into blocks of
``BLOCK_TOKENS``; a task reads one block by its byte range and finds all
separators with one vectorised comparison.  Blocks know nothing of each other:
a document that crosses a boundary, or spans many blocks, is stitched by a
prefix scan over the blocks' summaries (separators, place of the last one),
first inside runs of ``RUN`` blocks and then over runs, so that no file is
scanned in one task.  What is shuffled is a row for each document, not tokens.

``write_tokens`` makes such files from texts with a public tokenizer.  Tasks
write straight to the shared folder, one file for each attempt, and return the
list of documents in file order; that list names the files that count, so what
a failed attempt leaves behind is not read.  Files are read and
written through ``pyarrow.fs`` (local or mounted paths, ``hdfs``, ``s3``, ``gs``).

Defined cases: a null or empty text has 0 tokens; text that spells a special
token is ordinary text; tokens after a file's last separator are a last
document with ``closed`` false; an empty file has no documents; a file whose
size is no multiple of the identifier's width is an error; a null id is kept;
repeated rows count each; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed values of the vocabulary: how texts are split before merges, and the free identifier.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
DTYPE = "<u2"
BLOCK_TOKENS = 1 << 21
RUN = 4096            # blocks summarised together

_ENCODERS: dict = {}


def encoder(path: str = VOCABULARY, pattern: str = PATTERN):
    """The tokenizer of a rank file; loaded once in a worker."""
    if path not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text: str = "text", path: str = VOCABULARY,
                 pattern: str = PATTERN, end: int = END, dtype: str = DTYPE) -> DataFrame:
    """Write the texts' token files; returns the stored list ``(file, doc_no, id)`` of what they hold."""
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("doc_no", T.LongType()), docs.schema[id_col]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, out = TaskContext.get(), 0, None
        name = f"tokens-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        where, base = _store(folder)
        encode = encoder(path, pattern).encode_ordinary
        for batch in batches:
            if out is None:
                out = where.open_output_stream(f"{base}/{name}")
            for value in batch.column(text):
                out.write(np.array([*encode(value.as_py() or ""), end], dtype).tobytes())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array(np.arange(number, number + n)),
                                              batch.column(id_col)], names=schema.names)
            number += n
        if out is not None:
            out.close()

    return stored(docs.select(id_col, text).mapInArrow(run, schema), "token-documents")


def scan_tokens(spark: SparkSession, folder: str, end: int = END, dtype: str = DTYPE,
                block_tokens: int = BLOCK_TOKENS, named: DataFrame | None = None) -> DataFrame:
    """``(file, doc_no, start, n_tokens, closed)`` of every document of the ``.bin`` files of a folder.

    ``named``: only the files that this list names (column ``file``) are read.
    """
    width = np.dtype(dtype).itemsize
    size = width * block_tokens
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
             .where("length > 0").select(F.element_at(F.split("path", "/"), -1).alias("file"), "length"))
    if named is not None:
        files = files.join(named.select("file").distinct(), "file", "left_semi")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    todo = (files.select("file", "length", F.explode(F.sequence(F.lit(0), ((F.col("length") - 1) / size).cast("long"))).alias("block"))
            .repartition(parts, "file", "block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = _store(folder)
        for batch in batches:
            for name, length, block in zip(*[c.to_pylist() for c in batch.columns]):
                if length % width:
                    raise ValueError(f"{name}: {length} bytes are no whole number of identifiers")
                with where.open_input_file(f"{base}/{name}") as f:
                    ids = np.frombuffer(f.read_at(min(size, length - block * size), block * size), dtype)
                at = np.flatnonzero(ids == end) + block * block_tokens
                closed = np.ones(len(at), bool)
                if (block + 1) * size >= length and ids[-1] != end:      # the file ends inside a document
                    at, closed = np.append(at, length // width), np.append(closed, False)
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.string()), pa.array(np.full(n, block)), pa.array(np.arange(n)),
                     pa.array(np.append(-1, at[:-1])[:n], mask=np.arange(n) == 0), pa.array(at), pa.array(closed)],
                    names=["file", "block", "k", "previous", "stop", "closed"])

    found = stored(todo.mapInArrow(run, "file string, block long, k long, previous long, stop long, closed boolean"), "separators")
    # Prefix scan: separators before a block, and the place of the last one.
    block = (found.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.max("stop").alias("last"))
             .withColumn("run", F.floor(F.col("block") / RUN)))
    runs = block.groupBy("file", "run").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    over_runs = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("file", "run", F.sum("n").over(over_runs).alias("rn"), F.max("last").over(over_runs).alias("rl"))
    before = (block.select("file", "run", "block", F.sum("n").over(inside).alias("bn"), F.max("last").over(inside).alias("bl"))
              .join(runs, ["file", "run"])
              .select("file", "block", (F.coalesce("rn", F.lit(0)) + F.coalesce("bn", F.lit(0))).alias("earlier"),
                      F.coalesce("bl", "rl", F.lit(-1)).alias("carried")))
    return (found.join(before, ["file", "block"])
            .select("file", (F.col("earlier") + F.col("k")).alias("doc_no"),
                    (F.coalesce("previous", "carried") + 1).alias("start"), "stop", "closed")
            .select("file", "doc_no", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "closed"))


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``(id, n_tokens)`` of every row: texts become token files, which the separator scan counts."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    listed = write_tokens(docs, folder, id_col, text, path)
    return listed.join(scan_tokens(spark, folder, named=listed), ["file", "doc_no"]).select(id_col, "n_tokens")
