"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read by the next.

1. ``quality``: documents that the quality classifier rejects go.  Labels are
   learnt from the rows of ``labels`` whose id has a CRC-32 not divisible by 5.
2. ``line_dedup``: lines that repeat an earlier line go from the texts (and
   ``n_chars`` follows); a document that loses all its lines has an empty text.
3. ``simhash_dedup``: one document of each near-duplicate group stays.
4. ``decontaminate``: documents that hold a benchmark item go.
5. ``source_mix``: documents come as often as the mix takes them, with their
   ``size``, ``source_size``, ``target``, ``rate``, ``copies``, ``taken`` and ``copy_no``.

Every stage works on all that its predecessor kept, and all but the last return
the columns of ``documents``.  Nulls, empty and long texts, ties, repeated rows
and empty tables have the results that the operators state; without both labels
no document is rejected, without benchmark items none is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate, line_dedup, mixing, quality, simhash_dedup
from sluice.llm.common import fold, stored, table


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator uses, and the name of each column."""
    names = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(inner).alias(c) for c, inner in names.items()])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    inner, names = _apart(docs)
    labels = labels.withColumnRenamed("doc_id", names["doc_id"])
    return _back(quality.keep_good(inner, labels, fold(names["doc_id"], 5) != 0, names["doc_id"], names["text"]), names)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    inner, names = _apart(docs)
    cleaned = line_dedup.dedupe_lines(inner, names["doc_id"], names["text"])
    if "n_chars" in names:
        size = F.when(F.col("n_removed") > 0, F.length(names["text"]).cast("long")).otherwise(F.col(names["n_chars"]))
        cleaned = cleaned.withColumn(names["n_chars"], size)
    return _back(cleaned, names)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    inner, names = _apart(docs)
    return _back(simhash_dedup.keep_first(inner, names["doc_id"], names["text"]), names)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    inner, names = _apart(docs)
    return _back(decontaminate.decontaminate(inner, table(spark, sf_dir, "benchmark"), names["text"]), names)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    inner, names = _apart(docs)
    mixed = mixing.copied(mixing.mix_sources(inner, names["doc_id"], names["text"], names["source"]))
    results = [c for c in mixed.columns if c not in names.values()]
    kept = {c: n for c, n in names.items() if c.lower() not in results}
    return mixed.select(*[F.col(n).alias(c) for c, n in kept.items()], *results)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_dedup", near_duplicate_stage),
    ("decontaminate", benchmark_stage),
    ("source_mix", mixing_stage),
]

#: SQL cannot train the classifier of the first stage; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
