"""O23 and O24 from a stored table: rows in key order with a sparse position index.

A table is written once as range-partitioned, sorted files, with a row of fences
for each range: how many rows lie before it, how many it has, its least and its
greatest key.  A page is then served by looking at the fences and opening the one
or two ranges that hold it; inside a range the rows' places are a sorted column,
so the Parquet scan skips row groups too.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.paging import ROWS_PER_BUCKET, decode_cursor_value, range_tagged

_RANGE, _LOCAL = "_range", "_local"


def _fences(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/fences")


def _data(spark: SparkSession, path: str) -> DataFrame:
    """All rows; an empty table has a schema too, and no ranges."""
    root = path.rstrip("/")
    schema = spark.read.parquet(f"{root}/schema").schema
    try:
        return spark.read.schema(schema).parquet(f"{root}/data")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_ordered(df: DataFrame, path: str, order: list[str], rows_per_range: int = ROWS_PER_BUCKET) -> None:
    """Write ``df`` in the order of ``order`` (column names) with its fences."""
    ranges = max(1, math.ceil(df.count() / max(1, rows_per_range)))
    tagged = range_tagged(df, order, ranges).withColumnsRenamed({"_bucket": _RANGE})
    tagged.limit(0).write.mode("overwrite").parquet(f"{path.rstrip('/')}/schema")
    # Sorted by range and place already, so the writer keeps the order.
    (tagged.sortWithinPartitions(_RANGE, _LOCAL).write.mode("overwrite").partitionBy(_RANGE).parquet(f"{path.rstrip('/')}/data"))
    keys = F.struct(*order)
    per = _data(df.sparkSession, path).groupBy(_RANGE).agg(
        F.count(F.lit(1)).alias("n"), F.min(keys).alias("first"), F.max(keys).alias("last"))
    before = F.sum("n").over(Window.orderBy(_RANGE)) - F.col("n")          # one row for each range
    per.withColumn("head", before).write.mode("overwrite").parquet(f"{path.rstrip('/')}/fences")


def _ranges(spark: SparkSession, path: str, fences: list, row: Column | None = None) -> DataFrame:
    """The rows of some ranges with ``row_idx``; the scan opens only these."""
    rows = _data(spark, path)
    if not fences:
        return rows.where(F.lit(False)).withColumn("row_idx", F.lit(0).cast("long")).drop(_RANGE, _LOCAL)
    head = F.lit(None).cast("long")
    for f in fences:
        head = F.when(F.col(_RANGE) == f[_RANGE], F.lit(f["head"])).otherwise(head)
    kept = rows.where(F.col(_RANGE).isin([f[_RANGE] for f in fences]))
    if row is not None:
        kept = kept.where(row)
    return kept.withColumn("row_idx", (head + F.col(_LOCAL)).cast("long")).drop(_RANGE, _LOCAL)


def serve_stored_page(spark: SparkSession, path: str, limit: int, cursor: str | None) -> DataFrame:
    """The page that a cursor asks for, with ``row_idx``."""
    start = decode_cursor_value(cursor)
    stop = min(start + max(int(limit), 1), 2**63 - 1)
    fences = _fences(spark, path).where((F.col("head") < stop) & (F.col("head") + F.col("n") > start)).collect()
    # In places of each range, so that the filter reaches the scan.
    inside = F.lit(False)
    for f in fences:
        inside = inside | ((F.col(_RANGE) == f[_RANGE]) & (F.col(_LOCAL) >= start - f["head"]) & (F.col(_LOCAL) < stop - f["head"]))
    return _ranges(spark, path, fences, inside)


def serve_stored_keys(spark: SparkSession, path: str, key: str, after, limit: int) -> DataFrame:
    """The ``limit`` rows that follow the key ``after`` (None: the first), for a table ordered by ``key`` first."""
    fences = _fences(spark, path)
    if after is not None:
        fences = fences.where(F.col("last")[key] > F.lit(after))
    # All ranges but the first lie wholly past the key: as many as the limit needs beside it.
    chosen, have = [], 0
    for i, f in enumerate(fences.orderBy(_RANGE).toLocalIterator()):
        chosen.append(f)
        have += f["n"] if i or after is None else 0
        if have >= limit:
            break
    rows = _ranges(spark, path, chosen, None if after is None else F.col(key) > F.lit(after))
    return rows.orderBy("row_idx").limit(int(limit))


def export_ordered(spark: SparkSession, path: str, out: str, key: str) -> DataFrame:
    """O6 from an ordered table: one text file for each range, by ``key``, one a line; returns what was planned to be written.

    The ranges are sorted files already, so nothing is exchanged: a task reads one
    file and writes it, below ``range=000012``, and the files in path order are the
    whole table in order.  Files are kept whole by the reading session's own settings.
    """
    own = spark.newSession()
    largest = max((f["length"] for f in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                   .option("recursiveFileLookup", "true").load(f"{path.rstrip('/')}/data").agg(F.max("length").alias("length")).collect()
                   if f["length"] is not None), default=1)
    for name in ("maxPartitionBytes", "openCostInBytes"):
        own.conf.set(f"spark.sql.files.{name}", str(largest + 1))
    rows = (_data(own, path).sortWithinPartitions(_RANGE, _LOCAL)
            .select(F.lpad(F.col(_RANGE).cast("string"), 6, "0").alias("range"), F.col(key).cast("string").alias("value")))
    rows.write.mode("overwrite").partitionBy("range").text(out)
    return rows
