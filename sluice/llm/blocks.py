"""Members of index buckets, dealt into bounded blocks so that no bucket lands in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def blocks(members: DataFrame, key: list[str], value: list[str], block: int, only: str | None = None) -> DataFrame:
    """Group the distinct ``(key, value)`` rows of every bucket with two values or more.

    A bucket of ``n`` values is dealt into ``c = ceil(n / block)`` chunks by
    hash, and every pair of chunks ``i <= j`` becomes one row, so each row's
    ``members`` array holds about ``2 * block`` values at most and every two
    values of a bucket meet in exactly one row: in ``(i, i)`` if they share
    chunk ``i``, else as members of either ``side`` of ``(i, j)``.  Returns the
    key, ``same`` (``i = j``) and ``members``, structs of the value and ``side``.
    ``only``: buckets in which this boolean column is nowhere true are left out.

    Both tables are joined by sorting: ``members`` comes out of an explode, which
    Spark sizes as one row for each row before it, so it (or its buckets, as many)
    would be broadcast while the rows before it are few.
    """
    sizes = members.groupBy(*key).agg(F.count(F.lit(1)).alias("_bucket"), *([F.bool_or(only).alias("_some")] if only else []))
    sizes = sizes.where("_bucket > 1 AND _some" if only else "_bucket > 1").drop("_some")
    live = members.join(sizes.hint("merge"), key)
    c = F.ceil(F.col("_bucket") / F.lit(block)).cast("int")
    i = F.pmod(F.xxhash64(*value), c).cast("int")
    dealt = (live.select(*key, *value, i.alias("_c"), F.explode(F.sequence(F.lit(0), c - 1)).alias("_j"))
             .select(*key, *value, F.least("_c", "_j").alias("_i"), F.greatest("_c", "_j").alias("_j"),
                     (F.col("_c") > F.col("_j")).alias("side"))
             .repartition(*key, "_i", "_j"))
    return (dealt.groupBy(*key, "_i", "_j")
            .agg(F.collect_list(F.struct(*value, "side")).alias("members"))
            .select(*key, (F.col("_i") == F.col("_j")).alias("same"), "members"))
