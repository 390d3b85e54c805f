"""Ordered row index, offset pages, keyset pages and chunks: O23 O24 O24b.

Global row index without a single-task window
---------------------------------------------
``row_number() over (order by k)`` moves every row into one task.  Instead:

1. ``repartitionByRange(B, k)`` (Spark samples the keys and binary-searches the
   boundaries) and ``sortWithinPartitions(k)``: partition ``p`` holds the
   ``p``-th key range, sorted.
2. ``monotonically_increasing_id()`` after the sort encodes
   ``(p << 33) + position in p``.
3. The tagged rows are checkpointed (reliable, in ``spark.checkpoint.dir``) so
   every later read sees the same ranges even after executor loss.
4. Row counts per partition (B rows) give offsets through a running sum over B
   rows; the offsets are broadcast (B is chosen from the row count, so it is
   bounded) and added.

B is ``ceil(n / rows_per_bucket)``: each range task holds about
``rows_per_bucket`` rows whatever the total size.  The input row id is
appended to the order as a tiebreaker, so a key (or an exact copy) repeated
in a third of all rows still spreads over many ranges.
"""

from __future__ import annotations

import math

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import checkpoint_root

ROWS_PER_BUCKET = 2_000_000
_LOCAL_BITS = 33


def range_tagged(df: DataFrame, order, buckets: int) -> DataFrame:
    """``df`` in ``buckets`` key ranges, sorted, with ``_bucket`` and ``_local`` (the place inside it)."""
    # Tiebreaker: the row's id in its input split.  It makes the order total,
    # so rows equal on ``order`` (even exact copies, which may be a third of
    # all rows) spread over many ranges instead of one task.  (Were the input
    # order not reproducible, Spark reruns the whole indeterminate stage.)
    tie = df.select("*", F.monotonically_increasing_id().alias("_tie_i"))
    full = [*order, "_tie_i"]
    return (tie.repartitionByRange(buckets, *full)
            .sortWithinPartitions(*full)
            .withColumn("_mid", F.monotonically_increasing_id())
            .select(*df.columns, F.shiftright("_mid", _LOCAL_BITS).alias("_bucket"),
                    F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1).alias("_local")))


def row_index(df: DataFrame, order, name: str = "row_idx",
              rows_per_bucket: int = ROWS_PER_BUCKET, total: int | None = None) -> DataFrame:
    """Add a dense 0-based index in ``order`` (list of column names or Columns).

    ``total`` (the row count) is counted when not given; it only sizes the ranges.
    """
    n = df.count() if total is None else int(total)
    buckets = max(1, math.ceil(n / max(1, rows_per_bucket)))
    checkpoint_root(df.sparkSession)
    cols = df.columns
    tagged = range_tagged(df, list(order), buckets).checkpoint(eager=True)
    counts = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # B rows (one per range, B = n / rows_per_bucket): a single-partition
    # running sum over them is tiny, and so is the broadcast below.
    w = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_bucket").alias("_b"),
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), tagged["_bucket"] == offsets["_b"])
    return out.select(*cols, (F.col("_off") + F.col("_local")).alias(name))


def encode_cursor(index) -> "F.Column":
    """Cursor text for a row index: base64 of its decimal digits."""
    return F.base64(F.col(index).cast("string") if isinstance(index, str) else index.cast("string"))


def decode_cursor(cursor) -> "F.Column":
    """Start index for a cursor: empty or NULL means 0; a bad cursor raises.

    Base64 is read leniently, as the source system reads it: the URL alphabet
    counts too, other characters are skipped, padding may be missing.  The
    decoded text must start with an integer (``parseInt`` rules: leading white
    space and sign allowed, trailing text ignored) that is not negative; one
    past BIGINT is past every row.
    """
    c = F.col(cursor) if isinstance(cursor, str) else cursor

    # Each step is bound once: written out they would repeat inside one another.
    def from_plain(plain):
        whole = F.length(plain) - F.when(F.length(plain) % 4 == 1, F.lit(1)).otherwise(F.lit(0))
        cut = F.substring(plain, F.lit(1), whole)
        padded = F.concat(cut, F.repeat(F.lit("="), F.pmod(-whole, F.lit(4))))
        text = F.try_to_binary(padded, F.lit("base64")).cast("string")
        return S._let(F.regexp_extract(text, r"^\s*([+-]?\d+)", 1), from_digits)

    def from_digits(digits):
        value = (F.when(F.length(F.regexp_replace(digits, r"^[+]?0*", "")) > 18,
                        F.when(digits.startswith("-"), F.lit(-1)).otherwise(F.lit(2**63 - 1)))
                 .when(digits != "", digits.try_cast("long")))
        return S._let(value, lambda v: F.when(v >= 0, v))

    plain = F.regexp_replace(F.translate(F.substring_index(c, "=", 1), "-_", "+/"), "[^A-Za-z0-9+/]", "")
    start = F.when(c.isNull() | (c == ""), F.lit(0).cast("long")).otherwise(S._let(plain, from_plain))
    return F.coalesce(start, F.raise_error(F.concat(F.lit("Invalid cursor: "), c)).cast("long"))


def paginate(df: DataFrame, order, limit: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rows with ``row_idx``, ``page_no`` and ``pos`` for pages of ``max(limit, 1)``."""
    size = max(int(limit), 1)
    idx = row_index(df, order, rows_per_bucket=rows_per_bucket)
    return (idx.withColumn("page_no", F.expr(f"row_idx div {size}"))
            .withColumn("pos", (F.col("row_idx") % size).cast("long")))


def page_table(spark, total: int, limit: int) -> DataFrame:
    """O23 page list for ``total`` rows: ``(page_no, request_cursor, n, has_more, next_cursor)``.

    With no rows there is still one empty last page.
    """
    size = max(int(limit), 1)
    pages = max(1, math.ceil(total / size))
    p = F.col("id")
    end = F.least((p + 1) * size, F.lit(total))
    return spark.range(pages).select(
        p.alias("page_no"),
        F.when(p == 0, F.lit(None).cast("string")).otherwise(F.base64((p * size).cast("string")))
        .alias("request_cursor"),
        (end - p * size).alias("n"),
        (end < total).alias("has_more"),
        F.when(end < total, F.base64(end.cast("string"))).alias("next_cursor"))


def page_list(paged: DataFrame, limit: int) -> DataFrame:
    """O23 page list of paged rows (with ``page_no`` and ``row_idx``): the columns of :func:`page_table`.

    Rows decide it alone: no rows, no pages.
    """
    size = max(int(limit), 1)
    pages = paged.groupBy("page_no").agg(F.count(F.lit(1)).alias("n"), F.max("row_idx").alias("_last"))
    top = pages.agg(F.max("_last")).first()[0]             # one number: the last row's index
    p = F.col("page_no")
    more = F.col("_last") < F.lit(top)
    return pages.select(
        "page_no", F.when(p > 0, F.base64((p * size).cast("string"))).alias("request_cursor"), "n",
        more.alias("has_more"), F.when(more, F.base64((F.col("_last") + 1).cast("string"))).alias("next_cursor"))


def decode_cursor_value(cursor: str | None) -> int:
    """:func:`decode_cursor` of a cursor given as a parameter."""
    if not cursor:
        return 0
    try:
        return SparkSession.getActiveSession().range(1).select(decode_cursor(F.lit(cursor))).first()[0]
    except SparkRuntimeException as e:
        raise ValueError(f"Invalid cursor: {cursor}") from e


def serve_page(indexed: DataFrame, limit: int, cursor: str | None) -> DataFrame:
    """The page a cursor asks for, from rows carrying ``row_idx`` (a range filter)."""
    start = decode_cursor_value(cursor)
    stop = start + max(int(limit), 1)
    rows = indexed.where(F.col("row_idx") >= start)
    return rows.where(F.col("row_idx") < stop) if stop < 2**63 else rows


def keyset_page(df: DataFrame, key: str, after, limit: int) -> DataFrame:
    """``WHERE (after IS NULL OR key > after) ORDER BY key LIMIT n`` (top-k, no full sort)."""
    rows = df if after is None else df.where(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(int(limit))


def keyset_chunks(df: DataFrame, key: str, size: int = 50_000,
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The chunk report of a keyset export, in one pass.

    ``(chunk_no, first_key, last_key, n, running_total)``.  Every chunk but the
    last is full, so the running total is arithmetic, not a window.
    """
    if size <= 0:
        raise ValueError(f"Invalid chunk size: {size}")
    idx = row_index(df.select(key), [key], rows_per_bucket=rows_per_bucket)
    chunks = (idx.withColumn("chunk_no", F.expr(f"row_idx div {size}"))
              .groupBy("chunk_no")
              .agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"),
                   F.count(F.lit(1)).alias("n")))
    return chunks.withColumn("running_total", F.col("chunk_no") * size + F.col("n"))
