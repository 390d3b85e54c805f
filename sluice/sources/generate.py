"""Synthetic events and pages: O7 and the landed-page form of the paging source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import iso_ms

# Fixed values of the synthetic source.
MOCK_EPOCH_MS = 1704067200000  # 2024-01-01T00:00:00.000Z
MOCK_STEP_MS = 1000
MOCK_TYPES = ("click", "view")  # even index, odd index
MOCK_SOURCE = "mock-api"
MOCK_ID_FORMAT = "evt-%07d"     # zero-padded to 7, never truncated


def generate_events(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """``(eventId, occurredAt, eventType, source)`` for indexes ``0..n-1``.

    ``format_string`` pads without truncating (``lpad`` would cut ids past 7 digits).
    """
    ids = spark.range(0, int(n), 1, partitions) if partitions else spark.range(int(n))
    i = F.col("id")
    return ids.select(
        i.alias("idx"),
        F.format_string(MOCK_ID_FORMAT, i).alias("eventId"),
        iso_ms(F.timestamp_millis(F.lit(MOCK_EPOCH_MS) + i * MOCK_STEP_MS)).alias("occurredAt"),
        F.when(i % 2 == 0, F.lit(MOCK_TYPES[0])).otherwise(F.lit(MOCK_TYPES[1])).alias("eventType"),
        F.lit(MOCK_SOURCE).alias("source"))


def mock_pages(events: DataFrame, limit: int, run_id: str = "mock") -> DataFrame:
    """Page a generated event table the way the mock API serves it, as landed pages.

    The index ``idx`` of O7 is already dense, so the page of a row is
    arithmetic; each page is one bounded group of ``max(limit, 1)`` rows.
    Cursors are base64 of the decimal end index; the last page has none.
    """
    size = max(int(limit), 1)
    total = events.count()
    last_page = max(0, (total - 1) // size)
    rows = events.withColumn("page_no", F.expr(f"idx div {size}"))
    ev_json = F.to_json(F.struct("eventId", "occurredAt", "eventType", "source"))
    grouped = rows.groupBy("page_no").agg(
        F.array_sort(F.collect_list(F.struct("idx", ev_json.alias("j")))).alias("_evs"))
    p = F.col("page_no")
    has_more = p < last_page
    nxt = F.base64(F.least((p + 1) * size, F.lit(total)).cast("string"))
    body = F.concat(
        F.lit('{"data":['), F.array_join(F.transform("_evs", lambda x: x["j"]), ","),
        F.lit('],"hasMore":'), F.when(has_more, F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"nextCursor":'),
        F.when(has_more, F.concat(F.lit('"'), nxt, F.lit('"'))).otherwise(F.lit("null")),
        F.lit("}"))
    return grouped.select(
        F.lit(run_id).alias("run_id"), p.alias("page_no"),
        F.when(p == 0, F.lit(None).cast("string")).otherwise(F.base64((p * size).cast("string")))
        .alias("request_cursor"),
        F.timestamp_millis(F.lit(MOCK_EPOCH_MS) + p).alias("fetched_at"),
        body.alias("body"))
