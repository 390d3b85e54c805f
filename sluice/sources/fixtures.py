"""Landed pages derived by Spark from the ``events`` table.

This is how the engine's queries get realistic API replies at any scale
without a network: every event row becomes one JSON event, rows are paged in
``event_id`` order, and the rules below rotate through every spelling the
decoder must handle.  The expected answers can be computed straight from the
``events`` table (``sluice.plans.oracle_sql``), sharing no code with the decoder.

Rules, by the row's global index ``rn`` (0-based, ``event_id`` order):

* run ``rn % runs``; index in the run ``rrn = rn div runs``; page
  ``rrn div page_size``; position ``rrn % page_size``.
* id key ``eventId`` / ``event_id`` / ``id`` by ``rn % 3``; id text ``evt-%09d``.
* time by ``rn % 10``: ISO ms; seconds; ms; us; ns (numbers); seconds; padded
  ms; us; ns (strings); ``occurredAt: null`` with an ISO ``+01:00`` timestamp.
  ``rn % 37 = 36``: no time key (absent); else ``rn % 41 = 40``: both null.
* copies: ``rn % 7 = 3`` again on the next page of its run (the last page's
  copy wraps to page 0, where it arrives first), ``rn % 11 = 5`` again at the
  end of its own page; copies carry ``"copy": 1`` / ``2``.
* envelope by ``page_no % 5``: data+hasMore; events+has_more text;
  pagination.hasMore 1/0; pagination.has_more; data+nextCursor only.
* ``faults``: on pages with more to come and ``page_no % 5 != 4``:
  ``page_no % 13 = 7`` drops the next cursor, else ``page_no % 17 = 11``
  repeats the request cursor.
* ``invalid``: ``rn % 97 = 13`` numeric id; else ``rn % 89 = 7`` an array
  event; else ``rn % 83 = 5`` empty ``eventId``; else ``rn % 79 = 3`` a string.
  Whole pages: ``page_no % 23 = 7`` data is an object; else ``% 29 = 13`` the
  body is an array; else ``% 31 = 17`` the body is a string; else ``% 37 = 19``
  the body is not JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import iso_ms, ntz_epoch_micros
from ..operators.paging import row_index

PAGE_SIZE = 100
# Rows of an index range: a task writes the events' JSON text of one range, so they are
# smaller than those of plain tables.
ROWS_PER_BUCKET = 1 << 17
FIXTURE_EPOCH_MS = 1704067200000
ORDER = ("event_id", "ts", "user_id", "event_type", "value", "props")


def _q(c):
    return F.concat(F.lit('"'), c, F.lit('"'))


def _div(c, d: int):
    """Exact floor division of a BIGINT column by a positive constant."""
    return ((c - F.pmod(c, F.lit(d))) / d).cast("long")


def _time_part(rn, us):
    k = rn % 10
    sec = _div(us, 1000000)
    ms = _div(us, 1000)
    ns = us * 1000
    iso = iso_ms(F.timestamp_micros(us))
    plus1 = F.concat(F.date_format(
        F.timestamp_add("MICROSECOND", us + 3600 * 1000000,
                        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")),
        "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00"))
    s = lambda c: c.cast("string")
    rot = (F.when(k == 0, F.concat(F.lit(',"occurredAt":'), _q(iso)))
           .when(k == 1, F.concat(F.lit(',"occurred_at":'), s(sec)))
           .when(k == 2, F.concat(F.lit(',"timestamp":'), s(ms)))
           .when(k == 3, F.concat(F.lit(',"occurredAt":'), s(us)))
           .when(k == 4, F.concat(F.lit(',"occurredAt":'), s(ns)))
           .when(k == 5, F.concat(F.lit(',"timestamp":'), _q(s(sec))))
           .when(k == 6, F.concat(F.lit(',"occurred_at":" \\t'), s(ms), F.lit(' "')))
           .when(k == 7, F.concat(F.lit(',"timestamp":'), _q(s(us))))
           .when(k == 8, F.concat(F.lit(',"occurredAt":'), _q(s(ns))))
           .otherwise(F.concat(F.lit(',"occurredAt":null,"timestamp":'), _q(plus1))))
    return (F.when(rn % 37 == 36, F.lit(""))
            .when(rn % 41 == 40, F.lit(',"occurredAt":null,"timestamp":null'))
            .otherwise(rot))


def event_pages(events: DataFrame, page_size: int = PAGE_SIZE, runs: int = 1,
                faults: bool = False, invalid: bool = False,
                rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Landed pages ``(run_id, page_no, request_cursor, fetched_at, body)`` from ``events``."""
    ps, R = int(page_size), int(runs)
    base = events.select(*ORDER)
    n = base.count()
    idx = row_index(base, list(ORDER), name="rn", rows_per_bucket=rows_per_bucket, total=n)
    rn = F.col("rn")
    run = rn % R
    rrn = _div(rn, R)
    n_run = _div(F.lit(n) - run + (R - 1), R)
    last_page = _div(n_run - 1, ps)
    rows = idx.select(
        "*", run.alias("run"), _div(rrn, ps).alias("page_no"),
        (rrn % ps).alias("pos"), last_page.alias("last_page"),
        ntz_epoch_micros(F.col("ts")).alias("us"))

    tags = F.filter(F.array(F.lit(0), F.when(rn % 7 == 3, F.lit(1)), F.when(rn % 11 == 5, F.lit(2))),
                    lambda x: x.isNotNull())
    occ = rows.withColumn("tag", F.explode(tags))
    tag = F.col("tag")
    page = F.col("page_no")
    occ = occ.select(
        "*",
        F.when(tag == 1, (page + 1) % (F.col("last_page") + 1)).otherwise(page).alias("opage"),
        (tag * ps + F.col("pos")).alias("opos"))

    id_text = F.format_string("evt-%09d", F.col("event_id"))
    id_key = F.element_at(F.array(F.lit("eventId"), F.lit("event_id"), F.lit("id")),
                          (rn % 3 + 1).cast("int"))
    rest = F.to_json(F.struct(
        F.col("event_type").alias("eventType"), F.col("user_id").alias("userId"),
        F.when(~F.isnan("value"), F.col("value")).alias("value"), F.col("props")))
    tail = F.when(rest == "{}", F.lit("}")).otherwise(F.concat(F.lit(","), F.substring(rest, 2, 1 << 30)))
    copy = F.when(tag > 0, F.concat(F.lit(',"copy":'), tag.cast("string"))).otherwise(F.lit(""))
    time = _time_part(rn, F.col("us"))
    head = F.concat(F.lit('{"'), id_key, F.lit('":'), _q(id_text))
    text = F.concat(head, time, copy, tail)
    if invalid:
        text = (F.when(rn % 97 == 13, F.concat(F.lit('{"id":'), F.col("event_id").cast("string"),
                                               time, copy, tail))
                .when(rn % 89 == 7, F.lit("[1]"))
                .when(rn % 83 == 5, F.concat(F.lit('{"eventId":"","id":'), _q(id_text), time, copy, tail))
                .when(rn % 79 == 3, F.lit('"x"'))
                .otherwise(text))
    occ = occ.select("run", "last_page", F.col("opage").alias("page_no"), "opos", text.alias("text"))

    pages = occ.groupBy("run", "page_no").agg(
        F.max("last_page").alias("last_page"),
        F.array_sort(F.collect_list(F.struct("opos", "text"))).alias("_evs"))
    p = F.col("page_no")
    has_more = p < F.col("last_page")
    rc = F.when(p == 0, F.lit(None).cast("string")).otherwise(F.base64((p * ps).cast("string")))
    nc = F.when(has_more, F.base64(((p + 1) * ps).cast("string")))
    if faults:
        hit = has_more & (p % 5 != 4)
        nc = (F.when(hit & (p % 13 == 7), F.lit(None).cast("string"))
              .when(hit & (p % 17 == 11), rc).otherwise(nc))
    ncj = F.when(nc.isNull(), F.lit("null")).otherwise(_q(nc))
    tf = F.when(has_more, F.lit("true")).otherwise(F.lit("false"))
    arr = F.concat(F.lit("["), F.array_join(F.transform("_evs", lambda x: x["text"]), ","), F.lit("]"))
    v = p % 5
    body = (F.when(v == 0, F.concat(F.lit('{"data":'), arr, F.lit(',"hasMore":'), tf,
                                    F.lit(',"nextCursor":'), ncj, F.lit("}")))
            .when(v == 1, F.concat(F.lit('{"events":'), arr, F.lit(',"has_more":'),
                                   F.when(has_more, F.lit('" TRUE "')).otherwise(F.lit('"false"')),
                                   F.lit(',"next_cursor":'), ncj, F.lit("}")))
            .when(v == 2, F.concat(F.lit('{"data":'), arr, F.lit(',"pagination":{"hasMore":'),
                                   F.when(has_more, F.lit("1")).otherwise(F.lit("0")),
                                   F.lit(',"nextCursor":'), ncj, F.lit("}}")))
            .when(v == 3, F.concat(F.lit('{"data":'), arr, F.lit(',"pagination":{"has_more":'), tf,
                                   F.lit(',"next_cursor":'), ncj, F.lit("}}")))
            .otherwise(F.concat(F.lit('{"data":'), arr, F.lit(',"nextCursor":'), ncj, F.lit("}"))))
    if invalid:
        body = (F.when(p % 23 == 7, F.concat(F.lit('{"data":{},"hasMore":'), tf, F.lit("}")))
                .when(p % 29 == 13, F.concat(F.lit("["), arr, F.lit("]")))
                .when(p % 31 == 17, F.lit('"not a page"'))
                .when(p % 37 == 19, F.concat(F.lit('{"data":'), arr, F.lit(",")))
                .otherwise(body))
    return pages.select(
        F.format_string("run-%03d", F.col("run")).alias("run_id"),
        p.alias("page_no"), rc.alias("request_cursor"),
        F.timestamp_millis(F.lit(FIXTURE_EPOCH_MS) + p * 1000 + F.col("run")).alias("fetched_at"),
        body.alias("body"))
