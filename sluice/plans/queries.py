"""Named queries over the driver's tables, one or more per operator.

Every query reads the given parquet tables (``events``, ``orders``) or data
Spark derives from them (landed pages built by ``sources.fixtures``), so its
work grows with the tables.  Output columns are BIGINT / STRING / BOOLEAN;
instants are epoch milliseconds.  ``sluice.plans.oracle_sql`` holds the
matching DuckDB SQL computed straight from the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import envelope as E
from ..operators import ledger as L
from ..operators import paging as P
from ..operators import profile as PR
from ..operators.dedupe import first_by_key, pending
from ..operators.flush import assign_flush_batches, flush_rollup
from ..session import ensure_semantics, scratch_path
from ..sources import fixtures as FX
from ..sources.pages import land_pages, land_pages_in_order, scan_pages
from ..sources.ordered import export_ordered, serve_stored_keys, serve_stored_page, write_ordered
from ..sources.sinks import batch_key, export_keys, read_committed
from ..plans.ingest import decode_pages, event_rows, ingest_batch, page_events

# Fixed parameters of the registered queries (the oracle SQL uses the same).
PAGE_SIZE = FX.PAGE_SIZE          # events per fixture page
RUNS_MULTI = 3                    # runs in the multi-run fixture
FLUSH_BATCH = 250                 # flush threshold in events
ORDERS_PAGE = 1000                # rows per page when paging orders
KEYSET_AFTER = 1000               # keyset start key (exclusive)
KEYSET_LIMIT = 500
CHUNK_SIZE = 1000                 # keyset chunk size
SERVE_CURSOR = "NTAwMA=="         # base64("5000"): the page starting at row 5000

_CACHE: dict = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_pages(spark: SparkSession, sf_dir: str, runs: int = 1, faults: bool = False,
                  invalid: bool = False) -> DataFrame:
    """Landed pages derived from ``events``; checkpointed once per process."""
    ensure_semantics(spark)
    key = ("pages", spark.sparkContext.applicationId, sf_dir, runs, faults, invalid)
    if key not in _CACHE:
        pages = FX.event_pages(_table(spark, sf_dir, "events"), PAGE_SIZE, runs, faults, invalid)
        _CACHE[key] = pages.checkpoint(eager=True)
    return _CACHE[key]


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored event table (a full load), for queries that read the table."""
    key = ("ingested", spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = ingest_batch(fixture_pages(spark, sf_dir)).checkpoint(eager=True)
    return _CACHE[key]


def _pl(field: str, typ: str):
    return F.try_variant_get(F.col("payload"), f"$['{field}']", typ)


def _row_cols():
    return [F.col("event_id"), F.unix_millis("occurred_at").alias("occurred_at_ms"),
            _pl("eventType", "string").alias("event_type"),
            _pl("copy", "bigint").alias("copy_tag"),
            S.raw_field(F.col("payload"), "occurredAt").isNotNull().alias("has_time_key")]


# ---------------------------------------------------------------------------
def q_page_envelope(spark, sf_dir):
    """O1 + O2: land the pages as JSON files, scan them back, decode the envelopes."""
    path = scratch_path(spark, "landed")
    land_pages(fixture_pages(spark, sf_dir), path)
    parsed = decode_pages(scan_pages(spark, path))
    return parsed.select("run_id", "page_no", F.size("items").cast("long").alias("n_events"),
                         "has_more", "next_cursor")


def q_event_rows(spark, sf_dir):
    """O3 + O8-O13: every decoded event, duplicates included."""
    rows = event_rows(fixture_pages(spark, sf_dir))
    return rows.select("run_id", "page_no", F.col("pos").cast("long").alias("pos"),
                       F.col("event_id"), F.unix_millis("occurred_at").alias("occurred_at_ms"),
                       "time_present", _pl("eventType", "string").alias("event_type"),
                       _pl("copy", "bigint").alias("copy_tag"))


def q_event_table_rows(spark, sf_dir):
    """Stored columns from the payload's ISO text (the writer's re-normalisation)."""
    stored = _ingested(spark, sf_dir).select(
        "event_id", _pl("occurredAt", "string").alias("occurred_at"), "payload")
    rows = E.to_event_rows(stored)
    return rows.select("event_id", F.unix_millis("occurred_at").alias("occurred_at_ms"),
                       F.col("ingested_at").isNotNull().alias("has_ingested_at"))


def q_epoch_units(spark, sf_dir):
    """O10 on numbers of every magnitude derived from ``events.ts`` and ``value``."""
    ev = _table(spark, sf_dir, "events")
    us = S.ntz_epoch_micros(F.col("ts"))
    k = F.col("event_id") % 6
    x = (F.when(k == 0, us.cast("double") / 1000000.0)
         .when(k == 1, F.floor(us / 1000).cast("double"))
         .when(k == 2, us.cast("double"))
         .when(k == 3, (us * 1000).cast("double"))
         .when(k == 4, F.col("value"))
         .otherwise(-F.floor(us / 1000).cast("double")))
    df = ev.select("event_id", x.alias("x"))
    a = F.abs(F.col("x"))
    unit = (F.when(a >= S.NS_FROM, "ns").when(a >= S.US_FROM, "us").when(a >= S.MS_FROM, "ms")
            .when(a >= S.S_FROM, "s").otherwise("ms"))
    return df.select("event_id", unit.alias("unit"),
                     F.unix_millis(S.epoch_to_instant(F.col("x"))).alias("instant_ms"))


_FORMS = 7
FAR_MS = 284_012_568_000_000          # 9000 years


def q_time_forms(spark, sf_dir):
    """O9 + O10: ``events.ts`` written in each form of date text, and 9000 years on as ISO text."""
    ev = _table(spark, sf_dir, "events")
    k, ts = F.col("event_id") % _FORMS, F.col("ts").cast("timestamp_ntz")
    wall = lambda minutes: F.timestamp_add("MINUTE", F.lit(minutes), ts)
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    text = (F.when(k == 0, F.concat(F.date_format(ts, iso + ".SSS"), F.lit("Z")))
            .when(k == 1, F.concat(F.date_format(wall(60), iso), F.lit("+0100")))
            .when(k == 2, F.concat(F.date_format(wall(60), iso), F.lit("+01:00")))
            .when(k == 3, F.concat(F.date_format(ts, "d MMM yyyy HH:mm:ss"), F.lit(" GMT")))
            .when(k == 4, F.date_format(ts, "yyyy-MM-dd"))
            .when(k == 5, F.concat(F.date_format(wall(-210), "yyyy-MM-dd'T'HH:mm"), F.lit("-0330")))
            .otherwise(F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("Z"))))
    far = F.timestamp_millis(F.floor(S.ntz_epoch_micros(F.col("ts")) / 1000).cast("long") + FAR_MS)
    return ev.select("event_id", F.unix_millis(S.js_date_parse(text)).alias("instant_ms"), S.iso_ms(far).alias("far"))


FREE_FORMS = 10


def q_free_dates(spark, sf_dir):
    """``events.ts`` as free-form date text, and days past their month."""
    ev = _table(spark, sf_dir, "events")
    k, ts = F.col("event_id") % FREE_FORMS, F.col("ts").cast("timestamp_ntz")
    wall = lambda minutes: F.timestamp_add("MINUTE", F.lit(minutes), ts)
    text = (F.when(k == 0, F.date_format(ts, "MMM d, yyyy"))
            .when(k == 1, F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))
            .when(k == 2, F.date_format(ts, "M/d/yyyy"))
            .when(k == 3, F.date_format(ts, "yyyy-M-d H:m"))
            .when(k == 4, F.concat(F.date_format(wall(60), "EEE MMM dd yyyy HH:mm:ss"), F.lit(" GMT+0100 (Central European Time)")))
            .when(k == 5, F.date_format(ts, "d MMMM yyyy h:mm:ss a"))
            .when(k == 6, F.concat(F.date_format(wall(-300), "EEEE, dd-MMM-yy HH:mm:ss"), F.lit(" EST")))
            .when(k == 7, F.concat(F.date_format(ts, "yyyy"), F.lit("/02/31")))
            .when(k == 8, F.concat(F.date_format(ts, "yyyy/MM/dd"), F.lit(" 25:00")))
            .otherwise(F.concat(F.date_format(ts, "yyyy MMM d HH:mm:ss.SSS"), F.lit("Z"))))
    return ev.select("event_id", F.unix_millis(S.js_date_parse(text)).alias("instant_ms"))


def q_cursor_forms(spark, sf_dir):
    """Start rows of cursors written in each way the source system reads."""
    n = F.col("o_orderkey")
    b64 = F.base64(n.cast("string"))
    k = n % 6
    cursor = (F.when(k == 0, b64).when(k == 1, F.regexp_replace(b64, "=", ""))
              .when(k == 2, F.base64(F.concat(n.cast("string"), F.lit("abc"))))
              .when(k == 3, F.concat(F.lit(" \n"), b64)).when(k == 4, F.lit(""))
              .otherwise(F.base64(F.concat(F.lit(" +00000000000000000000"), n.cast("string")))))
    return _table(spark, sf_dir, "orders").select("o_orderkey", P.decode_cursor(cursor).alias("start"))


def q_first_by_key(spark, sf_dir):
    """The first occurrence of every id in arrival order."""
    ev = page_events(decode_pages(fixture_pages(spark, sf_dir)))
    firsts = first_by_key(ev, "event_id", ("run_id", "page_no", "pos"))
    return firsts.select("event_id", "page_no", F.col("pos").cast("long").alias("pos"),
                         S.as_string(S.raw_field(F.col("event"), "eventId")).isNotNull()
                         .alias("has_event_id_key"),
                         F.try_variant_get(F.col("event"), "$['copy']", "bigint").alias("copy_tag"))


def decode_all(pages):
    """Good pages, chain-breaking ones included."""
    return E.parse_envelope(pages).where(F.col("page_error").isNull())


def _split_pages(spark, sf_dir):
    pages = fixture_pages(spark, sf_dir)
    last = pages.agg(F.max("page_no")).first()[0]
    mid = (int(last) + 1) // 2
    return pages.where(F.col("page_no") < mid), pages.where(F.col("page_no") >= mid)


def q_insert_if_absent(spark, sf_dir):
    """Pages before the middle are stored; the rest arrive as a new load."""
    stored_pages, new_pages = _split_pages(spark, sf_dir)
    stored_path = scratch_path(spark, "stored-events")
    ingest_batch(stored_pages).write.mode("overwrite").parquet(stored_path)
    target = spark.read.parquet(stored_path)
    fresh = ingest_batch(new_pages, target=target, key_strategy="auto")
    return fresh.select("event_id", "page_no", F.col("pos").cast("long").alias("pos"))


KEY_BUCKETS = 16                 # of the key index in the registered query


def q_insert_indexed(spark, sf_dir):
    """O5 by key index: pages before the middle are committed; what the load of the rest adds."""
    from ..streaming.ingest_stream import make_batch_sink
    first, second = _split_pages(spark, sf_dir)
    table, ledger = scratch_path(spark, "indexed-table"), scratch_path(spark, "indexed-ledger")
    sink = make_batch_sink(table, ledger, "fixture", key_buckets=KEY_BUCKETS)
    sink(first, 0)
    sink(second, 1)
    added = read_committed(spark, table, ledger).where(F.col("ingest_batch") == batch_key("fixture", 1))
    return added.select("event_id", "page_no", F.col("pos").cast("long").alias("pos"))


def q_ingest_batch(spark, sf_dir):
    """The event table a full load produces (computed here, not cached)."""
    out = ingest_batch(fixture_pages(spark, sf_dir))
    return out.select(*_row_cols(), "page_no", F.col("pos").cast("long").alias("pos"))


def q_ingest_quarantine(spark, sf_dir):
    """O27b in quarantine mode: bad pages and bad events are skipped, the rest loaded."""
    out = ingest_batch(fixture_pages(spark, sf_dir, invalid=True), strict=False)
    return out.select(*_row_cols(), "page_no", F.col("pos").cast("long").alias("pos"))


def _faulty_pages(spark, sf_dir):
    """Faulty pages with gaps (``% 19 = 4``), copies (``% 23 = 6``) and request cursors not landed (``% 3 = 0``)."""
    p = F.col("page_no")
    pages = fixture_pages(spark, sf_dir, faults=True).where(p % 19 != 4)
    pages = pages.withColumn("request_cursor", F.when(p % 3 != 0, F.col("request_cursor")))
    return pages.unionByName(pages.where(p % 23 == 6))


def q_page_reports(spark, sf_dir):
    """O14 on landed pages with gaps and copies: every violation and report."""
    parsed = decode_all(_faulty_pages(spark, sf_dir))
    return E.check_page_chain(parsed, fill_missing_cursor=True)


def q_ingest_quarantine_chain(spark, sf_dir):
    """O27b in quarantine mode: pages that break the cursor chain are left out, copies count once."""
    out = ingest_batch(_faulty_pages(spark, sf_dir), strict=False)
    return out.select(*_row_cols(), "page_no", F.col("pos").cast("long").alias("pos"))


def q_ingest_stream(spark, sf_dir):
    """The same table through Structured Streaming (several micro-batches)."""
    from ..streaming.ingest_stream import run_ingest_stream
    landed = scratch_path(spark, "stream-landed")
    land_pages_in_order(fixture_pages(spark, sf_dir), landed, files=8)
    table = scratch_path(spark, "stream-table")
    ledger = scratch_path(spark, "stream-ledger")
    ckpt = scratch_path(spark, "stream-ckpt")
    run_ingest_stream(spark, landed, table, ledger, ckpt, run_tag="fixture",
                      max_files_per_trigger=2)
    out = read_committed(spark, table, ledger)
    return out.select(*_row_cols(), "page_no", F.col("pos").cast("long").alias("pos"))


def q_ingest_replay(spark, sf_dir):
    """O5 + O20 + O27: committed batches replayed, re-run with other pages, and old ids again."""
    from ..streaming.ingest_stream import make_batch_sink
    pages = fixture_pages(spark, sf_dir)
    first, second = _split_pages(spark, sf_dir)
    table, ledger = scratch_path(spark, "replay-table"), scratch_path(spark, "replay-ledger")
    sink = make_batch_sink(table, ledger, "fixture")
    sink(first, 0)
    sink(second, 1)
    sink(second, 1)                     # a crash after the ledger row, before Spark's commit
    sink(first, 1)                      # the same id with only stored ids: an empty attempt
    sink(second, 1)                     # and with its own pages again
    sink(pages, 2)                      # every id is stored already
    out = read_committed(spark, table, ledger)
    return out.select(*_row_cols(), "page_no", F.col("pos").cast("long").alias("pos"))


BATCHES = 4                       # loads of the committed-batches fixture


def _committed_loads(spark, sf_dir, hooks=None, pages=None, strict=True):
    """The pages committed as ``BATCHES`` consecutive loads; paths of table, page log and ledger."""
    from ..streaming.ingest_stream import make_batch_sink
    count = fixture_pages(spark, sf_dir).count()
    pages = fixture_pages(spark, sf_dir) if pages is None else pages
    table, ledger, log = (scratch_path(spark, f"loads-{n}") for n in ("table", "ledger", "log"))
    sink = make_batch_sink(table, ledger, "fixture", strict, hooks, log)
    for b in range(BATCHES):
        sink(pages.where(F.floor(F.col("page_no") * BATCHES / F.lit(count)) == b), b)
    return table, log, ledger


def q_stream_progress(spark, sf_dir):
    """O19 from page log and ledger: counters after every page and every committed batch."""
    from ..streaming.ingest_stream import stream_progress
    _, log, ledger = _committed_loads(spark, sf_dir)
    return stream_progress(spark, log, ledger, start_total=100).select(
        "seq", "pages", "events", "inserted", "flushes", "total_ingested", "cursor")


def q_hook_flushes(spark, sf_dir):
    """What the flush hook is told after each committed batch."""
    from ..streaming.hooks import IngestHooks
    told = []
    _committed_loads(spark, sf_dir, IngestHooks(on_flush=told.append))
    return spark.createDataFrame(told, "batch_size long, pages long, inserted long, cursor string, flush_number long")


def q_stream_chain(spark, sf_dir):
    """O14 + O27: the pages of ``ingest_quarantine_chain`` in four loads; breaks across loads are left out as in one."""
    table, _, ledger = _committed_loads(spark, sf_dir, pages=_faulty_pages(spark, sf_dir), strict=False)
    out = read_committed(spark, table, ledger)
    return out.select(*_row_cols(), "page_no", F.col("pos").cast("long").alias("pos"))


def q_left_out(spark, sf_dir):
    """O15 + O27: what four quarantine loads of the invalid fixture left out, as stored with them."""
    from ..streaming.run_state import read_left_out
    _, _, ledger = _committed_loads(spark, sf_dir, pages=fixture_pages(spark, sf_dir, invalid=True), strict=False)
    rows = read_left_out(spark, ledger)
    kept = F.when(F.col("pos").isNull(), F.col("body").isNotNull()).otherwise(F.col("event").isNotNull())
    return rows.select("run_id", "page_no", F.col("pos").cast("long").alias("pos"), "reason", kept.alias("kept"))


def q_stream_flushes(spark, sf_dir):
    """O22 + O27: flushes of a stream whose micro-batches are cut elsewhere (two files each, three runs)."""
    from ..streaming.ingest_stream import run_ingest_stream
    from ..streaming.run_state import stream_flushes
    paths = {n: scratch_path(spark, f"flushes-{n}") for n in ("landed", "table", "ledger", "ckpt")}
    land_pages_in_order(fixture_pages(spark, sf_dir, runs=RUNS_MULTI), paths["landed"], files=8)
    run_ingest_stream(spark, paths["landed"], paths["table"], paths["ledger"], paths["ckpt"], run_tag="fixture",
                      max_files_per_trigger=2, flush_size=FLUSH_BATCH)
    return stream_flushes(spark, paths["ledger"])


DAMAGED_EVERY, DAMAGED_AT = 11, 3      # landed lines cut in half


def q_damaged_lines(spark, sf_dir):
    """O1 + O15: landed lines of which some are cut in half; good pages with their events, and what is told of the others."""
    path = scratch_path(spark, "damaged")
    line = F.to_json(F.struct(*fixture_pages(spark, sf_dir).columns))
    cut = F.col("page_no") % DAMAGED_EVERY == DAMAGED_AT
    (fixture_pages(spark, sf_dir).select(F.when(cut, F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int")))
                                         .otherwise(line).alias("value")).write.mode("overwrite").text(path))
    parsed = E.parse_envelope(scan_pages(spark, path))
    return parsed.select("run_id", "page_no", F.when(F.col("page_error").isNull(), F.size("items")).cast("long").alias("n_events"),
                         F.col("page_error").alias("reason"), (F.col("file").contains("part-") & (
                             F.col("page_error").isNull() | F.col("corrupt_line").startswith("{"))).alias("traced"))


def q_unnest_columns(spark, sf_dir):
    """Each page's rows as three parallel arrays, turned back into rows."""
    rows = event_rows(fixture_pages(spark, sf_dir))
    packed = rows.groupBy("run_id", "page_no").agg(
        F.array_sort(F.collect_list(F.struct(
            "pos", "event_id", F.unix_millis("occurred_at").alias("ms"),
            _pl("eventType", "string").alias("t")))).alias("_r"))
    arrays = packed.select("run_id", "page_no",
                           F.col("_r.event_id").alias("event_id"),
                           F.col("_r.ms").alias("occurred_at_ms"),
                           F.col("_r.t").alias("event_type"))
    return E.unnest_columns(arrays, "event_id", "occurred_at_ms", "event_type",
                            keep=("run_id", "page_no"))


def q_page_chain(spark, sf_dir):
    """Cursor-chain violations on the fixture with planted faults."""
    parsed = decode_all(fixture_pages(spark, sf_dir, faults=True))
    return E.check_page_chain(parsed)


def q_page_chain_lag(spark, sf_dir):
    """O14 with the request cursor not landed: derived from the previous page."""
    parsed = decode_all(fixture_pages(spark, sf_dir, faults=True))
    parsed = parsed.withColumn("request_cursor", F.lit(None).cast("string"))
    return E.check_page_chain(parsed, fill_missing_cursor=True)


def q_invalid_events(spark, sf_dir):
    """Bad pages and bad events planted in the invalid fixture."""
    return E.invalid_events(E.parse_envelope(fixture_pages(spark, sf_dir, invalid=True)))


def _flushes(spark, sf_dir):
    """Page metadata, decoded once and stored, and its flushes."""
    parsed = decode_pages(fixture_pages(spark, sf_dir, runs=RUNS_MULTI))
    meta = E.page_metadata(parsed).checkpoint(eager=True)
    return meta, assign_flush_batches(meta, FLUSH_BATCH).checkpoint(eager=True)


def q_flush_batches(spark, sf_dir):
    """Flush number of every page (threshold 250 events, last page flushes)."""
    _, pages = _flushes(spark, sf_dir)
    return pages.select("run_id", "page_no", "n_events", "flush_no", "closes_flush")


def q_flush_rollup(spark, sf_dir):
    """O22 roll-up: per flush, its pages, events (the batch size) and committed cursor."""
    _, pages = _flushes(spark, sf_dir)
    return flush_rollup(pages).select("run_id", "flush_no", "pages", "events", "cursor")


def _inserted_per_flush(spark, sf_dir):
    parsed, pages = _flushes(spark, sf_dir)
    ingested = ingest_batch(fixture_pages(spark, sf_dir, runs=RUNS_MULTI))
    per_page = ingested.groupBy("run_id", "page_no").agg(F.count(F.lit(1)).alias("ins"))
    with_ins = pages.join(per_page, ["run_id", "page_no"], "left").fillna(0, ["ins"])
    per_flush = with_ins.groupBy("run_id", "flush_no").agg(
        F.sum("ins").cast("long").alias("inserted"),
        F.max_by("next_cursor", "page_no").alias("cursor"),
        F.max("page_no").alias("last_page_no"),
        F.max("fetched_at").alias("ts")).checkpoint(eager=True)
    return parsed, pages, per_flush


def q_run_summary(spark, sf_dir):
    """Per run pages, events, inserted, flushes and final cursor."""
    parsed, pages, per_flush = _inserted_per_flush(spark, sf_dir)
    return L.run_summary(parsed, flushes=per_flush.select("run_id", "flush_no"),
                         inserted=per_flush.select("run_id", "inserted")) \
        .select("run_id", "pages", "events", "inserted", "flushes", "final_cursor")


def q_progress(spark, sf_dir):
    """Running counters after every page and every flush of each run."""
    _, pages, per_flush = _inserted_per_flush(spark, sf_dir)
    page_log = pages.select("run_id", (F.col("page_no") * 2).alias("seq"),
                            F.col("fetched_at").alias("ts"),
                            F.col("n_events").alias("page_size"),
                            F.col("next_cursor").alias("cursor"))
    flush_log = per_flush.select("run_id", (F.col("last_page_no") * 2 + 1).alias("seq"),
                                 "ts", "inserted", "cursor")
    prog = L.ingest_progress(page_log, flush_log, start_total=100,
                             started_at=FX.FIXTURE_EPOCH_MS / 1000.0 - 1)
    return prog.select("run_id", "seq", "pages", "events", "inserted", "flushes",
                       "total_ingested", "cursor")


def q_ledger_state(spark, sf_dir):
    """Every flush committed as a ledger row; the state per run."""
    _, _, per_flush = _inserted_per_flush(spark, sf_dir)
    ledger = per_flush.select("run_id", F.col("flush_no").alias("batch_id"), "cursor",
                              "inserted", F.col("ts").alias("updated_at"))
    return L.latest_state(ledger).select("run_id", "cursor", "total_ingested", "last_batch")


def q_paginate(spark, sf_dir):
    """Orders in key order sliced into pages of 1000."""
    orders = _table(spark, sf_dir, "orders")
    paged = P.paginate(orders.select("o_orderkey", "o_custkey"), ["o_orderkey", "o_custkey"],
                       ORDERS_PAGE)
    return paged.select("o_orderkey", "row_idx", "page_no", "pos",
                        P.encode_cursor(F.col("row_idx") + 1).alias("cursor_after"))


def _ordered_orders(spark, sf_dir):
    """The orders stored in key order with fences, in some ten ranges; the path."""
    path = scratch_path(spark, "ordered")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    write_ordered(orders, path, ["o_orderkey", "o_custkey"], rows_per_range=-(-orders.count() // 10))
    return path


def q_serve_page(spark, sf_dir):
    """The orders page a cursor asks for (rows 5000..5999 in key order), from the ranges that hold it."""
    return serve_stored_page(spark, _ordered_orders(spark, sf_dir), ORDERS_PAGE, SERVE_CURSOR).select("o_orderkey", "row_idx")


def q_stored_keyset_page(spark, sf_dir):
    """The keyset page after key 1000 (limit 500), from the ranges that hold it."""
    path = _ordered_orders(spark, sf_dir)
    return serve_stored_keys(spark, path, "o_orderkey", KEYSET_AFTER, KEYSET_LIMIT).select("o_orderkey")


def q_page_table(spark, sf_dir):
    """O23 page list of the orders table, from its paged rows."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return P.page_list(P.paginate(orders, ["o_orderkey", "o_custkey"], ORDERS_PAGE), ORDERS_PAGE)


def q_keyset_page(spark, sf_dir):
    """The keyset page after key 1000 (limit 500)."""
    orders = _table(spark, sf_dir, "orders")
    return P.keyset_page(orders.select("o_orderkey", "o_totalprice"), "o_orderkey",
                         KEYSET_AFTER, KEYSET_LIMIT).select("o_orderkey")


def q_keyset_chunks(spark, sf_dir):
    """Chunk report of a keyset export over the ingested event ids."""
    table = _ingested(spark, sf_dir)
    return P.keyset_chunks(table, "event_id", CHUNK_SIZE)


def q_export_keys(spark, sf_dir):
    """Ordered export of every stored event id to text files, read back."""
    path = scratch_path(spark, "export")
    export_keys(_ingested(spark, sf_dir), path, "event_id")
    return spark.read.text(path)


def q_export_ordered(spark, sf_dir):
    """O6 from the event table stored in key order: exported range by range without an exchange, read back."""
    path, out = scratch_path(spark, "export-ordered"), scratch_path(spark, "export-ranges")
    ids = _ingested(spark, sf_dir).select("event_id")
    write_ordered(ids, path, ["event_id"], rows_per_range=-(-ids.count() // 10))
    export_ordered(spark, path, out, "event_id")
    return spark.read.text(out).select("value")


def q_payload_fields(spark, sf_dir):
    """Fields of the stored payload; the scan reads their shredded columns only."""
    path = scratch_path(spark, "payloads")
    ingest_batch(fixture_pages(spark, sf_dir)).select("event_id", "payload").write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    return stored.select("event_id", _pl("eventType", "string").alias("event_type"), _pl("copy", "bigint").alias("copy_tag"))


def q_page_shape(spark, sf_dir):
    """Structural profile of every landed page."""
    shape = PR.page_shape(fixture_pages(spark, sf_dir))
    return shape.select("run_id", "page_no",
                        F.array_join("top_level_keys", ",").alias("top_level_keys"),
                        "data_type", F.col("data_length").cast("long").alias("data_length"),
                        "has_more_type", "next_cursor_type",
                        F.array_join("first_event_keys", ",").alias("first_event_keys"),
                        F.col("sample_size").cast("long").alias("sample_size"))


def q_field_profile(spark, sf_dir):
    """Key and type counts over every decoded event."""
    ev = page_events(decode_pages(fixture_pages(spark, sf_dir)))
    return PR.field_profile(ev).select("key", "type", "n", "events", "share")


def q_pending(spark, sf_dir):
    """Landed pages not yet ingested, in name order."""
    stored_pages, _ = _split_pages(spark, sf_dir)
    name = F.format_string("%s/%09d", F.col("run_id"), F.col("page_no")).alias("name")
    available = fixture_pages(spark, sf_dir).select(name)
    applied = stored_pages.select(name)
    return pending(available, applied, "name", suffix=None)


def q_count_events(spark, sf_dir):
    """Rows in the stored event table."""
    return L.count_events(_ingested(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "page_envelope": q_page_envelope,
    "event_rows": q_event_rows,
    "event_table_rows": q_event_table_rows,
    "epoch_units": q_epoch_units,
    "time_forms": q_time_forms,
    "free_dates": q_free_dates,
    "cursor_forms": q_cursor_forms,
    "first_by_key": q_first_by_key,
    "insert_if_absent": q_insert_if_absent,
    "insert_indexed": q_insert_indexed,
    "ingest_batch": q_ingest_batch,
    "ingest_quarantine": q_ingest_quarantine,
    "ingest_quarantine_chain": q_ingest_quarantine_chain,
    "page_reports": q_page_reports,
    "ingest_stream": q_ingest_stream,
    "ingest_replay": q_ingest_replay,
    "stream_progress": q_stream_progress,
    "hook_flushes": q_hook_flushes,
    "stream_chain": q_stream_chain,
    "stream_flushes": q_stream_flushes,
    "left_out": q_left_out,
    "damaged_lines": q_damaged_lines,
    "unnest_columns": q_unnest_columns,
    "page_chain": q_page_chain,
    "page_chain_lag": q_page_chain_lag,
    "invalid_events": q_invalid_events,
    "flush_batches": q_flush_batches,
    "flush_rollup": q_flush_rollup,
    "run_summary": q_run_summary,
    "progress": q_progress,
    "ledger_state": q_ledger_state,
    "paginate": q_paginate,
    "page_table": q_page_table,
    "serve_page": q_serve_page,
    "keyset_page": q_keyset_page,
    "stored_keyset_page": q_stored_keyset_page,
    "keyset_chunks": q_keyset_chunks,
    "export_keys": q_export_keys,
    "export_ordered": q_export_ordered,
    "payload_fields": q_payload_fields,
    "page_shape": q_page_shape,
    "field_profile": q_field_profile,
    "pending": q_pending,
    "count_events": q_count_events,
}
