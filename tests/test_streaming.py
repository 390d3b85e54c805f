"""Streaming ingest: same table as batch, idempotent replay and restart, strict failure."""
import json

import pytest
from pyspark.sql import functions as F

from conftest import pages_df
from sluice.operators import ledger as L
from sluice.plans.ingest import ingest_batch
from sluice.session import scratch_path
from sluice.sources.pages import land_pages_in_order
from sluice.streaming import IngestHooks, run_ingest_stream


def _bodies(n_pages=9):
    out = []
    for p in range(n_pages):
        ev = [{"id": f"k{(p * 5 + i) % 23}", "n": p * 10 + i, "timestamp": 1704067200 + p}
              for i in range(6)]
        more = p < n_pages - 1
        out.append(json.dumps({"data": ev, "hasMore": more, "nextCursor": f"c{p + 1}" if more else None}))
    return out


def _table(spark, path):
    df = spark.read.parquet(path)
    return {r["event_id"]: r["n"] for r in df.select(
        "event_id", F.try_variant_get("payload", "$.n", "bigint").alias("n")).collect()}


def test_stream_equals_batch_and_replay_is_idempotent(spark):
    pages = pages_df(spark, _bodies(), request_cursors=[None] + [f"c{p}" for p in range(1, 9)])
    landed = scratch_path(spark, "t-landed")
    land_pages_in_order(pages, landed, files=5)
    table, ledger = scratch_path(spark, "t-table"), scratch_path(spark, "t-ledger")
    flushes = []
    hooks = IngestHooks(on_flush=flushes.append)
    run_ingest_stream(spark, landed, table, ledger, scratch_path(spark, "t-ck1"), "runA",
                      max_files_per_trigger=2, hooks=hooks)
    batch = {r["event_id"]: r["n"] for r in ingest_batch(pages).select(
        "event_id", F.try_variant_get("payload", "$.n", "bigint").alias("n")).collect()}
    assert _table(spark, table) == batch
    assert len(flushes) == 3 and flushes[-1]["cursor"] is None
    led = L.read_ledger(spark, ledger)
    total = L.lifetime_total(led).first()["total_ingested"]
    assert total == len(batch) == spark.read.parquet(table).count()
    assert sum(f["inserted"] for f in flushes) == total

    # a fresh checkpoint with a new run tag replays everything and inserts nothing
    run_ingest_stream(spark, landed, table, ledger, scratch_path(spark, "t-ck2"), "runB",
                      max_files_per_trigger=3)
    assert _table(spark, table) == batch
    st = L.state_of(L.read_ledger(spark, ledger), "runB")
    assert st["total_ingested"] == 0


def test_strict_stream_commits_nothing_for_a_bad_batch(spark):
    bad = ['{"data":[{"id":"a"}],"hasMore":true,"nextCursor":"c1"}',
           '{"data":[{"id":7}],"hasMore":false,"nextCursor":null}']
    landed = scratch_path(spark, "t-bad")
    land_pages_in_order(pages_df(spark, bad), landed, files=1)
    table, ledger = scratch_path(spark, "t-bad-table"), scratch_path(spark, "t-bad-ledger")
    with pytest.raises(Exception, match="missing event id"):
        run_ingest_stream(spark, landed, table, ledger, scratch_path(spark, "t-bad-ck"), "runC")
    assert spark.read.parquet(table).count() == 0 if _has_parquet(spark, table) else True
    assert not _has_parquet(spark, ledger)


def _has_parquet(spark, path):
    try:
        spark.read.parquet(path)
        return True
    except Exception:  # noqa: BLE001
        return False


def test_listener_sees_observed_metrics_and_compaction_keeps_rows(spark):
    from sluice.sources.sinks import compact_partitions
    from sluice.streaming import ProgressCollector
    pages = pages_df(spark, _bodies(4), request_cursors=[None, "c1", "c2", "c3"])
    landed = scratch_path(spark, "t-l2")
    land_pages_in_order(pages, landed, files=2)
    table, ledger = scratch_path(spark, "t-t2"), scratch_path(spark, "t-led2")
    listener = ProgressCollector()
    spark.streams.addListener(listener)
    try:
        run_ingest_stream(spark, landed, table, ledger, scratch_path(spark, "t-ck3"), "runL",
                          max_files_per_trigger=1)
        import time
        deadline = time.time() + 20          # listener events are delivered asynchronously
        while sum(r["input_rows"] for r in listener.rows) < 4 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert sum(r["input_rows"] for r in listener.rows) == 4
    out = scratch_path(spark, "t-compact")
    compact_partitions(spark, table, out)
    assert _table(spark, out) == _table(spark, table)


def test_parquet_landed_pages(spark):
    from sluice.sources.pages import scan_pages
    pages = pages_df(spark, _bodies(3))
    path = scratch_path(spark, "t-pq")
    pages.write.mode("overwrite").parquet(path)
    assert ingest_batch(scan_pages(spark, path, fmt="parquet")).count() == \
        ingest_batch(pages).count()


def test_readers_see_only_committed_batches(spark):
    from sluice.sources.sinks import batch_key, read_committed, write_event_partition
    pages = pages_df(spark, _bodies(4), request_cursors=[None, "c1", "c2", "c3"])
    landed = scratch_path(spark, "t-l4")
    land_pages_in_order(pages, landed, files=2)
    table, ledger = scratch_path(spark, "t-t4"), scratch_path(spark, "t-led4")
    run_ingest_stream(spark, landed, table, ledger, scratch_path(spark, "t-ck4"), "runR",
                      max_files_per_trigger=1)
    committed = read_committed(spark, table, ledger)
    assert committed.count() == spark.read.parquet(table).count()
    # a crash after the data write and before the ledger write: rows not visible
    stray = spark.read.parquet(table).drop("ingest_batch").limit(3) \
        .withColumn("event_id", F.concat(F.lit("stray-"), "event_id"))
    write_event_partition(stray, table, batch_key("runR", 99))
    assert spark.read.parquet(table).count() == committed.count() + 3
    assert read_committed(spark, table, ledger).count() == committed.count()


def test_replaying_the_same_batch_changes_nothing(spark):
    from sluice.streaming.ingest_stream import make_batch_sink
    pages = pages_df(spark, _bodies(6), request_cursors=[None] + [f"c{p}" for p in range(1, 6)])
    table, ledger = scratch_path(spark, "t-t5"), scratch_path(spark, "t-led5")
    sink = make_batch_sink(table, ledger, "runP")
    sink(pages.where("page_no < 3"), 0)
    sink(pages.where("page_no >= 3"), 1)
    before = _table(spark, table)
    led_before = sorted(tuple(r) for r in L.read_ledger(spark, ledger)
                        .select("run_id", "batch_id", "cursor", "inserted").collect())
    sink(pages.where("page_no >= 3"), 1)          # replay after a crash before the commit
    sink(pages.where("page_no < 3"), 0)           # and an older batch, too
    assert _table(spark, table) == before
    led_after = sorted(tuple(r) for r in L.read_ledger(spark, ledger)
                       .select("run_id", "batch_id", "cursor", "inserted").collect())
    assert led_after == led_before
    assert sum(r[3] for r in led_after) == len(before)


def test_uncommitted_partition_is_not_treated_as_stored(spark):
    from sluice.sources.sinks import batch_key, read_committed, write_event_partition
    from sluice.streaming.ingest_stream import make_batch_sink
    pages = pages_df(spark, _bodies(4), request_cursors=[None, "c1", "c2", "c3"])
    table, ledger = scratch_path(spark, "t-t6"), scratch_path(spark, "t-led6")
    # a crashed run wrote its rows but never its ledger row
    crashed = ingest_batch(pages.where("page_no < 2")).select(
        "event_id", "occurred_at", "payload", "ingested_at", "run_id", "page_no", "pos")
    write_event_partition(crashed, table, batch_key("runOld", 0))
    # a fresh run replays everything: the uncommitted ids are inserted again
    make_batch_sink(table, ledger, "runNew")(pages, 0)
    committed = read_committed(spark, table, ledger)
    ids = [r["event_id"] for r in committed.select("event_id").collect()]
    assert len(ids) == len(set(ids)) == len(_table(spark, table))
    assert set(ids) == set(r["event_id"] for r in ingest_batch(pages).select("event_id").collect())


def test_stream_progress_from_page_log_and_ledger(spark):
    from sluice.streaming import stream_progress
    pages = pages_df(spark, _bodies(6), request_cursors=[None] + [f"c{p}" for p in range(1, 6)]) \
        .withColumn("fetched_at", F.timestamp_seconds(F.lit(1704067200) + F.col("page_no")))
    landed = scratch_path(spark, "t-l7")
    land_pages_in_order(pages, landed, files=3)
    table, ledger, plog = (scratch_path(spark, n) for n in ("t-t7", "t-led7", "t-plog7"))
    run_ingest_stream(spark, landed, table, ledger, scratch_path(spark, "t-ck7"), "runG",
                      max_files_per_trigger=1, page_log_path=plog)
    prog = stream_progress(spark, plog, ledger, start_total=100).orderBy("seq").collect()
    last = prog[-1]
    n_rows = spark.read.parquet(table).count()
    assert (last["pages"], last["events"], last["flushes"]) == (6, 36, 3)
    assert last["inserted"] == n_rows and last["total_ingested"] == 100 + n_rows
    assert last["cursor"] is None                      # the final flush commits the null cursor
    assert [r["pages"] for r in prog][:3] == [1, 2, 2]  # two pages, then the first flush


def test_batch_and_stream_loads_share_one_table(spark):
    from sluice.sources.sinks import read_committed
    from sluice.streaming import ingest_into_table
    pages = pages_df(spark, _bodies(6), request_cursors=[None] + [f"c{p}" for p in range(1, 6)])
    table, ledger = scratch_path(spark, "t-t8"), scratch_path(spark, "t-led8")
    ingest_into_table(pages.where("page_no < 3"), table, ledger, "backfill", 0)
    ingest_into_table(pages.where("page_no < 3"), table, ledger, "backfill", 0)   # re-run: no change
    landed = scratch_path(spark, "t-l8")
    land_pages_in_order(pages.where("page_no >= 3"), landed, files=1)
    run_ingest_stream(spark, landed, table, ledger, scratch_path(spark, "t-ck8"), "live")
    got = {r["event_id"]: r["n"] for r in read_committed(spark, table, ledger).select(
        "event_id", F.try_variant_get("payload", "$.n", "bigint").alias("n")).collect()}
    want = {r["event_id"]: r["n"] for r in ingest_batch(pages).select(
        "event_id", F.try_variant_get("payload", "$.n", "bigint").alias("n")).collect()}
    assert got == want


def test_stream_over_parquet_landed_pages(spark):
    from sluice.sources.pages import scan_pages
    from sluice.streaming.ingest_stream import make_batch_sink
    pages = pages_df(spark, _bodies(4), request_cursors=[None, "c1", "c2", "c3"])
    landed = scratch_path(spark, "t-pq-landed")
    pages.coalesce(1).write.mode("overwrite").parquet(landed)
    table, ledger = scratch_path(spark, "t-pq-t"), scratch_path(spark, "t-pq-led")
    q = (scan_pages(spark, landed, streaming=True, fmt="parquet").writeStream
         .foreachBatch(make_batch_sink(table, ledger, "pq"))
         .option("checkpointLocation", scratch_path(spark, "t-pq-ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert _table(spark, table) == {r["event_id"]: r["n"] for r in ingest_batch(pages).select(
        "event_id", F.try_variant_get("payload", "$.n", "bigint").alias("n")).collect()}


def test_run_tag_must_be_path_safe():
    from sluice.sources.sinks import batch_key
    assert batch_key("live-1.a_b", 7) == "live-1.a_b-000000000007"
    with pytest.raises(ValueError):
        batch_key("bad/tag", 1)


def test_a_load_lists_only_the_batches_it_overlaps(spark, tmp_path):
    from sluice.operators.ledger import advance_state
    from sluice.sources.sinks import batch_key, committed_prior, write_event_partition
    table, ledger = str(tmp_path / "t"), str(tmp_path / "l")
    for b, ids in enumerate((["a", "b"], ["c", "d"], ["e", "f"])):
        rows = spark.createDataFrame([(i, None, None, None, "r", b, 0) for i in ids],
                                     "event_id string, occurred_at timestamp, payload string, ingested_at timestamp, "
                                     "run_id string, page_no long, pos int").withColumn("payload", F.parse_json(F.lit("{}")))
        attempt = write_event_partition(rows, table, batch_key("x", b))
        advance_state(spark, ledger, "x", b, None, 2, ids[0], ids[-1], attempt)
    near = committed_prior(spark, table, ledger, "d", "dd")
    assert [r.event_id for r in near.collect()] == ["d"]
    assert {p.split("ingest_batch=")[1].split("/")[0] for p in near.inputFiles()} == {batch_key("x", 1)}
    assert committed_prior(spark, table, ledger, "d", "dd", exclude=batch_key("x", 1)) is None
