"""Cursor chain, flushes and rows left out: in one decode, and across micro-batches."""
import json

import pytest
from pyspark.sql import functions as F

from conftest import pages_df
from sluice.operators import chain as C
from sluice.operators import envelope as E
from sluice.operators.flush import FLUSH_STATE, assign_flush_batches, flush_rollup, flush_step
from sluice.plans.ingest import chain_breaks, ingest_batch, split_pages
from sluice.session import scratch_path
from sluice.sources.pages import land_pages_in_order, scan_pages
from sluice.sources.sinks import read_committed
from sluice.streaming import read_left_out, run_ingest_stream, stream_flushes
from sluice.streaming.ingest_stream import make_batch_sink
from sluice.streaming.run_state import committed_state

STUCK = ['{"data":[{"id":"a"}],"hasMore":true,"nextCursor":"X"}', '{"data":[{"id":"b"}],"hasMore":true,"nextCursor":"X"}']


def _ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


def _paths(spark, *names):
    return [scratch_path(spark, f"t-{n}") for n in names]


@pytest.mark.parametrize("source", ["local", "parquet", "checkpoint"])
def test_strict_batch_fails_where_the_request_cursor_was_not_landed(spark, source):
    pages = pages_df(spark, STUCK)
    if source == "parquet":
        path = scratch_path(spark, "t-stuck")
        pages.write.mode("overwrite").parquet(path)
        pages = spark.read.parquet(path)
    elif source == "checkpoint":
        pages = pages.checkpoint()
    told = r"cursor did not advance \(run r, page 1\)"
    with pytest.raises(Exception, match=told):
        ingest_batch(pages).collect()
    with pytest.raises(Exception, match=told):
        ingest_batch(pages).write.mode("overwrite").parquet(scratch_path(spark, "t-stuck-out"))
    # Later filters, however selective, do not take the check away.
    for narrow in (F.col("event_id") == "a", F.col("page_no") == 0, F.col("run_id").isNull(), F.lit(False)):
        df = ingest_batch(pages).where(narrow)
        if "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString():
            continue            # WHERE FALSE: nothing at all is read
        with pytest.raises(Exception, match=told):
            df.collect()
    assert _ids(ingest_batch(pages, strict=False)) == ["a"]


def test_one_decode_and_one_exchange_in_the_strict_plan(spark):
    path = scratch_path(spark, "t-plan")
    pages_df(spark, STUCK).write.mode("overwrite").parquet(path)
    plan = ingest_batch(spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1
    physical = ingest_batch(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") == 1 and "raise_error" in physical


def test_sound_chains_and_ids_that_spell_a_record(spark):
    bodies = [json.dumps({"data": [{"id": i} for i in ids], "hasMore": p < 2, "nextCursor": f"c{p + 1}" if p < 2 else None})
              for p, ids in enumerate([["a", "1:1:rc1", "0:1:rc1"], ["b", "a", "1:1:rc1"], ["2:1:rc2", "1:1:rc2", "c"]])]
    got = ingest_batch(pages_df(spark, bodies)).select("event_id", "page_no", "pos").collect()
    assert sorted(map(tuple, got)) == sorted([("a", 0, 0), ("1:1:rc1", 0, 1), ("0:1:rc1", 0, 2), ("b", 1, 0),
                                              ("2:1:rc2", 2, 0), ("1:1:rc2", 2, 1), ("c", 2, 2)])
    empty = pages_df(spark, ['{"data":[],"hasMore":true,"nextCursor":"X"}', '{"data":[],"hasMore":true,"nextCursor":"X"}'])
    with pytest.raises(Exception, match="did not advance"):
        ingest_batch(empty).collect()


def test_any_landed_copy_of_the_page_before_counts(spark):
    bodies = ['{"data":[],"hasMore":true,"nextCursor":"A"}', '{"data":[],"hasMore":true,"nextCursor":"Z"}',
              '{"data":[{"id":"b"}],"hasMore":true,"nextCursor":"A"}']
    pages = pages_df(spark, bodies).withColumn("page_no", F.when(F.col("page_no") == 2, 1).otherwise(0).cast("long"))
    kinds = {(r.page_no, r.kind) for r in E.check_page_chain(E.parse_envelope(pages), fill_missing_cursor=True).collect()}
    assert (1, E.ERR_STUCK) in kinds
    assert {r.page_no for r in chain_breaks(E.page_metadata(E.parse_envelope(pages))).collect()} == {1}
    with pytest.raises(Exception, match="did not advance"):
        ingest_batch(pages).collect()
    assert _ids(ingest_batch(pages, strict=False)) == []


@pytest.mark.parametrize("strict", [True, False])
def test_break_across_micro_batches(spark, strict):
    pages = pages_df(spark, STUCK)
    table, ledger = _paths(spark, "c-table", "c-ledger")
    sink = make_batch_sink(table, ledger, "runX", strict)
    sink(pages.where("page_no = 0"), 0)
    if strict:
        with pytest.raises(ValueError, match=r"cursor did not advance \(run r, page 1\)"):
            sink(pages.where("page_no = 1"), 1)
        assert _ids(read_committed(spark, table, ledger)) == ["a"]
        return
    for _ in range(2):                             # a replay finds the same state
        sink(pages.where("page_no = 1"), 1)
    assert _ids(read_committed(spark, table, ledger)) == ["a"] == _ids(ingest_batch(pages, strict=False))
    left = read_left_out(spark, ledger).collect()
    assert [(r.page_no, r.pos, r.reason, r.body) for r in left] == [(1, None, E.ERR_STUCK, STUCK[1])]


def test_strict_stream_stops_at_a_break_between_two_files(spark):
    landed, table, ledger, ckpt = _paths(spark, "cs-landed", "cs-table", "cs-ledger", "cs-ckpt")
    land_pages_in_order(pages_df(spark, STUCK), landed, files=2)
    with pytest.raises(Exception, match="cursor did not advance"):
        run_ingest_stream(spark, landed, table, ledger, ckpt, "runY", max_files_per_trigger=1)
    assert _ids(read_committed(spark, table, ledger)) == ["a"]


def _run(n, run, stop=True):
    return [json.dumps({"data": [{"id": f"{run}{p}-{i}"} for i in range(p % 4)], "hasMore": p < n - 1 or not stop,
                        "nextCursor": f"c{p + 1}" if p < n - 1 or not stop else None}) for p in range(n)]


def test_open_records_stay_few_and_meet_out_of_order(spark):
    pages = pages_df(spark, _run(9, "a"))
    table, ledger = _paths(spark, "o-table", "o-ledger")
    sink = make_batch_sink(table, ledger, "runO")
    opened = []
    for b in range(5):
        sink(pages.where(F.col("page_no").between(2 * b, 2 * b + 1)), b)
        opened.append([tuple(r) for r in committed_state(spark, ledger, "chain").where(F.col("batch_id") == b)
                       .select("page_no", "cursor", "side").collect()])
    assert opened == [[(2, "c2", C.ASKED)], [(4, "c4", C.ASKED)], [(6, "c6", C.ASKED)], [(8, "c8", C.ASKED)], []]
    # The stuck page before the page that shows it: told when that one comes.
    table, ledger = _paths(spark, "l-table", "l-ledger")
    sink = make_batch_sink(table, ledger, "runL")
    stuck = pages_df(spark, STUCK)
    sink(stuck.where("page_no = 1"), 0)
    assert [r.side for r in committed_state(spark, ledger, "chain").orderBy("side").collect()] == [C.OWN, C.ASKED]
    with pytest.raises(ValueError, match=r"did not advance \(run r, page 1\)"):
        sink(stuck.where("page_no = 0"), 1)


def _expected_flushes(spark, pages, size):
    parsed = E.page_metadata(E.parse_envelope(pages))
    return sorted(tuple(r) for r in flush_rollup(assign_flush_batches(parsed, size))
                  .select("run_id", "flush_no", "pages", "events", "cursor").collect())


@pytest.mark.parametrize("files", [1, 2, 8])
def test_flushes_do_not_depend_on_triggers(spark, files):
    bodies = _run(16, "a")
    pages = pages_df(spark, bodies, "r1").unionByName(pages_df(spark, _run(11, "b"), "r2"))
    landed, table, ledger, ckpt = _paths(spark, "f-landed", "f-table", "f-ledger", "f-ckpt")
    land_pages_in_order(pages, landed, files=8)
    told = []
    from sluice.streaming import IngestHooks
    run_ingest_stream(spark, landed, table, ledger, ckpt, "runF", max_files_per_trigger=files, flush_size=5,
                      hooks=IngestHooks(on_flush=told.append))
    got = sorted(tuple(r) for r in stream_flushes(spark, ledger).select("run_id", "flush_no", "pages", "events", "cursor").collect())
    assert got == _expected_flushes(spark, pages, 5)
    assert sorted((f["run_id"], f["flush_number"], f["pages"], f["batch_size"], f["cursor"]) for f in told) == got
    assert stream_flushes(spark, ledger).agg(F.sum("inserted")).first()[0] == read_committed(spark, table, ledger).count()


def test_flush_state_of_unfinished_runs_and_replays(spark):
    pages = pages_df(spark, _run(10, "a", stop=False), "r1")
    meta = E.page_metadata(E.parse_envelope(pages)).withColumn("inserted", F.col("n_events"))
    state, flushes = spark.createDataFrame([], FLUSH_STATE), []
    for low, high in [(0, 0), (1, 4), (5, 5), (6, 9)]:
        step = lambda: flush_step(meta.where(F.col("page_no").between(low, high)), 4, state)
        closed, after = step()
        again, after_again = step()
        assert sorted(closed.collect()) == sorted(again.collect()) and after.collect() == after_again.collect()
        flushes += [(r.flush_no, r.pages, r.events) for r in closed.collect()]
        state = after.checkpoint()
    whole = assign_flush_batches(meta, 4)
    rolled = {r.flush_no: (r.flush_no, r.pages, r.events) for r in flush_rollup(whole).collect()}
    closed_nos = {r.flush_no for r in whole.where("closes_flush").collect()}
    assert sorted(flushes) == sorted(rolled[n] for n in closed_nos)
    left = state.first()
    open_no = max(rolled)
    want = (open_no - 1, *rolled[open_no][1:]) if open_no not in closed_nos else (open_no, 0, 0)
    assert (left.flushes, left.pages, left.events) == want


def test_split_keeps_everything_once(spark):
    bodies = ['{"data":[{"id":"a"},{"id":7},"x",null,{"id":"b"}],"hasMore":true,"nextCursor":"c1"}', "nope",
              '{"data":[{"id":"c"}],"hasMore":true,"nextCursor":null}', '{"data":[[1],{"id":"d"}],"hasMore":false}']
    split = split_pages(pages_df(spark, bodies))
    good, bad = split.events.collect(), split.left_out.collect()
    assert sorted(r.event_id for r in good) == ["a", "b", "d"]
    pages = {(r.page_no, r.reason) for r in bad if r.pos is None}
    assert pages == {(1, E.ERR_NOT_JSON), (2, E.ERR_NO_CURSOR)}
    assert {(r.page_no, r.pos) for r in bad if r.pos is not None} == {(0, 1), (0, 2), (0, 3), (3, 0)}
    assert all((r.body is None) == (r.pos is not None) for r in bad)
    kept = split.left_out.where("page_no = 0 AND pos = 1").select(F.to_json("event").alias("j")).first()
    assert json.loads(kept.j) == {"id": 7}


def test_unreadable_lines_are_told_with_their_file(spark):
    path = scratch_path(spark, "t-corrupt")
    line = json.dumps({"run_id": "r", "page_no": 0, "body": '{"data":[{"id":"a"}],"hasMore":false}'})
    spark.createDataFrame([(line,), ('{"run_id":"r","page_no":1,"bo',), ('{"page_no":"seven","body":"{}"}',)], "value string") \
        .coalesce(1).write.mode("overwrite").text(path)
    with pytest.raises(Exception, match=r"unreadable line \(.*file .*part-"):
        ingest_batch(scan_pages(spark, path)).collect()
    pages = scan_pages(spark, path)
    assert _ids(ingest_batch(pages, strict=False)) == ["a"]
    told = E.invalid_events(E.parse_envelope(pages)).collect()
    assert [r.reason for r in told] == [E.ERR_UNREADABLE] * 2
    table, ledger = _paths(spark, "u-table", "u-ledger")
    make_batch_sink(table, ledger, "runU", strict=False)(pages, 0)
    left = read_left_out(spark, ledger).collect()
    assert sorted(r.body for r in left) == ['{"page_no":"seven","body":"{}"}', '{"run_id":"r","page_no":1,"bo']
    assert all("part-" in r.file for r in left)


def test_messages_without_run_or_page(spark):
    pages = pages_df(spark, ["nope"]).withColumn("run_id", F.lit(None).cast("string")).withColumn("page_no", F.lit(None).cast("long"))
    with pytest.raises(Exception, match="body is not JSON"):
        ingest_batch(pages).collect()
    bad = pages_df(spark, ['{"data":[{"id":7}]}']).withColumn("run_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match=r"missing event id \(page 0, item 0\)"):
        ingest_batch(bad).collect()
