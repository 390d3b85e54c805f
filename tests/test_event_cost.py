"""The cost of an event in the committed loads: what each does once and does not carry along."""

import inspect
from collections import Counter

from pyspark.sql import functions as F

from sluice.operators import paging
from sluice.operators.envelope import finish_events
from sluice.sources.fixtures import event_pages
from sluice.sources.sinks import attempt_rows, attempt_stats, batch_key, write_event_partition
from sluice.streaming.hooks import IngestHooks
from sluice.streaming.ingest_stream import ingest_into_table

BODY = '{"data":[{"id":"a","timestamp":1704067200},{"event_id":"b","occurredAt":null,"timestamp":null,"x":null},{"eventId":"c"}],"hasMore":false}'


def _pages(spark):
    return spark.createDataFrame([("r", 0, None, BODY)], "run_id string, page_no long, request_cursor string, body string") \
        .withColumn("fetched_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_fields_of_an_event_are_read_once(spark):
    events = spark.createDataFrame([("a", '{"id":"a","timestamp":1704067200}'), ("b", '{"id":"b","occurredAt":null,"timestamp":null,"x":null}'),
                                    ("c", '{"eventId":"c"}')], "event_id string, j string").withColumn("event", F.parse_json("j")).drop("j")
    done = finish_events(events)
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert "$['occurredAt']" not in plan and "$['timestamp']" not in plan       # look-ups in the map, not in the VARIANT
    got = {r[0]: (r[1], r[2], r[3]) for r in done.select("event_id", F.unix_millis("occurred_at"), "time_present",
                                                           F.to_json("payload")).collect()}
    assert got == {"a": (1704067200000, True, '{"eventId":"a","id":"a","occurredAt":"2024-01-01T00:00:00.000Z","timestamp":1704067200}'),
                   "b": (None, True, '{"eventId":"b","id":"b","occurredAt":null,"timestamp":null,"x":null}'),
                   "c": (None, False, '{"eventId":"c"}')}


def test_strict_load_keeps_no_bodies(spark, tmp_path):
    seen = []
    hooks = IngestHooks(on_pages=lambda pages, _: seen.append(pages._jdf.queryExecution().withCachedData().toString()))
    ingest_into_table(_pages(spark), str(tmp_path / "t"), str(tmp_path / "l"), "r", 0, hooks=hooks)
    kept = seen[0].split("InMemoryRelation [")[1].split("]")[0]
    assert "items" in kept and "body" not in kept


def test_attempt_is_one_folder_even_when_empty(spark, tmp_path):
    table, key = str(tmp_path / "t"), batch_key("r", 0)
    rows = spark.sql("SELECT 'e' event_id, timestamp_millis(0) occurred_at, parse_json('{}') payload, timestamp_millis(0) ingested_at,"
                     " 'r' run_id, 0L page_no, 0 pos")
    full, empty = write_event_partition(rows, table, key), write_event_partition(rows.where("false"), table, key)
    assert attempt_stats(spark, table, key, full) == (1, "e", "e")
    assert attempt_stats(spark, table, key, empty) == (0, None, None)
    assert attempt_rows(spark, table, key, empty).count() == 0
    assert Counter(r.attempt for r in attempt_rows(spark, table, key, full).collect()) == {full: 1}


def test_fixture_ranges_are_smaller_than_a_plain_tables():
    ranges = inspect.signature(event_pages).parameters["rows_per_bucket"].default
    assert ranges * 8 < paging.ROWS_PER_BUCKET
