"""Page shape, field profile, synthetic events and mock pages."""
import json

from pyspark.sql import functions as F

from conftest import pages_df
from sluice.operators.profile import field_profile, page_shape
from sluice.plans.ingest import decode_pages, ingest_batch, page_events
from sluice.sources.generate import generate_events, mock_pages


def test_page_shape_of_a_camel_case_page(spark):
    body = '{"data":[{"eventId":"evt-1","occurredAt":"2026-01-01T00:00:00.000Z"}],' \
           '"hasMore":true,"nextCursor":"c"}'
    r = page_shape(pages_df(spark, [body])).first()
    assert r["top_level_keys"] == ["data", "hasMore", "nextCursor"]
    assert (r["data_type"], r["data_length"], r["has_more_type"], r["next_cursor_type"]) == \
        ("array", 1, "boolean", "string")
    assert r["first_event_keys"] == ["eventId", "occurredAt"]
    assert r["sample_size"] == 1


def test_page_shape_absent_and_null(spark):
    r = page_shape(pages_df(spark, ['{"events":[],"nextCursor":null}'])).first()
    assert (r["data_type"], r["data_length"], r["has_more_type"], r["next_cursor_type"]) == \
        ("undefined", None, "undefined", "null")


def test_field_profile(spark):
    body = json.dumps({"data": [{"id": "a", "t": 1}, {"id": "b", "t": "x"}, {"id": "c", "t": None}],
                       "hasMore": False})
    prof = {(r["key"], r["type"]): (r["n"], r["events"]) for r in
            field_profile(page_events(decode_pages(pages_df(spark, [body])))).collect()}
    assert prof[("id", "string")] == (3, 3)
    assert prof[("t", "number")] == (1, 3) and prof[("t", "string")] == (1, 3)
    assert prof[("t", "null")] == (1, 3)


def test_generated_events(spark):
    rows = generate_events(spark, 3).orderBy("idx").collect()
    assert [r["eventId"] for r in rows] == ["evt-0000000", "evt-0000001", "evt-0000002"]
    assert rows[0]["occurredAt"] == "2024-01-01T00:00:00.000Z"
    assert rows[1]["occurredAt"] == "2024-01-01T00:00:01.000Z"
    assert [r["eventType"] for r in rows] == ["click", "view", "click"]
    assert {r["source"] for r in rows} == {"mock-api"}
    big = generate_events(spark, 1).select(F.format_string("evt-%07d", F.lit(123456789)).alias("x"))
    assert big.first()["x"] == "evt-123456789"   # padded, never truncated


def test_mock_pages_round_trip(spark):
    pages = mock_pages(generate_events(spark, 5), 2)
    parsed = decode_pages(pages).orderBy("page_no").collect()
    assert [len(p["items"]) for p in parsed] == [2, 2, 1]
    assert [p["has_more"] for p in parsed] == [True, True, False]
    assert parsed[-1]["next_cursor"] is None
    assert ingest_batch(pages).count() == 5


def test_page_shape_first_event_array_keys(spark):
    r = page_shape(pages_df(spark, ['{"data":[[7,8,9]],"hasMore":false}'])).first()
    assert r["first_event_keys"] == ["0", "1", "2"]
    r = page_shape(pages_df(spark, ['{"data":[[]],"hasMore":false}'])).first()
    assert r["first_event_keys"] == []


def test_page_shape_key_order_follows_object_keys(spark):
    body = '{"b":1,"2":0,"data":[{"z":1,"10":1,"a":1,"1":1,"z":2}],"1":0,"hasMore":false}'
    r = page_shape(pages_df(spark, [body])).first()
    assert r["top_level_keys"] == ["1", "2", "b", "data", "hasMore"]
    assert r["first_event_keys"] == ["1", "10", "z", "a"]
