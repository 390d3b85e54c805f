"""Decoder cases: the source system's parser tests plus cases read from its code."""
import json

import pytest
from pyspark.sql import functions as F

from conftest import pages_df
from sluice.operators import envelope as E
from sluice.plans.ingest import event_rows


def _decode(spark, body):
    r = E.parse_envelope(pages_df(spark, [body])).select(
        F.size("items").alias("n"), "has_more", "next_cursor", "page_error").first()
    return r.asDict()


def _events(spark, events, **kw):
    body = json.dumps({"data": events, "hasMore": False, "nextCursor": None})
    df = event_rows(pages_df(spark, [body]), strict=False)
    return [r.asDict() for r in df.select(
        "pos", "event_id", F.unix_millis("occurred_at").alias("ms"), "time_present",
        F.to_json("payload").alias("payload")).orderBy("pos").collect()]


def test_camel_case_page(spark):
    body = '{"data":[{"eventId":"evt-1","occurredAt":"2026-01-01T00:00:00.000Z","eventType":"x"}],' \
           '"hasMore":true,"nextCursor":"c1"}'
    assert _decode(spark, body) == {"n": 1, "has_more": True, "next_cursor": "c1", "page_error": None}


def test_nested_pagination_and_snake_case(spark):
    assert _decode(spark, '{"data":[],"pagination":{"hasMore":true,"nextCursor":"n"}}')["has_more"]
    d = _decode(spark, '{"data":[],"has_more":"true","next_cursor":"n2"}')
    assert d["has_more"] is True and d["next_cursor"] == "n2"


def test_envelope_code_cases(spark):
    assert _decode(spark, '{"data":{},"events":[{"id":"b"}]}')["n"] == 1
    # an uncoercible top-level value stops the search
    assert _decode(spark, '{"data":[],"hasMore":"maybe","pagination":{"hasMore":true}}')["has_more"] is False
    assert _decode(spark, '{"data":[],"nextCursor":"c"}')["has_more"] is True
    assert _decode(spark, '{"data":[],"nextCursor":""}')["has_more"] is False
    assert _decode(spark, '{"data":[],"nextCursor":5}')["next_cursor"] is None
    assert _decode(spark, '{"data":[],"hasMore":1}')["has_more"] is True
    assert _decode(spark, '{"data":[],"hasMore":0,"nextCursor":"c"}')["has_more"] is False
    assert _decode(spark, '{"data":[],"hasMore":" TRUE "}')["has_more"] is True


def test_envelope_errors(spark):
    assert _decode(spark, '{"data":{},"hasMore":false}')["page_error"] == E.ERR_NOT_ARRAY
    assert _decode(spark, '[1,2]')["page_error"] == E.ERR_NOT_ARRAY
    assert _decode(spark, '"x"')["page_error"] == E.ERR_NOT_OBJECT
    assert _decode(spark, '{bad')["page_error"] == E.ERR_NOT_JSON


def test_time_encodings(spark):
    inst = 1769541612369
    evs = [
        {"id": "a", "timestamp": inst},
        {"id": "b", "timestamp": str(inst)},
        {"id": "c", "timestamp": inst * 1000},
        {"id": "d", "timestamp": inst * 1000000},
        {"id": "e", "timestamp": 1769541612},
        {"id": "f", "timestamp": "2024"},
        {"id": "g", "timestamp": "20240101"},
        {"event_id": "h", "timestamp": "2026-01-01T00:00:01Z"},
        {"id": "i", "timestamp": True},
        {"id": "j", "timestamp": {}},
        {"id": "k", "timestamp": ""},
        {"id": "l", "timestamp": "12:30"},
        {"id": "m", "timestamp": " \t 1769541612369 \n"},
        {"id": "n", "timestamp": "Mon, 01 Jan 2024 00:00:07 GMT"},
        {"id": "o", "timestamp": "0x10"},
        {"id": "p", "timestamp": "2024-01-01T00:00"},
    ]
    got = {r["event_id"]: r["ms"] for r in _events(spark, evs)}
    assert got["a"] == inst and got["b"] == inst and got["c"] == inst and got["d"] == inst
    assert got["e"] == 1769541612000
    assert got["f"] == 2024 and got["g"] == 20240101
    assert got["h"] == 1767225601000
    assert got["i"] is None and got["j"] is None and got["k"] is None and got["l"] is None
    assert got["m"] == inst
    assert got["n"] == 1704067207000
    assert got["o"] == 16
    assert got["p"] == 1704067200000


def test_double_division_and_infinity(spark):
    body = '{"data":[{"id":"a","timestamp":1769541612368999950},{"id":"b","timestamp":1e400}],' \
           '"hasMore":false}'
    rows = event_rows(pages_df(spark, [body]), strict=False).select(
        "event_id", F.unix_millis("occurred_at").alias("ms")).orderBy("event_id").collect()
    assert rows[0]["ms"] == 1769541612369
    assert rows[1]["ms"] is None


def test_event_ids(spark):
    evs = [{"eventId": None, "id": "a"}, {"eventId": "", "id": "a2"}, {"id": 7}, [1], "x",
           {"id": "a", "id2": 1}]
    body = json.dumps({"data": evs, "hasMore": False})
    ev = E.with_event_ids(E.explode_events(E.parse_envelope(pages_df(spark, [body]))))
    rows = ev.select("pos", "event_id", "reason").orderBy("pos").collect()
    assert rows[0]["event_id"] == "a"
    assert rows[1]["reason"] == "missing event id"
    assert rows[2]["reason"] == "missing event id"
    assert rows[3]["reason"] == "missing event id"       # an array is record-like
    assert rows[4]["reason"] == "event must be an object"
    assert rows[5]["event_id"] == "a"


def test_duplicate_key_last_wins(spark):
    body = '{"data":[{"id":"a","id":"b"}],"hasMore":false}'
    df = event_rows(pages_df(spark, [body]), strict=False)
    assert df.first()["event_id"] == "b"


def test_payload_null_versus_absent(spark):
    rows = _events(spark, [{"id": "a", "occurredAt": None},
                           {"id": "b", "occurredAt": None, "timestamp": None},
                           {"id": "c", "occurredAt": "2026-01-01T00:00:00Z", "extra": [1]}])
    pa, pb, pc = (json.loads(r["payload"]) for r in rows)
    assert "occurredAt" not in pa and pa["eventId"] == "a"
    assert "occurredAt" in pb and pb["occurredAt"] is None and pb["timestamp"] is None
    assert pc["occurredAt"] == "2026-01-01T00:00:00.000Z" and pc["extra"] == [1]
    assert [r["time_present"] for r in rows] == [False, True, True]


def test_strict_mode_fails_on_bad_event(spark):
    body = '{"data":[{"id":"a"},{"id":7}],"hasMore":false}'
    df = event_rows(pages_df(spark, [body]), strict=True)
    with pytest.raises(Exception, match="missing event id"):
        df.count()


def test_strict_mode_fails_on_bad_page(spark):
    df = event_rows(pages_df(spark, ['{"data":{},"hasMore":false}']), strict=True)
    with pytest.raises(Exception, match="data must be an array"):
        df.count()


def test_writer_renormalises_text_time(spark):
    df = spark.createDataFrame([("e1", "2026-01-01T00:00:00.000Z"), ("e2", "invalid-timestamp")],
                               "event_id string, occurred_at string") \
        .withColumn("payload", F.parse_json(F.lit('{"a":1}')))
    rows = E.to_event_rows(df).orderBy("event_id").collect()
    assert rows[0]["occurred_at"] is not None and rows[1]["occurred_at"] is None


def test_unnest_pads_short_arrays(spark):
    df = spark.createDataFrame([([1, 2, 3], ["a", "b"])], "ids array<int>, names array<string>")
    rows = E.unnest_columns(df, "ids", "names").collect()
    assert [(r["ids"], r["names"]) for r in rows] == [(1, "a"), (2, "b"), (3, None)]


def test_page_chain_missing_and_stuck(spark):
    bodies = ['{"data":[{"id":"a"}],"hasMore":true,"nextCursor":null}',
              '{"data":[{"id":"b"}],"hasMore":true,"nextCursor":"cursor-1"}',
              '{"data":[{"id":"c"}],"hasMore":true,"nextCursor":"cursor-2"}',
              '{"data":[],"hasMore":false,"nextCursor":null}']
    landed = pages_df(spark, bodies, request_cursors=[None, "cursor-1", "cursor-1", "cursor-2"])
    kinds = {r["page_no"]: r["kind"] for r in E.check_page_chain(E.parse_envelope(landed)).collect()}
    assert kinds == {0: E.ERR_NO_CURSOR, 1: E.ERR_STUCK}
    # without landed request cursors, the previous page's next cursor is used
    derived = E.parse_envelope(pages_df(spark, bodies))
    kinds2 = {r["page_no"]: r["kind"] for r in
              E.check_page_chain(derived, fill_missing_cursor=True).collect()}
    assert kinds2 == {0: E.ERR_NO_CURSOR}          # page 1's request cursor is unknown (NULL)
    with pytest.raises(ValueError, match="hasMore=true but nextCursor is null"):
        E.require_valid(E.parse_envelope(landed))


def test_strict_mode_fails_on_stuck_cursor(spark):
    bodies = ['{"data":[{"id":"a"}],"hasMore":true,"nextCursor":"cursor-1"}',
              '{"data":[{"id":"b"}],"hasMore":true,"nextCursor":"cursor-1"}']
    df = event_rows(pages_df(spark, bodies, request_cursors=[None, "cursor-1"]), strict=True)
    with pytest.raises(Exception, match="cursor did not advance"):
        df.count()


def test_column_form_of_occurred_at_matches_staged_form(spark):
    from sluice.functions.scalars import normalize_occurred_at, with_occurred_at
    evs = [{"id": "a", "timestamp": 1769541612}, {"id": "b", "occurredAt": " 2024-01-01 "},
           {"id": "c", "occurred_at": "Mon, 01 Jan 2024 00:00:07 GMT"}, {"id": "d"},
           {"id": "e", "occurredAt": None, "timestamp": None}, {"id": "f", "timestamp": "0b101"}]
    body = json.dumps({"data": evs, "hasMore": False})
    ev = E.explode_events(E.parse_envelope(pages_df(spark, [body])))
    inst, pres = normalize_occurred_at(F.col("event"))
    a = ev.select("pos", F.unix_millis(inst).alias("ms"), pres.alias("p")).orderBy("pos").collect()
    b = with_occurred_at(ev, "event").select("pos", F.unix_millis("occurred_at").alias("ms"),
                                             F.col("time_present").alias("p")).orderBy("pos").collect()
    assert a == b
    assert [r["ms"] for r in a] == [1769541612000, 1704067200000, 1704067207000, None, None, 5]


def test_iso_text_is_exact_in_a_daylight_saving_fall_back_hour(spark):
    from sluice.functions.scalars import iso_ms
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(1730622600000,), (1730626200000,)], "ms long")
        got = [r[0] for r in df.select(iso_ms(F.timestamp_millis("ms"))).orderBy(F.lit(1)).collect()]
        assert sorted(got) == ["2024-11-03T08:30:00.000Z", "2024-11-03T09:30:00.000Z"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_more_scalar_edges(spark):
    evs = [
        {"id": "a", "timestamp": "1e3"},                 # 1000 ms
        {"id": "b", "timestamp": "+5"},                  # 5 ms
        {"id": "c", "timestamp": ".5"},                  # 0.5 ms truncates to 0
        {"id": "d", "timestamp": "0o17"},                # 15 ms
        {"id": "e", "timestamp": "0x17A2B3C4D5E6F7"},    # 6652817449543415: microseconds
        {"id": "f", "timestamp": "NaN"},                 # not a number, not a date
        {"id": "g", "timestamp": 2.6e20},                # ns -> 2.6e14 ms: year 10209
        {"id": "k", "timestamp": 8.7e21},                # ns -> 8.7e15 ms: past the last date
        {"id": "j", "timestamp": 2.5e20},                # ns -> 2.5e14 ms: year 9892
        {"id": "h", "timestamp": -1.5},                  # truncates toward zero: -1 ms
        {"id": "i", "timestamp": "2024-01-01T00:00:00.123456789Z"},
    ]
    got = {r["event_id"]: r["ms"] for r in _events(spark, evs)}
    assert got["a"] == 1000 and got["b"] == 5 and got["c"] == 0 and got["d"] == 15
    assert got["e"] == int(0x17A2B3C4D5E6F7 / 1000)
    assert got["f"] is None and got["k"] is None
    assert got["g"] == 260000000000000
    assert got["j"] == 250000000000000
    assert got["h"] == -1
    assert got["i"] == 1704067200123


def test_boolean_coercion_cases(spark):
    for raw, want in [('true', True), ('false', False), ('1', True), ('0', False), ('1.0', True),
                      ('"TRUE "', True), ('"1"', False), ('2', False), ('null', False)]:
        body = '{"data":[],"hasMore":' + raw + ',"nextCursor":"c"}'
        has_more = _decode(spark, body)["has_more"]
        # uncoercible values fall back to "cursor present"; the cursor here is "c"
        expected = want if raw not in ('"1"', '2', 'null') else True
        assert has_more is expected, raw


def test_end_of_day_24_00(spark):
    got = {r["event_id"]: r["ms"] for r in _events(spark, [
        {"id": "a", "timestamp": "2024-01-01T24:00:00Z"},
        {"id": "b", "timestamp": "2024-01-01T24:00"},
        {"id": "c", "timestamp": "2024-01-01T24:00:00.000+01:00"},
        {"id": "d", "timestamp": "2024-01-01T24:00:01Z"}])}
    assert got["a"] == 1704153600000 and got["b"] == 1704153600000
    assert got["c"] == 1704153600000 - 3600000
    assert got["d"] is None


def test_payload_fast_path_equals_rebuild(spark):
    evs = [{"eventId": "a", "occurredAt": "2024-01-01T00:00:00.000Z", "x": [1, {"y": 2}]},   # fast
           {"eventId": "b", "occurredAt": "2024-01-01T00:00:00Z", "x": 1},                   # rebuilt
           {"eventId": "c", "x": 1},                                                         # fast (absent)
           {"eventId": "d", "occurredAt": None, "timestamp": None},                          # fast (null)
           {"event_id": "e", "occurredAt": "2024-01-01T00:00:00.000Z"},                      # rebuilt
           {"eventId": "f", "occurredAt": "garbage"}]                                        # rebuilt (-> null)
    got = {r["event_id"]: json.loads(r["payload"]) for r in _events(spark, evs)}
    assert got["a"] == {"eventId": "a", "occurredAt": "2024-01-01T00:00:00.000Z", "x": [1, {"y": 2}]}
    assert got["b"] == {"eventId": "b", "occurredAt": "2024-01-01T00:00:00.000Z", "x": 1}
    assert got["c"] == {"eventId": "c", "x": 1}
    assert got["d"] == {"eventId": "d", "occurredAt": None, "timestamp": None}
    assert got["e"] == {"eventId": "e", "event_id": "e", "occurredAt": "2024-01-01T00:00:00.000Z"}
    assert got["f"] == {"eventId": "f", "occurredAt": None}


def test_duplicate_keys_without_session_setup(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        df = event_rows(pages_df(spark, ['{"data":[{"id":"a","id":"b"}],"hasMore":false}']), strict=False)
        assert df.first()["event_id"] == "b"
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
