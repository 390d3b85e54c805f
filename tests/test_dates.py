"""Free-form date text."""
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sluice.functions import dates
from sluice.functions import scalars as S


def _ms(*args):
    return int(datetime(*args, tzinfo=timezone.utc).timestamp() * 1000)


CASES = {
    "Jan 2, 2024": _ms(2024, 1, 2), "2024/01/02": _ms(2024, 1, 2), "2024-1-5": _ms(2024, 1, 5), "1/5/2024": _ms(2024, 1, 5),
    "1-5-24": _ms(2024, 1, 5), "12/31/99": _ms(1999, 12, 31), "1/2/49": _ms(2049, 1, 2), "1/2/50": _ms(1950, 1, 2),
    "Fri Jan 05 2024 10:11:12 GMT+0100 (Central European Standard Time)": _ms(2024, 1, 5, 9, 11, 12),
    "5 January 2024 3:04 pm": _ms(2024, 1, 5, 15, 4), "Jan 5 2024 12:30 am": _ms(2024, 1, 5, 0, 30),
    "Jan 5 2024 12:30 PM": _ms(2024, 1, 5, 12, 30), "2024/02/30": _ms(2024, 3, 1), "2023/02/29": _ms(2023, 3, 1),
    "2024/04/31 01:00": _ms(2024, 5, 1, 1), "January 2024": _ms(2024, 1, 1), "Friday, 5-Jan-24 01:02:03 EST": _ms(2024, 1, 5, 6, 2, 3),
    "2024 Jan 5": _ms(2024, 1, 5), "Jan 5": _ms(2001, 1, 5), "5 dec": _ms(2001, 12, 5), "1/5": _ms(2001, 1, 5),
    "2024/1/5 24:00": _ms(2024, 1, 6), "2024-01-05t10:00:00z": _ms(2024, 1, 5, 10), "2024-1-5 10:00:00.1239 -03:30": _ms(2024, 1, 5, 13, 30) + 123,
    "2024/1/5 10:00 +2": _ms(2024, 1, 5, 8), "  Sept. 9,2020 ": _ms(2020, 9, 9), "2024-02-30 10:00": _ms(2024, 3, 1, 10),
    "2024/12/31 23:59:59.9 UTC": _ms(2024, 12, 31, 23, 59, 59) + 900,
}
NOT = ["12:30", "5 Foo 2024", "13/1/2024", "2024/1/32", "2024/1/5 24:01", "2024/1/5 10:60", "2024-13-01", "2024-02-30", "2024-02-30T00:00:00Z",
       "2024-01-01T24:00:01Z", "garbage", "Jan", "2024/1/5 13:00 pm", "1/2/3/4", "Jan 5 2024 10", "Jan 0 2024", "", "Jan 5 2024 at noon"]


def test_forms(spark):
    rows = [(t, ms) for t, ms in CASES.items()] + [(t, None) for t in NOT] + [(None, None)]
    df = spark.createDataFrame(rows, "s string, want long")
    got = df.select("s", "want", F.unix_millis(S.js_date_parse(S.js_trim(F.col("s")))).alias("ms")).collect()
    assert [(r.s, r.ms) for r in got] == rows


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_every_day_in_three_spellings_whatever_the_session_zone(spark, zone):
    first = date(1968, 1, 1)
    days = [first + timedelta(days=17 * i) for i in range(1500)]
    rows = [(int((d - date(1970, 1, 1)).days) * 86_400_000, t) for d in days
            for t in (f"{d.year}/{d.month}/{d.day}", d.strftime("%b %d, %Y"), d.strftime("%A, %d %B %Y 00:00 GMT"))]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame(rows, "want long, s string")
        wrong = df.select("s", "want", F.unix_millis(S.js_date_parse(F.col("s"))).alias("ms")).where("NOT want <=> ms").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert wrong == []


def test_columns_and_staged_form_agree(spark):
    df = spark.createDataFrame([(t,) for t in [*CASES, *NOT]], "s string")
    event = df.select("s", F.to_variant_object(F.struct(F.col("s").alias("timestamp"))).alias("event"))
    staged = {r.s: r.ms for r in S.with_occurred_at(event).select("s", F.unix_millis("occurred_at").alias("ms")).collect()}
    # Text that is a number is an epoch value there, which none of these is.
    assert {t: staged[t] for t in CASES} == CASES and all(staged[t] is None for t in NOT)
    plain = df.select("s", dates.free_form_ms(F.col("s")).alias("ms")).collect()
    assert {r.s: r.ms for r in plain if r.s in CASES and "T" not in r.s.split("(")[0][:11]}["2024/02/30"] == CASES["2024/02/30"]
