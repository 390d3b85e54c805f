"""Operator 13: exact round trips, the loser tree and the merged index."""

import gzip
import hashlib
import heapq
import os
import random

import pandas as pd
from pyspark.sql import functions as F

from sluice.llm import warc as W
from sluice.llm.queries import QUERIES
from sluice.session import scratch_path

MIDDLE = "/root/testdata/sf0.01"


def expected(pages):
    """page_id -> row, for ids that do not repeat."""
    full = [(i, (h or "").encode()) for i, h in pages]
    last = {}
    for i, b in full:
        if len(b) >= 1000:
            last[b] = max(last.get(b, i), i)
    return {i: (len(b), hashlib.sha1(b).hexdigest(), *(("revisit", last[b]) if last.get(b, i) != i else ("response", None)))
            for i, b in full}


def told(rows):
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows}


def test_query_equals_brute_force(spark):
    rows = QUERIES["op13_warc"](spark, MIDDLE).collect()
    pages = pd.read_parquet(f"{MIDDLE}/pages.parquet")
    assert told(rows) == expected(zip(pages.page_id, pages.html))
    assert sorted(r.place for r in rows) == list(range(len(pages)))
    in_order = sorted(rows, key=lambda r: r.place)
    keys = [(r.url_key.encode(), r.captured) for r in in_order]
    assert keys == sorted(keys)


def test_copies_odd_urls_and_nulls(spark):
    rng = random.Random(1)
    bodies = ["x" * 1000, "x" * 999, "é" * 500, "é" * 499, None, "", "a\r\n\r\nb\0" * 300, "z" * 200_000]
    urls = ["http://www.a.example/b?c#d", "HTTPS://A.Example:8080/b c\n", None, "", "no scheme", "http://u:p@b.a.example?q", "http://a.example"]
    pages = [(i, rng.choice(urls), rng.choice(bodies)) for i in range(400)]
    frame = spark.createDataFrame([(*p, 1, "s") for p in pages], "page_id long, url string, html string, at int, key string").repartition(5)
    rows = W.archive_pages(frame, at=F.col("page_id") % 7).collect()
    assert told(rows) == expected([(i, h) for i, _, h in pages])
    keys = {r.page_id: r.url_key for r in rows}
    of = {u: keys[i] for i, u, _ in pages}
    assert of[urls[0]] == "example,a)/b?c" and of[urls[1]] == "example,a)/b%20c%20" and of[None] == of[""] == "-"
    assert of["http://u:p@b.a.example?q"] == "example,a,b)/?q" and of["http://a.example"] == "example,a)/" and of["no scheme"] == "no%20scheme"


def test_repeated_rows_null_ids_and_empty_table(spark):
    big = "b" * 2000
    pages = [(None, "http://a.example/", big)] * 2 + [(3, "http://a.example/", big)] * 3 + [(3, "http://b.example/", big), (1, None, None)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = W.archive_pages(frame).collect()
    assert len(rows) == len(pages)
    # The greatest (id, url) is the response that all others name.
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows if r.payload_bytes) == \
        [(0, "revisit", 3)] * 2 + [(3, "response", None)] + [(3, "revisit", 3)] * 3
    same = spark.createDataFrame([(3, "u", big)] * 3 + [(2, "u", big)], "page_id long, url string, html string")
    assert sorted((r.page_id, r.record_type) for r in W.archive_pages(same).collect()) == [(2, "revisit")] + [(3, "response")] * 3
    assert W.archive_pages(frame.where("page_id = 9")).collect() == []


def test_loser_tree_merges_like_a_heap():
    rng = random.Random(2)
    for k in [0, 1, 2, 3, 5, 8, 13]:
        runs = [sorted(b"%d" % rng.randint(0, 30) for _ in range(rng.randint(0, 20))) for _ in range(k)]
        assert list(W.loser_tree([iter(r) for r in runs])) == list(heapq.merge(*runs))


def test_many_runs_in_passes_and_ranges(spark):
    folder = scratch_path(spark, "warc-test")
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.example/"), F.col("id") % 10).alias("url"),
                                     F.lit("body").alias("html")).repartition(9)
    blocks = W.write_archives(pages, folder, at=F.col("page_id"))
    assert blocks.select("run").distinct().count() == 9
    runs = {}
    for b in blocks.orderBy("run", "seq").collect():
        runs.setdefault(b.run, []).extend(W._lines(W._Files(folder), [(b.file, b.start, b.length)], None, None))
    assert all(lines == sorted(lines) for lines in runs.values())
    index = W.merge_runs(blocks, folder, fan_in=2, range_lines=300)
    found = [(r.key, r.stamp) for r in W.captures(index, folder).orderBy("place").collect()]
    assert found == sorted(found) and len(found) == 3000
    assert index.select((F.col("seq") / 2 ** 32).cast("long")).distinct().count() > 1
    # A hot URL is spread over ranges: its lines order by time below the key.
    hot = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("http://h.example/").alias("url"), F.lit("b").alias("html")).repartition(4)
    hot_folder = scratch_path(spark, "warc-test")
    old, W.BLOCK_LINES = W.BLOCK_LINES, 100
    try:
        merged = W.merge_runs(W.write_archives(hot, hot_folder, at=F.col("page_id")), hot_folder, range_lines=500)
        assert W.captures(merged, hot_folder).count() == 3000
    finally:
        W.BLOCK_LINES = old


def test_archives_are_plain_gzip_warc(spark):
    folder = scratch_path(spark, "warc-test")
    pages = spark.createDataFrame([(1, "http://a.example/", "<p>é</p>"), (2, "http://a.example/", "q" * 1500), (5, None, "q" * 1500)],
                                  "page_id long, url string, html string").coalesce(1)
    index = W.merge_runs(W.write_archives(pages, folder, at=F.lit(86400)), folder)
    base = folder.removeprefix("file:")
    name = next(n for n in os.listdir(base) if n.endswith(".warc.gz"))
    with gzip.open(f"{base}/{name}", "rb") as f:
        data = f.read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and data.count(b"WARC/1.1\r\n") == 4
    assert b"WARC-Date: 1970-01-02T00:00:00Z" in data and b"WARC-Profile: " + W.PROFILE.encode() in data
    rows = {r.page: r for r in W.read_records(W.captures(index, folder), folder, payload=True).collect()}
    assert rows["1"].payload == "<p>é</p>" and rows["1"].url == "http://a.example/"
    assert rows["2"].type == "revisit" and rows["2"].refers_to == rows["5"].record and rows["2"].payload is None
    assert rows["5"].payload == "q" * 1500 and rows["5"].url is None
