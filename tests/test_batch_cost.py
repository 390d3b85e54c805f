"""What a micro-batch costs beside its events: files, jobs, and state written beside the events."""
import json
import sys

import pytest
from conftest import pages_df
from pyspark.sql import functions as F

from sluice.operators import chain
from sluice.operators import ledger as L
from sluice.session import scratch_path
from sluice.streaming.ingest_stream import make_batch_sink


def _pages(spark, first, n, size=40):
    bodies = [json.dumps({"data": [{"id": f"e{p}-{i}", "timestamp": 1704067200 + i} for i in range(size)],
                          "hasMore": True, "nextCursor": f"c{p + 1}"}) for p in range(first, first + n)]
    return (pages_df(spark, bodies, request_cursors=[f"c{p}" for p in range(first, first + n)])
            .withColumn("page_no", F.col("page_no") + first))


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_files_follow_the_size_of_a_batch(spark, many_partitions):
    table, ledger = scratch_path(spark, "t-files"), scratch_path(spark, "t-files-ledger")
    group = "batch-cost"
    sink = make_batch_sink(table, ledger, "run", flush_size=100)
    spark.sparkContext.setJobGroup(group, group)
    try:
        sink(_pages(spark, 0, 4), 0)
        first = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        sink(_pages(spark, 3, 4), 1)            # one page again
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    files = spark.read.parquet(table).select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 16                          # of two batches, for 64 shuffle partitions
    assert 0 < first <= 45
    assert spark.read.parquet(table).count() == 280
    assert [r["inserted"] for r in L.read_ledger(spark, ledger).orderBy("batch_id").collect()] == [160, 120]


def test_a_state_that_cannot_be_stored_stops_the_commit(spark, monkeypatch):
    table, ledger = scratch_path(spark, "t-state"), scratch_path(spark, "t-state-ledger")
    module = sys.modules[make_batch_sink.__module__]       # the package has a function of its name
    write = module.write_state

    def failing(rows, path, kind, *rest):
        if kind == "chain":
            raise OSError("no room")
        return write(rows, path, kind, *rest)

    monkeypatch.setattr(module, "write_state", failing)
    with pytest.raises(OSError, match="no room"):
        make_batch_sink(table, ledger, "run", flush_size=100)(_pages(spark, 0, 2), 0)
    assert L.read_ledger(spark, ledger).count() == 0


def test_open_records_by_their_definition(spark):
    own, asked = chain.OWN, chain.ASKED
    found = [("r", 1, "a", own), ("r", 1, "a", own), ("r", 2, "b", own), ("r", 3, "c", own), ("r", 0, "z", own), ("s", 7, "q", own),
             ("r", 3, "c", asked), ("r", 5, "e", asked), ("r", 5, "f", asked), ("r", 6, "g", asked), (None, 5, "n", asked),
             ("r", None, "m", asked), (None, 4, "k", own), ("r", None, "l", own)]
    landed = [("r", 0), ("r", 6), ("r", 6), (None, 5), ("r", None), (None, 3)]
    came = {p for p in landed if None not in p}
    before = {(r, p + 1) for r, p in came} | {(r, p) for r, p, _, side in found if side == asked and None not in (r, p)}
    still = {x for x in found if (x[3] == asked and x[:2] not in came)
             or (x[3] == own and x[1] is not None and x[1] > 0 and x[:2] not in before)}
    got = chain.open_records(spark.createDataFrame(found, chain.RECORD), spark.createDataFrame(landed, "run_id string, page_no long"))
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == still and len(rows) == len(still)
