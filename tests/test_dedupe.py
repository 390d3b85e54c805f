"""First-wins dedupe and insert-if-absent (the source system's writer cases)."""
import json

from pyspark.sql import functions as F

from conftest import pages_df
from sluice.operators.dedupe import first_by_key, insert_if_absent, pending
from sluice.plans.ingest import ingest_batch


def _batch(spark, pairs, page=0):
    rows = [("r", page, i, k, v) for i, (k, v) in enumerate(pairs)]
    return spark.createDataFrame(rows, "run_id string, page_no long, pos long, event_id string, v string")


def test_first_wins_in_arrival_order(spark):
    df = _batch(spark, [("evt-1", "a"), ("evt-2", "b"), ("evt-1", "c"), ("evt-3", "d"), ("evt-2", "e")])
    got = {r["event_id"]: r["v"] for r in first_by_key(df).collect()}
    assert got == {"evt-1": "a", "evt-2": "b", "evt-3": "d"}


def test_first_wins_across_pages_not_partition_order(spark):
    rows = [("r", 2, 0, "x", "late"), ("r", 0, 5, "x", "early"), ("r", 1, 0, "x", "mid")]
    df = spark.createDataFrame(rows, "run_id string, page_no long, pos long, event_id string, v string")
    assert first_by_key(df.repartition(3)).first()["v"] == "early"


def test_insert_counts_only_new_rows(spark):
    stored = spark.createDataFrame([("evt-1",)], "event_id string")
    batch = first_by_key(_batch(spark, [("evt-1", "a"), ("evt-1", "b"), ("evt-2", "c")]))
    for strategy in ("broadcast", "shuffle", "auto"):
        out = insert_if_absent(batch, stored, strategy=strategy)
        assert sorted(r["event_id"] for r in out.collect()) == ["evt-2"]


def test_empty_batch_inserts_nothing(spark):
    stored = spark.createDataFrame([("evt-1",)], "event_id string")
    empty = _batch(spark, []).where("false")
    assert insert_if_absent(first_by_key(empty), stored).count() == 0


def test_many_distinct_rows(spark):
    ev = [{"eventId": f"e{i}"} for i in range(25007)]
    body = json.dumps({"data": ev, "hasMore": False})
    assert ingest_batch(pages_df(spark, [body])).count() == 25007


def test_duplicate_in_one_batch_counts_once(spark):
    body = json.dumps({"data": [{"eventId": "evt-1"}, {"eventId": "evt-1"}, {"eventId": "evt-2"}],
                       "hasMore": False})
    assert ingest_batch(pages_df(spark, [body])).count() == 2


def test_pending_in_binary_name_order(spark):
    avail = spark.createDataFrame([("0002_b.sql",), ("0001_a.sql",), ("0010_c.sql",)], "name string")
    applied = spark.createDataFrame([("0001_a.sql",)], "name string")
    assert [r["name"] for r in pending(avail, applied).collect()] == ["0002_b.sql", "0010_c.sql"]


def test_any_split_gives_the_same_table(spark):
    """Central property: first-wins per batch + do-nothing across batches = global first."""
    bodies = []
    for p in range(6):
        ev = [{"id": f"k{(p * 3 + i) % 7}", "n": p * 10 + i} for i in range(4)]
        bodies.append(json.dumps({"data": ev, "hasMore": p < 5, "nextCursor": f"c{p}" if p < 5 else None}))
    pages = pages_df(spark, bodies)
    whole = {r["event_id"]: r["n"] for r in ingest_batch(pages).select(
        "event_id", F.try_variant_get("payload", "$.n", "bigint").alias("n")).collect()}
    for cut in (1, 3, 5):
        first = ingest_batch(pages.where(F.col("page_no") < cut))
        second = ingest_batch(pages.where(F.col("page_no") >= cut), target=first)
        both = first.unionByName(second).select(
            "event_id", F.try_variant_get("payload", "$.n", "bigint").alias("n"))
        assert {r["event_id"]: r["n"] for r in both.collect()} == whole


def test_hot_key_keeps_the_first_copy(spark):
    # a third of all rows carry the same id; partial aggregation keeps one per task
    rows = [("r", p, i, "hot" if (p * 50 + i) % 3 == 0 else f"k{p}-{i}", f"{p}-{i}")
            for p in range(40) for i in range(50)]
    df = spark.createDataFrame(rows, "run_id string, page_no long, pos long, event_id string, v string")
    out = first_by_key(df.repartition(8))
    got = {r["event_id"]: r["v"] for r in out.collect()}
    assert got["hot"] == "0-0"
    assert len(got) == 1 + sum(1 for p in range(40) for i in range(50) if (p * 50 + i) % 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_pending_ignores_other_files(spark):
    avail = spark.createDataFrame([("0001_init.sql",), ("0002_more.sql",), ("notes.txt",)], "name string")
    applied = spark.createDataFrame([("0001_init.sql",)], "name string")
    assert [r["name"] for r in pending(avail, applied, suffix=".sql").collect()] == ["0002_more.sql"]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(pages=st.lists(st.lists(st.integers(0, 12), min_size=0, max_size=6), min_size=1, max_size=7),
       cuts=st.lists(st.integers(1, 6), max_size=3))
def test_split_loads_equal_one_load(spark, pages, cuts):
    bodies = []
    for p, ids in enumerate(pages):
        ev = [{"eventId": f"k{i}", "n": p * 100 + j} for j, i in enumerate(ids)]
        last = p == len(pages) - 1
        bodies.append(json.dumps({"data": ev, "hasMore": not last,
                                  "nextCursor": None if last else f"c{p + 1}"}))
    df = pages_df(spark, bodies)

    def as_dict(frame):
        return {r["event_id"]: r["n"] for r in frame.select(
            "event_id", F.try_variant_get("payload", "$.n", "bigint").alias("n")).collect()}

    whole = as_dict(ingest_batch(df))
    bounds = sorted({c for c in cuts if c < len(pages)}) + [len(pages)]
    stored, lo = None, 0
    for hi in bounds:
        part = ingest_batch(df.where((F.col("page_no") >= lo) & (F.col("page_no") < hi)),
                            target=stored, key_strategy="broadcast" if lo % 2 else "shuffle")
        part = part.checkpoint(eager=True)
        stored = part if stored is None else stored.unionByName(part)
        lo = hi
    assert as_dict(stored) == whole


def test_insert_against_a_target_with_a_hot_key(spark):
    stored = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                       .otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
                                       .alias("event_id"))
    batch = first_by_key(_batch(spark, [("hot", "a"), ("k1", "b"), ("new", "c")]))
    for strategy in ("broadcast", "shuffle"):
        out = insert_if_absent(batch, stored, strategy=strategy)
        assert [r["event_id"] for r in out.collect()] == ["new"]
    plan = insert_if_absent(batch, stored, strategy="broadcast")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastHashJoin" in plan
