"""First-wins dedupe, insert-if-absent and set difference: O21 O5 O16."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import observed
from .chain import ASKED, OWN
from .envelope import ERR_STUCK, place


def first_by_key(df: DataFrame, key: str = "event_id",
                 order=("run_id", "page_no", "pos")) -> DataFrame:
    """The first occurrence of every key in arrival order.

    ``min_by`` over the ordering struct is an aggregate with a map-side partial
    step, so a key repeated a billion times is reduced inside each task before
    anything is shuffled (unlike a window, which ships every copy).  The
    survivor is deterministic, unlike ``dropDuplicates``.
    """
    others = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(
        F.min_by(F.struct(*others), F.struct(*order)).alias("_first"))
    return agg.select(key, "_first.*")


def first_by_key_checked(df: DataFrame, key: str = "event_id", order=("run_id", "page_no", "pos")) -> DataFrame:
    """O21 and O14 in one exchange: the first occurrence of every key; a broken page chain fails the job.

    ``df`` holds events and, at positions below 0, chain records
    (:func:`.envelope.explode_with_chain`).  Where both records of one key meet
    the page is stuck.  That an event id may spell a record's key changes neither.
    The check and the choice of events are one predicate over the aggregate's
    results, and metrics fence it, so no later filter can drop records before it.
    """
    others = [c for c in df.columns if c != key]
    event = F.col("pos") >= 0
    grouped = df.groupBy(key).agg(
        F.min_by(F.struct(*others), F.when(event, F.struct(*order))).alias("_first"),
        F.bit_or(F.when(event, 0).otherwise(-F.col("pos"))).alias("_sides"))
    k = F.col(key)
    after_page = F.substring(k, F.instr(k, ":") + 1, F.length(k))
    size = F.substring_index(after_page, ":", 1)
    run = F.substring(after_page, F.length(size) + 2, size.try_cast("int"))
    told = F.concat(F.lit(ERR_STUCK), place(("run", run), ("page", F.substring_index(k, ":", 1))))
    keep = (F.when(F.col("_sides") == (OWN | ASKED), F.raise_error(told).cast("boolean"))
            .otherwise(F.col("_first").isNotNull()))
    return observed(grouped.where(keep).select(key, "_first.*"), "firsts", F.count(F.lit(1)).alias("firsts"))


def insert_if_absent(batch: DataFrame, target: DataFrame | None, key: str = "event_id",
                     strategy: str = "auto", key_range: tuple | None = None,
                     batch_key: str | None = None, batch_keys: DataFrame | None = None) -> DataFrame:
    """Rows of ``batch`` (already unique by key) whose key is not stored yet.

    ``ON CONFLICT DO NOTHING`` semantics: stored rows are never touched.

    * ``shuffle``: an anti-join against the distinct stored keys, for bulk loads.
    * ``auto`` (or ``broadcast``, the older name): the stored keys are first
      semi-joined with the batch's, and only the hits are anti-joined; for a
      batch that is small against the table.  No side is broadcast by a count
      of rows: Spark chooses each join by the sides' sizes in bytes.

    ``key_range`` (min, max of the batch keys) may be passed when already known.
    ``batch_key``: the batch's own ``ingest_batch`` partition, excluded from the
    target so that a replayed batch inserts its rows again.
    ``batch_keys``: the batch's keys where they are at hand (copies do not matter), so
    that the batch itself is read once.
    """
    if target is None:
        return batch
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown strategy: {strategy}")
    if batch_key is not None:
        target = target.where(F.col("ingest_batch") != batch_key)
    stored = target.select(key)
    if key_range is not None and key_range[0] is not None:
        # The range as a literal filter reaches the Parquet scan, so files whose
        # min/max statistics miss it are skipped (ids usually grow with time).
        stored = stored.where(F.col(key).between(F.lit(key_range[0]), F.lit(key_range[1])))
    if strategy != "shuffle":
        stored = stored.join((batch if batch_keys is None else batch_keys).select(key), key, "left_semi")
    # distinct with map-side partial aggregation: copies of one stored key do not
    # pile into one join task; its exchange is the one the join needs anyway.
    return batch.join(stored.distinct(), key, "left_anti")


def pending(available: DataFrame, applied: DataFrame, key: str = "name",
            suffix: str | None = None) -> DataFrame:
    """Items of ``available`` not in the ``applied`` ledger, in binary key order.

    ``suffix`` keeps only names ending with it (e.g. ``".sql"``).
    """
    if suffix is not None:
        available = available.where(F.col(key).endswith(suffix))
    return available.join(applied.select(key).distinct(), key, "left_anti").orderBy(key)
