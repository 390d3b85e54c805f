"""Batch ingest: O27b, the whole pipeline on a static DataFrame of landed pages.

Plan shape (one job):

    scan landed pages -> decode envelope (projection) -> explode items and chain records
    -> resolve ids (strict: raise_error on bad rows, same pass)
    -> first occurrence per id  [partial min_by, shuffle on event_id, final min_by;
       strict: raise_error where two chain records meet]
    -> time + payload on survivors only
    -> anti-join against the stored table  [shuffled, or broadcast keys when small]

First-wins inside the input plus do-nothing against the stored table equals
global first occurrence in arrival order, wherever batch boundaries fall, so
this and the streaming ingest (O27) give the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chain
from ..operators import envelope as E
from ..operators.dedupe import first_by_key, first_by_key_checked, insert_if_absent
from ..session import checkpoint_root

ARRIVAL = ("run_id", "page_no", "pos")


def decode_pages(pages: DataFrame, strict: bool = True) -> DataFrame:
    """O2 on landed pages; in strict mode a bad page fails the job that reads it.

    In quarantine mode bad pages, and pages whose landed cursors break the
    chain, are left out.
    """
    parsed = E.parse_envelope(pages)
    if strict:
        return E.strict_items(parsed)
    broken = E.chain_violation(F.col("has_more"), F.col("next_cursor"), F.col("request_cursor"))
    return parsed.where(F.col("page_error").isNull() & broken.isNull())


def chain_breaks(meta: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """``(run_id, page_no, kind)`` of pages that break the cursor chain, from page metadata.

    Pages in error have no part in it.  ``earlier``: chain records that earlier
    loads left open (:func:`..operators.chain.open_records`).
    """
    good = meta.where(F.col("page_error").isNull())
    local = E.check_page_chain(good)
    found = chain.records(good)
    if earlier is not None:
        found = found.unionByName(earlier.select(*found.columns))
    return local.unionByName(chain.stuck_pages(found).select("run_id", "page_no", F.lit(E.ERR_STUCK).alias("kind"))).distinct()


class Split:
    """Quarantine mode: decoded pages in two parts, good and left out, of one decode.

    ``parsed`` (O2, not strict) should be cheap to read more than once.  ``pages``
    are the good pages with their items, bad events still among them; ``events``
    are the good events; ``left_out`` has a row for everything else, with what was
    landed: a bad or chain-breaking page as ``body`` (or an unreadable line), a bad
    event of a good page as ``event`` at its position.
    """

    def __init__(self, parsed: DataFrame, earlier: DataFrame | None = None):
        self.parsed = parsed
        self.breaks = chain_breaks(E.page_metadata(parsed), earlier)
        # One row for a page; its first reason in text order, as one is told for each page.
        self.broken = self.breaks.groupBy("run_id", "page_no").agg(F.min("kind").alias("kind"))
        self.pages = (parsed.where(F.col("page_error").isNull())
                      .join(self.broken.select("run_id", "page_no"), ["run_id", "page_no"], "left_anti"))

    @property
    def events(self) -> DataFrame:
        return page_events(self.pages, strict=False)

    @property
    def left_out(self) -> DataFrame:
        body = F.coalesce("corrupt_line", "body") if "corrupt_line" in self.parsed.columns else F.col("body")
        file = F.col("file") if "file" in self.parsed.columns else F.lit(None).cast("string")
        nothing = F.lit(None)
        whole = [nothing.cast("int").alias("pos"), F.col("kind").alias("reason"), nothing.cast("variant").alias("event"),
                 body.alias("body"), file.alias("file")]
        errors = self.parsed.where(F.col("page_error").isNotNull()).withColumn("kind", F.col("page_error"))
        chained = self.parsed.where(F.col("page_error").isNull()).join(self.broken, ["run_id", "page_no"])
        keep = ["run_id", "page_no"] + (["file"] if "file" in self.parsed.columns else [])
        bad = (E.with_event_ids(E.explode_events(self.pages, keep)).where(F.col("reason").isNotNull())
               .select("run_id", "page_no", "pos", "reason", "event", nothing.cast("string").alias("body"), file.alias("file")))
        return (errors.select("run_id", "page_no", *whole).unionByName(chained.select("run_id", "page_no", *whole))
                .unionByName(bad))


def split_pages(pages: DataFrame, earlier: DataFrame | None = None) -> Split:
    """Decode pages once (into the checkpoint folder) and split them for quarantine mode."""
    checkpoint_root(pages.sparkSession)
    return Split(E.parse_envelope(pages).checkpoint(eager=True), earlier)


def page_events(parsed: DataFrame, strict: bool = True) -> DataFrame:
    """O3 + O8: ``(run_id, page_no, pos, event, event_id)`` for every item.

    Non-strict (quarantine) mode drops invalid events; ``invalid_events``
    lists them.
    """
    ev = E.with_event_ids(E.explode_events(parsed), strict=strict)
    if not strict:
        ev = ev.where(F.col("reason").isNull())
    return ev.drop("reason")


def checked_events(parsed: DataFrame) -> DataFrame:
    """Strict :func:`page_events` with the pages' chain records, for :func:`..operators.dedupe.first_by_key_checked`."""
    return E.with_event_ids(E.explode_with_chain(parsed), strict=True).drop("reason")


def event_rows(pages: DataFrame, strict: bool = True) -> DataFrame:
    """Every decoded event with its stored columns, duplicates included."""
    return E.finish_events(page_events(decode_pages(pages, strict), strict))


def ingest_batch(pages: DataFrame, target: DataFrame | None = None, strict: bool = True,
                 key_strategy: str = "shuffle", keep_arrival: bool = True) -> DataFrame:
    """The rows a load of ``pages`` adds to ``target`` (the stored event table).

    Pages are decoded once.  In strict mode a bad page or event fails the job in
    the pass that reads it, and a broken cursor chain in the exchange that dedupes;
    in quarantine mode they are left out (:func:`split_pages` tells what was).

    Output: ``event_id, occurred_at, payload, ingested_at`` plus, with
    ``keep_arrival``, where the stored copy arrived (``run_id, page_no, pos``).

    ``key_strategy``: ``"shuffle"`` (default, for bulk loads) joins against
    the distinct stored keys; ``"broadcast"``/``"auto"`` suit small loads into a
    large table and materialise the deduplicated load once (reliable
    checkpoint) because its keys are read three times.
    """
    if strict:
        firsts = first_by_key_checked(checked_events(decode_pages(pages)), "event_id", ARRIVAL)
    else:
        firsts = first_by_key(split_pages(pages).events, "event_id", ARRIVAL)
    if target is not None and key_strategy != "shuffle":
        # The size check, the key range and the broadcast keys all read the
        # deduped batch: materialise it once (reliable checkpoint) instead of
        # decoding the pages three times.
        firsts = firsts.checkpoint(eager=True)
    fresh = insert_if_absent(firsts, target, "event_id", strategy=key_strategy)
    done = E.finish_events(fresh)
    cols = ["event_id", "occurred_at", "payload", F.current_timestamp().alias("ingested_at")]
    if keep_arrival:
        cols += list(ARRIVAL)
    return done.select(*cols)
