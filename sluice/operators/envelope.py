"""Page envelopes and their events: O2 O3 O4 O13 O14 O15.

All of it is projection work on one page row at a time, so it runs in the
scan stage without a shuffle.  Strict validation uses ``raise_error`` inside a
column that the plan needs (so the optimizer cannot prune it): a bad page or
event fails the job in the same pass that reads it, with no pre-check job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.metrics import observed
from . import chain
from ..session import ensure_semantics

# Error texts of the source system.
ERR_NOT_JSON = "Invalid events response: body is not JSON"
ERR_NOT_OBJECT = "Invalid events response: expected object"
ERR_NOT_ARRAY = "Invalid events response: data must be an array"
ERR_NO_CURSOR = "Invalid pagination state: hasMore=true but nextCursor is null"
ERR_STUCK = "Invalid pagination state: cursor did not advance"
# Reports of this engine: landed files can repeat or lack a page, a live reply cannot.
ERR_TOO_LARGE = "Invalid events response: body is larger than a VARIANT"
ERR_UNREADABLE = "Landed pages: unreadable line"
ERR_RELANDED = "Landed pages: page landed more than once"
ERR_GAP = "Landed pages: previous page missing"
# Parsed bodies are limited by the VARIANT type (bytes, also of a text value in it).
VARIANT_BYTES = 128 << 20


def _items(v: Column) -> Column:
    arrays = [F.try_variant_get(v, f"$['{k}']", "array<variant>") for k in S.ITEM_KEYS]
    return F.coalesce(*arrays)


def parse_envelope(pages: DataFrame, body: str = "body") -> DataFrame:
    """O2: decode each landed body into ``items``, ``has_more``, ``next_cursor``.

    Adds ``page_error`` (NULL for good pages).  ``items`` is NULL on error.  A
    landed line that could not be read (``corrupt_line``, from the scan) is one.
    Sets ``spark.sql.variant.allowDuplicateKeys`` on the session (last key
    wins, as in ``JSON.parse``) before the parse expression is built.
    """
    ensure_semantics(pages.sparkSession)
    df = (pages.withColumn("_v", F.try_parse_json(F.col(body)))
          .withColumn("_first", F.regexp_extract(F.col(body), r"^\s*(\S)", 1)))
    v = F.col("_v")
    df = (df.withColumn("_items", _items(v))
          .withColumn("_hm", S.first_present(v, S.HAS_MORE_PATHS))
          .withColumn("_nc", S.first_present(v, S.NEXT_CURSOR_PATHS)))
    df = df.withColumn("_cur", S.as_string(F.col("_nc")))
    cursor = F.col("_cur")
    has_more = F.coalesce(S.coerce_bool(F.col("_hm")), cursor.isNotNull() & (F.length(cursor) > 0))
    unreadable = F.col("corrupt_line").isNotNull() if "corrupt_line" in pages.columns else F.lit(False)
    error = (F.when(unreadable, F.lit(ERR_UNREADABLE))
             .when(v.isNull() & (F.octet_length(F.col(body)) > VARIANT_BYTES), F.lit(ERR_TOO_LARGE))
             .when(v.isNull(), F.lit(ERR_NOT_JSON))
             .when(~F.col("_first").isin("{", "["), F.lit(ERR_NOT_OBJECT))
             .when(F.col("_items").isNull(), F.lit(ERR_NOT_ARRAY)))
    ok = F.col("page_error").isNull()
    out = (df.withColumn("page_error", error)
           .withColumn("items", F.when(ok, F.col("_items")))
           .withColumn("has_more", F.when(ok, has_more))
           .withColumn("next_cursor", F.when(ok, cursor))
           .drop("_v", "_first", "_items", "_hm", "_nc", "_cur"))
    return observed(out, "pages", F.count(F.lit(1)).alias("pages"),
                    F.count(F.col("page_error")).alias("bad_pages"))


def chain_violation(has_more: Column, next_cursor: Column, request_cursor: Column) -> Column:
    """O14 for one page: the violation text, NULL when the page is fine."""
    return (F.when(has_more & (next_cursor.isNull() | (next_cursor == "")), F.lit(ERR_NO_CURSOR))
            .when(has_more & (next_cursor == request_cursor), F.lit(ERR_STUCK)))


def page_metadata(parsed: DataFrame) -> DataFrame:
    """One small row per landed page: what chain checks, flushes and counters need of it."""
    wanted = ["run_id", "page_no", "request_cursor", "fetched_at", "has_more", "next_cursor", "page_error", "file"]
    return parsed.select(*[c for c in wanted if c in parsed.columns],
                         F.size("items").cast("long").alias("n_events"))


def _with_previous(parsed: DataFrame) -> DataFrame:
    """Every landed page with ``_prev`` (the previous page's next cursor; the greatest of
    its copies) and ``_prevs`` (those of all copies), whether a previous page was
    landed at all, and how often the page itself was.

    Not ``lag`` over a window partitioned by run (one task per run), and not a
    self-join (which would decode every page twice): each page emits itself
    and a "previous cursor" record for page + 1; one ``groupBy`` on
    ``(run_id, page_no)`` puts them together.
    Pass page metadata, not bodies or items, to keep the shuffle small.
    """
    cols = parsed.columns
    page_type = parsed.select(F.struct(*cols).alias("p")).schema["p"].dataType
    me = F.struct(F.col("page_no").alias("k"), F.struct(*cols).alias("page"),
                  F.lit(None).cast("string").alias("prev"))
    nxt = F.struct((F.col("page_no") + 1).alias("k"), F.lit(None).cast(page_type).alias("page"),
                   F.col("next_cursor").alias("prev"))
    rec = parsed.select("run_id", F.explode(F.array(me, nxt)).alias("r"))
    grouped = rec.groupBy("run_id", F.col("r.k").alias("_k")).agg(
        F.collect_list("r.page").alias("_pages"),          # the copies of one page
        F.max("r.prev").alias("_prev"), F.collect_set("r.prev").alias("_prevs"),
        F.count(F.when(F.col("r.page").isNull(), 1)).alias("_before"))
    return grouped.select(F.explode("_pages").alias("_page"), "_prev", "_prevs", "_before", F.size("_pages").alias("_copies")) \
        .select("_page.*", "_prev", "_prevs", "_before", "_copies")


def with_request_cursor(parsed: DataFrame) -> DataFrame:
    """Fill ``request_cursor`` from the previous page's ``next_cursor`` where it was not landed.

    Every landed copy of a page is kept; see :func:`check_page_chain` for copies and gaps.
    """
    return (_with_previous(parsed).withColumn("request_cursor", F.coalesce("request_cursor", "_prev"))
            .select(*parsed.columns))


def check_page_chain(parsed: DataFrame, fill_missing_cursor: bool = False) -> DataFrame:
    """``(run_id, page_no, kind)`` for every page that breaks the cursor chain.

    With ``fill_missing_cursor`` a request cursor that was not landed is taken
    from the previous page; a page that was landed more than once, and one whose
    chain cannot be checked because the page before it is missing, are reported too.
    """
    meta = parsed.select("run_id", "page_no", "has_more", "next_cursor", "request_cursor")
    if not fill_missing_cursor:
        kinds = F.array(chain_violation(F.col("has_more"), F.col("next_cursor"), F.col("request_cursor")))
    else:
        # Any copy of the previous page may have given the cursor that was not landed.
        known = F.coalesce("request_cursor", F.when(F.array_contains("_prevs", F.col("next_cursor")), F.col("next_cursor")))
        kinds = F.array(
            chain_violation(F.col("has_more"), F.col("next_cursor"), known),
            F.when(F.col("_copies") > 1, F.lit(ERR_RELANDED)),
            F.when((F.col("page_no") > 0) & F.col("request_cursor").isNull() & (F.col("_before") == 0),
                   F.lit(ERR_GAP)))
        meta = _with_previous(meta)
    return (meta.select("run_id", "page_no", F.explode(kinds).alias("kind"))
            .where(F.col("kind").isNotNull()).distinct())


def _fail_unless(ok: Column, message: Column) -> Column:
    """A filter predicate that is true or raises.  Filters are never pruned,
    so the check runs even when no output column depends on it."""
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def place(*named: tuple[str, Column]) -> Column:
    """`` (run r, page 7)``: where something was found; what is NULL is left out of the text."""
    parts = [F.concat(F.lit(f"{name} "), c.cast("string")) for name, c in named]
    return F.concat(F.lit(" ("), F.concat_ws(", ", *parts), F.lit(")"))


def page_place(df: DataFrame, *more: tuple[str, Column]) -> Column:
    """:func:`place` of a page row, with its landed file where the scan tells it."""
    file = [("file", F.col("file"))] if "file" in df.columns else []
    return place(("run", F.col("run_id")), ("page", F.col("page_no")), *more, *file)


def strict_items(parsed: DataFrame) -> DataFrame:
    """Fail the job on a bad or chain-breaking page, in the pass that reads it."""
    where = page_place(parsed)
    bad = F.coalesce(F.col("page_error"),
                     chain_violation(F.col("has_more"), F.col("next_cursor"),
                                     F.col("request_cursor")))
    return parsed.where(_fail_unless(bad.isNull(), F.concat(bad, where)))


def explode_events(parsed: DataFrame, keep=("run_id", "page_no")) -> DataFrame:
    """O3: one row per array item, ``pos`` keeping the order inside the page."""
    return parsed.select(*keep, F.posexplode("items").alias("pos", "event"))


def explode_with_chain(parsed: DataFrame) -> DataFrame:
    """O3 with the page's chain records among its events: positions ``-OWN`` and ``-ASKED``.

    A record is a row whose event is an object with the record's key as its id, so
    that it takes the same way as the events and meets its counterpart in the
    exchange that brings equal ids together (see :func:`..dedupe.first_by_key_checked`).
    """
    run, page, cursor = F.col("run_id"), F.col("page_no"), F.col("next_cursor")

    def record(at: Column, named: Column) -> Column:
        key = chain.record_key(run, at, named)
        return F.when(key.isNotNull(), F.to_variant_object(F.struct(key.alias(S.EVENT_ID_KEYS[0]))))

    two = F.array(record(page + 1, chain.asked_cursor(cursor)),
                  record(page, chain.own_cursor(F.col("has_more"), cursor, F.col("request_cursor"))))
    rows = parsed.select("run_id", "page_no", F.posexplode(F.concat(two, "items")).alias("pos", "event"))
    return (rows.withColumn("pos", F.col("pos") - chain.ASKED)
            .where((F.col("pos") >= 0) | F.col("event").isNotNull()))


def with_event_ids(events: DataFrame, strict: bool = False) -> DataFrame:
    """O8 on every event, with ``reason`` for events that would fail the page."""
    ev = F.col("event")
    out = (events.withColumn("_id_raw", S.first_present(ev, S.EVENT_ID_KEYS))
           .withColumn("event_id", S.as_string(F.col("_id_raw")))
           .withColumn("event_id", F.when(F.length("event_id") > 0, F.col("event_id")))
           .withColumn("reason", S.invalid_reason(ev, F.col("event_id")))
           .drop("_id_raw"))
    out = observed(out, "events", F.count(F.when(F.col("pos") >= 0, 1)).alias("events"),
                   F.count(F.col("reason")).alias("invalid"))
    if strict:
        msg = F.concat(F.lit("Invalid event payload: "), F.col("reason"), page_place(out, ("item", F.col("pos"))))
        out = out.where(_fail_unless(F.col("reason").isNull(), msg))
    return out


def invalid_events(parsed: DataFrame) -> DataFrame:
    """Every page or event that would stop a run: ``(run_id, page_no, pos, reason)``.

    Page-level problems carry ``pos = NULL``.  One pass: a bad page has no items
    and comes out of the outer explode as one row, beside the events of good pages.
    """
    rows = parsed.select("run_id", "page_no", "page_error", F.posexplode_outer("items").alias("pos", "event"))
    rows = with_event_ids(rows)
    found = (F.when(F.col("page_error").isNotNull(), F.col("page_error"))
             .when(F.col("pos").isNotNull(), F.col("reason")))
    return (rows.select("run_id", "page_no", F.col("pos").cast("long").alias("pos"), found.alias("reason"))
            .where(F.col("reason").isNotNull()))


def require_valid(parsed: DataFrame) -> None:
    """Driver-side gate: one aggregate job, raises before anything is written."""
    problems = invalid_events(parsed).unionByName(
        check_page_chain(parsed).select("run_id", "page_no", F.lit(None).cast("long").alias("pos"),
                                        F.col("kind").alias("reason")))
    first = problems.orderBy("run_id", "page_no", "pos").limit(1).collect()
    if first:
        r = first[0]
        raise ValueError(f"{r['reason']} (run {r['run_id']}, page {r['page_no']}, item {r['pos']})")


def finish_events(events: DataFrame) -> DataFrame:
    """O9 + O12 on events that already carry ``event_id``: adds the stored columns."""
    staged = events.withColumn("_fields", S.event_fields(F.col("event")))
    df = S.with_occurred_at(staged, "event", fields="_fields")
    df = observed(df.withColumn("_iso", S.iso_ms(F.col("occurred_at"))), "times",
                  F.count(F.col("occurred_at")).alias("with_instant"))
    payload = S.built_once(("payload",), lambda: S.build_payload(
        F.col("event"), F.col("event_id"), F.col("occurred_at"), F.col("time_present"), F.col("_iso"), F.col("_fields")))
    return df.withColumn("payload", payload).drop("_iso", "_fields")


def to_event_rows(events: DataFrame) -> DataFrame:
    """The stored columns.  ``ingested_at`` is one instant per query, like ``NOW()``.

    ``occurred_at`` may be given as text (the writer's own re-normalisation:
    an invalid text becomes NULL while the payload keeps it).
    """
    occ = F.col("occurred_at")
    if dict(events.dtypes).get("occurred_at") == "string":
        occ = S.js_date_parse(S.js_trim(occ))
    return events.select("event_id", occ.alias("occurred_at"), "payload",
                         F.current_timestamp().alias("ingested_at"))


def unnest_columns(df: DataFrame, *array_cols: str, keep=()) -> DataFrame:
    """Parallel arrays to rows; a shorter array pads with NULL (as ``UNNEST``)."""
    return df.select(*keep, F.inline(F.arrays_zip(*[F.col(c) for c in array_cols])))
