"""The cursor chain of a run as keyed records, so that it can be checked wherever pages meet.

A page that has more and whose request cursor was not landed must not name the
cursor that it was itself asked with, which is the next cursor of the page before
it.  Every page therefore gives up to two records:

* ``OWN``: ``(run, page, its next cursor)``, if its request cursor is missing;
* ``ASKED``: ``(run, page + 1, its next cursor)``, what the next page was asked with.

A page is stuck exactly where both records of one key meet.  Records are tiny,
and need not meet in one load: what has not met yet (:func:`open_records`) is kept
and joins the records of the next load.  Where pages are landed more than once,
any landed copy counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OWN, ASKED = 1, 2
_CAME, _CAME_BEFORE = 4, 8            # marks of a landed page, at its own number and at the next one's
RECORD = "run_id string, page_no long, cursor string, side int"


def _names_cursor(cursor: Column) -> Column:
    return cursor.isNotNull() & (cursor != "")


def own_cursor(has_more: Column, next_cursor: Column, request_cursor: Column) -> Column:
    """The cursor of a page's ``OWN`` record, NULL where it has none."""
    return F.when(has_more & request_cursor.isNull() & _names_cursor(next_cursor), next_cursor)


def asked_cursor(next_cursor: Column) -> Column:
    """The cursor of a page's ``ASKED`` record, NULL where it has none."""
    return F.when(_names_cursor(next_cursor), next_cursor)


def record_key(run: Column, page: Column, cursor: Column) -> Column:
    """One text for the key of a record; different keys give different texts."""
    return F.concat(page.cast("string"), F.lit(":"), F.length(run).cast("string"), F.lit(":"), run, cursor)


def records(meta: DataFrame) -> DataFrame:
    """``(run_id, page_no, cursor, side)`` of all records of page metadata."""
    has_more, cursor, request = F.col("has_more"), F.col("next_cursor"), F.col("request_cursor")
    both = F.array(
        F.struct(F.col("page_no").alias("page_no"), own_cursor(has_more, cursor, request).alias("cursor"), F.lit(OWN).alias("side")),
        F.struct((F.col("page_no") + 1).alias("page_no"), asked_cursor(cursor).alias("cursor"), F.lit(ASKED).alias("side")))
    return meta.select("run_id", F.inline(both)).where(F.col("cursor").isNotNull())


def stuck_pages(found: DataFrame) -> DataFrame:
    """``(run_id, page_no)`` of pages whose two records meet."""
    return (found.groupBy("run_id", "page_no", "cursor").agg(F.bit_or("side").alias("sides"))
            .where(F.col("sides") == (OWN | ASKED)).select("run_id", "page_no").distinct())


def open_records(found: DataFrame, landed: DataFrame) -> DataFrame:
    """The records that a later load may still meet.

    ``found``: the open records before this load and this load's own;
    ``landed``: ``(run_id, page_no)`` of this load's pages.  An ``ASKED`` record
    is closed by its page, an ``OWN`` record by the page before its own (page 0
    has none).  With pages landed in order one record for each unfinished run stays open.
    """
    nothing = F.lit(None).cast("string").alias("cursor")
    marks = F.array(F.struct(F.col("page_no").alias("page_no"), nothing, F.lit(_CAME).alias("side")),
                    F.struct((F.col("page_no") + 1).alias("page_no"), nothing, F.lit(_CAME_BEFORE).alias("side")))
    # Records and marks of one page meet in one exchange; a page without run or number meets none.
    met = (found.select("run_id", "page_no", "cursor", "side").unionByName(landed.select("run_id", F.inline(marks)))
           .groupBy("run_id", "page_no")
           .agg(F.bit_or("side").alias("sides"),
                F.collect_set(F.when(F.col("side") <= ASKED, F.struct("cursor", "side"))).alias("kept")))
    nameless = F.col("run_id").isNull() | F.col("page_no").isNull()
    unmet = lambda closing: nameless | (F.col("sides").bitwiseAND(F.lit(closing)) == 0)
    return (met.select("run_id", "page_no", "sides", F.inline("kept"))
            .where(F.when(F.col("side") == ASKED, unmet(_CAME)).otherwise((F.col("page_no") > 0) & unmet(_CAME_BEFORE | ASKED)))
            .select("run_id", "page_no", "cursor", "side"))
