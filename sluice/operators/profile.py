"""Shape and field profiles of pages and events: O25 O26."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import ensure_semantics


def page_shape(pages: DataFrame, body: str = "body") -> DataFrame:
    """O25 for every page: the structural facts the discovery step prints.

    Type names follow JavaScript ``typeof`` (object, array and null are all
    ``object`` except the explicit array test and the explicit ``null`` for
    the next cursor; an absent key is ``undefined``).  Only ``data`` and the
    top-level paging names are inspected.
    """
    ensure_semantics(pages.sparkSession)        # repeated keys: last wins
    v = F.try_parse_json(F.col(body))
    df = pages.withColumn("_v", v)
    v = F.col("_v")
    data = S.raw_field(v, "data")
    arr = F.try_variant_get(v, "$['data']", "array<variant>")
    first_text = F.get_json_object(F.col(body), "$.data[0]")
    first = F.try_variant_get(v, "$['data'][0]", "variant")
    cursor = S.raw_field(v, "nextCursor")
    is_obj = F.regexp_extract(F.col(body), r"^\s*(\S)", 1).isin("{", "[")
    return df.select(
        "run_id", "page_no",
        F.when(is_obj, _js_key_order(F.json_object_keys(F.col(body)))).alias("top_level_keys"),
        F.when(arr.isNotNull(), F.lit("array")).otherwise(S.js_typeof(data)).alias("data_type"),
        F.when(arr.isNotNull(), F.size(arr)).alias("data_length"),
        S.js_typeof(S.raw_field(v, "hasMore")).alias("has_more_type"),
        F.when(F.is_variant_null(cursor), F.lit("null")).otherwise(S.js_typeof(cursor))
        .alias("next_cursor_type"),
        F.when((F.size(arr) > 0) & S.is_record(first),
               F.coalesce(_js_key_order(F.json_object_keys(first_text)), _index_keys(first)))
        .alias("first_event_keys"),
        F.size(F.coalesce(arr, F.try_variant_get(v, "$['events']", "array<variant>")))
        .alias("sample_size"))


_INDEX_RE = r"^(0|[1-9][0-9]{0,9})$"


def _js_key_order(keys) -> "F.Column":
    """``Object.keys`` order: array-index keys ascending, then the rest in order.

    A key repeated in the text is listed once, at its first position.
    """
    keys = F.array_distinct(keys)

    def is_index(k):
        return k.rlike(_INDEX_RE) & (k.cast("long") < 4294967295)
    idx = F.transform(F.array_sort(F.transform(F.filter(keys, is_index), lambda k: k.cast("long"))),
                      lambda v: v.cast("string"))
    return F.concat(idx, F.filter(keys, lambda k: ~is_index(k)))


def _index_keys(x) -> "F.Column":
    """``Object.keys`` of a JSON array: its indexes as strings (empty for ``[]``)."""
    items = F.try_variant_get(x, "$", "array<variant>")
    n = F.size(items)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: i.cast("string"))) \
        .otherwise(F.array().cast("array<string>"))


def _kind(x) -> "F.Column":
    t = S.vtype(x)
    return (F.when(F.is_variant_null(x), F.lit("null"))
            .when(t == "STRING", "string").when(t == "BOOLEAN", "boolean")
            .when(S.is_number(t), "number").when(t.startswith("ARRAY"), "array")
            .otherwise("object"))


def field_profile(events: DataFrame, event: str = "event") -> DataFrame:
    """O26 over all events: ``(key, type, n, events, share)``.

    ``events`` counts the object events: each gives one marker row beside its
    entries, so that one pass and one aggregate find both.  The marker's count is a
    scalar subquery over the same aggregate, whose exchange is read again.
    """
    entries = F.map_entries(F.col(event).try_cast("map<string,variant>"))
    kind = "array<struct<key:string,value:variant>>"
    marker = F.when(S.vtype(F.col(event)).startswith("OBJECT"),
                    F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value"))))
    rows = events.where(F.col(event).isNotNull()).select(F.explode(F.concat(
        F.coalesce(marker.cast(kind), F.array().cast(kind)), F.coalesce(entries.cast(kind), F.array().cast(kind)))).alias("e"))
    # The marker is told by an aggregate, not by the key: a filter on the key would move
    # below the aggregate, and the exchange could not be shared.
    counts = rows.groupBy(F.col("e.key").alias("key"), _kind(F.col("e.value")).alias("type")).agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(F.col("e.key").isNull()).alias("_marker"))
    total = counts.agg(F.coalesce(F.max(F.when(F.col("_marker"), F.col("n"))), F.lit(0))).scalar()
    return (counts.where(~F.col("_marker")).withColumn("events", total)
            .withColumn("share", F.col("n") / F.col("events")).drop("_marker"))
