"""Event scalars as Column expressions over VARIANT values (no Python UDFs).

JSON semantics that matter here, and how they map to Spark:

* ``a ?? b ?? c`` skips absent *and* null.  A JSON null inside a VARIANT is not
  an SQL NULL, so every candidate is null-cleared with :func:`field` first.
* Types are tested before values are read: ``variant_get(v, '$', 'string')``
  happily turns the number 7 into ``'7'``.
* Epoch arithmetic is done in DOUBLE, as the source system does.

Recorded divergences are listed one by one in the README (date text).
"""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dates

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's for equal results)
# ---------------------------------------------------------------------------
EVENT_ID_KEYS = ("eventId", "event_id", "id")
OCCURRED_AT_KEYS = ("occurredAt", "occurred_at", "timestamp")
HAS_MORE_PATHS = ("hasMore", "has_more", "pagination.hasMore", "pagination.has_more")
NEXT_CURSOR_PATHS = ("nextCursor", "next_cursor", "pagination.nextCursor",
                     "pagination.next_cursor")
ITEM_KEYS = ("data", "events")
# Epoch magnitude thresholds: >=1e17 ns, >=1e14 us, >=1e11 ms, >=1e8 s, else ms.
NS_FROM = 1e17
US_FROM = 1e14
MS_FROM = 1e11
S_FROM = 1e8

# Representable instants (milliseconds since epoch): the source system's dates.
MIN_MS = -8_640_000_000_000_000
MAX_MS = 8_640_000_000_000_000

ISO_MS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

_NUMERIC_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")
_WS = r"[\s\p{Z}\x{FEFF}]"
_DECIMAL_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _path(dotted: str) -> str:
    return "$" + "".join(f"['{p}']" for p in dotted.split("."))


def raw_field(v: Column, dotted: str) -> Column:
    """The value at a key path, SQL NULL when absent (JSON null kept)."""
    return F.try_variant_get(v, _path(dotted), "variant")


def field(v: Column, dotted: str) -> Column:
    """The value at a key path with JSON null cleared to SQL NULL."""
    x = raw_field(v, dotted)
    return F.when(~F.is_variant_null(x), x)


def first_present(v: Column, paths) -> Column:
    """``v.a ?? v.b ?? ...``: the first candidate that is neither absent nor null."""
    return F.coalesce(*[field(v, p) for p in paths])


def vtype(x: Column) -> Column:
    return F.schema_of_variant(x)


def is_number(t: Column) -> Column:
    return t.isin(*_NUMERIC_TYPES) | t.startswith("DECIMAL")


def as_string(x: Column) -> Column:
    """The string value when ``x`` holds a JSON string, else NULL."""
    return F.when(vtype(x) == "STRING", F.try_variant_get(x, "$", "string"))


def as_double(x: Column) -> Column:
    """The numeric value when ``x`` holds a JSON number, else NULL."""
    return F.when(is_number(vtype(x)), F.try_variant_get(x, "$", "double"))


def js_trim(s: Column) -> Column:
    """White-space trim covering tabs, new lines and Unicode spaces.

    Strings that start and end with a printable ASCII character (nearly all)
    skip the regular expression.
    """
    first, last = F.ascii(s), F.ascii(F.substring(s, -1, 1))
    plain = (first > 32) & (first < 127) & (last > 32) & (last < 127)
    return F.when(plain, s).otherwise(F.regexp_replace(s, f"^{_WS}+|{_WS}+$", ""))


def is_record(x: Column) -> Column:
    """True for JSON objects and arrays (``typeof x === 'object' && x !== null``)."""
    t = vtype(x)
    return t.startswith("OBJECT") | t.startswith("ARRAY")


def js_typeof(x: Column) -> Column:
    """JavaScript ``typeof`` of a raw (not null-cleared) field; NULL input means absent."""
    t = vtype(x)
    return (F.when(x.isNull(), F.lit("undefined"))
            .when(t == "STRING", "string")
            .when(t == "BOOLEAN", "boolean")
            .when(is_number(t), "number")
            .otherwise("object"))


# ---------------------------------------------------------------------------
# O8 event id
# ---------------------------------------------------------------------------
def resolve_event_id(ev: Column) -> Column:
    """``eventId ?? event_id ?? id``; must be a non-empty string, else NULL."""
    s = as_string(first_present(ev, EVENT_ID_KEYS))
    return F.when(F.length(s) > 0, s)


def invalid_reason(ev: Column, event_id: Column) -> Column:
    """Why an event fails the page: not an object, or no usable id."""
    return (F.when(event_id.isNotNull(), F.lit(None).cast("string"))
            .when(ev.isNull() | ~is_record(ev), F.lit("event must be an object"))
            .otherwise(F.lit("missing event id")))


# ---------------------------------------------------------------------------
# O10 epoch units
# ---------------------------------------------------------------------------
def epoch_to_ms(x: Column) -> Column:
    """Scale a number of unknown unit to (fractional) milliseconds, as DOUBLE."""
    x = x.cast("double")
    a = F.abs(x)
    return (F.when(a >= NS_FROM, x / 1e6)
            .when(a >= US_FROM, x / 1e3)
            .when((a >= S_FROM) & (a < MS_FROM), x * 1e3)
            .otherwise(x))


def epoch_to_instant(x: Column) -> Column:
    """Number -> TIMESTAMP (truncated toward zero), NULL if not finite or out of range."""
    x = x.cast("double")
    ms = epoch_to_ms(x)
    ok = (~F.isnan(x) & (F.abs(x) < float("inf"))
          & (ms > MIN_MS - 1) & (ms < MAX_MS + 1))
    return F.when(ok, F.timestamp_millis(ms.cast("long")))


# ---------------------------------------------------------------------------
# O11 boolean coercion
# ---------------------------------------------------------------------------
def coerce_bool(x: Column) -> Column:
    """true/false; 'true'/'false' after trim and lower-casing; 1/0; else NULL.

    Pass a column reference: ``x`` is used several times.
    """
    t = vtype(x)
    s = F.lower(js_trim(F.try_variant_get(x, "$", "string")))
    d = F.try_variant_get(x, "$", "double")
    return (F.when(t == "BOOLEAN", F.try_variant_get(x, "$", "boolean"))
            .when(t == "STRING", F.when(s == "true", F.lit(True)).when(s == "false", F.lit(False)))
            .when(is_number(t), F.when(d == 1.0, F.lit(True)).when(d == 0.0, F.lit(False))))


# ---------------------------------------------------------------------------
# O9 occurred-at
# ---------------------------------------------------------------------------
def _radix_value(s: Column) -> Column:
    """``Number('0x..' / '0o..' / '0b..')``: unsigned digits in base 16/8/2 as DOUBLE.

    Up to two chunks of 48 bits each are converted exactly with ``conv`` and
    combined in DOUBLE; longer digit strings exceed any representable instant
    (infinite here, NULL downstream).
    """
    p = F.lower(F.substring(s, 2, 1))
    base = F.when(p == "x", 16).when(p == "o", 8).otherwise(2)
    chunk = F.when(p == "x", 12).when(p == "o", 16).otherwise(48)
    d = F.regexp_replace(F.substring(s, 3, 1 << 30), "^0+", "")
    n = F.length(d)
    lo = F.when(n > chunk, d.substr(n - chunk + 1, chunk)).otherwise(d)
    hi = F.when(n > chunk, d.substr(F.lit(1), n - chunk))
    lo_v = F.coalesce(F.call_function("conv", lo, base, F.lit(10)).cast("double"), F.lit(0.0))
    hi_v = F.coalesce(F.call_function("conv", hi, base, F.lit(10)).cast("double"), F.lit(0.0))
    return F.when(n <= 2 * chunk, hi_v * F.pow(base.cast("double"), chunk) + lo_v).otherwise(
        F.lit(float("inf")))


def js_number(s: Column) -> Column:
    """``Number(s)`` for an already-trimmed string; NULL where it gives NaN."""
    return (F.when(s.rlike(_DECIMAL_RE), s.try_cast("double"))
            .when(s.rlike(r"^0([xX][0-9a-fA-F]+|[oO][0-7]+|[bB][01]+)$"), _radix_value(s)))


def _in_range(ts: Column) -> Column:
    ms = F.unix_millis(ts)
    return F.when((ms >= MIN_MS) & (ms <= MAX_MS), ts)


# ISO-8601 forms accepted by Date.parse, rewritten to one form Spark casts.
_Y = r"([+-]\d{6}|\d{4})"
_ISO_REWRITES = (
    (rf"^{_Y}$", "$1-01-01T00:00:00Z"),
    (rf"^{_Y}-(\d{{2}})$", "$1-$2-01T00:00:00Z"),
    (rf"^{_Y}-(\d{{2}})-(\d{{2}})$", "$1-$2-$3T00:00:00Z"),
    (rf"^{_Y}-(\d{{2}})-(\d{{2}})[T ](\d{{2}}:\d{{2}})(Z|[+-]\d{{2}}:?\d{{2}})?$", "$1-$2-$3T$4:00$5"),
    (r"^(.*T\d{2}:\d{2}:\d{2}(\.\d+)?)$", "$1Z"),
    (r"^(.*[T ]\d{2}:\d{2}.*[+-]\d{2})(\d{2})$", "$1:$2"),
)
_ISO_ANY = (rf"^{_Y}(-\d{{2}}(-\d{{2}}([T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?"
            r"(Z|[+-]\d{2}:?\d{2})?)?)?)?$")
_RFC_ANY = (r"^(?:[A-Za-z]{3},\s*)?(\d{1,2}) ([A-Za-z]{3}) (\d{4}) (\d{2}:\d{2})(:\d{2})?"
            r" (GMT|UTC|UT|Z|[+-]\d{4})$")


#: Text that only the strict grammar may read: wrong fields in it are an error, not free form.
_ISO_STRICT = r"^([+-]\d{6}|\d{4})(-\d{2}){0,2}(T.*)?$"

# "T24:00" (with zero seconds/fraction) is the end of the day: next midnight.
_ISO_24 = r"^([+-]\d{6}|\d{4})-(\d{2})-(\d{2})T24:00(:00(?:\.0+)?)?(Z|[+-]\d{2}:?\d{2})?$"
_ISO_CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


_BUILT: dict = {}


def built_once(key: tuple, build):
    """``build()``, once for each application and key: large expressions over columns of given names.

    A Column names its inputs and belongs to no DataFrame, so it can be used again;
    building one of hundreds of nodes takes a call into the JVM for each.
    """
    at = (SparkContext._active_spark_context.applicationId, *key)
    if at not in _BUILT:
        _BUILT[at] = build()
    return _BUILT[at]


def _date_parse_unchecked(s: Column) -> Column:
    """``Date.parse`` as a millisecond-truncated TIMESTAMP, before the range check."""
    iso = s
    for pattern, repl in _ISO_REWRITES:
        iso = F.regexp_replace(iso, pattern, repl)
    rfc = F.regexp_replace(s, _RFC_ANY, "$1 $2 $3 $4$5 $6")
    rfc = F.regexp_replace(rfc, r"^(\S+ \S+ \S+ \d{2}:\d{2}) ", "$1:00 ")
    rfc = F.regexp_replace(rfc, r" (GMT|UTC|UT|Z)$", " +0000")
    end_of_day = F.regexp_replace(s, _ISO_24, "$1-$2-$3T00:00:00$5")
    next_day = F.timestamp_millis(F.unix_millis(
        F.regexp_replace(end_of_day, r"T00:00:00$", "T00:00:00Z").try_cast("timestamp")) + 86400000)
    parsed = (F.when(s.rlike(_ISO_24), next_day)
              .when(s.rlike(_ISO_CANONICAL), s.try_cast("timestamp"))
              .when(s.rlike(_ISO_ANY), iso.try_cast("timestamp"))
              .when(s.rlike(_RFC_ANY), F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss Z"))))
    # What no strict form gives is read as free-form text (a day past its month among it).
    parsed = F.coalesce(parsed, F.timestamp_millis(dates.free_form_ms(F.when(~s.rlike(_ISO_STRICT), s))))
    return F.date_trunc("millisecond", parsed)


def js_date_parse(s: Column) -> Column:
    """``Date.parse`` for ISO-8601, RFC-1123 and free-form text (:mod:`.dates`), time zone independent.

    Date-only forms are UTC; date-times without an offset are read as UTC.
    The result is truncated to milliseconds.  Canonical ISO text (the common
    case) is cast directly; other forms are first rewritten to it.
    """
    return _in_range(_date_parse_unchecked(s))


def event_fields(ev: Column) -> Column:
    """The fields of an object as a map, JSON nulls kept; NULL for anything else.

    Worth it where many fields are asked for: a look-up in a VARIANT spells every
    key that it passes.  Stage it as a column.
    """
    return ev.try_cast("map<string,variant>")


def with_occurred_at(df, event: str = "event", out: str = "occurred_at",
                     present_out: str = "time_present", fields: str | None = None):
    """O9 on a DataFrame: adds the instant and whether the time was present.

    ``present`` is false when the time is *absent* (the last alias,
    ``timestamp``, is missing and no earlier alias holds a value).  Absent and
    null both give a NULL instant; they differ only in the payload.
    Intermediate values are staged as columns so each is computed once.
    ``fields``: the column of :func:`event_fields`, where it is staged already.
    """
    from .metrics import observed
    ev = F.col(event)

    def steps() -> dict[str, Column]:
        if fields is None:
            found, last = first_present(ev, OCCURRED_AT_KEYS), raw_field(ev, OCCURRED_AT_KEYS[-1])
        else:
            values = [F.col(fields)[k] for k in OCCURRED_AT_KEYS]
            found, last = F.coalesce(*[F.when(~F.is_variant_null(x), x) for x in values]), values[-1]
        t, s = F.col("_ot"), F.col("_os")
        is_text = (t == "STRING") & (s != "")
        return {"_oc": found, "present": F.col("_oc").isNotNull() | last.isNotNull(), "_ot": vtype(F.col("_oc")),
                "_or": F.when(F.col("_ot") == "STRING", F.try_variant_get(F.col("_oc"), "$", "string")),
                "_os": js_trim(F.col("_or")),
                "_on": F.when(is_number(t), F.try_variant_get(F.col("_oc"), "$", "double")).when(is_text, js_number(s)),
                "_oi": epoch_to_instant(F.col("_on")),
                "_od": F.when(F.col("_oi").isNull() & is_text, _date_parse_unchecked(s)),
                "instant": F.coalesce(F.col("_oi"), _in_range(F.col("_od")))}

    c = built_once(("occurred_at", event, fields), steps)
    df = (df.withColumn("_oc", c["_oc"]).withColumn(present_out, c["present"]).withColumn("_ot", c["_ot"])
          .withColumn("_or", c["_or"]).withColumn("_os", c["_os"]))
    df = observed(df, "time_values", F.count(F.col("_oc")).alias("with_time"))
    df = df.withColumn("_on", c["_on"]).withColumn("_oi", c["_oi"])
    df = observed(df, "time_numbers", F.count(F.col("_oi")).alias("from_numbers"))
    df = df.withColumn("_od", c["_od"])
    return df.withColumn(out, c["instant"]).drop("_oc", "_ot", "_or", "_os", "_on", "_oi", "_od")


def _let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable once (``body(v)`` may use ``v`` many times)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def normalize_occurred_at(ev: Column) -> tuple[Column, Column]:
    """O9 as plain Columns: ``(instant, present)`` for an event VARIANT.

    Same rules as :func:`with_occurred_at`.  Shared values are bound once
    through one-element ``transform`` lambdas so the expression stays small;
    the staged DataFrame form is still the faster choice for large inputs.
    """
    cand = first_present(ev, OCCURRED_AT_KEYS)
    present = cand.isNotNull() | raw_field(ev, OCCURRED_AT_KEYS[-1]).isNotNull()

    def from_candidate(c):
        t = vtype(c)

        def from_text(s):
            is_text = (t == "STRING") & (s != "")
            number = F.when(is_number(t), F.try_variant_get(c, "$", "double")).when(
                is_text, js_number(s))
            parsed = _let(F.when(is_text, _date_parse_unchecked(s)), _in_range)
            return F.coalesce(_let(number, epoch_to_instant), parsed)
        return _let(js_trim(as_string(c)), from_text)

    return _let(cand, from_candidate), present


_EPOCH_NTZ = "1970-01-01 00:00:00"


def _epoch_ntz() -> Column:
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz")


def iso_ms(ts: Column) -> Column:
    """``Date.prototype.toISOString`` of an instant, whatever the session time zone.

    Built by TIMESTAMP_NTZ arithmetic from the epoch, so it never passes through
    a local wall clock (which is ambiguous in a daylight-saving fall-back hour).
    """
    utc_wall = F.timestamp_add("MILLISECOND", F.unix_millis(ts), _epoch_ntz())
    year = F.year(utc_wall)
    plain = F.date_format(utc_wall, ISO_MS_FORMAT)
    # Years of more than four digits are written with a sign and six digits.
    wide = F.concat(F.when(year < 0, "-").otherwise("+"), F.lpad(F.abs(year).cast("string"), 6, "0"),
                    F.date_format(utc_wall, ISO_MS_FORMAT.removeprefix("yyyy")))
    return F.when(ts.isNull() | year.between(0, 9999), plain).otherwise(wide)


def ntz_epoch_micros(ts_ntz: Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ read as UTC wall clock."""
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), ts_ntz)


# ---------------------------------------------------------------------------
# O12 payload
# ---------------------------------------------------------------------------
def build_payload(ev: Column, event_id: Column, occurred_at: Column, present: Column,
                  iso: Column | None = None, fields: Column | None = None) -> Column:
    """The whole event with ``eventId`` and the normalised ``occurredAt`` written over it.

    Alias keys stay.  ``occurredAt`` is the ISO text, JSON null, or dropped
    when the time was absent.  ``iso`` (the instant's ISO text) may be passed
    when already computed.

    Fast path, exact: when the event already holds ``eventId`` equal to the
    resolved id and an ``occurredAt`` equal to what would be written (the same
    ISO text, or JSON null, or no key when absent), the payload *is* the event
    and the map round trip is skipped.  Well-formed sources hit it for nearly
    every event.  ``fields``: :func:`event_fields` of the event, where staged.
    """
    iso = iso_ms(occurred_at) if iso is None else iso
    m = event_fields(ev) if fields is None else fields
    raw_time, raw_id = (raw_field(ev, k) if fields is None else m[k] for k in ("occurredAt", "eventId"))
    same_id = as_string(raw_id) == event_id
    same_time = (F.when(~present, raw_time.isNull())
                 .when(occurred_at.isNull(), F.coalesce(F.is_variant_null(raw_time), F.lit(False)))
                 .otherwise(F.coalesce(as_string(raw_time) == iso, F.lit(False))))
    kept = F.map_filter(m, lambda k, v: ~k.isin("eventId", "occurredAt"))
    id_entry = F.create_map(F.lit("eventId"), event_id.cast("variant"))
    time_value = F.when(occurred_at.isNotNull(), iso.cast("variant")).otherwise(
        F.parse_json(F.lit("null")))
    time_entry = F.when(present, F.create_map(F.lit("occurredAt"), time_value)).otherwise(
        F.create_map().cast("map<string,variant>"))
    rebuilt = F.to_variant_object(F.map_concat(kept, id_entry, time_entry))
    return F.when(F.coalesce(same_id, F.lit(False)) & same_time, ev).otherwise(rebuilt)
