"""Free-form date text, as lenient JavaScript engines read it (the rest of O9's ``Date.parse``).

A table of forms, each a pattern for the date part and where its year, month and
day stand, shares one tail for time of day and zone.  A text is put into one
spelling (words in lower case, text in parentheses and commas gone, one space),
matched against the table, and rewritten to its fields; the instant is integer
arithmetic on these, so a day that its month lacks runs on into the next
(``2024/02/30`` is 1 March).  Everything is built-in expressions.

Rules: words before the first number that are no month are ignored (week days);
any other unknown word gives NULL.  Months go by their first three letters.
Years of two digits are 1950 to 2049; a missing year is 2001.  A text without a
zone is UTC (an engine would take its own time zone).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
ZONES = {"z": 0, "ut": 0, "utc": 0, "gmt": 0, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360,
         "pst": -480, "pdt": -420}
DEFAULT_YEAR = 2001

_MONTH = rf"((?:{'|'.join(MONTHS)})[a-z]*)\.?"
_SEP = r"[-/ ]"
#: Date part of a form, and the groups of year, month and day (0: the default year).
FORMS = (
    (rf"(\d{{3,6}}){_SEP}(\d{{1,2}}){_SEP}(\d{{1,2}})", (1, 2, 3)),          # 2024/1/5
    (rf"(\d{{1,2}}){_SEP}(\d{{1,2}}){_SEP}(\d{{1,6}})", (3, 1, 2)),          # 1/5/2024
    (r"(\d{1,2})/(\d{1,2})", (0, 1, 2)),                                    # 1/5
    (rf"{_MONTH}{_SEP}?(\d{{1,2}}){_SEP}(\d{{1,6}})", (3, 1, 2)),            # Jan 5 2024
    (rf"{_MONTH}{_SEP}?(\d{{1,2}})", (0, 1, 2)),                             # Jan 5
    (rf"(\d{{1,2}}){_SEP}?{_MONTH}{_SEP}?(\d{{1,6}})", (3, 2, 1)),           # 5 Jan 2024
    (rf"(\d{{1,2}}){_SEP}?{_MONTH}", (0, 2, 1)),                             # 5 Jan
    (rf"(\d{{3,6}}){_SEP}?{_MONTH}{_SEP}?(\d{{1,2}})", (1, 2, 3)),           # 2024 Jan 5
    (rf"{_MONTH}{_SEP}(\d{{3,6}})", (2, 1, -1)),                             # January 2024
)
#: Hour, minute, second, fraction, half of the day, zone name, offset sign, hours, minutes.
_TAIL = (r"(?:[t ](\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:\.(\d+))?)? ?(am|pm)?)?"
         rf" ?({'|'.join(sorted(ZONES, key=len, reverse=True))})?(?: ?([+-])(\d{{1,2}}):?(\d{{2}})?)?")
_FIELDS = ("year", "month", "day", "hour", "minute", "second", "fraction", "half", "zone", "sign", "off_h", "off_m")
#: Words that may stand before the first number.
_LEADING = rf"^(?:(?!(?:{'|'.join(MONTHS)}))[a-z]+\.? )+"


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _spelled(s: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(s), r"\([^()]*\)", " "), r"[\s,]+", " ")
    return F.regexp_replace(F.trim(plain), _LEADING, "")


def _fields(form: str, groups: tuple[int, int, int]) -> tuple[str, str]:
    """Whole pattern of a form and the rewriting to its fields, one after the other by ``|``."""
    n = form.replace("(?:", "").count("(")
    date = "|".join(f"${g}" if g > 0 else "1" if g < 0 else str(DEFAULT_YEAR) for g in groups)
    return f"^{form}{_TAIL}$", date + "".join(f"|${n + i}" for i in range(1, 10))


def _number(field: Column) -> Column:
    return F.when(field != "", field.try_cast("int"))


def _instant(parts: Column) -> Column:
    """Milliseconds since 1970 of the fields, NULL where one is out of range."""
    f = {name: F.element_at(parts, i) for i, name in enumerate(_FIELDS, 1)}
    y = _number(f["year"])
    year = (F.when((F.length(f["year"]) <= 2) & (y < 50), y + 2000).when((F.length(f["year"]) <= 2) & (y < 100), y + 1900)
            .otherwise(y))
    named = F.array_position(F.array(*map(F.lit, MONTHS)), F.left(f["month"], F.lit(3)))
    month = F.when(named > 0, named.cast("int")).otherwise(_number(f["month"]))
    day = _number(f["day"])
    hour, minute, second = F.coalesce(_number(f["hour"]), F.lit(0)), F.coalesce(_number(f["minute"]), F.lit(0)), \
        F.coalesce(_number(f["second"]), F.lit(0))
    ms = F.coalesce(F.rpad(F.left(f["fraction"], F.lit(3)), 3, "0").try_cast("int"), F.lit(0))
    half = F.when(f["half"] == "", hour).when((hour >= 1) & (hour <= 12), hour % 12 + F.when(f["half"] == "pm", 12).otherwise(0))
    midnight = (hour == 24) & (minute == 0) & (second == 0) & (ms == 0) & (f["half"] == "")
    ok = (month.between(1, 12) & day.between(1, 31) & ((hour < 24) | midnight) & (minute < 60) & (second < 60)
          & half.isNotNull() & (year < 275761))
    zone = F.lit(0)
    for name, minutes in ZONES.items():
        if minutes:
            zone = F.when(f["zone"] == name, minutes).otherwise(zone)
    # +1 and +01 are hours, +100 and +0100 hours and minutes.
    offset = F.when(f["sign"] == "", 0).otherwise(
        F.when(f["sign"] == "-", -1).otherwise(1) * (_number(f["off_h"]) * 60 + F.coalesce(_number(f["off_m"]), F.lit(0))))
    first = F.when(ok, F.make_date(year, month, F.lit(1)))
    days = F.datediff(first, F.lit("1970-01-01").cast("date")).cast("long") + day - 1
    return (days * 86_400_000 + ((half * 60 + minute - zone - offset) * 60 + second).cast("long") * 1000 + ms)


def free_form_ms(s: Column) -> Column:
    """Milliseconds since 1970 that a free-form date text stands for; NULL where it is none."""
    def read(text: Column) -> Column:
        fields = F.lit(None).cast("string")
        for form, groups in reversed(FORMS):
            pattern, rewritten = _fields(form, groups)
            fields = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, rewritten)).otherwise(fields)
        return _let(F.split(fields, r"\|"), _instant)
    return _let(_spelled(s), read)
