"""Date and time expressions.

The mixed-date parser is a ``coalesce`` of guarded branches, tried in the
source's precedence order: y/m/d, d/m/yyyy, d/m/yy, day serial, ISO date-time,
other date forms (``generic_date``).
Each branch is a regex guard plus a ``try_*`` parse, so a bad cell is NULL.
The result is a ``TIMESTAMP_NTZ``: the date-time forms keep their time of day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from alloy.constants import (
    DATE_NULL_TOKENS,
    ENGLISH_MONTHS,
    INVALID_DATE,
    SERIAL_EPOCH,
    SERIAL_MAX_DAYS,
    TWO_DIGIT_YEAR_PIVOT,
)
from alloy.functions.numbers import _FLOAT_TEXT
from alloy.functions.text import _c, ustrip

NTZ = "timestamp_ntz"

_YMD = r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$"
_DMY4 = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
_DMY2 = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$"
_SERIAL = r"^[0-9]{3,6}$"
# Explicit ISO date-time forms accepted by the generic fallback:
# yyyy-MM-dd HH:mm:ss, yyyy-MM-dd'T'HH:mm:ss, both with a fraction, yyyy-MM-dd HH:mm
_ISO_DATETIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?$"
_HHMM = r"^[0-9]{1,2}:[0-9]{1,2}$"


# A time of day, perhaps with a zone, at the end of a cell; the zone alone is not
# taken, so that a date such as 15-01 does not lose a part of it.
_TIME = (r"(?i)^(.*?[0-9a-z])(?:t|[ ,]+)([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]{1,9}))?)?[ ]*([ap])?[.]?(?:m[.]?)?"
         r"[ ]*(?:z|utc|gmt|(?:utc|gmt)?[+-][0-9]{2}(?::?[0-9]{2})?)?$")
_COMPACT_TIME = r"(?i)^([0-9]{8})[t ]?([0-9]{2})([0-9]{2})([0-9]{2})(z?)$"
_WEEKDAY = r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*[., ]+"
_ORDINAL = r"(?i)([0-9])(?:st|nd|rd|th)\b"
_SEPARATORS = r"[-/., ]+"


# The characters of a date; no other cell is looked at.
_LIKE_DATE = r"^[A-Za-z0-9][A-Za-z0-9 ,.:/+-]*[0-9A-Za-z.]$"


def date_shapes() -> dict[str, str]:
    """Mask of a date -> order of its parts: y, m, d, or b for a month's name. In a mask
    digits are 9, a run of letters is a, and a run of separators is /."""
    shapes = {"99999999": "compact", "9999/99": "ym", "9999/9": "ym", "a/9999": "by"}
    short = ("9", "99")
    for d in short:
        for y in ("9999", "99"):
            shapes |= {f"{d}/a/{y}": "dby", f"a/{d}/{y}": "bdy"}
            shapes |= {f"{m}/{d}/{y}": "mdy" for m in short}
        shapes |= {f"9999/a/{d}": "ybd"} | {f"9999/{m}/{d}": "ymd" for m in short}
    return shapes


def month_numbers() -> dict[str, int]:
    """Lower-case English names of months, whole and short."""
    numbers = {n.lower(): i for i, n in enumerate(ENGLISH_MONTHS, 1)}
    return numbers | {n[:3]: i for n, i in numbers.items()} | {"sept": 9}


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for item in values.items() for x in item])


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` worked out once, only if it is reached, and
    outside of the generated code of the row."""
    return F.get(F.transform(F.array(value), then), 0)


def generic_date(col: Column | str) -> Column:
    """Other date forms -> TIMESTAMP_NTZ (NULL when none fits): English month names
    (``15 Jan 2024``, ``January 15th, 2024``), month before day (``01/31/2024``), compact
    (``20240115``, ``20240115T103000``), year and month, weekdays before them, times of
    24 and 12 hours after them, and zones after those.

    The cell is cut into a date and a time by one regular expression, the date's mask
    gives the order of its parts, and the numbers make the timestamp. Of two numbers
    that may both be the month, the first is. A time is taken as it is written: its zone
    says where the clock hung, not another hour.
    """
    text = F.regexp_replace(F.regexp_replace(_c(col), _COMPACT_TIME, "$1 $2:$3:$4$5"), _WEEKDAY, "")
    marks = F.when(text.rlike(_TIME), F.split(F.regexp_replace(text, _TIME, "$1|$2|$3|$4|$5|$6"), "[|]")).otherwise(F.array(text))
    return _let(marks, lambda m: _let(
        F.split(F.lower(F.regexp_replace(F.regexp_replace(F.get(m, 0), _ORDINAL, "$1"), _SEPARATORS, "/")), "/"),
        lambda parts: _dated(parts, m)))


def _dated(parts: Column, marks: Column) -> Column:
    letters = "abcdefghijklmnopqrstuvwxyz"
    mask = F.translate(F.array_join(parts, "/"), "0123456789" + letters, "9" * 10 + "a" * 26)
    order = F.try_element_at(_map(date_shapes()), F.regexp_replace(mask, "a+", "a"))

    def number(text: Column) -> Column:
        return text.try_cast("int")

    def part(o: Column, letter: str) -> Column:
        return F.get(parts, F.instr(o, letter) - 1)

    def dated(o: Column) -> Column:
        compact, text = o == "compact", F.get(parts, 0)
        y = F.when(compact, F.substring(text, 1, 4)).otherwise(part(o, "y"))
        century = F.when(F.length(y) == 4, 0).when(number(y) >= TWO_DIGIT_YEAR_PIVOT, 1900).otherwise(2000)
        m = F.when(compact, number(F.substring(text, 5, 2))).when(F.contains(o, F.lit("b")), F.try_element_at(_map(month_numbers()), part(o, "b")))
        m = F.coalesce(m, number(part(o, "m")))
        d = F.when(compact, number(F.substring(text, 7, 2))).when(~F.contains(o, F.lit("d")) & ~compact, F.lit(1)).otherwise(number(part(o, "d")))
        half = F.lower(F.get(marks, 5))
        hour = F.coalesce(number(F.get(marks, 1)), F.lit(0))
        hour = F.when(half.isin("a", "p"), F.when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))).otherwise(hour)
        minute = F.coalesce(number(F.get(marks, 2)), F.lit(0))
        second = F.concat(F.coalesce(F.nullif(F.get(marks, 3), F.lit("")), F.lit("0")), F.lit("."),
                          F.coalesce(F.substring(F.get(marks, 4), 1, 6), F.lit("")), F.lit("0")).try_cast("decimal(16,6)")

        def made(month: Column, day: Column) -> Column:
            return F.try_make_timestamp_ntz(number(y) + century, month, day, hour, minute, second)

        return F.coalesce(made(m, d), F.when(o == "mdy", made(d, m)))

    return _let(order, dated)


def parse_mixed_date(col: Column | str, generic: bool = True) -> Column:
    """Mixed-format date text -> TIMESTAMP_NTZ (NULL when unparsable). Without
    ``generic`` the forms of ``generic_date`` are not tried."""
    s = ustrip(_c(col))
    s = F.when(~s.isin(*DATE_NULL_TOKENS), s)
    sn = F.translate(s, "-.", "//")

    ymd = F.when(sn.rlike(_YMD), F.try_to_date(sn, "yyyy/M/d"))
    dmy4 = F.when(sn.rlike(_DMY4), F.try_to_date(sn, "d/M/yyyy"))
    yy = F.substring_index(sn, "/", -1)
    century = F.when(yy.try_cast("int") >= F.lit(TWO_DIGIT_YEAR_PIVOT), F.lit("19")).otherwise(F.lit("20"))
    dmy2 = F.when(
        sn.rlike(_DMY2),
        F.try_to_date(F.concat(F.substring_index(sn, "/", 2), F.lit("/"), century, yy), "d/M/yyyy"),
    )
    serial = F.when(
        s.rlike(_SERIAL) & (s.try_cast("int") <= F.lit(SERIAL_MAX_DAYS)),
        F.date_add(F.lit(SERIAL_EPOCH).cast("date"), F.least(s.try_cast("int"), F.lit(SERIAL_MAX_DAYS))),
    )
    iso = F.when(s.rlike(_ISO_DATETIME), s.try_cast(NTZ))
    forms = [ymd.cast(NTZ), dmy4.cast(NTZ), dmy2.cast(NTZ), serial.cast(NTZ), iso]
    return F.coalesce(*forms, *([F.when(s.rlike(_LIKE_DATE), generic_date(s))] if generic else []))


def error_date_key(parsed: Column | str) -> Column:
    """ISO date of a parsed value, or ``INVALID_DATE`` when it is NULL."""
    return F.coalesce(F.date_format(_c(parsed).cast("date"), "yyyy-MM-dd"), F.lit(INVALID_DATE))


def session_hour(col: Column | str) -> Column:
    """``Y/M/D/HH:MM`` -> HH as INT; any other shape -> NULL.

    Fourth '/'-separated part, text before the first ':', as a number rounded
    half away from zero. ``get`` returns NULL out of range (``[3]`` would raise).
    """
    part = F.substring_index(F.get(F.split(_c(col), "/"), 3), ":", 1)
    h = ustrip(part)
    return F.when(h.rlike(_FLOAT_TEXT), F.round(h.try_cast("double"), 0).try_cast("int"))


def time_from_hour(hour: Column | str) -> Column:
    """TIME(h, 0, 0) as ``HH:00:00`` text; hours outside 0..23 -> NULL."""
    h = _c(hour)
    return F.when(
        (h >= 0) & (h <= 23), F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":00:00"))
    )


def parse_hhmm(col: Column | str) -> Column:
    """Safe ``%H:%M`` parse to ``HH:mm:ss`` text; anything else -> NULL."""
    c = _c(col)
    hh = F.substring_index(c, ":", 1).try_cast("int")
    mm = F.substring_index(c, ":", -1).try_cast("int")
    ok = c.rlike(_HHMM) & (hh <= 23) & (mm <= 59)
    return F.when(
        ok,
        F.concat(F.lpad(hh.cast("string"), 2, "0"), F.lit(":"), F.lpad(mm.cast("string"), 2, "0"), F.lit(":00")),
    )


def session_start(day: Column | str, time_text: Column | str) -> Column:
    """DATETIME(date, time) from a DATE and ``HH:mm:ss`` text -> TIMESTAMP_NTZ."""
    d = _c(day)
    t = _c(time_text)
    return F.try_make_timestamp_ntz(
        F.year(d), F.month(d), F.dayofmonth(d),
        F.substring(t, 1, 2).cast("int"), F.substring(t, 4, 2).cast("int"),
        F.substring(t, 7, 2).cast("decimal(16,6)"),
    )
