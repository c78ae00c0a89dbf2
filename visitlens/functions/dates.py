"""Date/time helpers as Column expressions.

Action times arrive as ``yyyy-MM-dd H:mm:ss`` text whose hour may be
unpadded; they are parsed once (bad text -> NULL) and compared as
timestamps, never as strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# yyyy-M-d H:m:s with one- or two-digit fields (the generator leaves hours unpadded);
# a fraction of a second may follow and is dropped, as all results are in whole seconds
TIME_TEXT = r"^(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})(?:\.\d*)?$"


# The same fields as a lenient parser reads them: any number of digits, a sign, blanks
# before a field, and whatever text after the seconds.
LENIENT_TEXT = r"^[ \t]*(-?\d+)-[ \t]*(-?\d+)-[ \t]*(-?\d+) [ \t]*(-?\d+):[ \t]*(-?\d+):[ \t]*(-?\d+)"
_MOST_DAYS = 3_700_000  # more than the days of ten thousand years


def parse_time(c: Column | str, lenient: bool = False) -> Column:
    """Text -> TIMESTAMP_NTZ (wall clock, no time zone); bad or impossible text -> NULL.

    Fields are assembled with ``try_make_timestamp_ntz`` so no session time
    zone is involved (parsing to an instant and back would move wall-clock
    times that fall in a DST gap).

    ``lenient`` reads as the reference does: fields out of range roll over into the next
    larger one (month 13 is January of the next year, hour 25 is 1 o'clock of the next
    day, day 0 the last of the month before) and text after the seconds is ignored.  Dates are those of
    the proleptic Gregorian calendar; results outside the years 1 to 9999 are NULL.
    """
    if lenient:
        return _rolled_time(_c(c))
    c = _c(c)
    parts = [F.regexp_extract(c, TIME_TEXT, i).try_cast("int") for i in range(1, 7)]
    return F.try_make_timestamp_ntz(*parts)


def _rolled_time(c: Column) -> Column:
    year, month, day, hour, minute, second = (F.regexp_extract(c, LENIENT_TEXT, i).try_cast("int").cast("bigint") for i in range(1, 7))
    months = year * 12 + month - 1
    first_year, first_month = F.floor(months / 12), F.pmod(months, F.lit(12)) + 1
    inside = first_year.between(1, 9999)
    first = F.make_date(F.when(inside, first_year).cast("int"), first_month.cast("int"), F.lit(1))
    seconds = hour * 3600 + minute * 60 + second
    days = day - 1 + F.floor(seconds / 86400)
    at = F.date_add(first, F.when(F.abs(days) <= _MOST_DAYS, days).cast("int"))
    time = F.timestamp_add("SECOND", F.pmod(seconds, F.lit(86400)).cast("int"), at.cast("timestamp_ntz"))
    return F.when(at.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date")), time)


def _sec_of_day(c: Column) -> Column:
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c).cast("int")


def format_time(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a TIMESTAMP_NTZ (fraction dropped).

    Built from the wall-clock value itself, so the session time zone never
    enters (``date_format`` would convert through it).
    """
    return F.substring(_c(c).cast("timestamp_ntz").cast("string"), 1, 19)


def format_date(c: Column | str) -> Column:
    """``yyyy-MM-dd`` of a TIMESTAMP_NTZ, time-zone independent."""
    return F.to_date(_c(c)).cast("string")


def format_month(c: Column | str) -> Column:
    return F.substring(format_date(c), 1, 7)


def date_hour(c: Column | str) -> Column:
    """``yyyy-MM-dd_HH`` key of a TIMESTAMP_NTZ (hour zero-padded), time-zone independent."""
    c = _c(c)
    return F.concat(format_date(c), F.lit("_"), F.lpad(F.hour(c).cast("string"), 2, "0"))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole seconds from ``earlier`` to ``later``, each end truncated to the second.

    Day difference x 86400 + second-of-day difference: exact on wall-clock
    (NTZ) values whatever the session time zone, DST changes included.
    """
    a, b = _c(earlier), _c(later)
    days = F.datediff(F.to_date(b), F.to_date(a)).cast("bigint")
    return days * F.lit(86400) + (_sec_of_day(b) - _sec_of_day(a)).cast("bigint")


def before(t1: Column | str, t2: Column | str, lenient: bool = False) -> Column:
    """``t1 < t2`` for time text; unparsable input -> FALSE."""
    return F.coalesce(parse_time(t1, lenient) < parse_time(t2, lenient), F.lit(False))


def after(t1: Column | str, t2: Column | str, lenient: bool = False) -> Column:
    """``t1 > t2`` for time text; unparsable input -> FALSE."""
    return F.coalesce(parse_time(t1, lenient) > parse_time(t2, lenient), F.lit(False))


def minus(t1: Column | str, t2: Column | str, lenient: bool = False) -> Column:
    """Seconds ``t1 - t2`` for time text; unparsable input -> 0.

    ``lenient`` also gives 0 where a 32-bit number cannot hold the difference, as the reference does."""
    seconds = seconds_between(parse_time(t1, lenient), parse_time(t2, lenient))
    if lenient:
        seconds = F.when(seconds.between(-(1 << 31), (1 << 31) - 1), seconds)
    return F.coalesce(seconds, F.lit(0).cast("bigint"))


def today() -> Column:
    return F.date_format(F.current_date(), DATE_FORMAT)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)
