"""Dates kept as text: normalisation and the date part of a timestamp."""

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronicle.functions.text import WHITE_SPACE, empty_to_null, strip

# Month names, January first.
MONTHS = (
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
)

_GAP = f"[{WHITE_SPACE}]+"
# Where any digit may stand, it may be one of any script. There is no year 0.
_DAY = r"(3[01]|[12]\p{Nd}|0?[1-9])"
_MONTH = r"(1[0-2]|0?[1-9])"
_ZEROS = "".join(chr(c) for c in range(0x80, sys.maxunicode + 1) if unicodedata.decimal(chr(c), None) == 0)
_YEAR = rf"((?![0{_ZEROS}]{{4}})\p{{Nd}}{{4}})"
_LONG = "(" + "|".join(MONTHS) + ")"
_ANY = "(" + "|".join(MONTHS) + "|" + "|".join(m[:3] for m in MONTHS) + ")"

# The accepted layouts, each with the capture groups of year, month and day.
_LAYOUTS = (
    (rf"(?i)^{_ANY}{_GAP}{_DAY},{_GAP}{_YEAR}$", (3, 1, 2), True),
    (rf"^{_MONTH}/{_DAY}/{_YEAR}$", (3, 1, 2), False),
    (rf"^{_YEAR}-{_MONTH}-{_DAY}$", (1, 2, 3), False),
    (rf"(?i)^{_DAY}{_GAP}{_LONG}{_GAP}{_YEAR}$", (3, 2, 1), True),
)


@functools.cache
def _decimal_digits() -> tuple[str, str]:
    """All decimal digits beyond ASCII, and what each is in ASCII."""
    found = [(chr(c), unicodedata.decimal(chr(c), None)) for c in range(0x80, sys.maxunicode + 1)]
    found = [(c, str(n)) for c, n in found if n is not None]
    return "".join(c for c, _ in found), "".join(n for _, n in found)


def ascii_digits(text: Column) -> Column:
    """Decimal digits of all scripts as ``0`` to ``9``."""
    return F.translate(text, *_decimal_digits())


def _month_number(name: Column) -> Column:
    short = F.array(*[F.lit(m[:3]) for m in MONTHS])
    return F.array_position(short, F.lower(F.substring(name, 1, 3))).cast("string")


def parse_date(raw: Column) -> Column:
    """The date a text holds in one of the accepted layouts, else null.

    The layout is recognised by pattern first, so that the date parser sees
    well-formed input only; a failed parse costs an exception per row. Years
    run from 1 to 9999.
    """
    text = strip(raw)
    candidate = F.lit(None).cast("string")
    for pattern, (year, month, day), named in reversed(_LAYOUTS):
        m = F.regexp_extract(text, pattern, month)
        parts = (
            F.regexp_extract(text, pattern, year),
            _month_number(m) if named else m,
            F.regexp_extract(text, pattern, day),
        )
        candidate = F.when(text.rlike(pattern), F.concat_ws("-", *parts)).otherwise(candidate)
    return F.try_to_date(ascii_digits(candidate), "yyyy-M-d")


def normalize_date(raw: Column) -> Column:
    """ISO text where the date is understood, else the stripped text.

    Null and ``''`` give null; white space alone gives ``''``.
    """
    return F.coalesce(F.date_format(parse_date(raw), "yyyy-MM-dd"), strip(empty_to_null(raw)))


def cast_date(raw: Column) -> Column:
    """A history date: year, month and day in that order, else null.

    Separators are all ``-``, all ``/`` or all blanks; a time may follow and is ignored.
    """
    text = strip(raw)
    pattern = r"^(\d{4})([-/ ])(\d{1,2})\2(\d{1,2})(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"
    parts = [F.regexp_extract(text, pattern, g) for g in (1, 3, 4)]
    return F.try_to_date(F.when(text.rlike(pattern), F.concat_ws("-", *parts)), "yyyy-M-d")


# What may follow the date in a time stamp: any one character, a time of day,
# an offset, each in the plain or the compact form.
_CLOCK = r"(?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?|[0-5]\d(?:[0-5]\d(?:[.,]\d+)?)?)?"
_OFFSET = r"(?:Z|[+-](?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:\.\d+)?)?|[0-5]\d(?:[0-5]\d(?:\.\d+)?)?)?)?"
_TIME = rf"(?:.{_CLOCK}{_OFFSET})?$"
_CALENDAR_STAMP = rf"^(\d{{4}})(-?)(\d{{2}})\2(\d{{2}}){_TIME}"
_WEEK_STAMP = rf"^(\d{{4}})(-?)W(\d{{2}})(?:\2([1-7]))?{_TIME}"


def _calendar_date(stamp: Column) -> Column:
    parts = [F.regexp_extract(stamp, _CALENDAR_STAMP, g) for g in (1, 3, 4)]
    return F.try_to_date(F.when(stamp.rlike(_CALENDAR_STAMP), F.concat_ws("-", *parts)), "yyyy-MM-dd")


def _week_date(stamp: Column) -> Column:
    """Weeks start on Monday, and January 4th is always in the first one."""
    year, week, day = (F.regexp_extract(stamp, _WEEK_STAMP, g) for g in (1, 3, 4))
    january_4 = F.try_to_date(F.when(stamp.rlike(_WEEK_STAMP), F.concat(year, F.lit("-01-04"))), "yyyy-MM-dd")
    days = (week.try_cast("int") - 1) * 7 + F.coalesce(day.try_cast("int") - 1, F.lit(0))
    date = F.date_add(F.date_sub(january_4, F.weekday(january_4)), days)
    return F.when(F.weekofyear(date) == week.try_cast("int"), date)


def stamp_date(stamp: Column) -> Column:
    """The date written in an ISO timestamp, as a calendar or a week date, in the
    timestamp's own offset; null when the text is not an ISO timestamp."""
    return F.coalesce(_calendar_date(stamp), _week_date(stamp))
