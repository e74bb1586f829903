"""Text to number and date, with null for what does not parse.

The rules are those of a cast with ANSI mode off, written so that they hold whatever
the session's ANSI setting is: `try_cast` alone would lose `12.7` as an integer, where
the lenient cast cuts the fraction off.

A failing `try_cast` raises and catches an exception per value, some hundred times the
cost of a cast that works. A pattern therefore sorts out what cannot parse beforehand, so
that a column full of dashes or empty text costs no more than a clean one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace and control characters around a number do not count.
_PADDING = r"[\x00-\x20\x7f]*"
_WHOLE_THEN_FRACTION = rf"\A{_PADDING}[+-]?[0-9]+(?:[.][0-9]*)?{_PADDING}\z"
_FRACTION_ONLY = rf"\A{_PADDING}[+-]?[.][0-9]*{_PADDING}\z"
_DIGIT_OR_SPECIAL = r"[0-9]|(?i:nan|inf)"
_MONTH_DAY = r"\A0*([1-9]|1[0-2])/0*([1-9]|[12][0-9]|3[01])/"

# what a text must look like to be worth parsing, by date pattern: with a plain year, and
# with a signed or longer one
_DATE_SHAPES = {"M/d/yyyy": (_MONTH_DAY + r"[0-9]{4}\z", _MONTH_DAY + r"([+-]?[0-9]{4,18})\z")}


def _day_number(year: Column | int, month: Column | int, day: Column | int) -> Column | int:
    """Grows with the date; not a count of days."""
    return year * 372 + month * 31 + day


# the first and the last date that a timestamp in microseconds can hold; parsing goes by way
# of a timestamp and stops the job beyond them
_FIRST_DAY = _day_number(-290308, 12, 22)
_LAST_DAY = _day_number(294247, 1, 10)
_LARGEST_INT = 2**31 - 1


def lenient_integer(name: str, type_name: str) -> Column:
    """Whole part of a plain decimal number; text in any other form is null."""
    text = F.col(name)
    whole_part = F.substring_index(text, ".", 1).try_cast(type_name)
    return F.when(text.rlike(_WHOLE_THEN_FRACTION), whole_part).when(
        text.rlike(_FRACTION_ONLY), F.lit(0).cast(type_name)
    )


def lenient_double(name: str) -> Column:
    text = F.col(name)
    return F.when(text.rlike(_DIGIT_OR_SPECIAL), text.try_cast("double"))


def lenient_date(name: str, pattern: str) -> Column:
    """The parsed date; null for a text that does not parse or a date out of range."""
    text = F.col(name)
    parsed = F.try_to_date(text, pattern)
    if pattern not in _DATE_SHAPES:
        return parsed
    plain, signed = _DATE_SHAPES[pattern]
    month, day, year = (F.regexp_extract(text, signed, k).try_cast("long") for k in (1, 2, 3))
    # a year of 18 digits is no date and must not overflow on the way to being none
    in_range = year.between(-10**6, 10**6) & _day_number(
        F.when(year.between(-10**6, 10**6), year), month, day
    ).between(_FIRST_DAY, _LAST_DAY)
    return F.when(text.rlike(plain), parsed).when(text.rlike(signed) & in_range, parsed)


def date_key(day: Column) -> Column:
    """The date as the whole number yyyyMMdd, with the year's sign; null beyond an int."""
    year = F.year(day).cast("long")
    digits = F.abs(year) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return F.when(digits <= _LARGEST_INT, F.when(year < 0, -digits).otherwise(digits)).cast("int")
