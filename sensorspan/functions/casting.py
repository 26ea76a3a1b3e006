"""Text to typed values. A value that does not parse becomes NULL.

The shape of a text is checked before it is cast. A cast that fails is far
dearer than a pattern that does not match, and a feed can hold many such
values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The usual form of a time; Spark's own cast reads it, zone mark included.
_PLAIN_MOMENT = (
    r"^\d{4}-\d{2}-\d{2}[T ](?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d{1,9})?(?:Z|[+-]\d{2}:\d{2})?$"
)
# Any accepted form: a full date, optionally a time, optionally a zone mark.
_MOMENT = (
    r"^\s*(-?\d{1,6}[-/]\d{1,2}[-/]\d{1,2})"
    r"(?:[T ](\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?))?"
    r"\s*(?:Z|UTC|[+-]\d{2}(?::?\d{2})?)?\s*$"
)
_MIDNIGHT_AFTER = r"^24:0{1,2}(?::0{1,2}(?:\.0+)?)?$"

_WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
_NOT_FINITE = r"(?i)^\s*[+-]?(?:nan|inf|infinity)\s*$"


def to_moment(text: Column) -> Column:
    """Text to a zone-less timestamp; a zone mark is dropped.

    A year and month alone are no timestamp, months and days outside the
    calendar are none either, and 24:00 is the next day's start.
    """
    date = F.translate(F.regexp_extract(text, _MOMENT, 1), "/", "-")
    time = F.regexp_extract(text, _MOMENT, 2)
    parsed = F.concat_ws(" ", date, F.when(time != "", time)).try_cast("timestamp_ntz")
    next_day = F.date_add(date.try_cast("date"), 1).cast("timestamp_ntz")
    return (
        F.when(text.rlike(_PLAIN_MOMENT), text.try_cast("timestamp_ntz"))
        .when(date == "", None)
        .when(time.rlike(_MIDNIGHT_AFTER), next_day)
        .otherwise(parsed)
    )


def _ungrouped(text: Column) -> Column:
    """Digits without the underscores between them."""
    return F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")


def to_bigint(text: Column) -> Column:
    """Text to a whole number, halves away from zero.

    No digit passes through a double, so long ids stay exact.
    """
    digits = _ungrouped(text)
    rounded = F.round(digits.try_cast("decimal(38,18)"), 0).try_cast("bigint")
    return F.when(text.rlike(_WHOLE), text.try_cast("bigint")).when(digits.rlike(_NUMBER), rounded)


def number_to_bigint(value: Column) -> Column:
    """A feed number to a whole number, halves to the even neighbour.

    Feed numbers arrive as doubles, and doubles round differently from text.
    """
    rounded = F.rint(to_double(value)).try_cast("bigint")
    return F.when(value.rlike(_WHOLE), value.try_cast("bigint")).otherwise(rounded)


def to_double(text: Column) -> Column:
    """Text to a double; a Java type suffix (``1d``, ``2f``) is not a number."""
    digits = _ungrouped(text)
    return (
        F.when(text.rlike(_NUMBER), text.try_cast("double"))
        .when(text.rlike(_NOT_FINITE), text.try_cast("double"))
        .when(digits.rlike(_NUMBER), digits.try_cast("double"))
    )
