"""Column helpers that turn bad input into NULL instead of failing under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECONDS = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyy-MM-dd"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: Column | str) -> Column:
    """Narrow to int; out-of-range values, NaN and infinities give NULL."""
    return _column(c).try_cast("int")


def to_double(c: Column | str) -> Column:
    """Numeric text or number to double; anything else gives NULL."""
    return _column(c).try_cast("double")


def to_time(c: Column | str) -> Column:
    """ISO text to timestamp in the session zone (UTC)."""
    return F.try_to_timestamp(_column(c))


def to_day(c: Column | str) -> Column:
    """Text or timestamp to date."""
    return _column(c).try_cast("date")


def epoch_to_time(c: Column | str) -> Column:
    """Epoch seconds, as number or text, to timestamp."""
    return F.timestamp_seconds(_column(c).try_cast("bigint"))


def time_text(c: Column | str, pattern: str = SECONDS) -> Column:
    return F.date_format(_column(c), pattern)


def split_plain(c: Column | str) -> Column:
    """Split on every comma, keeping blanks."""
    return F.split(_column(c), ",")


def split_trimmed(c: Column | str, drop_empty: bool = False) -> Column:
    """Trim, then split on a comma with following blanks; '' gives [''] unless dropped."""
    parts = F.split(F.trim(_column(c)), r",\s*")
    return F.filter(parts, lambda part: part != "") if drop_empty else parts


def first_of(c: Column | str) -> Column:
    """First array element; NULL for a NULL or empty array."""
    return F.get(_column(c), 0)


def joined(c: Column | str, separator: str) -> Column:
    """Array to delimited text; NULL for a NULL or empty array."""
    array = _column(c)
    return F.when(F.size(array) > 0, F.array_join(array, separator))
