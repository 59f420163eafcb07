"""Column expressions. All are built-in functions and stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def present(column: Column | str) -> Column:
    """True where a text is neither null nor empty; never null."""
    return _col(column).isNotNull() & (_col(column) != "")


def flag(column: Column | str) -> Column:
    """Boolean as 0 / 1."""
    return _col(column).cast("int")


# Epoch seconds of the first and the last second of the years 1 to 9999.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def in_calendar(epoch: Column | str) -> Column:
    """Whether epoch seconds fall into the years 1 to 9999; null for null."""
    return _col(epoch).between(FIRST_SECOND, LAST_SECOND)


def moment(epoch: Column | str) -> Column:
    """Epoch seconds as a point in time, independent of the session's time zone.

    Null outside the years 1 to 9999, so that no number can stop a job.
    """
    return F.timestamp_seconds(F.when(in_calendar(epoch), _col(epoch)))


def epoch(column: Column | str) -> Column:
    """Point in time as whole epoch seconds."""
    return F.unix_timestamp(_col(column))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return epoch(end) - epoch(start)


def hours_between(start: Column | str, end: Column | str, digits: int | None = None) -> Column:
    hours = seconds_between(start, end) / F.lit(3600)
    return hours if digits is None else F.round(hours, digits)


def first_word(column: Column | str) -> Column:
    """Text before the first blank; the whole text where there is none."""
    return F.substring_index(_col(column), " ", 1)
