"""Time strings and epochs. Nothing here depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _not_blank(text: Column) -> Column:
    return F.length(F.trim(text)) > 0


def epoch_to_text(seconds: Column) -> Column:
    """Epoch seconds -> ``yyyy-MM-dd HH:mm:ss``."""
    return F.timestamp_add("SECOND", seconds, F.expr(EPOCH)).cast("string")


def epoch_millis_to_text(millis: Column) -> Column:
    """Epoch milliseconds -> ``yyyy-MM-dd HH:mm:ss``, the fraction dropped."""
    return epoch_to_text(F.floor(millis / F.lit(1000)).cast("long"))


def to_epoch(ts: Column) -> Column:
    """A zone-less timestamp -> epoch seconds, rounded down.

    Composed from the day and the clock: ``timestampdiff`` would read the timestamp in the session
    zone, and skip an hour where that zone does.
    """
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(ts.cast("date")).cast("long") * 86400 + clock


def compact_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> ``yyyyMMddHHmmss``; null when blank or without a time part."""
    # Trailing blanks are no time part; a missing part is null and makes the whole null.
    parts = F.split(F.rtrim(text), " ", -1)
    return F.concat(F.translate(parts[0], "-", ""), F.translate(F.get(parts, F.lit(1)), ":", ""))


def compact_day(text: Column) -> Column:
    """Dashes stripped; null when blank."""
    return F.when(_not_blank(text), F.translate(text, "-", ""))


def minus_days(text: Column, days: int = 15) -> Column:
    """``yyyyMMddHHmm`` moved back by whole days, same format; null when it is no such time."""
    def part(start: int, length: int) -> Column:
        return F.substring(text, start, length).try_cast("int")

    moment = F.try_make_timestamp_ntz(
        part(1, 4), part(5, 2), part(7, 2), part(9, 2), part(11, 2), F.lit(0))
    moved = F.timestamp_add("DAY", F.lit(-days), moment).cast("string")
    return F.translate(F.substring(moved, 1, 16), "- :", "")


def month_suffix(ts: Column) -> Column:
    """``yyyyMM`` of a date or timestamp."""
    return F.translate(F.substring(ts.cast("string"), 1, 7), "-", "")


def now_as(fmt: str = "yyyyMMddHHmmss") -> Column:
    """The current time in a caller's format."""
    return F.date_format(F.current_timestamp(), fmt)


def day_of(text: Column) -> Column:
    """Day part of ``yyyy-MM-dd HH:mm:ss``."""
    return F.substring_index(text, " ", 1)


def hour_of(text: Column) -> Column:
    """Two-digit hour of ``yyyy-MM-dd HH:mm:ss``."""
    return F.substring(F.substring_index(text, " ", -1), 1, 2)
