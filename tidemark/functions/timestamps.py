"""Timestamp columns: tolerant parsing, calendar arithmetic, partition keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Accepted layouts beside ISO dates and date-times.
OTHER_LAYOUTS = (
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd HH:mm",
    "yyyy/MM/dd",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy",
    "dd-MM-yyyy HH:mm:ss",
    "dd-MM-yyyy",
    "yyyyMMddHHmmss",
    "yyyyMMdd",
)
ISO_START = r"^\d{4}-\d{1,2}-\d{1,2}"
EPOCH_SECONDS = r"^\d{9,10}$"


def parse_timestamp(text: Column, layouts: Sequence[str] = OTHER_LAYOUTS) -> Column:
    """Best-effort timestamp, to the second; unreadable text gives NULL.

    ISO text takes the parser without a pattern. The listed layouts are tried in turn
    only for text that is not ISO, so clean data never pays for them.
    """
    trimmed = F.trim(text)
    others = [F.try_to_timestamp(trimmed, F.lit(layout)) for layout in layouts]
    epoch = F.when(trimmed.rlike(EPOCH_SECONDS), F.timestamp_seconds(trimmed.try_cast("bigint")))
    parsed = F.when(trimmed.rlike(ISO_START), F.try_to_timestamp(trimmed)).when(
        trimmed != "", F.coalesce(epoch, *others)
    )
    return to_second(parsed)


def to_second(ts: Column) -> Column:
    return F.date_trunc("second", ts)


def hours_between(start: Column, end: Column) -> Column:
    """Hour boundaries crossed: 10:59 to 12:01 is 2, although only 62 minutes passed."""
    return hour_number(end) - hour_number(start)


def hour_number(ts: Column) -> Column:
    """Whole hours since the epoch, in UTC."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(3600))


def calendar_days(start: Column, end: Column) -> Column:
    """Difference of the calendar dates, whatever the time of day."""
    return F.datediff(end, start)


def day(ts: Column) -> Column:
    return F.to_date(ts)


def day_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def second_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
