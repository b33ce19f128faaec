"""Time parsing and calendar keys. All of it assumes a UTC session clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the session logs.
LOCAL_SHAPE = r"^\d{2}\.\d{2}\.(?!0000)\d{4}_\d{2}:\d{2}:\d{2}$"
LOCAL_FORMAT = "dd.MM.yyyy_HH:mm:ss"
ZONED_SHAPE = (
    r"^([A-Z][a-z]{2}),_(\d{1,2}_[A-Z][a-z]{2}_(?!0000)\d{4}_\d{2}:\d{2}:\d{2})"
    r"_([+-])(0\d|1[0-7]|18(?=00))([0-5]\d)$"
)
ZONED_FORMAT = "d_MMM_yyyy_HH:mm:ss"


def _day_first(token: Column, pattern: str) -> Column:
    """Parse a time that starts with the day; days 29 to 31 fall back to the month's last day."""
    rest = F.regexp_extract(token, r"^\d+(.*)$", 1)
    month_end = F.date_format(F.last_day(F.try_to_timestamp(F.concat(F.lit("01"), rest), F.lit(pattern))), "dd")
    clamped = F.when(
        token.rlike(r"^(29|30|31)\D"), F.try_to_timestamp(F.concat(month_end, rest), F.lit(pattern))
    )
    return F.coalesce(F.try_to_timestamp(token, F.lit(pattern)), clamped)


MIDNIGHT = r"_24:00:00(?=$|_)"


def _midnight(token: Column) -> tuple[Column, Column]:
    """The token with 24:00:00 written as 00:00:00, and the days that this takes away."""
    return F.regexp_replace(token, MIDNIGHT, "_00:00:00"), F.when(token.rlike(MIDNIGHT), 1).otherwise(0)


def parse_local(token: Column) -> Column:
    """``dd.MM.yyyy_HH:mm:ss`` read as UTC, null when it is anything else; 24:00:00 is the next day's start."""
    plain, days = _midnight(token)
    parsed = _day_first(plain, LOCAL_FORMAT)
    return F.when(token.rlike(LOCAL_SHAPE), F.timestamp_seconds(F.unix_seconds(parsed) + days * 86400))


def parse_zoned(token: Column) -> Column:
    """``EEE,_d_MMM_yyyy_HH:mm:ss_Z``; a weekday that contradicts the written date gives null."""
    plain, days = _midnight(token)
    local = _day_first(F.regexp_extract(plain, ZONED_SHAPE, 2), ZONED_FORMAT)
    sign = F.regexp_extract(token, ZONED_SHAPE, 3)
    hours = F.concat(sign, F.regexp_extract(token, ZONED_SHAPE, 4)).try_cast("int")
    minutes = F.concat(sign, F.regexp_extract(token, ZONED_SHAPE, 5)).try_cast("int")
    return F.when(
        token.rlike(ZONED_SHAPE) & (F.date_format(local, "E") == F.regexp_extract(token, ZONED_SHAPE, 1)),
        F.timestamp_seconds(F.unix_seconds(local) + days * 86400 - (hours * 3600 + minutes * 60)),
    )


def parse_time(token: Column) -> Column:
    """The local form, else the form with an offset, else null."""
    return F.coalesce(parse_local(token), parse_zoned(token))


def epoch_us(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone."""
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps, both cut to the second."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def monday_first(ts: Column) -> Column:
    """Day of week, Monday = 1."""
    return (F.weekday(ts) + 1).cast("int")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMM")


def day_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")
