"""Dates, times of day, and their names."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.fixed_values import (
    COLLISION_TIME_PATTERN,
    MONTHS,
    SEASON_MONTHS,
    WEEKDAYS,
    YEAR_MONTH_PATTERN,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(ts: Column | str) -> Column:
    """The date part of a timestamp, a date or an ISO text; text that is no date becomes null."""
    return F.try_to_date(_col(ts))


def day_in(df: DataFrame, ts: str) -> Column:
    """:func:`day_of` a column of a frame; dates and timestamps need no check of a text."""
    return day_of(ts) if dict(df.dtypes).get(ts, "string") == "string" else F.to_date(ts)


def parse_date(text: Column | str, pattern: str) -> Column:
    """Text to date; text that does not fit the pattern becomes null."""
    return F.try_to_date(_col(text), pattern)


def parse_timestamp(text: Column | str, pattern: str) -> Column:
    """Text to a timestamp without zone; text that does not fit the pattern becomes null.

    The text is read as UTC and kept as that wall clock, so that a session in a
    zone with summer time neither shifts nor merges readings.
    """
    instant = F.try_to_timestamp(F.concat(_col(text), F.lit("Z")), F.lit(pattern + "X"))
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def days_between(ts: Column | str, first: dt.date | str, last: dt.date | str) -> Column:
    """Both days included.

    The test compares the raw column with two instants rather than its date part
    with two dates, so that the file reader can skip row groups.
    """
    start = _as_date(first)
    end = _as_date(last) + dt.timedelta(days=1)
    c = _col(ts)
    return (c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(end).cast("timestamp_ntz"))


def week_bounds(day: dt.date | str) -> tuple[dt.date, dt.date]:
    """Monday and Sunday of the week that holds the day."""
    d = _as_date(day)
    monday = d - dt.timedelta(days=d.weekday())
    return monday, monday + dt.timedelta(days=6)


def month_of(day: Column | str) -> Column:
    return F.month(_col(day))


def year_month(day: Column | str) -> Column:
    return F.date_format(_col(day), YEAR_MONTH_PATTERN)


def name_at(position: Column | str, names: Sequence[str]) -> Column:
    """The name at a position from 1; a lookup, which costs less per row than formatting."""
    return F.element_at(F.array(*map(F.lit, names)), _col(position))


def month_name(day: Column | str) -> Column:
    """Full month name."""
    return name_at(month_of(day), MONTHS)


def weekday_number(day: Column | str) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(_col(day)) + 1


def weekday_name(day: Column | str) -> Column:
    """Full weekday name."""
    return name_at(weekday_number(day), WEEKDAYS)


def season_of_month(month: Column | str) -> Column:
    """Season of a month number."""
    names = {m: name for name, months in SEASON_MONTHS.items() for m in months}
    return name_at(month, [names[m] for m in range(1, 13)])


def season(day: Column | str) -> Column:
    return season_of_month(month_of(day))


def hour_of_text(text: Column | str, pattern: str = COLLISION_TIME_PATTERN) -> Column:
    """Hour of a time of day given as text, such as ``0:05`` or ``23:59``; bad text is null."""
    return F.hour(parse_timestamp(text, pattern))


def hhmm_to_minutes(hhmm: Column | str) -> Column:
    """Clock reading written as the number HHMM -> minutes after midnight."""
    c = _col(hhmm).try_cast("int")
    return F.floor(c / 100).cast("int") * 60 + c % 100


def _as_date(day: dt.date | str) -> dt.date:
    if isinstance(day, str):
        return dt.date.fromisoformat(day)
    return day.date() if isinstance(day, dt.datetime) else day
