"""Row selections: date ranges, report types, and station series."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.fixed_values import LABELS
from daygrain.functions.calendar import days_between, month_of, week_bounds
from daygrain.functions.text import recode


def date_range(df: DataFrame, day: str, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Rows of the days from first to last, both included."""
    return df.filter(days_between(day, first, last))


def split_by_value(
    df: DataFrame, column: str, parts: Mapping[str, tuple[str, Sequence[str]]]
) -> dict[str, DataFrame]:
    """Several selections of one frame: name -> (value of the column, columns to keep)."""
    return {
        name: df.filter(F.col(column) == value).select(*keep)
        for name, (value, keep) in parts.items()
    }


def labelled_parts(
    df: DataFrame, column: str, labels: Mapping[str, str], name: str
) -> DataFrame:
    """The rows of several selections in one frame: value of the column -> label of the part.

    One scan for all parts, where a union of :func:`split_by_value` has one each.
    """
    return df.filter(F.col(column).isin(list(labels))).withColumn(name, recode(column, labels))


def station_series(
    df: DataFrame,
    first: dt.date | str,
    last: dt.date | str,
    measures: Sequence[str],
    ts: str = "ts",
    station: str = "station",
    stations: Sequence | None = None,
    where: Column | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Readings of the days from first to last, for all or for chosen stations.

    In time order if ``ordered``, which reads the selection once more to divide it.
    A table in folders by year and month opens only those of the period.
    """
    in_time = days_between(ts, first, last) & _in_folders(df, first, last)
    return _series(df, in_time, measures, ts, station, stations, where, ordered)


def week_series(df: DataFrame, day: dt.date | str, measures: Sequence[str], **options) -> DataFrame:
    """Readings of the Monday-to-Sunday week that holds the day."""
    first, last = week_bounds(day)
    return station_series(df, first, last, measures, **options)


def month_series(
    df: DataFrame,
    month: int,
    measures: Sequence[str],
    year: int | None = None,
    ts: str = "ts",
    station: str = "station",
    stations: Sequence | None = None,
    where: Column | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Readings of a month.

    Without a year, of that month in every year; with one, the selection is a
    range of instants that the file reader can use. A table in folders by year and
    month opens only those of the month.
    """
    if year is None:
        in_month = month_of(ts) == month
        if _has_folders(df):
            in_month &= F.col("month") == month
    else:
        first = dt.date(year, month, 1)
        last = dt.date(year, month, calendar.monthrange(year, month)[1])
        in_month = days_between(ts, first, last) & _in_folders(df, first, last)
    return _series(df, in_month, measures, ts, station, stations, where, ordered)


def measure_bounds(df: DataFrame, measure: str) -> DataFrame:
    """Smallest and largest value of a measure in a selection."""
    return df.agg(F.min(measure).alias("lowest"), F.max(measure).alias("highest"))


def with_labels(df: DataFrame, labels: Mapping[str, str] = LABELS) -> DataFrame:
    """Short column names -> the labels readers know."""
    return df.withColumnsRenamed({k: v for k, v in labels.items() if k in df.columns})


def _has_folders(df: DataFrame) -> bool:
    """Has the table the columns that folders by year and month give it?"""
    return {"year", "month"} <= {name for name, kind in df.dtypes if kind == "int"}


def _in_folders(df: DataFrame, first: dt.date | str, last: dt.date | str) -> Column:
    """The folders of the days from first to last, by year and month."""
    if not _has_folders(df):
        return F.lit(True)
    (y0, m0), (y1, m1) = ((int(str(d)[:4]), int(str(d)[5:7])) for d in (first, last))
    year, month = F.col("year"), F.col("month")
    after = (year > y0) | ((year == y0) & (month >= m0))
    before = (year < y1) | ((year == y1) & (month <= m1))
    return after & before


def _series(df, in_time, measures, ts, station, stations, where, ordered) -> DataFrame:
    kept = df.filter(in_time)
    if where is not None:
        kept = kept.filter(where)
    if stations is not None:
        kept = kept.filter(F.col(station).isin(list(stations)))
    picked = kept.select(station, ts, *measures)
    # Sorting by the measures too keeps many readings of one instant from meeting in one task.
    return picked.orderBy(ts, station, *measures) if ordered else picked
