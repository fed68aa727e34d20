"""Station reports -> clean hourly table, day temperatures and conditions, codes, series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain import fixed_values as V
from daygrain.functions import coerce_number, describe_code, flag_from_code, recode
from daygrain.operators import (
    code_day_grid,
    daily_flags,
    daily_min_max_avg,
    month_series,
    split_by_value,
    station_series,
    token_vocabulary,
    value_counts,
    week_series,
)

SERIES_MEASURES = ["dry_bulb_temperature", "relative_humidity", "precipitation"]
_HOURLY_HIDDEN = {"station", "report_type", "daily_weather", "sunrise", "sunset"}


def _is_report(kind: str) -> Column:
    return F.col("report_type") == kind


def _at(station: str | None) -> Column:
    return F.lit(True) if station is None else F.col("station") == station


def report_split(raw: DataFrame, station: str = V.STATION_CENTRAL_PARK) -> dict[str, DataFrame]:
    """One station's hourly, special and summary-of-day reports, each with its own columns."""
    hourly = [c for c in raw.columns if c not in _HOURLY_HIDDEN]
    summary = ["ts", "source", "daily_weather", "sunrise", "sunset"]
    return split_by_value(
        raw.filter(_at(station)),
        "report_type",
        {
            "hourly": (V.REPORT_HOURLY, hourly),
            "special": (V.REPORT_SPECIAL, hourly),
            "summary": (V.REPORT_SUMMARY_OF_DAY, summary),
        },
    )


def daily_temperature(
    raw: DataFrame,
    station: str | None = V.STATION_CENTRAL_PARK,
    report: str = V.REPORT_HOURLY,
) -> DataFrame:
    """date, min_t, max_t, avg_t from the hourly reports of a station, compared as numbers."""
    return daily_min_max_avg(
        raw,
        "ts",
        coerce_number("dry_bulb_temperature"),
        where=_at(station) & _is_report(report),
    )


def daily_conditions(
    raw: DataFrame,
    station: str | None = V.STATION_CENTRAL_PARK,
    codes: Mapping[str, str] = V.CONDITION_CODES,
    match: str = "contains",
) -> DataFrame:
    """date, sunrise, sunset and a boolean per condition from the summary-of-day reports.

    A day with several summaries is one row: a condition holds if one of them names it.
    """
    return daily_flags(
        raw,
        "ts",
        "daily_weather",
        codes,
        where=_at(station) & _is_report(V.REPORT_SUMMARY_OF_DAY),
        match=match,
        also=[F.min("sunrise").alias("sunrise"), F.max("sunset").alias("sunset")],
    )


TEMPERATURE = ["min_t", "max_t", "avg_t"]


def weather_days(
    raw: DataFrame,
    station: str | None = V.STATION_CENTRAL_PARK,
    codes: Mapping[str, str] = V.CONDITION_CODES,
    match: str = "contains",
) -> DataFrame:
    """Temperatures and conditions of every day, from one pass over the reports.

    ``has_hourly`` and ``has_summary`` tell which of the two a day has: filtered by
    them, these are the rows of :func:`daily_temperature` and
    :func:`daily_conditions`, without reading and shuffling the reports twice.
    """
    return with_mean(partial_days(raw, station, codes, match))


def partial_days(
    raw: DataFrame,
    station: str | None = V.STATION_CENTRAL_PARK,
    codes: Mapping[str, str] = V.CONDITION_CODES,
    match: str = "contains",
) -> DataFrame:
    """:func:`weather_days` with sum and number of the temperatures instead of their mean.

    Rows of one day from different files combine: sums and numbers add up, flags and bounds do as well.
    """
    hourly, summary = _is_report(V.REPORT_HOURLY), _is_report(V.REPORT_SUMMARY_OF_DAY)
    temperature = F.when(hourly, coerce_number("dry_bulb_temperature"))
    flags = [
        F.bool_or(summary & flag_from_code("daily_weather", code, match)).alias(flag)
        for flag, code in codes.items()
    ]
    return (
        raw.filter(F.col("ts").isNotNull() & _at(station) & (hourly | summary))
        .groupBy(F.to_date("ts").alias("date"))
        .agg(
            F.min(temperature).alias("min_t"),
            F.max(temperature).alias("max_t"),
            F.sum(temperature).alias("sum_t"),
            F.count(temperature).alias("n_t"),
            F.min(F.when(summary, F.col("sunrise"))).alias("sunrise"),
            F.max(F.when(summary, F.col("sunset"))).alias("sunset"),
            *flags,
            F.bool_or(hourly).alias("has_hourly"),
            F.bool_or(summary).alias("has_summary"),
        )
    )


def with_mean(partial: DataFrame) -> DataFrame:
    """The mean in place of sum and number."""
    mean = F.try_divide(F.col("sum_t"), F.col("n_t")).alias("avg_t")
    kept = [c for c in partial.columns if c not in ("sum_t", "n_t")]
    at = kept.index("max_t") + 1
    return partial.select(*kept[:at], mean, *kept[at:])


def temperature_of(days: DataFrame) -> DataFrame:
    """The days of :func:`weather_days` with hourly reports, and their temperatures."""
    return days.filter("has_hourly").select("date", *TEMPERATURE)


def conditions_of(days: DataFrame) -> DataFrame:
    """The days of :func:`weather_days` with a summary, and their conditions."""
    return days.filter("has_summary").drop(*TEMPERATURE, "has_hourly", "has_summary")


def both_of(days: DataFrame) -> DataFrame:
    """The days of :func:`weather_days` with both."""
    return days.filter("has_hourly AND has_summary").drop("has_hourly", "has_summary")


def daily_weather(
    raw: DataFrame,
    station: str | None = V.STATION_CENTRAL_PARK,
    codes: Mapping[str, str] = V.CONDITION_CODES,
    match: str = "contains",
) -> DataFrame:
    """Temperatures and conditions of the days that have both, from one pass over the reports."""
    return both_of(weather_days(raw, station, codes, match))


def code_vocabulary(raw: DataFrame, station: str | None = V.STATION_CENTRAL_PARK) -> DataFrame:
    """The distinct weather codes with their descriptions."""
    codes = token_vocabulary(raw.filter(_at(station)), "daily_weather", sep=None, name="code")
    return codes.withColumn("description", describe_code("code", V.WEATHER_CODES))


def report_counts(raw: DataFrame) -> DataFrame:
    return value_counts(raw, "report_type")


def clean_hourly(raw: DataFrame, names: Mapping[str, str] = V.STATION_NAMES) -> DataFrame:
    """Measures as numbers, trace precipitation as zero, station numbers as names."""
    return raw.withColumns(
        {
            "station": recode("station", names),
            "dry_bulb_temperature": coerce_number("dry_bulb_temperature"),
            "relative_humidity": coerce_number("relative_humidity"),
            "precipitation": coerce_number("precipitation", {V.TRACE_MARK: V.TRACE_VALUE}),
        }
    )


def day_series(
    clean: DataFrame, day: dt.date | str, measures=SERIES_MEASURES, ordered: bool = False
) -> DataFrame:
    where = _is_report(V.REPORT_HOURLY)
    return station_series(clean, day, day, measures, where=where, ordered=ordered)


def weekly_series(
    clean: DataFrame, day: dt.date | str, measures=SERIES_MEASURES, ordered: bool = False
) -> DataFrame:
    """The Monday-to-Sunday week that holds the day."""
    return week_series(clean, day, measures, where=_is_report(V.REPORT_HOURLY), ordered=ordered)


def monthly_series(
    clean: DataFrame,
    month: int,
    stations: Sequence[str] = tuple(V.STATION_NAMES.values()),
    year: int | None = None,
    measures: Sequence[str] = SERIES_MEASURES,
) -> DataFrame:
    where = _is_report(V.REPORT_HOURLY)
    return month_series(clean, month, measures, year=year, stations=stations, where=where)


def code_calendar(
    raw: DataFrame,
    first: dt.date | str = V.FIRST_DAY,
    last: dt.date | str = V.LAST_DAY,
    codes: Mapping[str, str] = V.WEATHER_CODES,
    station: str | None = None,
) -> DataFrame:
    """Per code and day of the period, whether any report names the code; all stations by default."""
    where = None if station is None else _at(station)
    grid = code_day_grid(raw, "ts", "daily_weather", list(codes), first, last, where=where)
    return grid.withColumn("description", describe_code("code", codes))
