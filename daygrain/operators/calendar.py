"""Counts by month, weekday, season and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.fixed_values import SEASON_MONTHS, WEEKDAYS
from daygrain.functions.calendar import (
    hour_of_text,
    month_of,
    name_at,
    season_of_month,
    weekday_number,
)
from daygrain.operators.days import daily_counts_and_sums
from daygrain.operators.domains import complete_domain


def mean_daily_by_month(
    df: DataFrame, ts: str, name: str = "avg_daily", counted: str | None = None
) -> DataFrame:
    """Mean number of rows per day that has any, by month number.

    ``counted`` names the count column of a frame that has one row per day already.
    """
    daily = (
        df.select(F.col(ts).alias("date"), F.col(counted).alias("n")).filter(F.col(ts).isNotNull())
        if counted
        else daily_counts_and_sums(df, ts, [])
    )
    return daily.groupBy(month_of("date").alias("month")).agg(F.avg("n").alias(name)).orderBy("month")


def by_weekday(df: DataFrame, ts: str, count: str = "n", counted: str | None = None) -> DataFrame:
    """Rows per weekday, Monday first; null for a weekday without any.

    ``counted`` names a column with the number of rows that each row stands for.
    """
    counts = _counts(df, ts, weekday_number(ts), "__number", count, counted)
    named = counts.select(name_at("__number", WEEKDAYS).alias("weekday"), count)
    return complete_domain(named, "weekday", WEEKDAYS)


def by_season(df: DataFrame, ts: str, count: str = "n", counted: str | None = None) -> DataFrame:
    """Rows per season, winter first; null for a season without any.

    ``counted`` names a column with the number of rows that each row stands for.
    """
    counts = _counts(df, ts, month_of(ts), "__month", count, counted)
    named = counts.groupBy(season_of_month("__month").alias("season")).agg(
        F.sum(count).alias(count)
    )
    return complete_domain(named, "season", list(SEASON_MONTHS))


def counts_by_hour(
    df: DataFrame, time_text: str, count: str = "n", counted: str | None = None
) -> DataFrame:
    """Rows per hour of a time of day given as text.

    ``counted`` names a column with the number of rows that each row stands for.

    Equal texts are counted first, so that only the distinct ones, at most one
    per minute of the day, are parsed. Rows without a valid time are left out.
    """
    rows = F.sum(counted) if counted else F.count(F.lit(1))
    by_text = df.groupBy(time_text).agg(rows.alias("__n"))
    # Tied to the count, or the test for valid times would move below it and parse every row.
    hour = F.when(F.col("__n") > 0, hour_of_text(time_text))
    return (
        by_text.withColumn("hour", hour)
        .filter(F.col("hour").isNotNull())
        .groupBy("hour")
        .agg(F.sum("__n").alias(count))
        .orderBy("hour")
    )


def _counts(
    df: DataFrame, ts: str, number: Column, name: str, count: str, counted: str | None
) -> DataFrame:
    # Numbers, not names, are grouped: names follow on the few rows that are left.
    known = df.filter(F.col(ts).isNotNull())
    rows = F.sum(counted) if counted else F.count(F.lit(1))
    return known.groupBy(number.alias(name)).agg(rows.alias(count))
