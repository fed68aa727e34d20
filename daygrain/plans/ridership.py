"""Daily transit counts -> the studied year, monthly profile, shares, use in rain and snow."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain import fixed_values as V
from daygrain.functions import share
from daygrain.operators import date_range, mean_of_groups, mean_std_by_flag, monthly_means


def clean(
    raw: DataFrame, first: dt.date | str = V.FIRST_DAY, last: dt.date | str = V.LAST_DAY
) -> DataFrame:
    """Days from first to last, both included; days without a readable date are left out."""
    return date_range(raw, "date", first, last)


def monthly_profile(cleaned: DataFrame, modes: Sequence[str] = tuple(V.PROFILE_MODES)) -> DataFrame:
    return monthly_means(cleaned, "date", modes).orderBy("month")


def daily_shares(cleaned: DataFrame, modes: Sequence[str] = tuple(V.SHARE_MODES)) -> DataFrame:
    """Percentage of each mode in the day's total of these modes."""
    return cleaned.select("date", *[share(m, modes).alias(m) for m in modes])


def mean_shares(cleaned: DataFrame, modes: Sequence[str] = tuple(V.SHARE_MODES)) -> DataFrame:
    """Mean over the months of each month's mean share."""
    monthly = monthly_means(daily_shares(cleaned, modes), "date", modes)
    return mean_of_groups(monthly, modes, "mode", "percent")


def two_modes(cleaned: DataFrame, first: str = "sub", second: str = "bus") -> DataFrame:
    return cleaned.select("date", first, second).orderBy("date")


def spread_by_weather(
    cleaned: DataFrame, conditions: DataFrame, modes: Sequence[str] = tuple(V.SPREAD_MODES)
) -> DataFrame:
    """Mean and standard deviation of each mode by rain, by snow, and with neither.

    Days on both sides only. The three conditions and all modes are one pass.
    """
    weather = conditions.select(F.col("date").alias("date_only"), "rain", "snow")
    joined = cleaned.join(weather, cleaned["date"] == weather["date_only"])
    rain, snow = F.col("rain"), F.col("snow")
    flags = {"rain": rain, "snow": snow, "neither": ~rain & ~snow}
    spread = mean_std_by_flag(joined, flags, modes)
    return spread.filter((F.col("condition") != "neither") | F.col("value"))
