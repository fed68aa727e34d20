"""Collision records -> clean table, day table, and the calendar and distribution profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain import fixed_values as V
from daygrain.functions import any_of, month_of, name_at, normalise_text, severity
from daygrain.operators import (
    by_season,
    by_weekday,
    complete_domain,
    count_flags,
    counts_by_grains,
    counts_by_hour,
    daily_counts_and_sums,
    grain_of,
    mean_daily_by_month,
    top_k,
    top_k_with_others,
    wide_counts,
)

VEHICLES = [f"vehicle_{i}" for i in range(1, 6)]


def clean(raw: DataFrame) -> DataFrame:
    """Borough names trimmed and in capitals; dates are typed by the reader."""
    return raw.withColumn("borough", normalise_text("borough"))


def daily(cleaned: DataFrame) -> DataFrame:
    """date, number of collisions and sums of the eight casualty counts."""
    return daily_counts_and_sums(
        cleaned, "crash_date", {c: c for c in V.CASUALTIES}, count="crash"
    )


def worst_days(days: DataFrame, k: int = 20) -> DataFrame:
    """The days of :func:`daily` with most collisions."""
    return top_k(days.select("date", "crash"), "crash", k, "date")


def mean_by_month(days: DataFrame) -> DataFrame:
    """Mean daily number of collisions by month, from the day table."""
    return mean_daily_by_month(days, "date", counted="crash")


def per_weekday(days: DataFrame) -> DataFrame:
    """Collisions per weekday, from the day table."""
    return by_weekday(days, "date", "crash", counted="crash")


def per_season(days: DataFrame) -> DataFrame:
    """Collisions per season, from the day table."""
    return by_season(days, "date", "crash", counted="crash")


def profile(cleaned: DataFrame) -> DataFrame:
    """Collisions by time of day, by month and severity, by day and borough, and by who was hurt, from one scan.

    The functions below take it instead of the collisions; it has a row for each combination that occurs.
    """
    return counts_by_grains(
        cleaned,
        {
            "time": {"crash_time": F.col("crash_time")},
            "severity": {"month": month_of("crash_date"), "severity": _severity()},
            "borough": {"crash_date": F.col("crash_date"), "borough": F.col("borough")},
            "party": {flag: any_of(hurt) for flag, hurt in _parties().items()},
        },
    )


def _severity() -> Column:
    return severity([F.col("ppl_i") > 0, F.col("ppl_k") > 0])


def _parties() -> dict[str, list[Column]]:
    names = {"Pedestrian": "ped", "Cyclist": "cyc", "Motorist": "mot"}
    return {name: [F.col(f"{p}_i") > 0, F.col(f"{p}_k") > 0] for name, p in names.items()}


def _grain(cleaned: DataFrame, grain: str) -> tuple[DataFrame, str | None]:
    """A grain of a profile and its count column, or the collisions themselves."""
    if "grain" in cleaned.columns:
        return grain_of(cleaned, grain), "n"
    return cleaned, None


def per_hour(cleaned: DataFrame) -> DataFrame:
    """Collisions by hour, from the collisions or their :func:`profile`."""
    rows, counted = _grain(cleaned, "time")
    return counts_by_hour(rows, "crash_time", "crash", counted)


def severity_by_month(cleaned: DataFrame) -> DataFrame:
    """One row per month of the year, a column per severity class; from the collisions or their :func:`profile`."""
    rows, counted = _grain(cleaned, "severity")
    counts = wide_counts(
        rows,
        F.col("month") if counted else month_of("crash_date"),
        "number",
        F.col("severity") if counted else _severity(),
        [V.SEVERE, V.NOT_SEVERE],
        others=None,  # a collision is one or the other
        counted=counted,
    )
    named = counts.withColumn("month", name_at("number", V.MONTHS)).drop("number")
    return complete_domain(named, "month", V.MONTHS)


def per_day_and_borough(
    cleaned: DataFrame,
    boroughs: Sequence[str] = tuple(V.BOROUGHS),
    others: str | None = V.OTHERS,
) -> DataFrame:
    """One row per day, a column per borough; collisions without a borough are left out.

    ``others`` names a column for boroughs that are not listed. From the collisions or their :func:`profile`.
    """
    rows, counted = _grain(cleaned, "borough")
    return wide_counts(rows, "crash_date", "date", "borough", list(boroughs), others, counted)


def vehicle_types(cleaned: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent vehicle types over the five slots, and all others together."""
    return top_k_with_others(cleaned, VEHICLES, k)


def involved_parties(cleaned: DataFrame) -> DataFrame:
    """Collisions that hurt pedestrians, cyclists or motorists, and those that hurt nobody.

    From the collisions or their :func:`profile`.
    """
    rows, counted = _grain(cleaned, "party")
    parties = {name: [F.col(name)] for name in _parties()} if counted else _parties()
    return count_flags(rows, parties, none=V.NO_PARTY, counted=counted)
