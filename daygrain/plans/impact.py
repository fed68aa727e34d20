"""Weather, collisions and ridership joined by day, and what follows from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain import fixed_values as V
from daygrain.functions import hhmm_to_minutes, steady_round
from daygrain.operators import (
    corr_long,
    holdout_predictions,
    impact_by_condition,
    join_on,
    moment_state,
    ols_from_moments,
    ols_models,
    ols_report,
)

IMPACT_SUMS = {
    "crash": "tt_crash",
    "ppl_i": "ppl_injured",
    "ppl_k": "ppl_killed",
    "sub": "sub_total",
    "bus": "bus_total",
}
IMPACT_RATES = {
    "ppl_injured_per_day": ("ppl_injured", 3),
    "ppl_killed_per_day": ("ppl_killed", 3),
    "crashes_per_day": ("tt_crash", 0),
    "sub_per_day": ("sub_total", 0),
    "bus_per_day": ("bus_total", 0),
}


def daily_features(*day_tables: DataFrame) -> DataFrame:
    """One row per day that all tables have.

    The mean temperature is rounded to one place. Sunrise and sunset stay clock
    readings (HHMM); ``sunrise_min`` and ``sunset_min`` are minutes after midnight.
    """
    joined = join_on(day_tables)
    return joined.withColumns(
        {
            "avg_t": steady_round("avg_t", 1),
            "sunrise_min": hhmm_to_minutes("sunrise"),
            "sunset_min": hhmm_to_minutes("sunset"),
        }
    )


def condition_impact(
    features: DataFrame, conditions: Sequence[str] = tuple(V.IMPACT_CONDITIONS)
) -> DataFrame:
    """Totals and daily rates of collisions, casualties and ridership per condition."""
    return impact_by_condition(features, list(conditions), "crash", IMPACT_SUMS, IMPACT_RATES)


def correlations(
    features: DataFrame,
    xs: Sequence[str] = tuple(V.WEATHER_MEASURES),
    ys: Sequence[str] = ("crash", *V.CASUALTIES, *V.TRANSIT_MODES),
    nulls: str = "drop",
) -> DataFrame:
    """Every weather measure against every outcome."""
    return corr_long(features, xs, ys, nulls)


def correlation_labels(corr: DataFrame) -> DataFrame:
    """The same with the labels readers know."""
    names = F.create_map(*[F.lit(x) for item in V.LABELS.items() for x in item])
    return corr.withColumns({c: F.coalesce(F.element_at(names, F.col(c)), c) for c in ("x", "y")})


def regression_report(
    features: DataFrame,
    terms: Sequence[str] = tuple(V.MODEL_FEATURES),
    labels: Sequence[str] = tuple(V.MODEL_LABELS),
    split: str = "day",
    seed: int = 0,
) -> DataFrame:
    """Least squares of collisions, injured and killed on temperature and transit use.

    Split by day, all models and scores follow from one aggregation; the random split fits row by row.
    """
    if split == "day":
        state = moment_state(features, ols_models(terms, labels))
        return ols_from_moments(state, list(terms), list(labels), seed=seed)
    return ols_report(features, list(terms), list(labels), split=split, seed=seed)


def regression_predictions(
    features: DataFrame,
    label: str,
    terms: Sequence[str] = tuple(V.MODEL_FEATURES),
    split: str = "day",
    seed: int = 0,
) -> DataFrame:
    """Label and prediction for the held-out days of one model of the report."""
    return holdout_predictions(features, list(terms), label, split=split, seed=seed)
