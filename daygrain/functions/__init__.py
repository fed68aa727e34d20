"""Column expressions; all are built-in Spark functions, so they stay in generated code."""

from daygrain.functions.calendar import (
    day_of,
    days_between,
    hhmm_to_minutes,
    hour_of_text,
    month_name,
    month_of,
    name_at,
    parse_date,
    parse_timestamp,
    season,
    season_of_month,
    week_bounds,
    weekday_name,
    weekday_number,
    year_month,
)
from daygrain.functions.flags import any_of, flag_from_code, severity
from daygrain.functions.numbers import coerce_number, rate, share, steady_round, total_of
from daygrain.functions.text import describe_code, normalise_text, recode, tokens

__all__ = [
    "any_of", "coerce_number", "day_of", "days_between", "describe_code", "flag_from_code",
    "hhmm_to_minutes", "hour_of_text", "month_name", "month_of", "name_at", "normalise_text",
    "parse_date", "parse_timestamp", "rate", "recode", "season", "season_of_month", "severity",
    "share", "steady_round", "tokens", "total_of", "week_bounds", "weekday_name",
    "weekday_number", "year_month",
]
