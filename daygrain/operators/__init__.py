"""Operators from DataFrame to DataFrame, independent of any data set."""

from daygrain.operators.bitmaps import (
    bitmap_calendar,
    co_occurring_days,
    day_bitmaps,
    days_of,
    days_with_all,
    days_with_any,
    merge_bitmaps,
)
from daygrain.operators.calendar import by_season, by_weekday, counts_by_hour, mean_daily_by_month
from daygrain.operators.conditions import count_flags, impact_by_condition, mean_std, mean_std_by_flag
from daygrain.operators.correlation import corr_long, corr_matrix
from daygrain.operators.days import (
    counts_join_sums,
    daily_counts_and_sums,
    daily_flags,
    daily_min_max_avg,
    daily_sums_by_group,
    join_on,
)
from daygrain.operators.domains import code_day_grid, complete_domain, day_spine, literal_domain
from daygrain.operators.grains import counts_by_grains, grain_of
from daygrain.operators.groups import (
    mean_of_groups,
    monthly_means,
    stack_columns,
    token_vocabulary,
    top_k,
    top_k_with_others,
    value_counts,
    wide_counts,
)
from daygrain.operators.heavy import heavy_hitters
from daygrain.operators.moments import (
    corr_from_moments,
    merge_moments,
    moment_state,
    ols_from_moments,
    ols_models,
    pair_models,
    spread_from_moments,
)
from daygrain.operators.regression import (
    assemble,
    fit_ols,
    holdout_predictions,
    in_training,
    ols_report,
    random_split,
    split_by_day,
)
from daygrain.operators.selections import (
    date_range,
    labelled_parts,
    measure_bounds,
    month_series,
    split_by_value,
    station_series,
    week_series,
    with_labels,
)

__all__ = [
    "assemble", "bitmap_calendar", "by_season", "by_weekday", "co_occurring_days", "code_day_grid", "complete_domain", "corr_long",
    "corr_from_moments", "corr_matrix", "count_flags", "counts_by_grains", "counts_by_hour", "counts_join_sums", "daily_counts_and_sums",
    "daily_flags", "daily_min_max_avg", "daily_sums_by_group", "date_range", "day_bitmaps", "day_spine", "days_of", "days_with_all", "days_with_any",
    "fit_ols", "grain_of", "heavy_hitters", "holdout_predictions", "impact_by_condition", "in_training", "join_on", "labelled_parts", "literal_domain",
    "mean_daily_by_month", "mean_of_groups", "mean_std", "mean_std_by_flag", "measure_bounds", "merge_bitmaps", "merge_moments", "moment_state",
    "month_series", "monthly_means", "ols_from_moments", "ols_models", "ols_report", "pair_models", "random_split", "split_by_day",
    "split_by_value", "spread_from_moments", "stack_columns", "station_series", "token_vocabulary", "top_k",
    "top_k_with_others", "value_counts", "week_series", "wide_counts", "with_labels",
]
