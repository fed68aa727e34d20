"""Reduction of event tables to one row per day, and joins of day tables.

Each reduction is one aggregation that combines within a task before the
shuffle, so what is shuffled grows with days times tasks, not with events, and a
crowded day costs no more than a quiet one. The result is partitioned by day:
joining such tables by day needs no further shuffle. Rows without a day are left
out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.fixed_values import OTHERS
from daygrain.functions.calendar import day_in
from daygrain.functions.flags import flag_from_code


def _by_day(df: DataFrame, ts: str, where: Column | None, day: str):
    kept = df.filter(F.col(ts).isNotNull())
    if where is not None:
        kept = kept.filter(where)
    return kept.groupBy(day_in(df, ts).alias(day))


def daily_min_max_avg(
    df: DataFrame,
    ts: str,
    value: Column | str,
    where: Column | None = None,
    day: str = "date",
    names: tuple[str, str, str] = ("min_t", "max_t", "avg_t"),
) -> DataFrame:
    """Smallest, largest and mean value per day, over numbers."""
    low, high, mean = names
    return _by_day(df, ts, where, day).agg(
        F.min(value).alias(low), F.max(value).alias(high), F.avg(value).alias(mean)
    )


def daily_flags(
    df: DataFrame,
    ts: str,
    text: str,
    codes: Mapping[str, str],
    where: Column | None = None,
    match: str = "contains",
    day: str = "date",
    also: Sequence[Column] = (),
) -> DataFrame:
    """One boolean per flag and day: does any row of the day name the code?

    ``also`` takes further aggregates of the day.
    """
    flags = [F.bool_or(flag_from_code(text, code, match)).alias(f) for f, code in codes.items()]
    return _by_day(df, ts, where, day).agg(*also, *flags)


def daily_counts_and_sums(
    df: DataFrame,
    ts: str,
    cols: Sequence[str] | Mapping[str, str],
    count: str = "n",
    where: Column | None = None,
    day: str = "date",
) -> DataFrame:
    """Rows and column sums per day, in one pass.

    Sums are named ``<column>_sum``, or as the mapping says.
    """
    names = dict(cols) if isinstance(cols, Mapping) else {c: f"{c}_sum" for c in cols}
    sums = [F.sum(c).alias(name) for c, name in names.items()]
    return _by_day(df, ts, where, day).agg(F.count(F.lit(1)).alias(count), *sums)


def counts_join_sums(
    df: DataFrame, ts: str, cols: Sequence[str], count: str = "n", day: str = "date"
) -> DataFrame:
    """The same as two aggregates joined by day; prefer :func:`daily_counts_and_sums`."""
    counts = _by_day(df, ts, None, day).agg(F.count(F.lit(1)).alias(count))
    sums = _by_day(df, ts, None, day).agg(*[F.sum(c).alias(f"{c}_sum") for c in cols])
    return counts.join(sums, day)


def daily_sums_by_group(
    df: DataFrame,
    ts: str,
    group: str,
    measure: str,
    names: Mapping[str, str],
    day: str = "date",
    others: str | None = OTHERS,
) -> DataFrame:
    """One column per group value with its sum of the day; null where the day lacks the group.

    ``others`` names a column for the sum over all other groups and rows without
    one; None is for lists that are known to be complete. Sums under a condition
    need one shuffle, where a pivot needs two.
    """
    if others in names.values():
        raise ValueError(f"a listed group is called {others!r}: name the column for the others")
    sums = [
        F.sum(F.when(F.col(group) == value, F.col(measure))).alias(name)
        for value, name in names.items()
    ]
    if others is not None:
        listed = F.coalesce(F.col(group).isin(list(names)), F.lit(False))
        sums.append(F.sum(F.when(~listed, F.col(measure))).alias(others))
    return _by_day(df, ts, None, day).agg(*sums)


def join_on(frames: Sequence[DataFrame], key: str = "date") -> DataFrame:
    """Inner join of all frames, with one key column; a key missing from one frame drops out."""
    return reduce(lambda left, right: left.join(right, key), frames)
