"""Outcomes under conditions.

Several conditions are compared in one pass: each row is repeated per condition
and grouped by (condition, value), instead of one grouping job per condition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from daygrain.functions.flags import any_of
from daygrain.functions.numbers import rate


def _per_condition(
    df: DataFrame, flags: Sequence[str] | Mapping[str, Column], measures: Sequence[str]
) -> DataFrame:
    named = flags if isinstance(flags, Mapping) else {f: F.col(f) for f in flags}
    picked = df.select(*measures, *[c.alias(f"__{f}") for f, c in named.items()])
    long = F.explode(
        F.array(
            *[F.struct(F.lit(f).alias("condition"), F.col(f"__{f}").alias("value")) for f in named]
        )
    )
    return picked.select(*measures, long.alias("__c")).select(*measures, "__c.condition", "__c.value")


def impact_by_condition(
    df: DataFrame,
    flags: Sequence[str] | Mapping[str, Column],
    count: str,
    sums: Mapping[str, str],
    rates: Mapping[str, tuple[str, int]],
) -> DataFrame:
    """Totals and daily rates per condition and value.

    ``days`` counts the rows where ``count`` is known; ``sums`` maps a column to
    the name of its total; ``rates`` maps a name to (total, decimal places).
    """
    columns = list(dict.fromkeys([count, *sums]))
    totals = (
        _per_condition(df, flags, columns)
        .groupBy("condition", "value")
        .agg(F.count(count).alias("days"), *[F.sum(c).alias(name) for c, name in sums.items()])
    )
    whole = {f.name for f in totals.schema if isinstance(f.dataType, IntegralType)}
    per_day = {
        name: rate(total, "days", places, whole=total in whole)
        for name, (total, places) in rates.items()
    }
    return totals.withColumns(per_day)


def mean_std_by_flag(
    df: DataFrame, flags: Sequence[str] | Mapping[str, Column], measures: Sequence[str]
) -> DataFrame:
    """Mean and sample standard deviation per condition, value and measure."""
    grouped = _per_condition(df, flags, measures).groupBy("condition", "value")
    return _long(grouped.agg(*_mean_std(measures)), ["condition", "value"], measures)


def mean_std(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation of each measure over all rows."""
    return _long(df.agg(*_mean_std(measures)), [], measures)


def count_flags(
    df: DataFrame,
    flags: Mapping[str, Sequence[Column]],
    none: str,
    name: str = "party",
    count: str = "n",
    counted: str | None = None,
) -> DataFrame:
    """Rows for which each flag holds, and rows for which none does.

    A flag holds if one of its conditions does; a row may count under several.
    ``counted`` names a column with the number of rows that each row stands for.
    """
    hits = {flag: any_of(conditions) for flag, conditions in flags.items()}

    def total(where: Column) -> Column:
        if not counted:
            return F.count_if(where)
        return F.coalesce(F.sum(F.when(where, F.col("__rows"))), F.lit(0).cast("bigint"))

    rows = [F.col(counted).cast("bigint").alias("__rows")] if counted else []
    one_row = df.select(*[c.alias(flag) for flag, c in hits.items()], *rows).agg(
        *[total(F.col(flag)).alias(flag) for flag in hits],
        total(~any_of([F.col(flag) for flag in hits])).alias(none),
    )
    return one_row.unpivot([], [*hits, none], name, count)


def _mean_std(measures):
    for m in measures:
        yield F.avg(m).alias(f"{m}_mean")
        yield F.stddev_samp(m).alias(f"{m}_stddev")


def _long(wide: DataFrame, keys: list[str], measures: Sequence[str]) -> DataFrame:
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(m).alias("measure"),
                    F.col(f"{m}_mean").alias("mean"),
                    F.col(f"{m}_stddev").alias("stddev"),
                )
                for m in measures
            ]
        )
    )
    return wide.select(*keys, rows)
