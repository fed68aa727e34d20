"""Counts by value, top-k, wide counts, means of groups and vocabularies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.fixed_values import OTHERS
from daygrain.functions.calendar import year_month
from daygrain.functions.text import tokens


def value_counts(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Rows per value, most frequent first; rows without a value are left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(count))
        .orderBy(F.desc(count), column)
    )


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The k rows with the largest ``by``; equal ones in the order of ``tie``."""
    return df.orderBy(F.desc(by), tie).limit(k)


def stack_columns(
    df: DataFrame, cols: Sequence[str], value: str = "value", slot: str = "slot"
) -> DataFrame:
    """All the columns below one another; the table is read once."""
    return df.select(*cols).unpivot([], list(cols), slot, value)


def top_k_with_others(
    df: DataFrame, cols: Sequence[str], k: int, others: str = OTHERS, count: str = "n"
) -> DataFrame:
    """Counts of the k most frequent values over the columns, and one row for all the rest.

    A value that is itself called like the rest is counted there, so that name stands once.
    The rest is the total less the top k, so the counts take part only as they
    are: Spark reads the table once, shuffles the counts once and uses that
    shuffle for each part. The number of distinct values does not matter.
    """
    values = stack_columns(df, cols).filter(F.col("value").isNotNull())
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias(count))
    # left out after a limit, or the filter would move below the counts and count anew
    more = top_k(counts, count, k + 1, "value").filter(F.col("value") != others)
    top = top_k(more, count, k, "value")
    total = counts.agg(F.sum(count).alias(count))
    less = top.select((-F.col(count)).alias(count))
    rest = total.unionByName(less).agg(F.coalesce(F.sum(count), F.lit(0)).alias(count))
    return top.unionByName(rest.select(F.lit(others).alias("value"), count))


def wide_counts(
    df: DataFrame,
    key: Column | str,
    name: str,
    column: str | Column,
    values: Sequence | Mapping,
    others: str | None = OTHERS,
    counted: str | None = None,
) -> DataFrame:
    """One row per key, one column per value with its count; null where there is none.

    Rows without key or value are left out; ``others`` names a column for the
    values that are not listed, so that no row is lost. ``others=None`` is for
    lists that are known to be complete. Counts under a condition need one
    shuffle, where a pivot needs two. ``counted`` names a column with the number of
    rows that each row stands for.
    """
    names = dict(values) if isinstance(values, Mapping) else {v: str(v) for v in values}
    if others in names.values():
        raise ValueError(f"a listed value is called {others!r}: name the column for the others")
    rows = df.select(
        (F.col(key) if isinstance(key, str) else key).alias("__key"),
        (F.col(column) if isinstance(column, str) else column).alias("__value"),
        (F.col(counted) if counted else F.lit(1)).cast("bigint").alias("__rows"),
    ).filter(F.col("__key").isNotNull() & F.col("__value").isNotNull())
    def total(where: Column) -> Column:
        rows = F.sum(F.when(where, F.col("__rows"))) if counted else F.count_if(where)
        return F.nullif(rows, F.lit(0))

    counts = [total(F.col("__value") == v).alias(label) for v, label in names.items()]
    if others is not None:
        counts.append(total(~F.col("__value").isin(list(names))).alias(others))
    return rows.groupBy(F.col("__key").alias(name)).agg(*counts)


def monthly_means(df: DataFrame, day: str, cols: Sequence[str]) -> DataFrame:
    """Mean of each column per month, labelled year-month; empty values do not count."""
    month = year_month(F.trunc(day, "month"))
    return df.groupBy(month.alias("month")).agg(*[F.avg(c).alias(c) for c in cols])


def mean_of_groups(df: DataFrame, cols: Sequence[str], key: str, value: str) -> DataFrame:
    """Mean of each column over the rows, as (name, mean) rows."""
    means = df.agg(*[F.avg(c).alias(c) for c in cols])
    return means.unpivot([], list(cols), key, value)


def token_vocabulary(df: DataFrame, text: str, sep: str | None = " ", name: str = "token"):
    """The distinct tokens of a text column, without empty ones."""
    return (
        df.select(F.explode(tokens(text, sep)).alias(name)).filter(F.col(name) != "").distinct()
    )
