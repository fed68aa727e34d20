"""Complete domains: results that keep a row for every value, met or not."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions.calendar import day_in, days_between
from daygrain.functions.text import tokens


def literal_domain(
    spark: SparkSession, values: Sequence, key: str = "key", order: str = "ord"
) -> DataFrame:
    """The values as rows, with their position from 1."""
    return spark.range(0, 1, 1, 1).select(
        F.posexplode(F.array(*map(F.lit, values))).alias("p", key)
    ).select(F.col(key), (F.col("p") + 1).alias(order))


def complete_domain(
    df: DataFrame, key: str, values: Sequence, order: str = "ord"
) -> DataFrame:
    """One row per value in the given order; null where the frame has none."""
    domain = literal_domain(df.sparkSession, values, key, order)
    return domain.join(df, key, "left").orderBy(order)


def day_spine(
    spark: SparkSession, first: dt.date | str, last: dt.date | str, day: str = "date"
) -> DataFrame:
    """Every day from first to last, both included."""
    bounds = [F.lit(d).cast("date") for d in (first, last)]
    return spark.range(0, 1, 1, 1).select(F.explode(F.sequence(*bounds)).alias(day))


def code_day_grid(
    df: DataFrame,
    ts: str,
    text: str,
    codes: Sequence[str],
    first: dt.date | str,
    last: dt.date | str,
    where: Column | None = None,
) -> DataFrame:
    """Per code and day, 1 if a row of the day names the code as a word, else 0.

    The grid has every code and every day. A code outside the list appears only
    on the days that name it. The zeros are rows like the readings, so the grid
    is filled by the one aggregation and needs no join.
    """
    kept = df.filter(days_between(ts, first, last) & F.col(text).isNotNull())
    if where is not None:
        kept = kept.filter(where)
    hits = kept.select(
        F.explode(tokens(text, None)).alias("code"),
        day_in(df, ts).alias("date"),
        F.lit(1).alias("present"),
    ).filter(F.col("code") != "")
    empty = day_spine(df.sparkSession, first, last).select(
        F.explode(F.array(*map(F.lit, codes))).alias("code"), "date", F.lit(0).alias("present")
    )
    return empty.unionByName(hits).groupBy("code", "date").agg(F.max("present").alias("present"))
