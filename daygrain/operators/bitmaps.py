"""Days as bitmaps: one row of bits per code instead of a row per code and day.

Day numbers are counted from 1970 and cut into buckets of 32,768, so one bitmap of 4,096 bytes covers some 89 years.
Bitmaps of different rows, files or loads are combined by or, and sets of days are compared by bit operations.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions.calendar import day_in
from daygrain.functions.text import tokens
from daygrain.operators.domains import day_spine


def _number(day: Column) -> Column:
    """1 for 1970-01-01; bit positions of Spark's bitmaps begin with it."""
    return (F.unix_date(day) + 1).cast("bigint")


def day_bitmaps(
    df: DataFrame, ts: str, text: str, where: Column | None = None, sep: str | None = None, code: str = "code"
) -> DataFrame:
    """``code, bucket, days``: the days on which a row names the code as a word, one bitmap per code and bucket.

    Tasks combine their own bits first, so what is shuffled is codes times tasks, not rows. Rows without a day
    or text are left out.
    """
    kept = df.filter(F.col(ts).isNotNull() & F.col(text).isNotNull())
    if where is not None:
        kept = kept.filter(where)
    hits = kept.select(F.explode(tokens(text, sep)).alias(code), _number(day_in(df, ts)).alias("number"))
    return (
        hits.filter((F.col(code) != "") & F.col("number").isNotNull())
        .groupBy(code, F.bitmap_bucket_number("number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("days"))
    )


def merge_bitmaps(bitmaps: DataFrame, code: str = "code") -> DataFrame:
    """Bitmaps of the same code and bucket from several loads as one."""
    return bitmaps.groupBy(code, "bucket").agg(F.bitmap_or_agg("days").alias("days"))


def days_with_any(bitmaps: DataFrame, codes: Sequence[str] | None = None, code: str = "code") -> DataFrame:
    """``bucket, days``: days on which one of the codes is named."""
    kept = bitmaps if codes is None else bitmaps.filter(F.col(code).isin(list(codes)))
    return kept.groupBy("bucket").agg(F.bitmap_or_agg("days").alias("days"))


def days_with_all(bitmaps: DataFrame, codes: Sequence[str], code: str = "code") -> DataFrame:
    """``bucket, days``: days on which all of the codes are named."""
    codes = list(dict.fromkeys(codes))
    kept = merge_bitmaps(bitmaps.filter(F.col(code).isin(codes)), code)
    both = kept.groupBy("bucket").agg(F.bitmap_and_agg("days").alias("days"), F.count(F.lit(1)).alias("n"))
    return both.filter(F.col("n") == len(codes)).drop("n")


def co_occurring_days(bitmaps: DataFrame, codes: Sequence[str], code: str = "code") -> DataFrame:
    """``code_1, code_2, days``: number of days that name both, for each pair of the listed codes that shares one.

    Pairs are of codes, so their number does not grow with the rows.
    """
    listed = merge_bitmaps(bitmaps.filter(F.col(code).isin(list(codes))), code)
    one = listed.select(F.col(code).alias("code_1"), "bucket", F.col("days").alias("days_1"))
    two = listed.select(F.col(code).alias("code_2"), "bucket", F.col("days").alias("days_2"))
    pairs = one.join(two, "bucket").filter("code_1 < code_2")
    sides = pairs.select("code_1", "code_2", "bucket", F.explode(F.array("days_1", "days_2")).alias("days"))
    both = sides.groupBy("code_1", "code_2", "bucket").agg(F.bitmap_and_agg("days").alias("days"))
    counts = both.groupBy("code_1", "code_2").agg(F.sum(F.bitmap_count("days")).alias("days"))
    return counts.filter("days > 0")


def _bit(days: Column, number: Column) -> Column:
    """Whether the bitmap has the bit of a day number of its bucket."""
    position = F.bitmap_bit_position(number).cast("int")
    byte = F.conv(F.hex(F.substring(days, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, position % 8) == 1


def bitmap_calendar(
    bitmaps: DataFrame, codes: Sequence[str], first: dt.date | str, last: dt.date | str, code: str = "code"
) -> DataFrame:
    """``code, date, present``: 1 or 0 for each day of the period and each listed code."""
    days = day_spine(bitmaps.sparkSession, first, last)
    grid = days.select(F.explode(F.array(*map(F.lit, codes))).alias(code), "date")
    number = _number(F.col("date"))
    listed = merge_bitmaps(bitmaps.filter(F.col(code).isin(list(codes))), code)
    found = grid.withColumn("bucket", F.bitmap_bucket_number(number)).join(listed, [code, "bucket"], "left")
    present = F.coalesce(_bit(F.col("days"), number), F.lit(False)).cast("int")
    return found.select(code, "date", present.alias("present"))


def days_of(bitmap: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """The dates of the period that a ``bucket, days`` table has."""
    days = day_spine(bitmap.sparkSession, first, last)
    number = _number(F.col("date"))
    found = days.withColumn("bucket", F.bitmap_bucket_number(number)).join(bitmap, "bucket")
    return found.filter(_bit(F.col("days"), number)).select("date")
