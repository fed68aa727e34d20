"""Pearson correlations of many column pairs in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def corr_long(
    df: DataFrame, xs: Sequence[str], ys: Sequence[str], nulls: str = "drop"
) -> DataFrame:
    """One row (x, y, r) per pair of columns.

    ``nulls="drop"`` leaves out, pair by pair, the rows where either side is
    unknown; ``"zero"`` counts an unknown value as 0. A constant side has no
    correlation: r is null.

    Every row is repeated per pair and the pairs are grouped: one scan and one
    shuffle of a few numbers per pair and task, in a plan whose size does not
    depend on the number of pairs. A single aggregation with an expression per
    pair has hundreds of buffers, too many for generated code.
    """
    if nulls not in ("drop", "zero"):
        raise ValueError(f"nulls must be 'drop' or 'zero', not {nulls!r}")

    def number(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.coalesce(value, F.lit(0.0)) if nulls == "zero" else value

    def entries(cols: Sequence[str]) -> Column:
        return F.array(
            *[F.struct(F.lit(c).alias("name"), number(c).alias("value")) for c in cols]
        )

    sides = df.select(entries(xs).alias("xs"), entries(ys).alias("ys"))
    pairs = sides.select(F.explode("xs").alias("x"), "ys").select("x", F.explode("ys").alias("y"))
    return pairs.groupBy(F.col("x.name").alias("x"), F.col("y.name").alias("y")).agg(
        _r(F.col("x.value"), F.col("y.value")).alias("r")
    )


def corr_matrix(corr: DataFrame, ys: Sequence[str]) -> DataFrame:
    """Wide form: one row per x, one column per y; a missing cell is 0."""
    cells = [
        F.coalesce(F.max(F.when(F.col("y") == y, F.col("r"))), F.lit(0.0)).alias(y)
        for y in sorted(ys)
    ]
    return corr.groupBy("x").agg(*cells).orderBy("x")


def _r(x: Column, y: Column) -> Column:
    # The built-in correlation fails on a constant column, even under a condition.
    x_paired = F.when(y.isNotNull(), x)
    y_paired = F.when(x.isNotNull(), y)
    spread = F.stddev_pop(x_paired) * F.stddev_pop(y_paired)
    return F.try_divide(F.covar_pop(x, y), spread)
