"""The most frequent values, named by a summary and counted exactly, without shuffling every value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.fixed_values import OTHERS
from daygrain.operators.groups import stack_columns, top_k, top_k_with_others
from daygrain.sources.sinks import written

#: Values that the summary of a task tracks.
TRACKED = 10_000


def heavy_hitters(
    df: DataFrame,
    cols: Sequence[str],
    k: int,
    others: str = OTHERS,
    count: str = "n",
    tracked: int = TRACKED,
) -> DataFrame:
    """As :func:`daygrain.operators.top_k_with_others`, for columns of very many values.

    A mergeable summary of ``tracked`` values a task names candidates; a second scan counts these exactly, and all
    other rows together. What is shuffled is bounded by ``tracked`` for each task, however many values there are.

    A value that is no candidate occurs in at most 8 of ``tracked`` parts of the rows. If the k-th candidate is not
    above that, the candidates prove nothing and all values are counted instead; so the result is exact always.
    """
    values = stack_columns(df, cols).filter(F.col("value").isNotNull())
    summary = values.agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(value, {tracked}, {tracked})").alias("items")
    )
    found = summary.select("rows", F.explode_outer("items.item").alias("value"))
    found = written(found, "candidates")  # at most ``tracked`` rows
    rows = found.agg(F.max("rows")).first()[0] or 0
    candidates = found.filter("value IS NOT NULL").select(F.col("value").alias("candidate"))
    counted = values.join(F.broadcast(candidates), F.col("value") == F.col("candidate"), "left")
    counts = written(counted.groupBy("candidate").agg(F.count(F.lit(1)).alias(count)), "recount")
    best = top_k(counts.filter(F.col("candidate").isNotNull() & (F.col("candidate") != others)), count, k, "candidate")
    least = best.agg(F.min(count), F.count(F.lit(1))).first()
    unnamed = counts.filter("candidate IS NULL").first()
    if unnamed is not None and (least[1] < k or least[0] * tracked <= 8 * rows):
        return top_k_with_others(df, cols, k, others, count)
    top = best.withColumnRenamed("candidate", "value")
    total = counts.agg(F.sum(count).alias(count))
    rest = total.unionByName(top.select((-F.col(count)).alias(count))).agg(F.coalesce(F.sum(count), F.lit(0)).alias(count))
    return top.unionByName(rest.select(F.lit(others).alias("value"), count))
