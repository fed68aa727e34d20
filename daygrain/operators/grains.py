"""Counts of one table at several grains, from one scan and one shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_by_grains(
    df: DataFrame, grains: Mapping[str, Mapping[str, Column]], count: str = "n"
) -> DataFrame:
    """``grain``, the keys of all grains, and the number of rows: a row for each combination of each grain's keys.

    ``grains`` names the key columns of every grain; keys of other grains are null. Grouping sets repeat a row once
    for each grain inside its task, where equal ones are combined before the shuffle, so what is shuffled follows the
    combinations that occur. The result is small beside the events: write it once, and take every grain with
    :func:`grain_of`.
    """
    names = {f"{g}__{k}": (g, k) for g, keys in grains.items() for k in keys}
    rows = df.select(*[grains[g][k].alias(name) for name, (g, k) in names.items()])
    sets = [[name for name, (owner, _) in names.items() if owner == g] for g in grains]
    counted = rows.groupingSets(sets, *names).agg(
        F.grouping_id(*names).alias("__id"), F.count(F.lit(1)).alias(count)
    )
    # a bit of the id is set for a key that does not take part, the first key in the highest bit
    ids = {}
    for g, keys in zip(grains, sets, strict=True):
        ids[sum(1 << (len(names) - 1 - i) for i, name in enumerate(names) if name not in keys)] = g
    grain = F.create_map(*[F.lit(v) for pair in ids.items() for v in pair])
    return counted.select(
        F.element_at(grain, F.col("__id").cast("int")).alias("grain"), *names, count
    )


def grain_of(counts: DataFrame, grain: str, count: str = "n") -> DataFrame:
    """Keys and counts of one grain."""
    prefix = f"{grain}__"
    keys = [F.col(c).alias(c.removeprefix(prefix)) for c in counts.columns if c.startswith(prefix)]
    return counts.filter(F.col("grain") == grain).select(*keys, count)
