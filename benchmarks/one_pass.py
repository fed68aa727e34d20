"""Seconds of the one-pass forms against a job, a scan or a shuffle per result.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` as for ``bench.py``. Prints one line per
comparison: the median of three warm runs of either form.
"""

from __future__ import annotations

import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F

from daygrain.operators import (
    corr_long,
    counts_join_sums,
    daily_counts_and_sums,
    impact_by_condition,
    mean_std_by_flag,
    wide_counts,
)
from daygrain.queries import standins as S
from daygrain.queries.conditions import IMPACT_RATES, IMPACT_SUMS
from daygrain.session import local_session

MEASURES = ["sub", "bus", "lirr"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def correlations(spark, sf_dir):
    def per_pair():
        days = S.four_way(spark, sf_dir).cache()
        for x in S.XS:
            for y in S.YS:
                days.stat.corr(x, y)
        days.unpersist()

    return per_pair, lambda: run(corr_long(S.features(spark, sf_dir), S.XS, S.YS))


def impact(spark, sf_dir):
    def per_condition():
        days = S.four_way(spark, sf_dir).cache()
        for flag in S.FLAGS:
            sums = [F.sum(c).alias(name) for c, name in IMPACT_SUMS.items()]
            run(days.groupBy(flag).agg(F.count("crash").alias("days"), *sums))
        days.unpersist()

    one = impact_by_condition
    return per_condition, lambda: run(
        one(S.features(spark, sf_dir), S.FLAGS, "crash", IMPACT_SUMS, IMPACT_RATES)
    )


def spread(spark, sf_dir):
    def per_measure():
        rides, conditions = S.ridership(spark, sf_dir), S.weather_cond(spark, sf_dir)
        joined = rides.join(conditions, "date")
        dry = joined.filter(~F.col("urgent") & ~F.col("high"))
        for m in MEASURES:
            stats = [F.avg(m).alias("mean"), F.stddev(m).alias("stddev")]
            run(joined.groupBy("urgent").agg(*stats))
            run(joined.groupBy("high").agg(*stats))
            run(dry.agg(*stats))

    def one():
        joined = S.ridership(spark, sf_dir).join(S.weather_cond(spark, sf_dir), "date")
        urgent, high = F.col("urgent"), F.col("high")
        flags = {"urgent": urgent, "high": high, "neither": ~urgent & ~high}
        run(mean_std_by_flag(joined, flags, MEASURES))

    return per_measure, one


def counts_and_sums(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem")
    cols = ["l_quantity", "l_linenumber", "l_discount", "l_tax"]
    return (
        lambda: run(counts_join_sums(lines, "l_shipdate", cols)),
        lambda: run(daily_counts_and_sums(lines, "l_shipdate", cols)),
    )


def wide(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem")
    day, values = F.to_date("l_shipdate"), ["A", "N", "R"]
    return (
        lambda: run(lines.groupBy(day.alias("date")).pivot("l_returnflag", values, others=None).count()),
        lambda: run(wide_counts(lines, day, "date", "l_returnflag", values, others=None)),
    )


def seconds(form) -> float:
    start = time.perf_counter()
    form()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    for comparison in (correlations, impact, spread, counts_and_sums, wide):
        medians = []
        for form in comparison(spark, sf_dir):
            form()
            medians.append(statistics.median(seconds(form) for _ in range(3)))
        several, one = medians
        print(f"{comparison.__name__:16} several {several:7.2f}  one {one:6.2f}  x{several / one:.1f}")
    spark.stop()


if __name__ == "__main__":
    main()
