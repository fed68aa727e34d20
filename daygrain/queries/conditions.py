"""Outcomes under conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions import coerce_number, steady_round
from daygrain.operators import count_flags, impact_by_condition, mean_std, mean_std_by_flag
from daygrain.plans.impact import IMPACT_RATES, IMPACT_SUMS
from daygrain.queries.registry import query
from daygrain.queries.standins import DAY_TABLES_SQL, FLAGS, features, half_up, table


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _impact_sql(flag: str) -> str:
    return f"""
SELECT '{flag}' AS condition, {flag} AS value, count(crash) AS days,
       CAST(sum(crash) AS BIGINT) AS tt_crash, sum(ppl_i) AS ppl_injured,
       CAST(sum(ppl_k) AS BIGINT) AS ppl_killed,
       round(sum(sub), 2) AS sub_total, round(sum(bus), 2) AS bus_total,
       {half_up("sum(ppl_i) / count(crash)", 3)} AS ppl_injured_per_day,
       {half_up("sum(ppl_k) / count(crash)", 3)} AS ppl_killed_per_day,
       {half_up("sum(crash) / count(crash)", 0)} AS crashes_per_day,
       {half_up("sum(sub) / count(crash)", 0)} AS sub_per_day,
       {half_up("sum(bus) / count(crash)", 0)} AS bus_per_day
FROM features GROUP BY 1, 2"""


@query(f"{DAY_TABLES_SQL} {_union([_impact_sql(f) for f in FLAGS])}")
def condition_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    impact = impact_by_condition(features(spark, sf_dir), FLAGS, "crash", IMPACT_SUMS, IMPACT_RATES)
    return impact.withColumns({c: F.round(c, 2) for c in ("sub_total", "bus_total")})


def _spread_sql(flag: str, condition: str, measure: str) -> str:
    return f"""
SELECT '{flag}' AS condition, {condition} AS value, '{measure}' AS measure,
       {half_up(f"avg({measure})", 2)} AS mean, {half_up(f"stddev_samp({measure})", 2)} AS stddev
FROM features GROUP BY 1, 2"""


_SPREAD_FLAGS = {
    "urgent": "urgent",
    "high": "high",
    "neither": "NOT urgent AND NOT high",
}
_SPREAD_MEASURES = ["sub", "bus", "lirr"]


def _spread(df: DataFrame) -> DataFrame:
    return df.withColumns({c: steady_round(c, 2) for c in ("mean", "stddev")})


@query(f"""{DAY_TABLES_SQL} {_union([_spread_sql(f, c, m)
                                     for f, c in _SPREAD_FLAGS.items() for m in _SPREAD_MEASURES])}""")
def flag_mean_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent, high = F.col("urgent"), F.col("high")
    flags = {"urgent": urgent, "high": high, "neither": ~urgent & ~high}
    return _spread(mean_std_by_flag(features(spark, sf_dir), flags, _SPREAD_MEASURES))


@query(f"""{DAY_TABLES_SQL} {_union([
    f"SELECT '{m}' AS measure, {half_up(f'avg({m})', 2)} AS mean, "
    f"{half_up(f'stddev_samp({m})', 2)} AS stddev FROM features WHERE NOT urgent AND NOT high" for m in _SPREAD_MEASURES])}""")
def neither_mean_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    neither = features(spark, sf_dir).filter(~F.col("urgent") & ~F.col("high"))
    return _spread(mean_std(neither, _SPREAD_MEASURES))


@query("""
SELECT event_type, round(avg(reading), 6) AS mean, round(stddev_samp(reading), 6) AS stddev
FROM (SELECT event_type, try_cast(nullif(text, '') AS DOUBLE) AS reading
      FROM (SELECT event_type,
                   CASE WHEN event_id % 3 = 0 THEN '' ELSE CAST(value AS VARCHAR) END AS text
            FROM events))
GROUP BY 1
""")
def text_measure_mean_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measure that arrives as text and is empty at times."""
    text = F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("value").cast("string"))
    texts = table(spark, sf_dir, "events").select("event_type", text.alias("text"))
    reading = F.when(F.col("text") != "", coerce_number("text"))
    return texts.groupBy("event_type").agg(
        F.round(F.avg(reading), 6).alias("mean"), F.round(F.stddev_samp(reading), 6).alias("stddev")
    )


_PARTIES_SQL = {
    "Pedestrian": "(l_quantity > 45 OR l_discount > 0.09)",
    "Cyclist": "(l_tax > 0.07 OR l_linenumber > 6)",
    "Motorist": "(l_extendedprice > 80000 OR l_linenumber < 2)",
}


@query(_union(
    [f"SELECT '{p}' AS party, count(*) AS n FROM lineitem WHERE {c}" for p, c in _PARTIES_SQL.items()]
    + [f"SELECT 'Vehicle', count(*) FROM lineitem WHERE NOT ({' OR '.join(_PARTIES_SQL.values())})"]
))
def party_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_flags(
        table(spark, sf_dir, "lineitem"),
        {
            "Pedestrian": [F.col("l_quantity") > 45, F.col("l_discount") > 0.09],
            "Cyclist": [F.col("l_tax") > 0.07, F.col("l_linenumber") > 6],
            "Motorist": [F.col("l_extendedprice") > 80000, F.col("l_linenumber") < 2],
        },
        none="Vehicle",
    )
