"""Monthly means, shares, top-k and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions import share, steady_round
from daygrain.operators import (
    date_range,
    heavy_hitters,
    mean_of_groups,
    monthly_means,
    stack_columns,
    top_k_with_others,
)
from daygrain.queries.registry import oracle_sql, query
from daygrain.queries.standins import DAY_TABLES_SQL, STATUS_MODES, half_up, ridership, table

MODES = list(STATUS_MODES.values())


@query(f"""{DAY_TABLES_SQL}
SELECT strftime(date, '%Y-%m') AS month, {half_up("avg(sub)", 2)} AS sub,
       {half_up("avg(bus)", 2)} AS bus, {half_up("avg(lirr)", 2)} AS lirr
FROM ridership GROUP BY 1""", name="monthly_means")
def monthly_ridership_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = monthly_means(ridership(spark, sf_dir), "date", MODES)
    return means.withColumns({m: steady_round(m, 2) for m in MODES})


_SHARES_SQL = f"""{DAY_TABLES_SQL},
shares AS (
  SELECT date, strftime(date, '%Y-%m') AS month, sub / nullif(sub + bus + lirr, 0) * 100 AS sub,
         bus / nullif(sub + bus + lirr, 0) * 100 AS bus,
         lirr / nullif(sub + bus + lirr, 0) * 100 AS lirr
  FROM ridership)
"""


def _shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ridership(spark, sf_dir).select("date", *[share(m, MODES).alias(m) for m in MODES])


@query(f"{_SHARES_SQL} SELECT date, round(sub, 6) AS sub, round(bus, 6) AS bus, "
       "round(lirr, 6) AS lirr FROM shares")
def mode_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shares(spark, sf_dir).withColumns({m: F.round(m, 6) for m in MODES})


@query(f"""{_SHARES_SQL},
monthly AS (
  SELECT month, avg(sub) AS sub, avg(bus) AS bus, avg(lirr) AS lirr FROM shares GROUP BY 1)
SELECT 'sub' AS mode, round(avg(sub), 6) AS percent FROM monthly
UNION ALL SELECT 'bus', round(avg(bus), 6) FROM monthly
UNION ALL SELECT 'lirr', round(avg(lirr), 6) FROM monthly""")
def mode_share_mean_of_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = monthly_means(_shares(spark, sf_dir), "date", MODES)
    means = mean_of_groups(monthly, MODES, "mode", "percent")
    return means.withColumn("percent", F.round("percent", 6))


@query(f"""{_SHARES_SQL}
SELECT 'sub' AS mode, round(avg(sub), 6) AS percent FROM shares
UNION ALL SELECT 'bus', round(avg(bus), 6) FROM shares
UNION ALL SELECT 'lirr', round(avg(lirr), 6) FROM shares""")
def mode_share_daily_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = mean_of_groups(_shares(spark, sf_dir), MODES, "mode", "percent")
    return means.withColumn("percent", F.round("percent", 6))


@query(f"""{DAY_TABLES_SQL}
SELECT date, round(sub, 2) AS sub, round(bus, 2) AS bus FROM ridership
WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""")
def two_mode_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = date_range(ridership(spark, sf_dir), "date", "1996-01-01", "1996-12-31")
    return year.select("date", F.round("sub", 2).alias("sub"), F.round("bus", 2).alias("bus")).orderBy(
        "date"
    )


@query("""
SELECT slot, value, count(*) AS n
FROM (SELECT 'p_brand' AS slot, p_brand AS value FROM part
      UNION ALL SELECT 'p_type', p_type FROM part
      UNION ALL SELECT 'p_name', p_name FROM part)
GROUP BY 1, 2
""")
def stacked_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stacked = stack_columns(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_name"])
    return stacked.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH counts AS (
  SELECT value, count(*) AS n
  FROM (SELECT p_brand AS value FROM part UNION ALL SELECT p_type FROM part
        UNION ALL SELECT p_name FROM part)
  WHERE value IS NOT NULL GROUP BY 1),
top AS (SELECT value, n FROM counts ORDER BY n DESC, value LIMIT 10)
SELECT value, n FROM top
UNION ALL
SELECT 'Others', CAST(coalesce(sum(n), 0) AS BIGINT) FROM counts
WHERE value NOT IN (SELECT value FROM top)
""", name="topk_with_others")
def part_text_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_with_others(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_name"], 10)


@query(oracle_sql()["topk_with_others"])
def topk_by_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from candidates that are counted exactly; where they prove nothing, from all counts."""
    return heavy_hitters(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_name"], 10)


@query("""
WITH counts AS (
  SELECT value, count(*) AS n
  FROM (SELECT o_orderpriority AS value FROM orders UNION ALL SELECT CAST(o_orderkey AS VARCHAR) FROM orders)
  WHERE value IS NOT NULL GROUP BY 1),
top AS (SELECT value, n FROM counts ORDER BY n DESC, value LIMIT 3)
SELECT value, n FROM top
UNION ALL
SELECT 'Others', CAST(coalesce(sum(n), 0) AS BIGINT) FROM counts WHERE value NOT IN (SELECT value FROM top)
""")
def topk_of_many_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few frequent values among as many different ones as there are orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", F.col("o_orderkey").cast("string").alias("key"))
    return heavy_hitters(orders, ["o_orderpriority", "key"], 3)
