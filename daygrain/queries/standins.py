"""Day tables made from the driver's tables, in Spark and in SQL.

``orders`` stands for weather and ridership and ``lineitem`` for collisions:
prices are temperatures, priorities are weather codes, statuses are transit
modes, and shipped lines are collisions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions import flag_from_code, steady_round
from daygrain.operators import (
    daily_counts_and_sums,
    daily_flags,
    daily_min_max_avg,
    daily_sums_by_group,
    join_on,
)

PRIORITY_CODES = {
    "urgent": "URGENT",
    "high": "HIGH",
    "medium": "MEDIUM",
    "unspecified": "NOT",
    "low": "LOW",
}
FLAGS = list(PRIORITY_CODES)
STATUS_MODES = {"F": "sub", "O": "bus", "P": "lirr"}
LINE_SUMS = {"l_quantity": "ppl_i", "l_linenumber": "ppl_k", "l_discount": "ped_i", "l_tax": "ped_k"}
XS = ["min_t", "max_t", "avg_t"]
YS = ["crash", "ppl_i", "ppl_k", "ped_i", "ped_k", "sub", "bus", "lirr"]


# Given schemas spare a job that opens a file only to learn its columns.
SCHEMAS = {
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def weather_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_min_max_avg(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")
    return daily.withColumn("avg_t", steady_round("avg_t", 1))


def weather_cond(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_flags(
        table(spark, sf_dir, "orders"), "o_orderdate", "o_orderpriority", PRIORITY_CODES
    )


def collision_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_counts_and_sums(
        table(spark, sf_dir, "lineitem"), "l_shipdate", LINE_SUMS, count="crash"
    )


def ridership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_sums_by_group(
        table(spark, sf_dir, "orders"),
        "o_orderdate",
        "o_orderstatus",
        "o_totalprice",
        STATUS_MODES,
        others=None,  # these are all the statuses
    )


def four_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four day tables joined one after the other, as when each comes from its own source.

    Here three of them share a source; :func:`features` is the cheaper form then.
    """
    return join_on([f(spark, sf_dir) for f in (weather_agg, weather_cond, collision_daily, ridership)])


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table with each fact table read and shuffled once.

    Three of the four day tables come from ``orders``, so one aggregation
    computes their columns together.
    """
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderdate").isNotNull())
    price = F.col("o_totalprice")
    from_orders = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.min(price).alias("min_t"),
        F.max(price).alias("max_t"),
        steady_round(F.avg(price), 1).alias("avg_t"),
        *[
            F.bool_or(flag_from_code("o_orderpriority", code)).alias(flag)
            for flag, code in PRIORITY_CODES.items()
        ],
        *[
            F.sum(F.when(F.col("o_orderstatus") == status, price)).alias(mode)
            for status, mode in STATUS_MODES.items()
        ],
    )
    return from_orders.join(collision_daily(spark, sf_dir), "date")


def half_up(expression: str, places: int) -> str:
    """SQL for ``steady_round``: decimals, since multiplying a double may miss a half."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28, {places + 6})), {places}) AS DOUBLE)"


WEATHER_AGG_SQL = f"""
  SELECT CAST(o_orderdate AS DATE) AS date, min(o_totalprice) AS min_t, max(o_totalprice) AS max_t,
         {half_up("avg(o_totalprice)", 1)} AS avg_t
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1"""
WEATHER_COND_SQL = """
  SELECT CAST(o_orderdate AS DATE) AS date,
         bool_or(contains(o_orderpriority, 'URGENT')) AS urgent,
         bool_or(contains(o_orderpriority, 'HIGH')) AS high,
         bool_or(contains(o_orderpriority, 'MEDIUM')) AS medium,
         bool_or(contains(o_orderpriority, 'NOT')) AS unspecified,
         bool_or(contains(o_orderpriority, 'LOW')) AS low
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1"""
COLLISION_DAILY_SQL = """
  SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS crash, sum(l_quantity) AS ppl_i,
         CAST(sum(l_linenumber) AS BIGINT) AS ppl_k, sum(l_discount) AS ped_i, sum(l_tax) AS ped_k
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1"""
RIDERSHIP_SQL = """
  SELECT CAST(o_orderdate AS DATE) AS date,
         sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS sub,
         sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS bus,
         sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS lirr
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1"""
DAY_TABLES_SQL = f"""
WITH weather_agg AS ({WEATHER_AGG_SQL}),
weather_cond AS ({WEATHER_COND_SQL}),
collision_daily AS ({COLLISION_DAILY_SQL}),
ridership AS ({RIDERSHIP_SQL}),
features AS (
  SELECT * FROM weather_agg JOIN weather_cond USING (date) JOIN collision_daily USING (date)
  JOIN ridership USING (date))
"""
