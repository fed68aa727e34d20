"""Calendar profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.fixed_values import MONTHS, NOT_SEVERE, SEVERE, WEEKDAYS
from daygrain.functions import month_of, name_at, severity, weekday_name
from daygrain.operators import (
    by_season,
    by_weekday,
    complete_domain,
    counts_by_hour,
    daily_counts_and_sums,
    mean_daily_by_month,
    top_k,
    wide_counts,
)
from daygrain.queries.registry import query
from daygrain.queries.standins import table


@query("""
SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS n FROM lineitem
WHERE l_shipdate IS NOT NULL GROUP BY 1 ORDER BY n DESC, date LIMIT 20
""")
def top_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_counts_and_sums(table(spark, sf_dir, "lineitem"), "l_shipdate", [])
    return top_k(daily, "n", 20, "date")


@query("""
SELECT CAST(month(date) AS INTEGER) AS month, round(avg(n), 6) AS avg_daily
FROM (SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS n FROM lineitem
      WHERE l_shipdate IS NOT NULL GROUP BY 1)
GROUP BY 1
""")
def avg_daily_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = mean_daily_by_month(table(spark, sf_dir, "lineitem"), "l_shipdate")
    return means.withColumn("avg_daily", F.round("avg_daily", 6))


@query("""
WITH domain(weekday, ord) AS (
  VALUES ('Monday', 1), ('Tuesday', 2), ('Wednesday', 3), ('Thursday', 4), ('Friday', 5),
         ('Saturday', 6), ('Sunday', 7)),
counts AS (
  SELECT dayname(l_shipdate) AS weekday, count(*) AS n FROM lineitem
  WHERE l_shipdate IS NOT NULL GROUP BY 1)
SELECT weekday, ord, n FROM domain LEFT JOIN counts USING (weekday)
""")
def total_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_weekday(table(spark, sf_dir, "lineitem"), "l_shipdate")


@query("""
WITH domain(season, ord) AS (
  VALUES ('Winter', 1), ('Spring', 2), ('Summer', 3), ('Autumn', 4)),
counts AS (
  SELECT CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 'Winter'
              WHEN month(l_shipdate) IN (3, 4, 5) THEN 'Spring'
              WHEN month(l_shipdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
         count(*) AS n
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1)
SELECT season, ord, n FROM domain LEFT JOIN counts USING (season)
""")
def total_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_season(table(spark, sf_dir, "lineitem"), "l_shipdate")


@query("""
WITH domain(weekday, ord) AS (
  VALUES ('Monday', 1), ('Tuesday', 2), ('Wednesday', 3), ('Thursday', 4), ('Friday', 5),
         ('Saturday', 6), ('Sunday', 7)),
counts AS (
  SELECT dayname(ts) AS weekday, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1)
SELECT weekday, ord, n FROM (SELECT * FROM domain UNION ALL SELECT 'Holiday', 8)
LEFT JOIN counts USING (weekday)
""")
def weekday_domain_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekdays and one more value that has no rows."""
    names = table(spark, sf_dir, "events").filter(F.col("ts").isNotNull())
    counts = names.groupBy(weekday_name("ts").alias("weekday")).agg(F.count(F.lit(1)).alias("n"))
    return complete_domain(counts, "weekday", [*WEEKDAYS, "Holiday"])


@query("""
WITH domain AS (
  SELECT monthname(make_date(2000, CAST(m AS INTEGER), 1)) AS month, CAST(m AS INTEGER) AS ord
  FROM range(1, 13) AS r(m)),
counts AS (
  SELECT monthname(l_shipdate) AS month,
         nullif(count(*) FILTER (l_quantity > 45 OR l_discount > 0.09), 0) AS dangerous,
         nullif(count(*) FILTER (NOT (l_quantity > 45 OR l_discount > 0.09)), 0) AS non_injury
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1)
SELECT month, ord, dangerous, non_injury FROM domain LEFT JOIN counts USING (month)
""")
def monthly_severity_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = wide_counts(
        table(spark, sf_dir, "lineitem"),
        month_of("l_shipdate"),
        "number",
        severity([F.col("l_quantity") > 45, F.col("l_discount") > 0.09]),
        {SEVERE: "dangerous", NOT_SEVERE: "non_injury"},
        others=None,
    )
    named = counts.withColumn("month", name_at("number", MONTHS)).drop("number")
    return complete_domain(named, "month", MONTHS)


@query("SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events "
       "WHERE ts IS NOT NULL GROUP BY 1", name="counts_by_hour")
def event_counts_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = F.lpad(F.minute("ts").cast("string"), 2, "0")
    time = F.concat(F.hour("ts").cast("string"), F.lit(":"), minutes)
    texts = table(spark, sf_dir, "events").select(time.alias("time"))
    return counts_by_hour(texts, "time")
