"""Selections, renames, parsing and recoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.fixed_values import TRACE_MARK, TRACE_VALUE
from daygrain.functions import (
    coerce_number,
    describe_code,
    normalise_text,
    parse_date,
    parse_timestamp,
    recode,
)
from daygrain.operators import (
    date_range,
    labelled_parts,
    measure_bounds,
    month_series,
    split_by_value,
    station_series,
    token_vocabulary,
    value_counts,
    week_series,
)
from daygrain.queries.registry import query
from daygrain.queries.standins import table

USER = {"station": "user_id"}


REPORTS = {"view": "hourly", "click": "special", "purchase": "summary"}


@query("""
SELECT 'hourly' AS report, event_id, ts, value FROM events WHERE event_type = 'view'
UNION ALL
SELECT 'special', event_id, ts, value FROM events WHERE event_type = 'click'
UNION ALL
SELECT 'summary', event_id, ts, value FROM events WHERE event_type = 'purchase'
""")
def report_type_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = labelled_parts(table(spark, sf_dir, "events"), "event_type", REPORTS, "report")
    return parts.select("report", "event_id", "ts", "value")


@query("SELECT event_id, ts, props FROM events WHERE event_type = 'purchase'")
def summary_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of three frames, each with its own columns."""
    hourly = ["event_id", "ts", "value"]
    parts = split_by_value(
        table(spark, sf_dir, "events"),
        "event_type",
        {
            "hourly": ("view", hourly),
            "special": ("click", hourly),
            "summary": ("purchase", ["event_id", "ts", "props"]),
        },
    )
    return parts["summary"]


@query("""
SELECT c_custkey AS id, c_name AS label, round(c_acctbal, 0) AS balance, c_acctbal < 0 AS in_debt
FROM customer
""")
def rename_and_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .drop("c_nationkey", "c_mktsegment", "no_such_column")
        .withColumnsRenamed({"c_custkey": "id", "c_name": "label"})
        .withColumns({"balance": F.round("c_acctbal"), "in_debt": F.col("c_acctbal") < 0})
        .drop("c_acctbal")
    )


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 20")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").orderBy("c_custkey").limit(20)


@query("""
SELECT upper(trim('  ' || lower(c_mktsegment) || ' ')) AS segment, count(*) AS n
FROM customer GROUP BY 1
""", name="normalise_text")
def normalised_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    return (
        table(spark, sf_dir, "customer")
        .groupBy(normalise_text(padded).alias("segment"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("""
SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%m/%d/%Y'), '%m/%d/%Y') AS DATE) AS date
FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
""")
def parse_pattern_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("text")
    )
    typed = texts.select("o_orderkey", parse_date("text", "MM/dd/yyyy").alias("date"))
    return date_range(typed, "date", "1996-01-01", "1996-12-31")


@query("""
SELECT event_id, date_trunc('second', ts) AS ts, CAST(ts AS DATE) AS date FROM events
""")
def parse_pattern_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = "yyyy-MM-dd'T'HH:mm:ss"
    texts = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", pattern).alias("text")
    )
    typed = texts.select("event_id", parse_timestamp("text", pattern).alias("ts"))
    return typed.withColumn("date", F.to_date("ts"))


@query("""
SELECT DISTINCT t.token
FROM part, unnest(string_split(p_name, ' ')) AS t(token) WHERE t.token <> ''
""", name="token_vocabulary")
def part_name_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_vocabulary(table(spark, sf_dir, "part"), "p_name")


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1",
       name="value_counts")
def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(table(spark, sf_dir, "events"), "event_type")


@query("""
SELECT event_id,
       try_cast(CASE WHEN text = 'T' THEN '0.00' ELSE text END AS DOUBLE) AS reading
FROM (SELECT event_id,
             CASE WHEN event_id % 5 = 0 THEN 'T' WHEN event_id % 7 = 0 THEN '33s'
                  WHEN event_id % 11 = 0 THEN '' ELSE CAST(value AS VARCHAR) END AS text
      FROM events)
""")
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    texts = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(key % 5 == 0, TRACE_MARK)
        .when(key % 7 == 0, "33s")
        .when(key % 11 == 0, "")
        .otherwise(F.col("value").cast("string"))
        .alias("text"),
    )
    return texts.select("event_id", coerce_number("text", {TRACE_MARK: TRACE_VALUE}).alias("reading"))


@query("""
SELECT event_id, CASE event_type WHEN 'view' THEN 'Seen' WHEN 'click' THEN 'Clicked'
                 ELSE event_type END AS kind
FROM events
""")
def recode_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"view": "Seen", "click": "Clicked"}
    return table(spark, sf_dir, "events").select("event_id", recode("event_type", names).alias("kind"))


_PRIORITIES = {"1-URGENT": "at once", "2-HIGH": "soon", "3-MEDIUM": "in turn"}


@query("""
WITH d(code, description) AS (
  VALUES ('1-URGENT', 'at once'), ('2-HIGH', 'soon'), ('3-MEDIUM', 'in turn'))
SELECT o_orderpriority AS code, coalesce(description, o_orderpriority) AS description, count(*) AS n
FROM orders LEFT JOIN d ON code = o_orderpriority GROUP BY 1, 2
""")
def code_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("code"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.withColumn("description", describe_code("code", _PRIORITIES))


@query("""
SELECT user_id, ts, value FROM events
WHERE ts >= DATE '2024-01-10' AND ts < DATE '2024-01-11' AND event_type = 'view'
""")
def station_series_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = F.col("event_type") == "view"
    events = table(spark, sf_dir, "events")
    return station_series(events, "2024-01-10", "2024-01-10", ["value"], where=views, **USER)


@query("""
SELECT user_id, ts, value FROM events
WHERE ts >= DATE '2024-01-08' AND ts < DATE '2024-01-15' AND event_type = 'view'
""")
def station_series_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = F.col("event_type") == "view"
    return week_series(table(spark, sf_dir, "events"), "2024-01-10", ["value"], where=views, **USER)


_MONTH_SQL = """
SELECT user_id, ts, value FROM events
WHERE month(ts) = 1 AND year(ts) = 2024 AND event_type = 'view' AND user_id IN (1, 2, 3, 5, 8)
"""


@query(_MONTH_SQL)
def station_series_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_series(
        table(spark, sf_dir, "events"),
        1,
        ["value"],
        year=2024,
        stations=[1, 2, 3, 5, 8],
        where=F.col("event_type") == "view",
        **USER,
    )


@query("""
SELECT 0 AS year_given, user_id, ts, value FROM events WHERE month(ts) = 1 AND event_type = 'view'
""")
def station_series_month_any_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = F.col("event_type") == "view"
    series = month_series(table(spark, sf_dir, "events"), 1, ["value"], where=views, **USER)
    return series.select(F.lit(0).alias("year_given"), "*")


@query(f"SELECT min(value) AS lowest, max(value) AS highest FROM ({_MONTH_SQL})")
def selection_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure_bounds(station_series_month(spark, sf_dir), "value")
