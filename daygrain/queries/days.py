"""Reductions to day grain and joins of day tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.operators import (
    bitmap_calendar,
    co_occurring_days,
    code_day_grid,
    counts_join_sums,
    daily_counts_and_sums,
    daily_min_max_avg,
    daily_sums_by_group,
    day_bitmaps,
    days_of,
    days_with_all,
    days_with_any,
    join_on,
    merge_bitmaps,
    wide_counts,
)
from daygrain.queries.registry import query
from daygrain.queries.standins import (
    DAY_TABLES_SQL,
    collision_daily,
    STATUS_MODES,
    four_way,
    ridership,
    table,
    weather_agg,
    weather_cond,
)
from daygrain.session import scratch_folder
from daygrain.sources import read_table, values_of, write_bucketed, write_for_lookup, write_table

LINE_SUMS = ["l_quantity", "l_linenumber", "l_discount", "l_tax"]


def _rounded(df: DataFrame, cols: list[str], places: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


@query("""
SELECT CAST(ts AS DATE) AS date, min(value) AS min_t, max(value) AS max_t,
       round(avg(value), 6) AS avg_t
FROM events WHERE event_type = 'view' AND ts IS NOT NULL GROUP BY 1
""", name="daily_min_max_avg")
def daily_min_max_avg_of_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = F.col("event_type") == "view"
    daily = daily_min_max_avg(table(spark, sf_dir, "events"), "ts", "value", where=views)
    return _rounded(daily, ["avg_t"], 6).orderBy("date")


@query(f"{DAY_TABLES_SQL} SELECT * FROM weather_cond")
def day_condition_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_cond(spark, sf_dir).orderBy("date")


_DAILY_LINES_SQL = """
SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS n, sum(l_quantity) AS l_quantity_sum,
       CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber_sum,
       round(sum(l_discount), 2) AS l_discount_sum, round(sum(l_tax), 2) AS l_tax_sum
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1
"""


@query(_DAILY_LINES_SQL, name="daily_counts_and_sums")
def daily_counts_and_sums_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_counts_and_sums(table(spark, sf_dir, "lineitem"), "l_shipdate", LINE_SUMS)
    return _rounded(daily, ["l_discount_sum", "l_tax_sum"]).orderBy("date")


@query(_DAILY_LINES_SQL)
def daily_counts_join_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = counts_join_sums(table(spark, sf_dir, "lineitem"), "l_shipdate", LINE_SUMS)
    return _rounded(daily, ["l_discount_sum", "l_tax_sum"]).orderBy("date")


@query(f"""{DAY_TABLES_SQL}
SELECT * REPLACE (round(ped_i, 2) AS ped_i, round(ped_k, 2) AS ped_k,
                  round(sub, 2) AS sub, round(bus, 2) AS bus, round(lirr, 2) AS lirr)
FROM features""")
def daily_feature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(four_way(spark, sf_dir), ["ped_i", "ped_k", "sub", "bus", "lirr"])


@query(f"""{DAY_TABLES_SQL}
SELECT r.date AS ride_date, c.date AS date_only, round(sub, 2) AS sub, round(bus, 2) AS bus,
       urgent, high
FROM ridership r JOIN weather_cond c ON r.date = c.date""")
def join_different_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = ridership(spark, sf_dir).withColumnRenamed("date", "ride_date")
    conditions = weather_cond(spark, sf_dir).withColumnRenamed("date", "date_only")
    joined = rides.join(conditions, rides["ride_date"] == conditions["date_only"])
    return _rounded(joined, ["sub", "bus"]).select(
        "ride_date", "date_only", "sub", "bus", "urgent", "high"
    )


@query(f"{DAY_TABLES_SQL} SELECT date, round(sub, 2) AS sub, round(bus, 2) AS bus, "
       "round(lirr, 2) AS lirr FROM ridership")
def daily_sums_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ridership(spark, sf_dir), list(STATUS_MODES.values()))


@query("""
SELECT CAST(l_shipdate AS DATE) AS date,
       nullif(count(*) FILTER (l_returnflag = 'A'), 0) AS a,
       nullif(count(*) FILTER (l_returnflag = 'R'), 0) AS r,
       nullif(count(*) FILTER (l_returnflag NOT IN ('A', 'R')), 0) AS "Others"
FROM lineitem WHERE l_shipdate IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1
""")
def daily_by_group_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_counts(
        table(spark, sf_dir, "lineitem"),
        F.to_date("l_shipdate"),
        "date",
        "l_returnflag",
        {"A": "a", "R": "r"},
    )


@query("""
SELECT CAST(o_orderdate AS DATE) AS date,
       round(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END), 2) AS urgent,
       round(sum(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END), 2) AS low,
       round(sum(CASE WHEN o_orderpriority IS NULL OR o_orderpriority NOT IN ('1-URGENT', '5-LOW')
                 THEN o_totalprice END), 2) AS "Others"
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1
""")
def daily_sums_by_group_and_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = daily_sums_by_group(
        table(spark, sf_dir, "orders"),
        "o_orderdate",
        "o_orderpriority",
        "o_totalprice",
        {"1-URGENT": "urgent", "5-LOW": "low"},
    )
    return _rounded(sums, ["urgent", "low", "Others"])


@query("""
WITH texts AS (
  SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'no date' WHEN o_orderkey % 11 = 0 THEN NULL
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)
SELECT CAST(day AS DATE) AS date, count(*) AS n FROM texts
WHERE day IS NOT NULL AND day <> 'no date' GROUP BY 1
""")
def daily_counts_of_iso_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days given as text, some of it no date: such rows have no day."""
    key = F.col("o_orderkey")
    day = (
        F.when(key % 7 == 0, "no date")
        .when(key % 11 == 0, F.lit(None))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    texts = table(spark, sf_dir, "orders").select(day.alias("day"))
    return daily_counts_and_sums(texts, "day", []).filter(F.col("date").isNotNull())


_GRID_CODES = ["5-LOW", "1-URGENT", "SPECIFIED", "2-HIGH", "NEVER"]


@query("""
WITH hits AS (
  SELECT DISTINCT t.code, CAST(o_orderdate AS DATE) AS date
  FROM orders, unnest(string_split(o_orderpriority, ' ')) AS t(code)
  WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01' AND t.code <> ''),
grid AS (
  SELECT code, CAST(d AS DATE) AS date
  FROM unnest(['5-LOW', '1-URGENT', 'SPECIFIED', '2-HIGH', 'NEVER']) AS c(code),
       generate_series(DATE '1996-01-01', DATE '1996-12-31', INTERVAL 1 DAY) AS s(d))
SELECT code, date, CASE WHEN h.present THEN 1 ELSE 0 END AS present
FROM grid FULL JOIN (SELECT *, TRUE AS present FROM hits) h USING (code, date)
""", name="code_day_grid")
def code_day_grid_of_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_day_grid(
        table(spark, sf_dir, "orders"),
        "o_orderdate",
        "o_orderpriority",
        _GRID_CODES,
        "1996-01-01",
        "1996-12-31",
    )


_HITS_SQL = """
WITH hits AS (
  SELECT DISTINCT t.code, CAST(o_orderdate AS DATE) AS date
  FROM orders, unnest(string_split(o_orderpriority, ' ')) AS t(code)
  WHERE o_orderdate IS NOT NULL AND t.code <> '')"""


def _priority_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps of two loads, kept and put together."""
    path, orders = scratch_folder(spark, "bitmaps"), table(spark, sf_dir, "orders")
    odd = F.col("o_orderkey") % 2 == 1
    for mode, load in (("errorifexists", orders.filter(odd)), ("append", orders.filter(~odd))):
        write_table(day_bitmaps(load, "o_orderdate", "o_orderpriority"), path, mode=mode)
    return merge_bitmaps(read_table(spark, path))


@query(_HITS_SQL + """
SELECT code, CAST(d AS DATE) AS date, CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS present
FROM unnest(['5-LOW', '1-URGENT', 'SPECIFIED', '2-HIGH', 'NEVER']) AS c(code)
CROSS JOIN generate_series(DATE '1996-01-01', DATE '1996-12-31', INTERVAL 1 DAY) AS s(d)
LEFT JOIN hits h USING (code) WHERE h.date IS NULL OR h.date = CAST(d AS DATE)
UNION ALL
SELECT code, CAST(d AS DATE), 0
FROM unnest(['5-LOW', '1-URGENT', 'SPECIFIED', '2-HIGH', 'NEVER']) AS c(code),
     generate_series(DATE '1996-01-01', DATE '1996-12-31', INTERVAL 1 DAY) AS s(d)
WHERE code IN (SELECT code FROM hits) AND NOT EXISTS (
  SELECT 1 FROM hits h WHERE h.code = c.code AND h.date = CAST(s.d AS DATE))
""")
def code_calendar_from_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmap_calendar(_priority_days(spark, sf_dir), _GRID_CODES, "1996-01-01", "1996-12-31")


@query(_HITS_SQL + """
SELECT a.code AS code_1, b.code AS code_2, count(*) AS days
FROM hits a JOIN hits b ON a.date = b.date AND a.code < b.code
WHERE a.code IN ('5-LOW', '1-URGENT', 'SPECIFIED', '2-HIGH', 'NEVER')
  AND b.code IN ('5-LOW', '1-URGENT', 'SPECIFIED', '2-HIGH', 'NEVER')
GROUP BY 1, 2
""")
def co_occurring_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co_occurring_days(_priority_days(spark, sf_dir), _GRID_CODES)


@query(_HITS_SQL + """
SELECT 'any' AS kind, date FROM hits WHERE code IN ('5-LOW', '1-URGENT') GROUP BY 2
UNION ALL
SELECT 'all', date FROM hits WHERE code IN ('5-LOW', '1-URGENT') GROUP BY 2 HAVING count(*) = 2
""")
def days_with_any_and_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    bitmaps, pair = _priority_days(spark, sf_dir), ["5-LOW", "1-URGENT"]
    kinds = {"any": days_with_any(bitmaps, pair), "all": days_with_all(bitmaps, pair)}
    one, two = (
        days_of(days, "1990-01-01", "2004-12-31").select(F.lit(kind).alias("kind"), "date")
        for kind, days in kinds.items()
    )
    return one.unionByName(two)


@query(DAY_TABLES_SQL + """
SELECT date, avg_t, urgent, crash FROM weather_agg JOIN weather_cond USING (date) JOIN collision_daily USING (date)
""")
def bucketed_day_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three day tables kept in buckets of the day, joined without an exchange."""
    base = scratch_folder(spark, "bucketed")
    kept = [
        write_bucketed(make(spark, sf_dir), f"t{base.rsplit('-', 1)[-1]}_{i}", f"{base}/{i}", "date", 4)
        for i, make in enumerate((weather_agg, weather_cond, collision_daily))
    ]
    return join_on(kept).select("date", "avg_t", "urgent", "crash")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (7, 11)")
def customer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few customers' orders from files sorted by customer, with bloom filters."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    kept = write_for_lookup(orders, scratch_folder(spark, "lookup"), "o_custkey")
    return values_of(kept, "o_custkey", [7, 11])
