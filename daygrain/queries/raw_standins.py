"""The three data sets in their own columns, derived from the driver's tables.

Reports come from ``events``, collisions from ``lineitem`` and ridership from
``orders``. For the joint analyses, dates of the last two are folded onto the
30 days of the events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.queries.standins import table

_REPORTS = {
    "station": """CASE pmod(user_id, 3) WHEN 0 THEN '72505394728' WHEN 1 THEN '72503014732'
                  ELSE '72502014734' END""",
    "ts": "ts",
    "report_type": """CASE event_type WHEN 'view' THEN 'FM-15' WHEN 'click' THEN 'FM-16'
                      WHEN 'purchase' THEN 'SOD' ELSE 'FM-12' END""",
    "source": "'7'",
    "daily_weather": """CASE WHEN event_type <> 'purchase' THEN NULL
                        WHEN pmod(event_id, 6) = 0 THEN 'RA' WHEN pmod(event_id, 6) = 1 THEN 'FZRA BR'
                        WHEN pmod(event_id, 6) = 2 THEN 'BLSN' WHEN pmod(event_id, 6) = 3 THEN 'HZ  FG'
                        WHEN pmod(event_id, 6) = 4 THEN 'UP ZZ' END""",
    "sunrise": "CASE WHEN event_type = 'purchase' THEN 600 + CAST(minute(ts) AS INT) END",
    "sunset": "CASE WHEN event_type = 'purchase' THEN 1800 + CAST(minute(ts) AS INT) END",
    "dry_bulb_temperature": (
        "CASE WHEN pmod(event_id, 50) = 0 THEN '33s' ELSE CAST(value AS STRING) END"
    ),
    "relative_humidity": "CAST(pmod(event_id, 101) AS STRING)",
    "precipitation": "CASE WHEN pmod(event_id, 4) = 0 THEN 'T' ELSE CAST(value AS STRING) END",
}
_COLLISIONS = {
    "crash_time": """concat(CAST(pmod(l_orderkey, 24) AS STRING), ':',
                     lpad(CAST(pmod(l_partkey, 60) AS STRING), 2, '0'))""",
    "borough": "CASE l_returnflag WHEN 'A' THEN ' queens ' WHEN 'N' THEN 'Bronx' END",
    "ppl_i": "CASE WHEN l_linenumber > 5 THEN l_linenumber - 5 ELSE 0 END",
    "ppl_k": "CASE WHEN l_quantity > 48 THEN 1 ELSE 0 END",
    "ped_i": "CASE WHEN l_discount > 0.08 THEN 1 WHEN l_linenumber = 2 THEN NULL ELSE 0 END",
    "ped_k": "CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END",
    "cyc_i": "CASE WHEN l_quantity < 3 THEN 2 ELSE 0 END",
    "cyc_k": "CASE WHEN l_quantity = 10 THEN 1 ELSE 0 END",
    "mot_i": "CASE WHEN l_linenumber > 4 THEN l_linenumber ELSE 0 END",
    "mot_k": "CASE WHEN l_discount < 0.01 THEN 1 ELSE 0 END",
    "vehicle_1": "concat('Type ', CAST(pmod(l_suppkey, 17) AS STRING))",
    "vehicle_2": (
        "CASE WHEN l_linestatus = 'F' THEN concat('Type ', CAST(pmod(l_partkey, 23) AS STRING)) END"
    ),
    "vehicle_3": "CASE WHEN l_linenumber = 7 THEN 'Type 1' END",
    "vehicle_4": "CASE WHEN l_linenumber > 2 THEN 'Others' END",
    "vehicle_5": "CAST(NULL AS STRING)",
}
_MODES = {
    "sub": "o_orderstatus = 'F'",
    "bus": "o_orderstatus = 'O'",
    "lirr": "o_orderpriority = '1-URGENT'",
    "metro_north": "o_orderpriority = '2-HIGH'",
    "acc_a_ride": "o_orderpriority = '5-LOW'",
    "brdg_tun": "o_orderstatus = 'P'",
    "sttn_rw": "o_totalprice > 250000",
}


def _fold(ts: str) -> str:
    return (
        f"date_add(DATE'2024-01-01', CAST(pmod(datediff(CAST({ts} AS DATE), DATE'1995-01-01'), 30) AS INT))"
    )


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{e} AS {name}" for name, e in columns.items()]


# On every fourth day hourly reports are special ones, so that these days lack temperatures.
WITH_GAPS_SQL = (
    "WHEN 'view' THEN 'FM-15'",
    "WHEN 'view' THEN CASE WHEN date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) % 4 = 0 "
    "THEN 'FM-16' ELSE 'FM-15' END",
)


def reports(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    found = table(spark, sf_dir, "events").selectExpr(*_select(_REPORTS))
    if not gaps:
        return found
    number = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date"))
    special = (F.col("report_type") == "FM-15") & (number % 4 == 0)
    return found.withColumn("report_type", F.when(special, "FM-16").otherwise(F.col("report_type")))


def crashes(spark: SparkSession, sf_dir: str, fold: bool = False) -> DataFrame:
    day = _fold("l_shipdate") if fold else "CAST(l_shipdate AS DATE)"
    lines = table(spark, sf_dir, "lineitem")
    return lines.selectExpr(*_select({"crash_date": day, **_COLLISIONS}))


def rides(spark: SparkSession, sf_dir: str, fold: bool = False) -> DataFrame:
    day = _fold("o_orderdate") if fold else "CAST(o_orderdate AS DATE)"
    orders = table(spark, sf_dir, "orders").filter("o_orderdate IS NOT NULL")
    counts = [F.expr(f"count_if({condition})").alias(mode) for mode, condition in _MODES.items()]
    return orders.groupBy(F.expr(day).alias("date")).agg(*counts)


def _duck(expression: str) -> str:
    """The same expression as DuckDB writes it."""
    return expression.replace("pmod(", "mod(").replace("AS STRING)", "AS VARCHAR)")


def _duck_select(columns: dict[str, str]) -> str:
    return ", ".join(f"{_duck(e)} AS {name}" for name, e in columns.items())


def _duck_fold(ts: str) -> str:
    return (
        f"CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST({ts} AS DATE)) % 30 "
        "AS INTEGER) AS DATE)"
    )


def _rides_sql(day: str) -> str:
    counts = ", ".join(f"count(*) FILTER ({c}) AS {m}" for m, c in _MODES.items())
    return f"SELECT {day} AS date, {counts} FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1"


RAW_SQL = f"""
WITH reports AS (SELECT {_duck_select(_REPORTS)} FROM events),
crashes AS (
  SELECT CAST(l_shipdate AS DATE) AS crash_date, {_duck_select(_COLLISIONS)} FROM lineitem),
crashes_folded AS (
  SELECT {_duck_fold("l_shipdate")} AS crash_date, {_duck_select(_COLLISIONS)} FROM lineitem),
rides AS ({_rides_sql("CAST(o_orderdate AS DATE)")}),
rides_folded AS ({_rides_sql(_duck_fold("o_orderdate"))})
"""
