"""Writing and reading back files in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.operators import corr_long, daily_counts_and_sums
from daygrain.plans.incremental import counted_days, load, read_days
from daygrain.queries.registry import query
from daygrain.queries.standins import DAY_TABLES_SQL, XS, YS, features, table
from daygrain.session import scratch_folder
from daygrain.sources import (
    Checked,
    CommitLog,
    conform,
    conform_checked,
    ledger_counts,
    publish,
    read_correlations,
    read_csv,
    read_csv_by_header,
    read_csv_text,
    read_published,
    read_table,
    write_table,
    write_to_all,
)

_DAILY_SQL = """
SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS crash, sum(l_quantity) AS ppl_i
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1
"""


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return daily_counts_and_sums(lines, "l_shipdate", {"l_quantity": "ppl_i"}, count="crash")


@query(_DAILY_SQL)
def csv_roundtrip_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day table as one CSV file in date order, read back with its schema."""
    path = scratch_folder(spark, "csv-single")
    daily = _daily(spark, sf_dir)
    write_table(daily, path, "csv", order_by=["date"], single_file=True)
    return read_csv(spark, path, daily.schema)


@query(_DAILY_SQL)
def csv_roundtrip_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with types inferred from the text, after an overwrite."""
    path = scratch_folder(spark, "csv-inferred")
    daily = _daily(spark, sf_dir)
    write_table(spark.createDataFrame([], daily.schema), path, "csv")
    write_table(daily, path, "csv", mode="overwrite")
    inferred = read_csv(spark, path)
    return inferred.withColumn("crash", F.col("crash").cast("bigint"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS date FROM orders")
def csv_roundtrip_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many files in two targets; the second is read as text and typed by name."""
    targets = [scratch_folder(spark, "csv-parts") for _ in range(2)]
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("DATE")
    )
    write_to_all(orders, targets)
    return conform(
        read_csv_text(spark, targets[1]),
        {
            "O_ORDERKEY": "o_orderkey",
            "o_orderstatus": "o_orderstatus",
            "o_totalprice": "o_totalprice",
            "date": "date",
        },
        types={"o_orderkey": "bigint", "o_totalprice": "double"},
        date_patterns={"date": "yyyy-MM-dd"},
    )


@query("""
SELECT o_orderkey, target, CASE o_orderkey % 4
  WHEN 0 THEN o_orderstatus || chr(10) || o_orderpriority
  WHEN 1 THEN 'said "' || o_orderstatus || '", twice'
  WHEN 2 THEN '  ' || o_orderstatus || ' ' ELSE o_orderstatus END AS text
FROM orders, (VALUES (1), (2)) AS t(target)
""")
def csv_equal_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, quotes and outer blanks in two targets, both read back."""
    status, number = F.col("o_orderstatus"), F.col("o_orderkey") % 4
    text = (
        F.when(number == 0, F.concat_ws("\n", status, "o_orderpriority"))
        .when(number == 1, F.concat(F.lit('said "'), status, F.lit('", twice')))
        .when(number == 2, F.concat(F.lit("  "), status, F.lit(" ")))
        .otherwise(status)
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    targets = write_to_all(orders, [scratch_folder(spark, "csv-equal") for _ in range(2)])
    one, two = (
        read_csv(spark, path, orders.schema, multiline=True).withColumn("target", F.lit(i))
        for i, path in enumerate(targets, 1)
    )
    return one.unionByName(two)


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders")
def csv_date_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date column in another notation, typed by the reader."""
    path = scratch_folder(spark, "csv-dates")
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("date")
    )
    write_table(texts, path, "csv")
    return read_csv(spark, path, "o_orderkey bigint, date date", date_pattern="MM/dd/yyyy")


@query("""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date,
       CAST(month(l_shipdate) AS INTEGER) AS month
FROM lineitem WHERE month(l_shipdate) IN (6, 7)
""")
def parquet_partitioned_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact table kept in a folder per month; a filter on the month opens only those folders."""
    path = scratch_folder(spark, "by-month")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.to_date("l_shipdate").alias("date"),
        F.month("l_shipdate").alias("month"),
    )
    write_table(lines, path, partition_by=["month"])
    return read_table(spark, path).filter(F.col("month").isin(6, 7))


@query(DAY_TABLES_SQL + "\nUNION ALL\n".join(
    f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS r FROM features"
    for x in XS for y in YS))
def corr_text_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations written as lines ``x | y | r`` and parsed again."""
    path = scratch_folder(spark, "corr-text")
    corr = corr_long(features(spark, sf_dir), XS, YS)
    lines = corr.select(F.concat_ws(" | ", "x", "y", F.col("r").cast("string")).alias("value"))
    write_table(lines, path, "text")
    return read_correlations(spark, path).withColumn("r", F.round("r", 6))


_FAULTY = {
    "o_orderkey": ("bigint", "CAST(o_orderkey AS VARCHAR)"),
    "o_orderdate": ("date yyyy-MM-dd", "CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' "
                    "ELSE strftime(o_orderdate, '%Y-%m-%d') END"),
    "o_totalprice": ("double", "CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus || '?' "
                     "WHEN o_orderkey % 3 <> 0 THEN CAST(o_totalprice AS VARCHAR) END"),
}
_BAD = {"o_orderkey": "FALSE", "o_orderdate": "o_orderkey % 7 = 0", "o_totalprice": "o_orderkey % 5 = 0"}


def _faulty(spark: SparkSession, sf_dir: str) -> Checked:
    """Orders as CSV text, some of whose fields are no dates or no prices, read with a check."""
    path = scratch_folder(spark, "faulty")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        F.when(F.col("o_orderkey") % 5 == 0, F.concat("o_orderstatus", F.lit("?")))
        .when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice").cast("string"))
        .alias("o_totalprice"),
    )
    write_table(orders, path, "csv")
    return conform_checked(
        read_csv_by_header(spark, path, checked=True),
        {c: c for c in _FAULTY},
        types={"o_orderkey": "bigint", "o_totalprice": "double"},
        date_patterns={"o_orderdate": "yyyy-MM-dd"},
    )


@query("SELECT CAST(NULL AS VARCHAR) AS column, count(*) AS given, count(*) AS typed, CAST(0 AS BIGINT) AS rejected "
       "FROM orders\nUNION ALL\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}', count({text}), count({text}) FILTER (NOT ({_BAD[c]})), count({text}) FILTER ({_BAD[c]}) FROM orders"
    for c, (_, text) in _FAULTY.items()))
def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields given, typed and rejected by column: the first is the sum of the others."""
    return _faulty(spark, sf_dir).counts


@query("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, {text} AS raw, '{kind}' AS expected, count(*) AS n FROM orders "
    f"WHERE {_BAD[c]} AND {text} IS NOT NULL GROUP BY 2" for c, (kind, text) in _FAULTY.items()))
def quarantined_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text that could not be read, and how often."""
    ledger = _faulty(spark, sf_dir).ledger
    return ledger.groupBy("column", "raw", "expected").agg(F.count(F.lit(1)).alias("n"))


@query("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, '{kind}' AS expected, count(*) AS n, min({text}) AS example FROM orders "
    f"WHERE {_BAD[c]} AND {text} IS NOT NULL HAVING count(*) > 0" for c, (kind, text) in _FAULTY.items()))
def quarantine_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger by column, over all files."""
    by_file = ledger_counts(_faulty(spark, sf_dir).ledger)
    return by_file.groupBy("column", "expected").agg(F.sum("n").alias("n"), F.min("example").alias("example"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
       CASE WHEN o_orderkey % 3 <> 1 THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def csv_differing_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three folders of files: columns moved, one missing, names in capitals."""
    path = scratch_folder(spark, "csv-headers")
    orders = table(spark, sf_dir, "orders")
    key, status, priority = (F.col(c) for c in ("o_orderkey", "o_orderstatus", "o_orderpriority"))
    layouts = (
        [key, status, priority],
        [status, key],
        [priority.alias("O_ORDERPRIORITY"), key.alias("O_OrderKey"), status],
    )
    for k, layout in enumerate(layouts):
        write_table(orders.filter(key % 3 == k).select(*layout), f"{path}/{k}", "csv")
    return conform(
        read_csv_by_header(spark, path, required=["o_orderkey"]),
        {c: c for c in ("o_orderkey", "o_orderstatus", "o_orderpriority")},
    )


@query(_DAILY_SQL)
def incremental_day_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day table from two loads of files, in both of which a day may have rows."""
    base = scratch_folder(spark, "incremental")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity")
    first = F.col("l_orderkey") % 2 == 0
    days = counted_days(
        lambda spark, files: spark.read.schema(lines.schema).parquet(*files), "l_shipdate", {"l_quantity": "ppl_i"}, "crash"
    )
    for name, part in (("first", lines.filter(first)), ("second", lines.filter(~first))):
        write_table(part, f"{base}/files/{name}")
        load(spark, f"{base}/files", f"{base}/state", days)
    return read_days(spark, f"{base}/state")


@query("""
SELECT 'orders' AS target, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
UNION ALL SELECT 'lines', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM lineitem
""")
def published_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two targets published twice, each read as the second publication left it."""
    base = scratch_folder(spark, "published")
    log = CommitLog(spark, f"{base}/log")
    keys = {"orders": "o_orderkey", "lines": "l_orderkey"}
    frames = {
        name: table(spark, sf_dir, source).select(key)
        for (name, key), source in zip(keys.items(), ("orders", "lineitem"), strict=True)
    }
    publish({f"{base}/{name}": df.limit(0) for name, df in frames.items()}, log)
    publish({f"{base}/{name}": df for name, df in frames.items()}, log)
    one, two = (
        read_published(log, f"{base}/{name}").agg(
            F.lit(name).alias("target"), F.count(F.lit(1)).alias("n"), F.sum(key).alias("keys")
        )
        for name, key in keys.items()
    )
    return one.unionByName(two)
