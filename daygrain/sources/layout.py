"""Tables laid out for what reads them: in buckets of a key, or sorted with bloom filters in their files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(
    df: DataFrame, name: str, path: str, key: str | Sequence[str], buckets: int, mode: str = "errorifexists"
) -> DataFrame:
    """Write a table of the catalog in buckets of a key, sorted by it inside, and give it back.

    Tables in as many buckets of the same key are joined, and one is regrouped by it, without an exchange. The one
    shuffle of the write puts a bucket into one file; a key that holds a great part of the rows makes its bucket
    as great, so this is for keys such as the day, whose crowd the reductions before have taken away, or for
    tables that are reduced again and again.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    writer = rows.write.format("parquet").mode(mode).option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def write_for_lookup(
    df: DataFrame, path: str, column: str, mode: str = "errorifexists", rows_per_group: int = 1_000_000
) -> DataFrame:
    """Write Parquet files sorted by a column inside, with a bloom filter of it for every row group.

    A reader that looks for some of its values skips the row groups whose bounds or bloom filter rule them out. Files
    keep the order of the input across them, so a filter by time still skips files; nothing is shuffled.
    """
    rows = df.sortWithinPartitions(column)
    writer = rows.write.mode(mode).option("parquet.block.row.count.limit", rows_per_group)
    writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
    writer.option("parquet.page.row.count.limit", min(20_000, rows_per_group)).parquet(path)
    return df.sparkSession.read.parquet(path)


def values_of(table: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with one of the values, by a comparison that the files' bounds and bloom filters can answer."""
    if len(values) == 1:
        return table.filter(F.col(column) == F.lit(values[0]))
    return table.filter(F.col(column).isin(list(values)))


def rows_read(df: DataFrame, spark: SparkSession) -> int:
    """Rows that the scans of a frame hand over when it runs: for tests and for choosing a layout."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numOutputRows"):
            total += metrics.apply("numOutputRows").value()
    return total
