"""Writers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.session import scratch_folder
from daygrain.sources.readers import read_table


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    order_by: Sequence[str] | None = None,
    single_file: bool = False,
    partition_by: Sequence[str] | None = None,
) -> str:
    """Write a table, with a header line if it is CSV; give the path back.

    ``single_file`` sends all rows through one task, so it is meant for day-grain
    tables. Without it the files are written in parallel, and ``order_by`` sorts
    across them. With ``partition_by`` rows are first brought together by folder,
    so that tasks do not each leave a small file in every folder; a crowded
    folder is split over several tasks, and ``order_by`` sorts within a file.
    """
    order = list(order_by or [])
    if single_file:
        df = df.repartition(1)
    elif partition_by:
        df = df.hint("rebalance", *map(F.col, partition_by))
        order = [*partition_by, *order] if order else []
    elif order:
        df = df.orderBy(*order)
    if order and (single_file or partition_by):
        df = df.sortWithinPartitions(*order)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        # blanks around a value belong to it
        writer = writer.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows read from a copy in the shared scratch folder.

    Runs the plan. What follows no longer depends on the tasks that made the
    rows, so several uses, or the loss of an executor, do not repeat them.
    """
    spark = df.sparkSession
    return read_table(spark, write_table(df, scratch_folder(spark, name)))


@contextmanager
def scratch_copy(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As :func:`written`, and removed when the block ends: nothing lazy may need it after that."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    try:
        yield read_table(spark, write_table(df, path))
    finally:
        remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing lazy needs any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_to_all(df: DataFrame, paths: Sequence[str], fmt: str = "csv", **options) -> list[str]:
    """Write one frame to several targets, each with the same rows.

    The plan runs once, into a scratch copy that keeps types and texts as they are;
    every target is filled from it, so nothing has to fit in memory and a lost
    executor costs no recomputation.
    """
    with scratch_copy(df, "targets") as copy:
        for path in paths:
            write_table(copy, path, fmt, **options)
    return list(paths)
