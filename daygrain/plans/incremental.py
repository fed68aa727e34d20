"""Day tables that grow by files: a load reads the new files alone and rewrites the months they touch.

The events of some files are reduced to partial rows by day, whose columns can be combined with those of
other files: numbers and sums add up, bounds and flags combine. Partial rows are kept by load, and a log names the
files of each load. The day table is combined from the partial rows of all loads, for the months that a load
has days in; its folders are months, which a dynamic overwrite replaces one by one.

A load that fails is done again from where it was: partial rows count once the log names them, and a load whose
months were not rewritten yet is rewritten by the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain import fixed_values as V
from daygrain.operators import daily_counts_and_sums
from daygrain.plans import collisions, weather
from daygrain.sources import input_files, read_collisions, read_table, read_weather
from daygrain.sources.commits import CommitLog


@dataclass(frozen=True)
class DayTable:
    """How a day table is made from files in parts.

    ``partial`` gives ``date`` and columns that ``merge`` names with the aggregate that combines them; ``finish``
    takes the combined rows.
    """

    read: Callable[[SparkSession, Sequence[str]], DataFrame]
    partial: Callable[[DataFrame], DataFrame]
    merge: Mapping[str, Callable[[str], Column]]
    finish: Callable[[DataFrame], DataFrame]


#: Days with temperatures and conditions, as ``weather.weather_days`` gives them.
WEATHER_DAYS = DayTable(
    read=read_weather,
    partial=weather.partial_days,
    merge={
        "min_t": F.min, "max_t": F.max, "sum_t": F.sum, "n_t": F.sum, "sunrise": F.min, "sunset": F.max,
        **{flag: F.bool_or for flag in [*V.CONDITION_CODES, "has_hourly", "has_summary"]},
    },
    finish=weather.with_mean,
)

#: Collisions and casualties by day, as ``collisions.daily`` gives them.
COLLISION_DAYS = DayTable(
    read=read_collisions,
    partial=collisions.daily,
    merge={"crash": F.sum, **{c: F.sum for c in V.CASUALTIES}},
    finish=lambda days: days,
)


def counted_days(
    read: Callable[[SparkSession, Sequence[str]], DataFrame], ts: str, sums: Mapping[str, str], count: str = "n"
) -> DayTable:
    """A day table of row counts and column sums of any files."""
    return DayTable(
        read=read,
        partial=lambda df: daily_counts_and_sums(df, ts, dict(sums), count=count),
        merge={count: F.sum, **{name: F.sum for name in sums.values()}},
        finish=lambda days: days,
    )


def _months(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year("date"), "month": F.month("date")})


def _combined(partials: DataFrame, table: DayTable) -> DataFrame:
    merged = [how(c).alias(c) for c, how in table.merge.items()]
    return table.finish(partials.groupBy("date").agg(*merged))


def new_files(spark: SparkSession, source: str | Sequence[str], log: CommitLog) -> list[str]:
    """Files that no load has taken. A file that a load has taken and that has changed since is refused."""
    taken = {f["path"]: f for r in log.records() if r["kind"] == "load" for f in r["files"]}
    found = {r.path: (r.length, r.modified.isoformat()) for r in input_files(spark, source).collect()}
    changed = [p for p, seen in found.items() if p in taken and seen != (taken[p]["length"], taken[p]["modified"])]
    if changed:
        raise ValueError(f"{changed[0]} was loaded and has changed since; load it under another name into a new folder")
    return sorted(found.keys() - taken.keys())


def load(spark: SparkSession, source: str | Sequence[str], state: str, table: DayTable) -> list[str]:
    """Take the files that are new in ``source`` into the day table below ``state``; gives these files.

    The list of files is on the driver, rows are not. Two loads of one state must not run at once: the second to
    finish is refused.
    """
    log = CommitLog(spark, f"{state}/log")
    files = new_files(spark, source, log)
    if files:
        seen = {r.path: r for r in input_files(spark, files).collect()}
        number = len(log.records())
        part = _months(table.partial(table.read(spark, files)))
        path = f"{state}/partials/load={number}"
        part.write.mode("overwrite").parquet(path)
        entries = [{"path": p, "length": seen[p].length, "modified": seen[p].modified.isoformat()} for p in files]
        log.append({"kind": "load", "files": entries, "partials": path}, number)
    refresh(spark, state, table)
    return files


def refresh(spark: SparkSession, state: str, table: DayTable) -> None:
    """Rewrite the months of loads that the day table lacks."""
    log = CommitLog(spark, f"{state}/log")
    records = log.records()
    loads = [r["partials"] for r in records if r["kind"] == "load"]
    done = max((r["loads"] for r in records if r["kind"] == "refresh"), default=0)
    if len(loads) == done:
        return
    partials = spark.read.parquet(*loads)
    touched = spark.read.parquet(*loads[done:]).select("year", "month").distinct()
    days = partials.join(touched, ["year", "month"], "left_semi") if done else partials
    whole = _months(_combined(days, table)).repartition("year", "month").sortWithinPartitions("year", "month", "date")
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(f"{state}/days")
    log.append({"kind": "refresh", "loads": len(loads)}, len(records))


def read_days(spark: SparkSession, state: str) -> DataFrame:
    """The day table of all loads."""
    return read_table(spark, f"{state}/days").drop("year", "month")
