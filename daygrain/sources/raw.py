"""The three raw data sets and the text form of correlations, typed and renamed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daygrain import fixed_values as V
from daygrain.sources.files import read_csv_by_header
from daygrain.sources.quarantine import Checked, conform_checked
from daygrain.sources.readers import conform, read_csv

#: How the raw columns of each data set are named, typed and required.
WEATHER = dict(
    names=V.WEATHER_COLUMNS,
    types={"sunrise": "int", "sunset": "int"},
    timestamp_patterns={"ts": V.WEATHER_TIMESTAMP_PATTERN},
    required=V.WEATHER_REQUIRED,
)
COLLISIONS = dict(
    names=V.COLLISION_COLUMNS,
    types={c: "int" for c in V.CASUALTIES}
    | {"latitude": "double", "longitude": "double", "collision_id": "bigint"},
    date_patterns={"crash_date": V.COLLISION_DATE_PATTERN},
    required=V.COLLISION_REQUIRED,
)
RIDERSHIP = dict(
    names=V.RIDERSHIP_COLUMNS,
    types={c: "bigint" for c in V.TRANSIT_MODES},
    date_patterns={"date": V.RIDERSHIP_DATE_PATTERN},
    required=list(V.RIDERSHIP_COLUMNS.values()),
)


def _raw(spark: SparkSession, path: str | Sequence[str], how: Mapping, checked: bool) -> DataFrame:
    needed = [raw for raw, name in how["names"].items() if name in how["required"]]
    return read_csv_by_header(spark, path, needed, checked=checked)


def _trimmed(reports: DataFrame) -> DataFrame:
    return reports.withColumn("report_type", F.trim("report_type"))


def read_weather(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Station reports, from files whose headers may differ.

    The measures stay text, since marks such as a trace sign occur. Report types
    are padded in the file and trimmed here, so that later filters on them are
    plain comparisons that Parquet can use.
    """
    return _trimmed(conform(_raw(spark, path, WEATHER, False), **WEATHER))


def read_collisions(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per collision, from files whose headers may differ."""
    return conform(_raw(spark, path, COLLISIONS, False), **COLLISIONS)


def read_ridership(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per day and a column per mode; the percentage columns stay in the file."""
    return conform(_raw(spark, path, RIDERSHIP, False), **RIDERSHIP)


def check_raw(
    spark: SparkSession, path: str | Sequence[str], how: Mapping, observation: Observation | None = None
) -> Checked:
    """A raw data set with the ledger of what could not be read; ``how`` is WEATHER, COLLISIONS or RIDERSHIP."""
    checked = conform_checked(_raw(spark, path, how, True), **how, observation=observation)
    rows = _trimmed(checked.rows) if how is WEATHER else checked.rows
    return Checked(rows, checked.ledger, checked.counts)


def read_correlations(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the form ``x | y | r``."""
    return read_csv(spark, path, "x string, y string, r double", header=False, sep=" | ")
