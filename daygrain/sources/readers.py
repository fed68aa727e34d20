"""CSV and table readers.

A path may be a file, a folder or a glob; every data file in a folder is read.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daygrain.functions.calendar import parse_date, parse_timestamp


def read_csv_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Header CSV with every column as text; names come from the header line.

    ``multiline`` is for files with line breaks inside quotes, such as
    :func:`daygrain.sources.write_table` leaves for texts that hold some; a file is
    then read by one task.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .csv(path)
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    date_pattern: str | None = None,
    header: bool = True,
    sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """Typed CSV; a field that does not fit its type is null.

    Give the schema for anything large: without one Spark reads the files once
    more to infer it. With a header, the names in every file must agree with the
    schema, rather than being matched by position. ``multiline`` as in
    :func:`read_csv_text`.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("multiLine", multiline)
    if date_pattern:
        reader = reader.option("dateFormat", date_pattern)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", not header).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def conform(
    df: DataFrame,
    names: Mapping[str, str],
    types: Mapping[str, str] | None = None,
    date_patterns: Mapping[str, str] | None = None,
    timestamp_patterns: Mapping[str, str] | None = None,
    required: Collection[str] = (),
) -> DataFrame:
    """Pick raw columns by name, rename and type them, and leave the rest in the file.

    Names match without regard to case. A raw column that the file lacks becomes
    null, unless its new name is required; a value that does not fit its type
    becomes null.
    """
    pairs = typed_columns(df, names, types, date_patterns, timestamp_patterns, required)
    return df.select(*[typed.alias(name) for name, (_, typed, _) in pairs.items()])


def typed_columns(
    df: DataFrame,
    names: Mapping[str, str],
    types: Mapping[str, str] | None = None,
    date_patterns: Mapping[str, str] | None = None,
    timestamp_patterns: Mapping[str, str] | None = None,
    required: Collection[str] = (),
) -> dict[str, tuple[Column, Column, str]]:
    """New name -> raw text, typed value and what the text should be, as :func:`conform` picks them."""
    types = types or {}
    date_patterns = date_patterns or {}
    timestamp_patterns = timestamp_patterns or {}
    present = {c.lower(): c for c in df.columns}
    missing = [r for r, name in names.items() if name in required and r.lower() not in present]
    if missing:
        raise ValueError(f"the file has no column {', '.join(map(repr, missing))}")

    def both(raw: str, name: str) -> tuple[Column, Column, str]:
        found = present.get(raw.lower())
        value = F.col("`" + found.replace("`", "``") + "`") if found else F.lit(None).cast("string")
        if name in date_patterns:
            return value, parse_date(value, date_patterns[name]), f"date {date_patterns[name]}"
        if name in timestamp_patterns:
            pattern = timestamp_patterns[name]
            return value, parse_timestamp(value, pattern), f"timestamp {pattern}"
        kind = types.get(name, "string")
        return value, value.try_cast(kind), kind

    return {name: both(raw, name) for raw, name in names.items()}
