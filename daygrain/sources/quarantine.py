"""Fields and records that could not be read, beside the typed table instead of a silent null."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from daygrain.sources.files import FILE, MALFORMED
from daygrain.sources.readers import typed_columns

LEDGER_SCHEMA = "file string, column string, raw string, expected string"
#: What a malformed record should have been.
RECORD = "a record with the fields of its header"


@dataclass(frozen=True)
class Checked:
    """A typed table, the ledger of what it lacks, and the counts of both by column, all lazy."""

    rows: DataFrame
    ledger: DataFrame
    counts: DataFrame


def conform_checked(
    df: DataFrame,
    names: Mapping[str, str],
    types: Mapping[str, str] | None = None,
    date_patterns: Mapping[str, str] | None = None,
    timestamp_patterns: Mapping[str, str] | None = None,
    required: Collection[str] = (),
    observation: Observation | None = None,
) -> Checked:
    """As :func:`daygrain.sources.conform` on a checked read, and what did not fit.

    ``rows`` has the well-formed records, with null for a field that does not fit its type. ``ledger`` has a
    row ``file, column, raw, expected`` for each such field, and one without a column for each malformed record,
    which is in no other part. ``counts`` has ``column, given, typed, rejected`` over the well-formed records, and a
    row without a column for the records themselves: given = typed + rejected in each.

    The three are computed from the files each; the ledger is as long as there are faults, and ``counts`` is one
    aggregation in a scan. An ``observation`` gathers the same counts while ``rows`` are written, without a scan of
    its own: see :func:`observed_counts`.
    """
    pairs = typed_columns(df, names, types, date_patterns, timestamp_patterns, required)
    sound = F.col(MALFORMED).isNull()
    seen = df if observation is None else df.observe(observation, *_sums(pairs, sound))
    rows = seen.filter(sound).select(*[typed.alias(name) for name, (_, typed, _) in pairs.items()])

    def fault(column: Column, raw: Column, expected: str) -> Column:
        return F.struct(column.alias("column"), raw.alias("raw"), F.lit(expected).alias("expected"))

    nowhere = F.lit(None).cast("string")
    faults = [F.when(~sound, fault(nowhere, F.col(MALFORMED), RECORD))]
    for name, (raw, typed, expected) in pairs.items():
        if expected != "string":
            faults.append(F.when(sound & raw.isNotNull() & typed.isNull(), fault(F.lit(name), raw, expected)))
    listed = F.filter(F.array(*faults), lambda f: f.isNotNull())
    ledger = df.select(F.col(FILE).alias("file"), F.explode(listed).alias("fault")).select("file", "fault.*")
    return Checked(rows, ledger, _counts(df, pairs, sound))


def _sums(pairs: Mapping[str, tuple[Column, Column, str]], sound: Column) -> list[Column]:
    sums = [F.count(F.lit(1)).alias("given"), F.count_if(sound).alias("typed")]
    for i, (raw, typed, _) in enumerate(pairs.values()):
        sums.append(F.count_if(sound & raw.isNotNull()).alias(f"given_{i}"))
        sums.append(F.count_if(sound & typed.isNotNull()).alias(f"typed_{i}"))
    return sums


def _counts(df: DataFrame, pairs: Mapping[str, tuple[Column, Column, str]], sound: Column) -> DataFrame:
    entries = [F.struct(F.lit(None).cast("string").alias("column"), F.col("given"), F.col("typed"))]
    for i, name in enumerate(pairs):
        entries.append(
            F.struct(F.lit(name).alias("column"), F.col(f"given_{i}").alias("given"), F.col(f"typed_{i}").alias("typed"))
        )
    each = df.agg(*_sums(pairs, sound)).select(F.explode(F.array(*entries)).alias("of")).select("of.*")
    return each.withColumn("rejected", F.col("given") - F.col("typed"))


def observed_counts(observation: Observation, names: Mapping[str, str]) -> list[tuple[str | None, int, int, int]]:
    """``column, given, typed, rejected`` as gathered while the rows were written; waits until they are."""
    found = observation.get
    columns = [(None, ""), *((name, f"_{i}") for i, name in enumerate(names.values()))]
    counts = ((c, found[f"given{end}"], found[f"typed{end}"]) for c, end in columns)
    return [(c, given, typed, given - typed) for c, given, typed in counts]


def ledger_counts(ledger: DataFrame) -> DataFrame:
    """``file, column, expected, n, example``: how often, and the least of the texts."""
    return ledger.groupBy("file", "column", "expected").agg(
        F.count(F.lit(1)).alias("n"), F.min("raw").alias("example")
    )
