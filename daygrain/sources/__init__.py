"""Readers for the raw files and the tables between steps, and writers."""

from daygrain.sources.commits import CommitLog, publish, read_published
from daygrain.sources.files import input_files, read_csv_by_header
from daygrain.sources.layout import rows_read, values_of, write_bucketed, write_for_lookup
from daygrain.sources.quarantine import Checked, conform_checked, ledger_counts, observed_counts
from daygrain.sources.raw import (
    COLLISIONS,
    RIDERSHIP,
    WEATHER,
    check_raw,
    read_collisions,
    read_correlations,
    read_ridership,
    read_weather,
)
from daygrain.sources.readers import conform, read_csv, read_csv_text, read_table
from daygrain.sources.sinks import scratch_copy, write_table, write_to_all, written

__all__ = [
    "COLLISIONS", "Checked", "CommitLog", "RIDERSHIP", "WEATHER", "check_raw", "conform", "conform_checked", "input_files",
    "ledger_counts", "observed_counts", "publish", "read_published", "read_collisions", "read_correlations", "read_csv", "read_csv_by_header", "read_csv_text",
    "read_ridership", "read_table", "read_weather", "rows_read", "scratch_copy", "values_of", "write_bucketed", "write_for_lookup", "write_table", "write_to_all", "written",
]
