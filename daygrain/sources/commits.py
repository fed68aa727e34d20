"""A log of small records, each of which appears at once or not at all, and tables that appear together.

What a job writes counts from the moment a record of the log names it: a job that fails before leaves folders
that no reader looks at, and a later one takes other names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from daygrain.sources.readers import read_csv_text, read_table
from daygrain.sources.sinks import write_table


@dataclass(frozen=True)
class CommitLog:
    """Records in a folder, numbered from 0 without gaps."""

    spark: SparkSession
    folder: str

    def _path(self, name: str = ""):
        jvm = self.spark._jvm
        return jvm.org.apache.hadoop.fs.Path(f"{self.folder.rstrip('/')}/{name}" if name else self.folder)

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def records(self) -> list[dict]:
        """All records in order."""
        files, folder = self._files(), self._path()
        if not files.exists(folder):
            return []
        found = (s.getPath().getName() for s in files.listStatus(folder))
        numbers = sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json") and n[0].isdigit())
        return [json.loads(self._read(f"{n:012d}.json")) for n in numbers]

    def _read(self, name: str) -> str:
        stream = self._files().open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def append(self, record: Mapping, number: int | None = None) -> int:
        """Add a record and give its number; fails if another job has taken ``number`` meanwhile.

        The record is written under another name and renamed, which a file system does at once.
        """
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        number = len(self.records()) if number is None else number
        staged = self._path(f"_staged-{uuid.uuid4().hex}")
        out = self._files().create(staged, True)
        try:
            out.write(bytearray(json.dumps(dict(record)).encode()))
        finally:
            out.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path().toUri(), conf)
        try:
            context.rename(staged, self._path(f"{number:012d}.json"), options)
        except Exception as error:
            self._files().delete(staged, False)
            raise FileExistsError(f"record {number} of {self.folder} is another job's") from error
        return number


def _plain(path: str) -> str:
    return path.rstrip("/")


def publish(
    frames: Mapping[str, DataFrame], log: CommitLog, fmt: str = "parquet", **options
) -> str:
    """Write several tables, by target path, that readers see together or not at all; gives their version.

    Every table goes to a folder of its own below its target, and one record of the log names them all at the
    end. Until then, and after a failure at any point, readers get what the record before named.
    """
    version, number = uuid.uuid4().hex, len(log.records())
    targets = {}
    for target, df in frames.items():
        path = f"{_plain(target)}/version-{version}"
        write_table(df, path, fmt, **options)
        targets[_plain(target)] = path
    log.append({"version": version, "targets": targets, "fmt": fmt}, number)
    return version


def read_published(log: CommitLog, target: str) -> DataFrame:
    """A target as the last complete publication left it; CSV comes as text by name."""
    for record in reversed(log.records()):
        if _plain(target) in record.get("targets", {}):
            path = record["targets"][_plain(target)]
            if record["fmt"] == "csv":
                return read_csv_text(log.spark, path)
            return read_table(log.spark, path, record["fmt"])
    raise FileNotFoundError(f"{target} was never published in {log.folder}")
