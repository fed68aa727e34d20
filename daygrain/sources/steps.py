"""Steps of a long run whose finished tables are read again instead of made again."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.sources.commits import CommitLog
from daygrain.sources.files import input_files


def key_of(*parts) -> str:
    """A key that differs when any of the parts does."""
    return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()


def files_key(spark: SparkSession, path: str) -> str:
    """A key of the names, lengths and times of all files behind a path, none of which is opened.

    Computed where the list is: the driver gets one number for each of its parts.
    """
    each = F.xxhash64("path", "length", "modified")
    n, total, parity = input_files(spark, path).agg(
        F.count(F.lit(1)), F.sum(each.cast("decimal(20,0)")), F.bit_xor(each)
    ).first()
    return key_of(n, total, parity)


class Steps:
    """Finished steps by name and key, in a log beside their tables.

    A step is finished once its table is written whole; the record comes after that. With ``resume`` a finished
    step of the same key is not made again, and what an unfinished one has left is overwritten.
    """

    def __init__(self, spark: SparkSession, folder: str, resume: bool = False):
        self.spark, self.log, self.resume = spark, CommitLog(spark, folder), resume
        self.records = self.log.records()
        self.finished = {r["step"]: r["key"] for r in self.records} if resume else {}
        self.number = len(self.records)

    def is_finished(self, name: str, key: str) -> bool:
        return self.finished.get(name) == key

    def all_finished(self, names: Sequence[str], key: str) -> bool:
        return all(self.is_finished(name, key) for name in names)

    def keep(
        self,
        name: str,
        key: str,
        make: Callable[[], DataFrame],
        write: Callable[[DataFrame, str], object],
        mode: str,
    ) -> bool:
        """Make and write a table unless that was done; tells whether it was made now."""
        if self.is_finished(name, key):
            return False
        write(make(), "overwrite" if self.resume else mode)
        self.number = self.log.append({"step": name, "key": key}, self.number) + 1
        self.finished[name] = key
        return True
