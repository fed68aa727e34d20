"""The files behind a path, and CSV files whose headers differ."""

from __future__ import annotations

import csv
from collections.abc import Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Columns of a checked read beside those of the files: where a row comes from, and its text if it is malformed.
FILE, MALFORMED = "_file", "_malformed"


def input_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path, length, modified`` of every data file behind a file, folder, glob or a list of them; none is opened."""
    paths = path if isinstance(path, str) else list(path)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, compressed or not; empty if the file is."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(conf).open(file)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
        content = codec.createInputStream(stream) if codec is not None else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, "UTF-8")).readLine()
    finally:
        stream.close()
    return (line or "").removeprefix("\ufeff")


def files_by_header(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Names in a header line -> the files that start with it; empty files are left out.

    The driver reads one line of every file.
    """
    files = sorted(r.path for r in input_files(spark, path).filter("length > 0").select("path").collect())
    with ThreadPoolExecutor(16) as threads:
        lines = list(threads.map(lambda f: first_line(spark, f), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        names = tuple(next(csv.reader([line], delimiter=sep), ()))
        lowered = [n.lower() for n in names]
        if len(set(lowered)) < len(lowered):
            raise ValueError(f"{file} names a column twice: {line}")
        groups.setdefault(names, []).append(file)
    return groups


def read_csv_by_header(
    spark: SparkSession,
    path: str | Sequence[str],
    required: Collection[str] = (),
    sep: str = ",",
    multiline: bool = False,
    checked: bool = False,
) -> DataFrame:
    """Header CSV with every column as text, from files whose columns may be others or in another order.

    Files with the same header are read together, each group with its own schema, and joined by name
    without regard to case; the spelling that comes first in the order of the files stays. A column that a
    file lacks is null in its rows; a file without one of the ``required`` columns is refused. The plan has a
    scan for each different header, not for each file.

    With ``checked`` the column ``_file`` tells where a row comes from, and ``_malformed`` has the text of a record
    with too many or too few fields, of which no field can be trusted.
    """
    groups = files_by_header(spark, path, sep)
    if not groups:
        raise ValueError(f"no file with a header line in {path}")
    spelling: dict[str, str] = {}
    frames = []
    for names, files in groups.items():
        missing = [r for r in required if r.lower() not in {n.lower() for n in names}]
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(map(repr, missing))}")
        fields = [StructField(n, StringType()) for n in names]
        schema = StructType([*fields, StructField(MALFORMED, StringType())]) if checked else StructType(fields)
        reader = spark.read.schema(schema).option("header", True).option("sep", sep).option("multiLine", multiline)
        if checked:
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
        rows = reader.csv(files)
        columns = [F.col(_quoted(n)).alias(spelling.setdefault(n.lower(), n)) for n in names]
        if checked:
            # whether a record is whole shows only if all its fields are read: the condition always holds
            whole = F.hash(*[F.col(_quoted(n)) for n in names]) >= F.lit(-(1 << 31))
            columns += [F.when(whole, F.col(MALFORMED)).alias(MALFORMED), F.col("_metadata.file_path").alias(FILE)]
        frames.append(rows.select(*columns))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
