"""Reading the given tables, and what several operators share."""

from __future__ import annotations

import os
import site
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import daygrain
from daygrain.session import scratch_folder
from daygrain.sources import sinks

#: Bytes of text that one task is dealt where an operator chooses the number of its partitions.
TEXT_PER_TASK = 8 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package known to the Python workers, once for each application.

    Nothing is done where they find it by themselves: installed, named in PYTHONPATH, in the working
    folder, or given with ``--py-files``.
    """
    root = Path(daygrain.__file__).resolve().parents[1]
    found = ["", *os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages()]
    if not root.is_dir() or str(root) in map(os.path.realpath, found):
        return
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        archive = Path(tempfile.mkdtemp(prefix="daygrain-")) / "daygrain.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted((root / "daygrain").rglob("*.py")):
                out.write(file, file.relative_to(root))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver as a table.

    They go to Spark in Arrow's form. Of a list it makes an RDD that Python workers hand on, others than those of
    ``mapInArrow``, which then stay in the executors' memory beside these.
    """
    kinds = StructType.fromDDL(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kinds])
    columns = [pa.array(list(c)) for c in zip(*rows, strict=True)]
    return spark.createDataFrame(pa.table(columns, names=kinds.names), kinds)


#: While a copy is written: shuffle files go when nothing needs them, and rows are read and given to Python in small batches.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
}


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows read back from a copy in the shared scratch folder; frees the shuffle files behind it.

    What follows needs the copy alone, so Spark may drop the shuffle files when the write ends. Batches of whole
    texts are kept small, in the executor and in its Python workers.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    before = {key: spark.conf.get(key, None) for key in _WRITING}
    for key, value in _WRITING.items():
        spark.conf.set(key, value)
    try:
        sinks.write_table(df, path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    copy = spark.read.parquet(path)
    copy.scratch = path
    return copy


def forget(*copies: DataFrame | None) -> None:
    """Remove the files of copies that :func:`written` made and that nothing lazy needs any more."""
    for copy in copies:
        path = getattr(copy, "scratch", None)
        if path is not None:
            sinks.remove_folder(copy.sparkSession, path)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts, in one pass over that column."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def tasks_for(size: int, per_task: int = TEXT_PER_TASK, least: int = 12) -> int:
    """A number of partitions that follows the size of the input."""
    return max(least, -(-size // per_task))


__all__ = ["TEXT_PER_TASK", "forget", "ship", "small_table", "table", "tasks_for", "text_bytes", "written"]
