"""Session helpers: a local session for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("daygrain")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder path for a table written between two steps.

    It lies in the shared folder named by ``spark.checkpoint.dir``, so any
    executor can write it and read it back. Only a local session may go without
    that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/daygrain/{name}-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="daygrain-")
