"""Session settings and durable scratch space.

Everything here works on a session somebody else built: `configure` only sets
runtime SQL options, and scratch tables go to the folder the cluster names in
`spark.checkpoint.dir`, so they survive the loss of an executor.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# A side with at most this many rows may be broadcast (rows here are a few
# hundred bytes at most, so this stays far below the 8 GB broadcast limit).
BROADCAST_ROWS = 200_000

# A group with at most this many rows may be sorted by one task (sorts spill).
# Larger groups take the distributed paths.
GROUP_ROWS = 1_000_000

# The same for exact percentile buffers, which live in memory, up to 128 groups of
# a task at a time.
PERCENTILE_ROWS = 100_000

_SQL_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # repeated keys are valid JSON; the last one counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    # newest-N of 10,000 per group is cut in every map task, before the shuffle
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
}

# Fixed when a session starts. Call-site capture costs several driver round trips
# per column expression, about a second per plan here.
_START_OPTIONS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators rely on: UTC clock, last duplicate key wins."""
    for key, value in _SQL_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "pulsegrid", cores: str = "*", **options: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**_SQL_OPTIONS, **_START_OPTIONS, **options}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for scratch tables of this application."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="pulsegrid-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/pulsegrid/{spark.sparkContext.applicationId}"


_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are dropped at the end, when nothing reads them any more."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            delete_path(spark, path)


@contextmanager
def files_at_once(spark: SparkSession, files: int) -> Iterator[None]:
    """Writes inside keep up to so many partition folders open per task in place of sorting rows by
    folder; a task that meets more sorts the rest."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(files))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialise(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Write `df` once as a scratch table and read it back; `options` are those of the Parquet writer.

    Cuts lineage durably: several consumers see identical rows whatever is
    retried, and none of them recomputes the source.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a table folder through the cluster's file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def clear_scratch(spark: SparkSession) -> None:
    """Drop every scratch table this application wrote."""
    delete_path(spark, scratch_root(spark))
