"""How many rows Spark hands to a Python worker at a time."""

from __future__ import annotations

from pyspark.sql import SparkSession

_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Texts in a batch: with megabytes each, still far below Arrow's 2 GB for a column.
TEXTS = 500


def small_batches(spark: SparkSession, rows: int = TEXTS) -> None:
    """Lower the session's rows per Arrow batch to `rows`; a lower setting stays.

    Batches are bounded by rows alone, and plans are run later than they are made, so this is a
    setting of the session and stays set.
    """
    now = int(spark.conf.get(_ROWS))
    if now <= 0 or now > rows:
        spark.conf.set(_ROWS, rows)


def small_bytes(spark: SparkSession, size: int = 16 << 20) -> None:
    """The same for the bytes of a batch, for rows that hold whole packs of texts."""
    now = int(spark.conf.get(_BYTES).removesuffix("b"))
    if now <= 0 or now > size:
        spark.conf.set(_BYTES, f"{size}b")
