"""Stored tables and outgoing messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid import schemas
from pulsegrid.session import files_at_once

# Routes times signals that one task writes side by side; lines need no buffer but a file's own.
ROUTED_FILES = 64

# How routed lines are stored. They repeat keys and attributes, so even the fastest level leaves a small part of them.
# Readers of text open such files by their name; a file is read whole, and has one task's lines of one route.
LINES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def conform(df: DataFrame, schema: T.StructType, whole_seconds: bool = False) -> DataFrame:
    """Exactly the columns of a stored table; `processed_at` defaults to now, missing
    documents to ''. `whole_seconds` cuts times for stores without fractions."""
    if "processed_at" not in df.columns:
        df = df.withColumn("processed_at", F.current_timestamp())
    columns = []
    for field in schema.fields:
        present = field.name in df.columns
        column = F.col(field.name) if present else F.lit(None)
        column = column.cast(field.dataType)
        if field.name.endswith("features"):
            column = F.coalesce(column, F.lit(""))
        if whole_seconds and isinstance(field.dataType, T.TimestampType):
            column = F.date_trunc("second", column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _gathered(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows of one folder in one task: else each task writes a file into every folder, and files grow
    with tasks times folders. The number of tasks is fixed, since folders cost time however small they are."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *by)


def _write_batch(df: DataFrame, path: str, order: list[str], by: list[str]) -> None:
    (
        # the writer wants rows by folder; sorted so from the start they keep their order inside
        df.sortWithinPartitions(*by, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_messages(df: DataFrame, path: str, whole_seconds: bool = False, many_batches: bool = False) -> None:
    """Message rows with their feature documents, partitioned by day and batch.

    Writing a batch again replaces that batch. With `many_batches`, say when stored messages are written anew,
    the rows of a batch are brought together first; those of one batch are written by the tasks that have them.
    """
    rows = conform(df, schemas.MESSAGES, whole_seconds).withColumn("date", F.to_date("window_start"))
    by = ["date", "batch_id"]
    _write_batch(_gathered(rows, by) if many_batches else rows, path, ["ts", "topic"], by)


def write_aggregated(df: DataFrame, path: str, batch_id: int, whole_seconds: bool = False) -> None:
    """Per-topic rows of a batch, same rules. There is one row per topic: one file."""
    rows = conform(df, schemas.AGGREGATED, whole_seconds)
    rows = rows.withColumn("date", F.to_date("window_start"))
    rows = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    _write_batch(rows, path, ["window_start", "topic"], ["date", "batch_id"])


def write_batch_table(df: DataFrame, path: str, batch_id: int) -> None:
    """Any other table of a batch (quarantine, summary), replaced when replayed."""
    rows = df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "batch_id"
    ).parquet(path)


def write_rollups(df: DataFrame, path: str) -> None:
    """Roll-ups of any batches, in the layout `write_batch_table` gives to those of one."""
    rows = _gathered(df, ["batch_id"])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def outgoing(routed: DataFrame) -> DataFrame:
    """Routed messages that go to a topic, as Kafka records."""
    rows = routed.filter("dest_topic IS NOT NULL")
    return rows.select(F.col("dest_topic").alias("topic"), "value")


def write_kafka(routed: DataFrame, servers: str) -> None:
    """Send routed messages to their topics."""
    outgoing(routed).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_routed(routed: DataFrame, path: str, batch_id: int) -> None:
    """Routed messages of a batch as JSON lines (gzip), one folder per batch, route and signal.

    Writing a batch again replaces all of it, also routes that it no longer has.
    """
    rows = routed.select("route", "signal", "value")
    with files_at_once(rows.sparkSession, ROUTED_FILES):
        writer = rows.write.mode("overwrite").options(**LINES).partitionBy("route", "signal")
        writer.text(f"{path.rstrip('/')}/batch_id={batch_id}")


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    """What `write_routed` wrote: value, batch_id, route, signal. Filters on the last three open their folders only."""
    return spark.read.schema("value string, batch_id bigint, route string, signal string").text(path)


def append_files(routed: DataFrame, path: str) -> None:
    """Append routed messages as JSON lines (gzip), one folder per route and signal."""
    rows = routed.select("route", "signal", "value")
    with files_at_once(rows.sparkSession, ROUTED_FILES):
        rows.write.mode("append").options(**LINES).partitionBy("route", "signal").text(path)
