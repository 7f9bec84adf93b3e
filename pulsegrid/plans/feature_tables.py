"""The whole feature plan of one set of messages, batch or micro-batch."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.documents import features_document
from pulsegrid.functions.scalars import is_filled
from pulsegrid.operators.correlation import (
    CORRELATION_COLUMNS,
    INFRA_COLUMNS,
    attach_correlation,
    correlate,
    facts,
)
from pulsegrid.operators.history import ARRIVAL, STORED_ARRIVAL
from pulsegrid.operators.joins import attach
from pulsegrid.operators.messages import history_of, read, readable, unread
from pulsegrid.operators.running import (
    WINDOWS,
    enhanced_document,
    running_features,
    sliding_document,
)
from pulsegrid.operators.snapshot import aggregated_row
from pulsegrid.session import GROUP_ROWS, materialise


# Messages with all their documents that one task joins; each has some kilobytes of text.
JOINED_ROWS = 50_000


@dataclass
class FeatureTables:
    """Results of one batch."""

    messages: DataFrame
    aggregated: DataFrame
    quarantine: DataFrame
    window_start: dt.datetime
    window_end: dt.datetime


def bounds_of(messages: DataFrame, *keys: str) -> DataFrame:
    """Earliest and latest message time per group, failing messages included."""
    return messages.groupBy(*keys).agg(F.min("ts").alias("window_start"), F.max("ts").alias("window_end"))


def batch_bounds(messages: DataFrame) -> tuple[dt.datetime | None, dt.datetime | None]:
    """Earliest and latest message time (UTC), failing messages included."""
    low, high = F.unix_micros("window_start"), F.unix_micros("window_end")
    row = bounds_of(messages).select(low.alias("low"), high.alias("high")).first()

    def instant(value: int | None) -> dt.datetime | None:
        epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
        return None if value is None else epoch + dt.timedelta(microseconds=value)

    return instant(row["low"]), instant(row["high"])


def parse_batch(messages: DataFrame) -> DataFrame:
    """Messages with their features and problems, written once: history, correlation, the
    documents and the quarantine all read from it, each only the columns it needs.

    Nearly all its text differs from row to row, so the writer keeps no dictionaries."""
    return materialise(read(messages), "parsed", **{"parquet.enable.dictionary": "false"})


def _spread(df: DataFrame, messages: int) -> DataFrame:
    """One row a message by (topic, seq), in parts that grow in number with the messages where the session's
    shuffle partitions would grow in size; few messages are left to the session."""
    parts = -(-messages // JOINED_ROWS)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, "topic", "seq") if parts > usual else df


def correlation_document():
    """JSON of a topic's correlation row; '' where the topic had no features."""
    fields = F.struct(*CORRELATION_COLUMNS, *INFRA_COLUMNS)
    known = F.col("error_density").isNotNull()
    return F.when(known, F.to_json(fields)).otherwise(F.lit(""))


def build(
    messages: DataFrame,
    batch_id: int = 0,
    parsed: DataFrame | None = None,
    history: DataFrame | None = None,
    bounds: tuple[dt.datetime, dt.datetime] | None = None,
    history_limit: int | None = None,
    group_rows: int = GROUP_ROWS,
    scored: DataFrame | None = None,
) -> FeatureTables:
    """Feature tables of `messages`.

    `scored` gives messages (topic, seq) the correlation row of their own group, a service say; by
    default all messages of a topic carry that of the topic.

    `history` is what the frames may reach back to, this batch included; by
    default it is the batch alone. Pass `parsed` when parse_batch was already run.
    """
    whole = parse_batch(messages) if parsed is None else parsed
    window_start, window_end = bounds or batch_bounds(whole)  # the source is read by the parse alone
    parsed = readable(whole)
    alone = history is None
    if alone:
        history = materialise(history_of(parsed), "history")  # counted, placed and aggregated from one table
    else:  # stored history also holds topics this batch has no message of
        topics = messages.select("topic").distinct()
        history = attach(history, topics, ["topic"], spread_by=["seq", "pos"], how="left_semi")

    running = running_features(
        history, parsed, WINDOWS, history_limit=history_limit, group_rows=group_rows
    ).select(
        "topic",
        "seq",
        enhanced_document().alias("enhanced_features"),
        sliding_document().alias("sliding_features"),
    )
    size = whole.count()  # read from the files' footers
    rows = parsed.select(
        "topic",
        "value",
        "ts",
        "seq",
        features_document(F.col("logs"), F.col("traces"), F.col("metrics")).alias("features"),
    )
    rows = _spread(rows, size).join(_spread(running, size), ["topic", "seq"], "left")
    document = correlation_document().alias("correlation_features")
    if scored is None:
        rows = attach_correlation(rows, correlate(facts(parsed)).select("topic", document))
    else:
        rows = rows.join(scored.select("topic", "seq", document), ["topic", "seq"], "left")
    rows = rows.select(
        "topic",
        "value",
        "ts",
        "seq",
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(window_start).cast("timestamp").alias("window_start"),
        F.lit(window_end).cast("timestamp").alias("window_end"),
        "features",
        *[
            F.coalesce(c, F.lit("")).alias(c)
            for c in ("enhanced_features", "sliding_features", "correlation_features")
        ],
    )
    aggregated = aggregated_row(
        history,
        window_start,
        window_end,
        history_limit=history_limit,
        group_rows=group_rows,
        arrival=ARRIVAL if alone else STORED_ARRIVAL,
    )
    return FeatureTables(rows, aggregated, unread(whole), window_start, window_end)


def _document_counts() -> list[Column]:
    def holding(name: str):
        return F.count_if(F.contains("features", F.lit(f'"{name}":')))

    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_filled(F.col("features"))).alias("with_features"),
        F.count_if(is_filled(F.col("enhanced_features"))).alias("with_enhanced"),
        F.count_if(is_filled(F.col("sliding_features"))).alias("with_sliding"),
        F.count_if(is_filled(F.col("correlation_features"))).alias("with_correlation"),
        holding("logs").alias("logs"),
        holding("traces").alias("traces"),
        holding("metrics").alias("metrics"),
    ]


COUNTS = ("total", "with_features", "with_enhanced", "with_sliding", "with_correlation", "logs", "traces", "metrics")


def batch_summary(stored: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """How many stored messages carry which documents and signals."""
    return stored.groupBy(*keys).agg(*_document_counts())


def topic_distribution(stored: DataFrame) -> DataFrame:
    """Stored messages per batch and topic."""
    return stored.groupBy("batch_id", "topic").agg(F.count(F.lit(1)).alias("messages"))


# ---- roll-ups: one row per batch and topic, written with the batch -----------------


def batch_rollup(stored: DataFrame) -> DataFrame:
    """Counts and time ranges of stored messages per day folder, batch and topic.

    A handful of rows a batch. Serving merges them and reads no message again.
    """
    return stored.groupBy("date", "batch_id", "topic").agg(
        *_document_counts(),
        F.min("ts").alias("first_message"),
        F.max("ts").alias("last_message"),
        F.min("processed_at").alias("first_processed"),
        F.max("processed_at").alias("last_processed"),
    )


def merged_summary(rollup: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The same row as `batch_summary`, from roll-ups; zeros where there are none."""
    return rollup.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])


def merged_distribution(rollup: DataFrame) -> DataFrame:
    """The same rows as `topic_distribution`, from roll-ups."""
    return rollup.groupBy("batch_id", "topic").agg(F.sum("total").alias("messages"))
