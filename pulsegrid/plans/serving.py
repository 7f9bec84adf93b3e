"""Queries over the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.scalars import is_filled, iso, json_float, present
from pulsegrid.operators.snapshot import error_flag
from pulsegrid.plans.feature_tables import batch_summary, merged_summary


def _instant(as_of) -> Column:
    """The query's clock: a column, a literal, or now when not given."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def _since(as_of, hours: int) -> Column:
    return _instant(as_of) - F.make_dt_interval(hours=F.lit(hours))


def topic_catalogue(stored: DataFrame) -> DataFrame:
    """All topics with message counts, time range, batches and document counts."""
    return (
        stored.groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("total_messages"),
            F.min("ts").alias("first_message"),
            F.max("ts").alias("last_message"),
            F.count_distinct("batch_id").alias("batch_count"),
            F.count_if(is_filled(F.col("features"))).alias("messages_with_features"),
            F.count_if(is_filled(F.col("enhanced_features"))).alias("messages_with_enhanced_features"),
            F.count_if(is_filled(F.col("sliding_features"))).alias("messages_with_sliding_features"),
        )
        .orderBy(F.desc("total_messages"), "topic")
    )


def rolled_catalogue(rollup: DataFrame) -> DataFrame:
    """The rows of `topic_catalogue` from the roll-ups of all batches; no message is read.

    Batches of a topic are counted after grouping by them: a plain sum, however many there are.
    """
    batches = rollup.groupBy("topic", "batch_id").agg(
        *[F.sum(c).alias(c) for c in ("total", "with_features", "with_enhanced", "with_sliding")],
        F.min("first_message").alias("first_message"),
        F.max("last_message").alias("last_message"),
    )
    return (
        batches.groupBy("topic")
        .agg(
            F.sum("total").alias("total_messages"),
            F.min("first_message").alias("first_message"),
            F.max("last_message").alias("last_message"),
            F.count(F.lit(1)).alias("batch_count"),
            F.sum("with_features").alias("messages_with_features"),
            F.sum("with_enhanced").alias("messages_with_enhanced_features"),
            F.sum("with_sliding").alias("messages_with_sliding_features"),
        )
        .orderBy(F.desc("total_messages"), "topic")
    )


def enhanced_stats(stored: DataFrame, as_of=None, hours: int = 1, rollup: DataFrame | None = None) -> DataFrame:
    """Per-topic averages of what was processed in the last hour.

    A message without the document counts as 0 in the averages. With the roll-ups of a stored
    table only folders of batches that were processed since are opened.
    """
    since = _since(as_of, hours)
    recent = stored.filter(F.col("processed_at") >= since)
    if rollup is not None:
        folders = rollup.filter(F.col("last_processed") >= since).select("date", "batch_id").distinct()
        recent = recent.join(folders, ["date", "batch_id"], "left_semi")
    return (
        recent.groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("total_messages"),
            F.count_if(is_filled(F.col("enhanced_features"))).alias("enhanced_count"),
            F.count_if(is_filled(F.col("sliding_features"))).alias("sliding_count"),
            F.count_if(is_filled(F.col("correlation_features"))).alias("correlation_count"),
            F.avg(json_float(F.col("enhanced_features"), "messages_per_minute")).alias("avg_msg_rate"),
            F.avg(json_float(F.col("enhanced_features"), "error_rate")).alias("avg_error_rate"),
            F.min("ts").alias("earliest_message"),
            F.max("ts").alias("latest_message"),
        )
        .orderBy(F.desc("total_messages"), "topic")
    )


def trends(
    aggregated: DataFrame, topic: str, as_of=None, hours: int = 6, limit: int = 50
) -> DataFrame:
    """The newest rows of one topic in the last hours, newest first.

    A stored table is partitioned by the day of `window_start`; earlier days are not opened.
    """
    since = _since(as_of, hours)
    mine = aggregated.filter((F.col("topic") == topic) & (F.col("window_start") >= since))
    if "date" in aggregated.columns:
        mine = mine.filter(F.col("date") >= F.to_date(since))
    return (
        mine.select(
            "window_start", "messages_per_minute", "error_rate", "trend_coefficient", "avg_duration_ms"
        )
        .orderBy(F.desc("window_start"))
        .limit(limit)
    )


def rolling_counts(messages: DataFrame, seconds: int = 5, watermark: str | None = None) -> DataFrame:
    """Messages per topic and fixed time slot; with a watermark it also runs on a stream."""
    if watermark is not None:
        messages = messages.withWatermark("ts", watermark)
    slots = messages.groupBy(F.window("ts", f"{seconds} seconds").alias("slot"), "topic")
    return slots.agg(F.count(F.lit(1)).alias("messages")).select(
        F.col("slot.start").alias("slot_start"), "topic", "messages"
    )


def recent_batches(stored: DataFrame, limit: int = 20) -> DataFrame:
    """The newest batches with their size and time range."""
    return (
        stored.groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.min("ts").alias("first_message"),
            F.max("ts").alias("last_message"),
        )
        .orderBy(F.desc("batch_id"))
        .limit(limit)
    )


def rolled_batches(rollup: DataFrame, limit: int = 20) -> DataFrame:
    """The rows of `recent_batches` from roll-ups."""
    return (
        rollup.groupBy("batch_id")
        .agg(
            F.sum("total").alias("messages"),
            F.min("first_message").alias("first_message"),
            F.max("last_message").alias("last_message"),
        )
        .orderBy(F.desc("batch_id"))
        .limit(limit)
    )


def rolled_stats(rollup: DataFrame) -> DataFrame:
    """The row of `feature_stats` from roll-ups."""
    return merged_summary(rollup)


def feature_stats(stored: DataFrame) -> DataFrame:
    """Document and signal counts over everything stored."""
    return batch_summary(stored)


def feature_sample(stored: DataFrame, topic: str, limit: int = 5) -> DataFrame:
    """The newest rows of one topic with their documents."""
    return (
        stored.filter(F.col("topic") == topic)
        .orderBy(F.desc("ts"), F.desc("value"))
        .select(
            "topic", "ts", "features", "enhanced_features", "sliding_features", "correlation_features"
        )
        .limit(limit)
    )


def anomaly_rate(metrics: DataFrame, threshold: float, keys: tuple[str, ...] = ("topic",)) -> DataFrame:
    """Share of metric values above a threshold."""
    high = F.count_if(F.col("value") > threshold)
    return metrics.groupBy(*keys).agg(
        high.alias("anomalies"), (high / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("anomaly_rate")
    )


def grid_features(
    history: DataFrame, minutes: int, step_minutes: int, watermark: str | None = None
) -> DataFrame:
    """Window features on a fixed grid; with a watermark it also runs on a stream.

    Only measures that combine map-side, so no window of a busy topic is held
    whole. Rows later than the watermark are dropped on a stream.
    """
    if watermark is not None:
        history = history.withWatermark("timestamp", watermark)
    frames = history.groupBy(
        F.window("timestamp", f"{minutes} minutes", f"{step_minutes} minutes").alias("frame"), "topic"
    )
    return frames.agg(
        (F.count(F.lit(1)) / F.lit(float(max(minutes, 1)))).alias("avg_messages"),
        F.avg(error_flag()).alias("error_rate"),
        F.avg("duration_ms").alias("avg_duration"),
        F.max("value").alias("value_max"),
    ).select(
        F.col("frame.start").alias("frame_start"), "topic", "avg_messages", "error_rate",
        "avg_duration", "value_max",
    )


# ---- presentation -------------------------------------------------------


def show_topics(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: iso(F.col(c)) for c in ("first_message", "last_message")})


def show_enhanced_stats(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "avg_msg_rate": present(F.col("avg_msg_rate"), 2),
            "avg_error_rate": present(F.col("avg_error_rate"), 4),
            "earliest_message": iso(F.col("earliest_message")),
            "latest_message": iso(F.col("latest_message")),
        }
    )


def show_trends(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "window_start": iso(F.col("window_start")),
            "messages_per_minute": present(F.col("messages_per_minute"), 2),
            "error_rate": present(F.col("error_rate"), 4),
            "trend_coefficient": present(F.col("trend_coefficient"), 6),
            "avg_duration_ms": present(F.col("avg_duration_ms"), 2),
        }
    )
