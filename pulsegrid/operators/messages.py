"""From raw messages to parsed signals, per-record tables and history entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid import schemas
from pulsegrid.functions import otlp
from pulsegrid.functions.scalars import is_json_object, json_object
from pulsegrid.functions.unreadable import unreadable

# Top-level key of each signal in a message.
SIGNAL_KEYS = {"logs": "resourceLogs", "traces": "resourceSpans", "metrics": "resourceMetrics"}


#: What could not be read of a message: the whole of it ('$') or an element of a list.
PROBLEM = "struct<signal:string,path:string,reason:string,raw:string>"


def _documents(messages: DataFrame) -> DataFrame:
    """Messages with their value as a variant `_doc`, NULL where it is not one JSON object.

    A generated column is computed once: whatever reads it later, a message is parsed here only.
    """
    return messages.select("*", F.explode(F.array(json_object(F.col("value")))).alias("_doc"))


def _resources(signal: str, lists: dict[str, str] = schemas.RESOURCE_LISTS) -> Column:
    """The signal's list of resources; elements of the wrong kind are NULL, the others whole."""
    key = SIGNAL_KEYS[signal]
    return F.try_variant_get("_doc", f"$.{key}", lists[key])


def parse(
    messages: DataFrame,
    signals: tuple[str, ...] = tuple(SIGNAL_KEYS),
    resource_source: bool = False,
) -> DataFrame:
    """Messages whose value is one JSON object, with the feature arrays `logs`, `traces`, `metrics`, or those in `signals`.

    An array is NULL when the message does not carry the signal. Elements that cannot be read are
    left out, one by one; `read` lists them.
    """
    arrays = [_features(s, _resources(s), resource_source) for s in signals]
    return _documents(messages).filter("_doc IS NOT NULL").select(*messages.columns, *arrays)


def read(messages: DataFrame, signals: tuple[str, ...] = tuple(SIGNAL_KEYS), resource_source: bool = False) -> DataFrame:
    """All messages with their feature arrays and `problems`, a list of PROBLEM; one parse a message.

    A message that is not one JSON object has no arrays and one problem.
    """
    lists = _documents(messages).select("*", *[_resources(s).alias(f"_{s}") for s in signals])
    arrays = [_features(s, F.col(f"_{s}"), resource_source) for s in signals]
    return lists.select(*messages.columns, *arrays, _problems(signals))


def _problems(signals: tuple[str, ...]) -> Column:
    value = F.col("value")
    text = F.trim(value)
    reason = (
        F.when(value.isNull() | (text == ""), "empty")
        .when(text.rlike(r"^[\[\"]") | text.try_cast("double").isNotNull(), "not an object")
        .when(text.isin("null", "true", "false"), "not an object")
        .otherwise("malformed")
    )
    nothing = F.lit(None).cast("string")
    whole = F.struct(nothing.alias("signal"), F.lit("$").alias("path"), reason.alias("reason"), value.alias("raw"))
    parts = F.concat(*[unreadable(F.col("_doc"), s, SIGNAL_KEYS[s], F.col(f"_{s}")) for s in signals])
    return F.when(F.col("_doc").isNull(), F.array(whole)).otherwise(parts).cast(f"array<{PROBLEM}>").alias("problems")


def readable(parsed: DataFrame) -> DataFrame:
    """The messages of `read` that are one JSON object."""
    whole = F.exists("problems", lambda p: p["path"] == "$")
    return parsed.filter(~whole).drop("problems")


def unread(parsed: DataFrame) -> DataFrame:
    """The problems of `read`: topic, value (the text that could not be read), ts, seq, reason, signal, path."""
    # empty lists go after the explosion: a filter before it would look for the problems again
    rows = parsed.select("topic", "ts", "seq", F.inline_outer("problems")).filter("path IS NOT NULL")
    return rows.select("topic", F.col("raw").alias("value"), "ts", "seq", "reason", "signal", "path")


def _features(signal: str, resources: Column, resource_source: bool = False) -> Column:
    readers = {
        "logs": lambda c: otlp.log_features(c, F.col("ts"), resource_source),
        "traces": lambda c: otlp.span_features(c, F.col("ts")),
        "metrics": lambda c: otlp.metric_features(c, F.col("ts")),
    }
    return readers[signal](resources).alias(signal)


def parse_by_origin(messages: DataFrame) -> DataFrame:
    """One row per resource entry of a message, with its place as `entry`, its service as `origin`
    and its feature arrays.

    A service's signals may come in several topics; grouped by origin they meet. Entries
    without a service name have the origin 'unknown'.
    """
    lists = _documents(messages).filter("_doc IS NOT NULL")
    lists = lists.select(*messages.columns, *[_resources(s).alias(f"_{s}") for s in SIGNAL_KEYS])

    def entries(signal: str) -> Column:
        def alone(entry: Column) -> Column:
            origin = otlp.attribute(entry["resource"]["attributes"], otlp.SERVICE)
            own = {s: F.array(entry) if s == signal else F.when(F.lit(False), F.col(f"_{s}")) for s in SIGNAL_KEYS}
            return F.struct(
                F.coalesce(origin, F.lit(otlp.UNKNOWN)).alias("origin"),
                *[column.alias(s) for s, column in own.items()],
            )

        return F.transform(F.array_compact(f"_{signal}"), alone)

    every = F.flatten(F.array_compact(F.array(*[entries(s) for s in SIGNAL_KEYS])))
    rows = lists.select(*messages.columns, F.posexplode_outer(every).alias("entry", "_entry"))
    rows = rows.filter("_entry IS NOT NULL").select(*messages.columns, "entry", "_entry.*")
    arrays = [_features(s, F.col(s)) for s in SIGNAL_KEYS]
    return rows.select(*messages.columns, "entry", "origin", *arrays)


def signals_present(messages: DataFrame) -> DataFrame:
    """Which signals a message carries, by its top-level keys; one message may carry several."""
    keys = F.json_object_keys("value")
    return messages.select(
        "*",
        *[
            F.coalesce(F.array_contains(keys, key), F.lit(False)).alias(f"has_{name}")
            for name, key in SIGNAL_KEYS.items()
        ],
    )


def accepted(messages: DataFrame) -> DataFrame:
    """Messages whose value is one JSON object."""
    return messages.filter(is_json_object(F.col("value")))


def quarantined(messages: DataFrame) -> DataFrame:
    """Whatever cannot be read, kept with a reason: whole messages (path '$') and single elements.

    One row a problem: topic, value (the text in question), ts, seq, reason, signal, path.
    """
    shapes = [_resources(s, schemas.RESOURCE_SHAPES).alias(f"_{s}") for s in SIGNAL_KEYS]
    lists = _documents(messages).select("*", *shapes)
    return unread(lists.select("topic", "ts", "seq", _problems(tuple(SIGNAL_KEYS))))


def _records(messages: DataFrame, signal: str, **options) -> DataFrame:
    parsed = parse(messages, (signal,), **options)
    return _exploded(parsed, F.col(signal))


def _exploded(parsed: DataFrame, records, *more: str) -> DataFrame:
    """One row per record. Empty arrays go after the explosion: a filter before it would
    read, and so parse, the message again."""
    rows = parsed.select("topic", "seq", *more, F.posexplode_outer(records).alias("pos", "_r"))
    return rows.filter("pos IS NOT NULL").select("topic", "seq", "pos", *more, "_r.*")


def log_table(messages: DataFrame, resource_source: bool = False) -> DataFrame:
    """One row per log record."""
    return _records(messages, "logs", resource_source=resource_source)


def span_table(messages: DataFrame) -> DataFrame:
    """One row per span."""
    return _records(messages, "traces")


def metric_table(messages: DataFrame) -> DataFrame:
    """One row per metric data point."""
    return _records(messages, "metrics")


def history_of(parsed: DataFrame) -> DataFrame:
    """One history row per record of already parsed messages (one scan, one parse).

    `arrived` is the message's time, `pos` the arrival position inside the message.
    An unknown hour falls back to the hour of the timestamp.
    """
    entries = otlp.history_entries(F.col("logs"), F.col("traces"), F.col("metrics"))
    return _exploded(parsed.withColumn("arrived", F.col("ts")), entries, "arrived")


def history_table(messages: DataFrame) -> DataFrame:
    return history_of(parse(messages))
