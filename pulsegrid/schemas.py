"""Schemas of the OTLP-JSON envelope and of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# 64-bit integers, nanosecond stamps and severities may arrive as JSON numbers or strings;
# reading them as text accepts both.
_ANY_VALUE = "struct<stringValue:string,intValue:string,doubleValue:double,boolValue:boolean>"
KEY_VALUES = f"array<struct<key:string,value:{_ANY_VALUE}>>"
RESOURCE = f"struct<attributes:{KEY_VALUES}>"

_LOG_RECORD = (
    "struct<observedTimeUnixNano:string,severityNumber:string,severityText:string,"
    "body:struct<stringValue:string>,traceId:string,spanId:string,"
    f"attributes:{KEY_VALUES}>"
)
_SPAN = (
    "struct<traceId:string,spanId:string,parentSpanId:string,name:string,kind:int,"
    "startTimeUnixNano:string,endTimeUnixNano:string,"
    f"attributes:{KEY_VALUES},"
    f"events:array<struct<name:string,attributes:{KEY_VALUES}>>,"
    "status:struct<code:int>>"
)
_POINTS = (
    "dataPoints:array<struct<timeUnixNano:string,asDouble:double,asInt:string,count:string,"
    f"attributes:{KEY_VALUES},exemplars:array<string>>>"
)
_METRIC = (
    "struct<name:string,description:string,unit:string,"
    f"gauge:struct<{_POINTS}>,"
    f"sum:struct<{_POINTS},aggregationTemporality:int,isMonotonic:boolean>,"
    f"histogram:struct<{_POINTS},aggregationTemporality:int>,"
    f"exponentialHistogram:struct<{_POINTS},aggregationTemporality:int>,"
    f"summary:struct<{_POINTS}>>"
)

# The lists of resources of each signal, by their key in a message.
RESOURCE_LISTS = {
    "resourceLogs": f"array<struct<resource:{RESOURCE},scopeLogs:array<struct<logRecords:array<{_LOG_RECORD}>>>>>",
    "resourceSpans": f"array<struct<resource:{RESOURCE},scopeSpans:array<struct<spans:array<{_SPAN}>>>>>",
    "resourceMetrics": f"array<struct<resource:{RESOURCE},scopeMetrics:array<struct<metrics:array<{_METRIC}>>>>>",
}

# Their lists and objects alone, for finding elements of the wrong kind. No element has the one field.
_ANY = "struct<nothing:boolean>"
_ANY_KINDS = ",".join(
    f"{kind}:struct<dataPoints:array<{_ANY}>>" for kind in ("gauge", "sum", "histogram", "exponentialHistogram", "summary")
)
RESOURCE_SHAPES = {
    "resourceLogs": f"array<struct<resource:{_ANY},scopeLogs:array<struct<logRecords:array<{_ANY}>>>>>",
    "resourceSpans": f"array<struct<resource:{_ANY},scopeSpans:array<struct<spans:array<{_ANY}>>>>>",
    "resourceMetrics": f"array<struct<resource:{_ANY},scopeMetrics:array<struct<metrics:array<struct<{_ANY_KINDS}>>>>>>",
}

# The same lists with every resource entry kept as its original JSON text;
# routing forwards entries unchanged, unknown fields included.
RAW_ENVELOPE = (
    "struct<resourceLogs:array<string>,resourceSpans:array<string>,resourceMetrics:array<string>>"
)


def table(columns: str) -> T.StructType:
    """A schema from 'name type, name type'; needs no running session."""
    schema = T.StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema = schema.add(name, kind)
    return schema


MESSAGES = table(
    "topic string, value string, ts timestamp, batch_id long, window_start timestamp, "
    "window_end timestamp, features string, enhanced_features string, sliding_features string, "
    "correlation_features string, processed_at timestamp"
)

AGGREGATED = table(
    "topic string, window_start timestamp, window_end timestamp, window_minutes long, "
    "messages_per_minute double, error_rate double, unique_sources long, "
    "avg_body_length double, avg_duration_ms double, p95_duration_ms double, "
    "trend_coefficient double, processed_at timestamp"
)

HISTORY = table(
    "topic string, seq long, pos integer, arrived timestamp, timestamp timestamp, severity_number integer, "
    "is_error integer, value double, duration_ms double, body_length integer, source string, "
    "hour integer"
)
