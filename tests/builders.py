"""Small OTLP messages and history rows for tests."""

from __future__ import annotations

import datetime as dt
import json

T0 = dt.datetime(2024, 1, 1, 12, 0, 0, tzinfo=dt.timezone.utc)
NANO = 1704110400_000_000_000  # T0


def attribute(key, **value):
    return {"key": key, "value": value}


def log(**record):
    return {"resourceLogs": [{"scopeLogs": [{"logRecords": [record]}]}]}


def span(resource=(), **record):
    return {
        "resourceSpans": [
            {"resource": {"attributes": list(resource)}, "scopeSpans": [{"spans": [record]}]}
        ]
    }


def metric(resource=(), **record):
    return {
        "resourceMetrics": [
            {"resource": {"attributes": list(resource)}, "scopeMetrics": [{"metrics": [record]}]}
        ]
    }


def messages(spark, values, topic="demo-a", ts=T0):
    """One message per value; dictionaries become JSON, strings stay as they are."""
    rows = [
        (topic, v if isinstance(v, str) or v is None else json.dumps(v), ts, i)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "topic string, value string, ts timestamp, seq long")


def history(spark, rows):
    """Rows of (topic, seconds after T0, seq, severity, value, duration, body_length, source)."""
    full = []
    for topic, seconds, seq, severity, value, duration, body, source in rows:
        at = T0 + dt.timedelta(microseconds=round(seconds * 1e6))
        full.append((topic, seq, 0, at, at, severity, 0, value, duration, body, source, at.hour))
    return spark.createDataFrame(
        full,
        "topic string, seq long, pos int, arrived timestamp, timestamp timestamp, severity_number int, is_error int, "
        "value double, duration_ms double, body_length int, source string, hour int",
    )
