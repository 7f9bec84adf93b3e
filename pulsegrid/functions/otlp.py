"""Feature records of OTLP logs, spans and metrics as nested column expressions.

Each `*_features` function maps the parsed resource array of a message to one
flat `array<struct>`: no explode and no shuffle, so the same expression builds a
message's feature document and, exploded, the per-record tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.functions.scalars import (
    day_of_week,
    is_error_severity,
    nanos,
    nanos_to_ts,
    whole_number,
)

UNKNOWN = "unknown"
SERVICE = "service.name"

# Metric kinds in order of precedence.
METRIC_KINDS = ("gauge", "sum", "histogram", "exponentialHistogram", "summary")
CUMULATIVE = 2


def _nested(array: Column, body: Callable[[Column], Column]) -> Column:
    """Map then flatten; missing inner arrays and elements that could not be read count as empty."""
    return F.flatten(F.array_compact(F.transform(array, body)))


def _each(array: Column, body: Callable[[Column], Column]) -> Column:
    """Map the elements that could be read."""
    return F.transform(F.array_compact(array), body)


def _with(record: Column, names: list[str], **more: Column) -> Column:
    return F.struct(
        *[record[n].alias(n) for n in names], *[c.alias(n) for n, c in more.items()]
    )


def text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


# ---- attributes ---------------------------------------------------------


def attribute(attributes: Column, key: str | Column) -> Column:
    """String value of a key; the last duplicate wins."""
    wanted = F.filter(attributes, lambda a: a["key"] == key)
    return F.try_element_at(wanted, F.lit(-1))["value"]["stringValue"]


def _to_map(attributes: Column, value: Callable[[Column], Column]) -> Column:
    named = F.filter(attributes, lambda a: text(a["key"]) != "")
    pairs = F.transform(named, lambda a: F.struct(a["key"].alias("key"), value(a["value"])))
    return F.map_from_entries(F.coalesce(pairs, F.from_json(F.lit("[]"), "array<struct<key:string,value:string>>")))


def string_attributes(attributes: Column) -> Column:
    """Resource and event attributes: string values only."""
    return _to_map(attributes, lambda v: v["stringValue"].alias("value"))


def span_attributes(attributes: Column) -> Column:
    """Span attributes: the string value, else the integer value."""
    return _to_map(
        attributes,
        lambda v: F.coalesce(F.nullif(v["stringValue"], F.lit("")), v["intValue"]).alias("value"),
    )


def point_attributes(attributes: Column) -> Column:
    """Data-point attributes: string, integer, non-zero double, then boolean value."""
    return _to_map(
        attributes,
        lambda v: F.coalesce(
            F.nullif(v["stringValue"], F.lit("")),
            v["intValue"],
            F.nullif(v["doubleValue"], F.lit(0.0)).cast("string"),
            v["boolValue"].cast("string"),
        ).alias("value"),
    )


# ---- logs ---------------------------------------------------------------


def context_object(attributes: Column) -> Column:
    """JSON text of the first attribute named `context`; NULL unless it holds an object."""
    first = F.get(F.filter(attributes, lambda a: a["key"] == "context"), F.lit(0))
    raw = first["value"]["stringValue"]
    return F.when(F.json_object_keys(raw).isNotNull(), raw)


def log_error(severity: Column, body: Column) -> Column:
    """Error details: severity 17 or more, or the word ERROR in any case in the body."""
    # fixed value: the pattern of an SQL state
    code = F.nullif(F.regexp_extract(body, r"(?U)SQLSTATE\[(\w+)\]", 1), F.lit(""))
    return F.when(
        is_error_severity(severity) | F.contains(F.upper(body), F.lit("ERROR")),
        F.struct(body.alias("message"), code.alias("code")),
    )


def log_features(resource_logs: Column, ts: Column, resource_source: bool = False) -> Column:
    """One struct per log record. `resource_source` adds the resource's service
    name as a fallback where the record's context names none."""

    def read(record: Column, resource: Column) -> Column:
        fallback = attribute(resource["attributes"], SERVICE) if resource_source else F.lit(None)
        return F.struct(
            nanos_to_ts(record["observedTimeUnixNano"], ts).alias("observed_ts"),
            F.coalesce(whole_number(record["severityNumber"]), F.lit(0)).alias("severity_number"),
            text(record["severityText"]).alias("severity_text"),
            text(record["body"]["stringValue"]).alias("body"),
            text(record["traceId"]).alias("trace_id"),
            text(record["spanId"]).alias("span_id"),
            context_object(record["attributes"]).alias("context"),
            fallback.cast("string").alias("fallback"),
        )

    records = _nested(
        resource_logs,
        lambda entry: _nested(
            entry["scopeLogs"],
            lambda scope: _each(scope["logRecords"], lambda record: read(record, entry["resource"])),
        ),
    )
    return F.transform(
        records,
        lambda r: F.struct(
            r["observed_ts"].alias("observed_ts"),
            r["severity_number"].alias("severity_number"),
            r["severity_text"].alias("severity_text"),
            r["body"].alias("body"),
            F.length(r["body"]).alias("body_length"),
            r["trace_id"].alias("trace_id"),
            r["span_id"].alias("span_id"),
            r["context"].alias("context"),
            log_error(r["severity_number"], r["body"]).alias("error"),
            F.hour(r["observed_ts"]).alias("hour"),
            day_of_week(r["observed_ts"]).alias("day_of_week"),
            r["observed_ts"].alias("timestamp"),
            r["severity_number"].alias("value"),
            F.coalesce(
                F.get_json_object(r["context"], f"$['{SERVICE}']"), r["fallback"], F.lit(UNKNOWN)
            ).alias("source"),
        ),
    )


# ---- spans --------------------------------------------------------------


def duration_ms(start: Column, end: Column) -> Column:
    elapsed = F.try_subtract(nanos(end), nanos(start))
    return F.coalesce(elapsed / F.lit(1e6), F.lit(0.0))


def exception_of(events: Column) -> Column:
    """Details of the first event named `exception`."""
    first = F.get(F.filter(events, lambda e: e["name"] == "exception"), F.lit(0))

    def detail(key: str) -> Column:
        return attribute(first["attributes"], key)

    return F.when(
        first.isNotNull(),
        F.struct(
            detail("exception.type").alias("type"),
            detail("exception.message").alias("message"),
            F.length(text(detail("exception.stacktrace"))).alias("stacktrace_length"),
        ),
    )


def span_error(http_status: Column, status_code: Column) -> Column:
    return F.coalesce(
        F.when(http_status.try_cast("int") >= 400, 1), F.when(status_code == 2, 1), F.lit(0)
    )


def span_features(resource_spans: Column, ts: Column) -> Column:
    """One struct per span."""

    def read(span: Column, resource: Column) -> Column:
        return F.struct(
            text(span["traceId"]).alias("trace_id"),
            text(span["spanId"]).alias("span_id"),
            span["parentSpanId"].alias("parent_span_id"),
            text(span["name"]).alias("name"),
            F.coalesce(span["kind"], F.lit(0)).alias("kind"),
            nanos_to_ts(span["startTimeUnixNano"], ts).alias("start_time"),
            nanos_to_ts(span["endTimeUnixNano"], ts).alias("end_time"),
            duration_ms(span["startTimeUnixNano"], span["endTimeUnixNano"]).alias("duration_ms"),
            span_attributes(span["attributes"]).alias("attributes"),
            array_size(span["events"]).alias("events_count"),
            exception_of(span["events"]).alias("exception"),
            string_attributes(resource["attributes"]).alias("resource_attributes"),
            span["status"]["code"].alias("status_code"),
        )

    copied = [
        "trace_id", "span_id", "parent_span_id", "name", "kind", "start_time", "end_time",
        "duration_ms", "attributes", "events_count", "exception", "resource_attributes",
    ]
    spans = _nested(
        resource_spans,
        lambda entry: _nested(
            entry["scopeSpans"],
            lambda scope: _each(scope["spans"], lambda span: read(span, entry["resource"])),
        ),
    )
    return F.transform(
        spans,
        lambda s: _with(
            s,
            copied,
            is_error=span_error(
                F.try_element_at(s["attributes"], F.lit("http.status_code")), s["status_code"]
            ),
            hour=F.hour(s["start_time"]),
            day_of_week=day_of_week(s["start_time"]),
            timestamp=s["start_time"],
            value=s["duration_ms"],
            source=F.coalesce(
                F.try_element_at(s["attributes"], F.lit(SERVICE)),
                F.try_element_at(s["resource_attributes"], F.lit(SERVICE)),
                F.lit(UNKNOWN),
            ),
        ),
    )


# ---- metrics ------------------------------------------------------------


def array_size(array: Column) -> Column:
    return F.coalesce(F.array_size(array), F.lit(0))


def metric_kind(metric: Column) -> Column:
    """First kind present, in order of precedence; '' when there is none."""
    return F.coalesce(
        *[F.when(metric[kind].isNotNull(), F.lit(kind)) for kind in METRIC_KINDS], F.lit("")
    )


def _by_kind(metric: Column, pick: Callable[[Column], Column], kinds: tuple[str, ...]) -> Column:
    """`pick` applied to the kind that takes precedence; NULL for kinds not listed."""
    result = None
    for kind in METRIC_KINDS:
        branch = pick(metric[kind]) if kind in kinds else F.lit(None)
        present = metric[kind].isNotNull()
        result = F.when(present, branch) if result is None else result.when(present, branch)
    return result


def aggregation(metric: Column) -> Column:
    """Temporality of sums and histograms (cumulative only for code 2), monotonicity of sums."""
    return F.struct(
        _by_kind(
            metric,
            lambda m: F.when(m["aggregationTemporality"] == CUMULATIVE, F.lit("cumulative"))
            .otherwise(F.lit("delta")),
            ("sum", "histogram", "exponentialHistogram"),
        ).alias("temporality"),
        _by_kind(
            metric, lambda m: F.coalesce(m["isMonotonic"], F.lit(False)), ("sum",)
        ).alias("is_monotonic"),
    )


def point_value(point: Column) -> Column:
    return F.coalesce(
        point["asDouble"],
        point["asInt"].try_cast("double"),
        point["count"].try_cast("double"),
        F.lit(0.0),
    )


def metric_features(resource_metrics: Column, ts: Column) -> Column:
    """One struct per data point."""

    def read(point: Column, metric: Column, resource: Column) -> Column:
        return F.struct(
            text(metric["name"]).alias("name"),
            metric_kind(metric).alias("type"),
            metric["unit"].alias("unit"),
            metric["description"].alias("description"),
            nanos_to_ts(point["timeUnixNano"], ts).alias("timestamp"),
            point_value(point).alias("value"),
            aggregation(metric).alias("aggregation"),
            point_attributes(point["attributes"]).alias("attributes"),
            array_size(point["exemplars"]).alias("exemplars_count"),
            string_attributes(resource["attributes"]).alias("resource_attributes"),
        )

    copied = [
        "name", "type", "unit", "description", "timestamp", "value", "aggregation",
        "attributes", "exemplars_count", "resource_attributes",
    ]
    points = _nested(
        resource_metrics,
        lambda entry: _nested(
            entry["scopeMetrics"],
            lambda scope: _nested(
                scope["metrics"],
                lambda metric: _each(
                    _by_kind(metric, lambda m: m["dataPoints"], METRIC_KINDS),
                    lambda point: read(point, metric, entry["resource"]),
                ),
            ),
        ),
    )
    return F.transform(
        points,
        lambda p: _with(
            p,
            copied,
            hour=F.hour(p["timestamp"]),
            day_of_week=day_of_week(p["timestamp"]),
            source=F.coalesce(
                F.try_element_at(p["resource_attributes"], F.lit(SERVICE)), F.lit(UNKNOWN)
            ),
        ),
    )


# ---- history entries ----------------------------------------------------


def history_entries(logs: Column, spans: Column, metrics: Column) -> Column:
    """The common eight-field entries of all three signals, in arrival order.

    Fields a signal does not carry take the defaults 0 and '' on purpose: they
    take part in later means and rates. A NaN value is no number and becomes NULL.
    """

    def entry(r: Column, severity, is_error, value, duration, body_length) -> Column:
        return F.struct(
            r["timestamp"].alias("timestamp"),
            severity.cast("int").alias("severity_number"),
            is_error.cast("int").alias("is_error"),
            F.when(~F.isnan(value.cast("double")), value.cast("double")).alias("value"),
            duration.cast("double").alias("duration_ms"),
            body_length.cast("int").alias("body_length"),
            r["source"].alias("source"),
            r["hour"].cast("int").alias("hour"),
        )

    zero = F.lit(0)
    parts = [
        F.transform(
            logs, lambda r: entry(r, r["severity_number"], zero, r["value"], zero, r["body_length"])
        ),
        F.transform(
            spans, lambda r: entry(r, zero, r["is_error"], r["value"], r["duration_ms"], zero)
        ),
        F.transform(metrics, lambda r: entry(r, zero, zero, r["value"], zero, zero)),
    ]
    return F.flatten(F.array_compact(F.array(*parts)))
