"""OTLP-JSON messages made from the `events` table, inside Spark.

One message per event carries a log record, a span, a metric data point, or any
of them together. The rules are listed in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SERVICES = ("laravel", "flask", "node", "app1", "app2")
METRIC_NAMES = (
    "k8s.container.restarts",
    "k8s.node.condition.memory_pressure",
    "k8s.container.cpu.request",
    "k8s.container.ready",
    "container.cpu.throttled",
    "k8s.node.condition.disk_pressure",
    "app_requests",
    "app_cpu_usage",
)

# Rows of the events table that one task makes messages of; a message is some kilobytes of JSON.
SPLIT_ROWS = 25_000


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Rows in splits of about SPLIT_ROWS, at least one a core: messages are a hundred times as large as
    their rows, so splits grow in number with the table, not in size. A table that already has
    enough splits is left as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = max(cores, -(-df.count() // SPLIT_ROWS))  # the count is read from the files' footers
    return df.repartition(splits, key) if df.rdd.getNumPartitions() < splits else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with `ts` as an instant and the derived columns."""
    table = _spread(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_id")
    services = F.array(*[F.lit(s) for s in SERVICES])
    return table.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.concat(F.lit("demo-"), "event_type").alias("topic"),
        F.get(services, (F.col("user_id") % 5).cast("int")).alias("service"),
    )


def _text(*parts: Column | str) -> Column:
    """Concatenated JSON text; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _string_attribute(key: str, value: Column) -> Column:
    return _text('{"key":"', key, '","value":{"stringValue":"', value, '"}}')


def _list(*items: Column) -> Column:
    """A JSON list of the items that are not NULL."""
    return _text("[", F.concat_ws(",", *items), "]")


def _resource() -> Column:
    node = F.when(F.col("event_id") % 3 == 0, F.lit("minikube")).otherwise(F.lit("worker"))
    component = F.when(F.col("event_id") % 4 == 0, F.lit("otel-agent"))
    return _text(
        '"resource":{"attributes":',
        _list(
            _string_attribute("service.name", F.col("service")),
            _string_attribute("k8s.node.name", node),
            _string_attribute("signoz.component", component),
        ),
        "}",
    )


def _nanos() -> Column:
    return F.unix_micros("ts") * 1000


def _trace_id() -> Column:
    return F.lpad(F.lower(F.hex("event_id")), 32, "0")


def _span_id() -> Column:
    return F.lpad(F.lower(F.hex("event_id")), 16, "0")


def _log() -> Column:
    error, click = F.col("event_type") == "error", F.col("event_type") == "click"
    severity = F.when(error, 17).when(click, 13).otherwise(9)
    label = F.when(error, "ERROR").when(click, "WARN").otherwise("INFO")
    body = F.when(error, _text("SQLSTATE[42P01]: user ", F.col("user_id"))).otherwise(
        _text("Handled ", F.col("event_type"))
    )
    # the stamp as a string, as a number, and missing (then the message time counts)
    shape = F.col("event_id") % 7
    observed = (
        F.when(shape == 0, F.lit(""))
        .when(shape == 1, _text('"observedTimeUnixNano":', _nanos(), ","))
        .otherwise(_text('"observedTimeUnixNano":"', _nanos(), '",'))
    )
    context = _text('{\\"service.name\\":\\"', F.col("service"), '\\"}')
    return _text(
        "{", observed, '"severityNumber":', severity, ',"severityText":"', label,
        '","body":{"stringValue":"', body, '"},"traceId":"', _trace_id(),
        '","spanId":"', _span_id(), '","attributes":',
        _list(_string_attribute("context", context)), "}",
    )


def _span() -> Column:
    error = F.col("event_type") == "error"
    length = F.round(F.col("value") * 1e6).cast("bigint")
    status = F.when(error, 500).otherwise(200)
    # the status code as a string or as a number
    code = F.when(F.col("event_id") % 2 == 0, _text('"', status, '"')).otherwise(status.cast("string"))
    attributes = _list(
        _text('{"key":"http.status_code","value":{"intValue":', code, "}}"),
        F.when(F.col("event_id") % 2 == 0, _string_attribute("service.name", F.col("service"))),
    )
    parent = F.when(F.col("event_id") % 3 == 1, _text('"parentSpanId":"', _span_id(), '",'))
    exception = F.when(
        error & (F.col("user_id") % 2 == 0),
        _text(
            '{"name":"exception","attributes":',
            _list(
                _string_attribute("exception.type", F.lit("QueryError")),
                _string_attribute("exception.message", _text("user ", F.col("user_id"))),
                _string_attribute("exception.stacktrace", _text("line ", F.col("event_id"))),
            ),
            "}",
        ),
    )
    return _text(
        '{"traceId":"', _trace_id(), '","spanId":"', _span_id(), '",',
        F.coalesce(parent, F.lit("")), '"name":"', F.col("event_type"), '","kind":',
        F.col("event_id") % 6, ',"startTimeUnixNano":"', _nanos(), '","endTimeUnixNano":"',
        _nanos() + length, '","attributes":', attributes, ',"events":', _list(exception),
        ',"status":{"code":', F.when(error, 2).otherwise(1), "}}",
    )


def _metric() -> Column:
    which = (F.col("event_id") % 8).cast("int")
    name = F.get(F.array(*[F.lit(n) for n in METRIC_NAMES]), which)
    value = F.when((which == 3) & (F.col("user_id") % 2 == 0), F.lit(0.0)).otherwise(F.col("value"))
    count = F.floor("value").cast("bigint")
    as_double = _text('"asDouble":', value)
    as_int = _text('"asInt":"', count, '"')
    as_count = _text('"count":"', count, '"')
    number = F.when(which.isin(1, 5, 7), as_count).when(which == 4, as_int).otherwise(as_double)
    attributes = _list(
        _string_attribute("host", _text("h", F.col("user_id") % 10)),
        _text('{"key":"slot","value":{"intValue":"', F.col("event_id") % 4, '"}}'),
        _text('{"key":"load","value":{"doubleValue":', F.col("user_id") % 3 + F.lit(0.5), "}}"),
        _text('{"key":"on","value":{"boolValue":', (F.col("user_id") % 2 == 0), "}}"),
    )
    exemplars = F.when(F.col("event_id") % 5 == 0, F.lit('[{"asDouble":1.0},{"asDouble":2.0}]')).otherwise("[]")
    point = _text(
        '{"timeUnixNano":"', _nanos(), '",', number, ',"attributes":', attributes,
        ',"exemplars":', exemplars, "}",
    )
    points = _text('"dataPoints":[', point, "]")
    kind = (
        F.when(which == 1, _text('"exponentialHistogram":{', points, ',"aggregationTemporality":2}'))
        .when(which == 5, _text('"summary":{', points, "}"))
        .when(which == 6, _text('"sum":{', points, ',"aggregationTemporality":2,"isMonotonic":true}'))
        .when(which == 7, _text('"histogram":{', points, ',"aggregationTemporality":1}'))
        .otherwise(_text('"gauge":{', points, "}"))
    )
    return _text('{"name":"', name, '","unit":"1","description":"', name, ' reading",', kind, "}")


def messages(
    source: DataFrame, signals: tuple[str, ...] = ("logs", "traces", "metrics"), damaged: bool = False
) -> DataFrame:
    """`topic, value, ts, seq` of every event; `damaged` cuts the value of every tenth
    event after 20 characters."""
    parts = {
        "logs": lambda: _text(
            '"resourceLogs":[{', _resource(), ',"scopeLogs":[{"logRecords":[', _log(), "]}]}]"
        ),
        "traces": lambda: _text(
            '"resourceSpans":[{', _resource(), ',"scopeSpans":[{"spans":[', _span(), "]}]}]"
        ),
        "metrics": lambda: _text(
            '"resourceMetrics":[{', _resource(), ',"scopeMetrics":[{"metrics":[', _metric(), "]}]}]"
        ),
    }
    body = _text("{", F.concat_ws(",", *[parts[s]() for s in signals]), "}")
    if damaged:
        body = F.when(F.col("event_id") % 10 == 0, F.substring(body, 1, 20)).otherwise(body)
    # a generated column is computed once; a projected one would be built again inside
    # every filter and parser that reads it
    value = F.explode(F.array(body)).alias("value")
    return source.select("topic", value, "ts", F.col("event_id").alias("seq"))


# ---- messages with many resources, scopes and records, and elements of the wrong kind ------

# Per signal: list of resources, of scopes, of records.
_LISTS = {
    "logs": ("resourceLogs", "scopeLogs", "logRecords"),
    "traces": ("resourceSpans", "scopeSpans", "spans"),
    "metrics": ("resourceMetrics", "scopeMetrics", "metrics"),
}


def _joined(items: Column) -> Column:
    return _text("[", F.array_join(items, ","), "]")


def _upto(last: Column) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), last)


def _crowded_record(signal: str, i: Column, j: Column, k: Column) -> Column:
    start = (F.unix_micros("ts") + k * 1_000_000) * 1000
    if signal == "logs":
        return _text(
            '{"observedTimeUnixNano":"', start, '","severityNumber":', 9 + 4 * k,
            ',"body":{"stringValue":"', i, ".", j, ".", k, '"}}',
        )
    if signal == "traces":
        return _text(
            '{"name":"', i, ".", j, ".", k, '","startTimeUnixNano":"', start,
            '","endTimeUnixNano":', start + k * 1_000_000, "}",
        )
    points = F.transform(_upto(k), lambda n: _text('{"timeUnixNano":', start, ',"asDouble":', n, ".5}"))
    return _text('{"name":"', i, ".", j, ".", k, '","gauge":{"dataPoints":', _joined(points), "}}")


def crowded_resource(signal: str, i: Column, damaged: bool = False) -> Column:
    """Entry `i` of an event's list of resources."""
    _, scope_list, record_list = _LISTS[signal]
    services = F.array(*[F.lit(s) for s in SERVICES])
    attributes = _list(
        _string_attribute("service.name", F.get(services, ((F.col("user_id") + i) % 5).cast("int"))),
        _string_attribute("k8s.node.name", F.when((F.col("event_id") + i) % 3 == 0, "minikube").otherwise("worker")),
        F.when((F.col("event_id") + i) % 4 == 0, _string_attribute("signoz.component", F.lit("otel-agent"))),
    )
    resource = _text('{"attributes":', attributes, "}")
    kind = F.col("event_id") % 4
    if damaged:
        resource = F.when((kind == 3) & (i == 0), "[]").otherwise(resource)

    def scope(j: Column) -> Column:
        records = F.transform(_upto((F.col("event_id") + i + j) % 3), lambda k: _crowded_record(signal, i, j, k))
        if damaged:
            records = F.when(kind == 1, F.concat(F.array(F.lit("7")), records)).otherwise(records)
        return _text('{"', record_list, '":', _joined(records), "}")

    scopes = F.transform(_upto(F.col("event_id") % 2), scope)
    if damaged:
        scopes = F.when(kind == 2, F.concat(F.array(F.lit('"scope"')), scopes)).otherwise(scopes)
    return _text('{"resource":', resource, ',"', scope_list, '":', _joined(scopes), "}")


def crowded_messages(
    source: DataFrame, signals: tuple[str, ...] = ("logs", "traces", "metrics"), damaged: bool = False
) -> DataFrame:
    """`topic, value, ts, seq` of every event, with up to three resources of up to two scopes of up to three records.

    `damaged` puts the number 7 in front of the records of every fourth event, a text in front of the
    scopes of others, a list in place of the first resource of others, and ends every fifth
    event's resources with null.
    """

    def part(signal: str) -> Column:
        entries = F.transform(_upto(F.col("event_id") % 3), lambda i: crowded_resource(signal, i, damaged))
        if damaged:
            entries = F.when(F.col("event_id") % 5 == 0, F.concat(entries, F.array(F.lit("null")))).otherwise(entries)
        return _text('"', _LISTS[signal][0], '":', _joined(entries))

    body = _text("{", F.concat_ws(",", *[part(s) for s in signals]), "}")
    return source.select("topic", F.explode(F.array(body)).alias("value"), "ts", F.col("event_id").alias("seq"))
