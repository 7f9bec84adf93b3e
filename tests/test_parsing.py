"""Messages to records: validity, attributes, times, errors, kinds, documents."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from builders import NANO, T0, attribute, log, messages, metric, span
from pyspark.sql import functions as F

from pulsegrid.functions.documents import features_document
from pulsegrid.operators import messages as ops


def utc(value: dt.datetime) -> dt.datetime:
    return value.astimezone(dt.timezone.utc)


def logs_of(spark, *records, **options):
    frame = ops.log_table(messages(spark, [log(**r) for r in records]), **options)
    return [r.asDict() for r in frame.orderBy("seq").collect()]


def spans_of(spark, *records, resource=()):
    frame = ops.span_table(messages(spark, [span(resource, **r) for r in records]))
    return [r.asDict(True) for r in frame.orderBy("seq").collect()]


def points_of(spark, *records, resource=()):
    frame = ops.metric_table(messages(spark, [metric(resource, **r) for r in records]))
    return [r.asDict(True) for r in frame.orderBy("seq").collect()]


VALID = [
    "{}",
    '{"resourceLogs":[]}',
    ' {"a":"}"}\n',
    '{"a":1,"a":2}',
    '{"topic":"t","ts":"2024-01-01T00:00:00Z","seq_in_second":1,"payload":{"value":1.5}}',
]
INVALID = ["", "17", "null", '"text"', "[{}]", '{"a":1', "{} x", "{}{}", "{}}", "{}]", "{'a':1}", None]


def test_validity_splits_messages(spark):
    frame = messages(spark, VALID + INVALID)
    kept = {r.seq for r in ops.accepted(frame).collect()}
    assert kept == set(range(len(VALID)))
    bad = {r.seq: r.reason for r in ops.quarantined(frame).collect()}
    assert set(bad) == set(range(len(VALID), len(VALID) + len(INVALID)))
    assert bad[len(VALID)] == "empty" and bad[len(VALID) + 1] == "not an object"
    assert bad[len(VALID) + 5] == "malformed"


def test_messages_without_signals_are_kept_without_features(spark):
    frame = messages(spark, VALID)
    document = features_document(F.col("logs"), F.col("traces"), F.col("metrics"))
    rows = ops.parse(frame).select(document.alias("d")).collect()
    assert [r.d for r in rows] == [""] * len(VALID)


def test_missing_arrays_act_as_empty(spark):
    shapes = [
        {"resourceLogs": None},
        {"resourceLogs": [{}]},
        {"resourceLogs": [{"scopeLogs": [{}, {"logRecords": []}]}]},
        {"resourceLogs": [{}, {"scopeLogs": [{"logRecords": [{"severityNumber": 9}]}]}]},
    ]
    assert [r.seq for r in ops.log_table(messages(spark, shapes)).collect()] == [3]


def test_nanos_missing_zero_or_unreadable_take_the_message_time(spark):
    rows = logs_of(
        spark,
        {"observedTimeUnixNano": str(NANO + 1_500_000)},
        {"observedTimeUnixNano": NANO + 1_500_000},
        {"observedTimeUnixNano": "0"},
        {"observedTimeUnixNano": 0},
        {"observedTimeUnixNano": "soon"},
        {},
    )
    later = T0 + dt.timedelta(microseconds=1500)
    assert [utc(r["observed_ts"]) for r in rows] == [later, later, T0, T0, T0, T0]
    assert rows[0]["hour"] == 12 and rows[0]["day_of_week"] == 0


def test_log_errors(spark):
    rows = logs_of(
        spark,
        {"severityNumber": 17, "body": {"stringValue": "SQLSTATE[42P01]: gone"}},
        {"severityNumber": 9, "body": {"stringValue": "no error here"}},
        {"severityNumber": 9, "body": {"stringValue": "fine"}},
        {"severityNumber": 21},
        {"severityNumber": 9, "body": {"intValue": 5}},
    )
    errors = [r["error"] and tuple(r["error"]) for r in rows]
    assert errors == [("SQLSTATE[42P01]: gone", "42P01"), ("no error here", None), None, ("", None), None]
    assert [r["body_length"] for r in rows] == [21, 13, 4, 0, 0]
    assert [r["value"] for r in rows] == [17, 9, 9, 21, 9]


@pytest.mark.parametrize(
    ("context", "source"),
    [
        ('{"service.name":"svc"}', "svc"),
        ('{"other":1}', "unknown"),
        ("not json", "unknown"),
        ("[1,2]", "unknown"),
    ],
)
def test_log_source_from_context(spark, context, source):
    row = logs_of(spark, {"attributes": [attribute("context", stringValue=context)]})[0]
    assert row["source"] == source


def test_first_context_attribute_counts_and_keyless_attributes_do_not_fail(spark):
    row = logs_of(
        spark,
        {
            "attributes": [
                {"value": {"stringValue": "x"}},
                attribute("context", stringValue='{"service.name":"one"}'),
                attribute("context", stringValue='{"service.name":"two"}'),
            ]
        },
    )[0]
    assert row["source"] == "one"


def test_resource_fallback_is_opt_in(spark):
    value = log(severityNumber=9)
    value["resourceLogs"][0]["resource"] = {"attributes": [attribute("service.name", stringValue="svc")]}
    frame = messages(spark, [value])
    assert ops.log_table(frame).first().source == "unknown"
    assert ops.log_table(frame, resource_source=True).first().source == "svc"


def test_span_error_from_http_status_or_status_code(spark):
    def status(**value):
        return {"attributes": [attribute("http.status_code", **value)]}

    rows = spans_of(
        spark,
        status(stringValue="500"),
        status(intValue="500"),
        status(intValue=404),
        status(intValue=200),
        status(boolValue=True),
        {},
        {"status": {"code": 2}},
        {**status(intValue=200), "status": {"code": 2}},
    )
    assert [r["is_error"] for r in rows] == [1, 1, 1, 0, 0, 0, 1, 1]


def test_span_times_and_duration(spark):
    rows = spans_of(
        spark,
        {"startTimeUnixNano": str(NANO), "endTimeUnixNano": str(NANO + 2_500_000)},
        {"startTimeUnixNano": str(NANO)},
        {"startTimeUnixNano": "x", "endTimeUnixNano": str(NANO)},
    )
    assert [r["duration_ms"] for r in rows] == [2.5, 0.0, 0.0]
    assert [r["value"] for r in rows] == [2.5, 0.0, 0.0]
    assert utc(rows[1]["end_time"]) == T0 and utc(rows[2]["start_time"]) == T0


def test_exception_events(spark):
    full = {
        "name": "exception",
        "attributes": [
            attribute("exception.type", stringValue="E"),
            attribute("exception.stacktrace", stringValue="abc"),
        ],
    }
    rows = spans_of(
        spark,
        {"events": [{"name": "other"}, full, {"name": "exception"}]},
        {"events": [{"name": "exception"}]},
        {"events": [{"name": "other"}]},
        {},
    )
    assert rows[0]["exception"] == {"type": "E", "message": None, "stacktrace_length": 3}
    assert rows[1]["exception"] == {"type": None, "message": None, "stacktrace_length": 0}
    assert rows[2]["exception"] is None and rows[3]["exception"] is None
    assert [r["events_count"] for r in rows] == [3, 1, 1, 0]


def test_attributes_last_duplicate_wins_and_sources(spark):
    resource = [attribute("service.name", stringValue="a"), attribute("service.name", stringValue="b")]
    rows = spans_of(
        spark,
        {"attributes": [attribute("service.name", stringValue="own")]},
        {"attributes": [attribute("n", intValue=3), attribute("d", doubleValue=1.5), {"value": {}}]},
        resource=resource,
    )
    assert [r["source"] for r in rows] == ["own", "b"]
    assert rows[0]["resource_attributes"] == {"service.name": "b"}
    assert rows[1]["attributes"] == {"n": "3", "d": None}
    assert spans_of(spark, {})[0]["source"] == "unknown"


def test_metric_kinds_and_aggregation(spark):
    def points(**more):
        return {"dataPoints": [{"asDouble": 1.0}], **more}

    rows = points_of(
        spark,
        {"name": "m", "gauge": points(), "sum": points()},
        {"sum": points(aggregationTemporality=2, isMonotonic=True)},
        {"sum": points(aggregationTemporality=0)},
        {"histogram": points(aggregationTemporality=1)},
        {"exponentialHistogram": points(aggregationTemporality=2)},
        {"summary": points()},
        {"name": "nothing"},
    )
    assert [r["type"] for r in rows] == [
        "gauge", "sum", "sum", "histogram", "exponentialHistogram", "summary",
    ]
    assert [tuple(r["aggregation"].values()) for r in rows] == [
        (None, None), ("cumulative", True), ("delta", False), ("delta", None), ("cumulative", None), (None, None),
    ]


def test_point_values_and_attributes(spark):
    def gauge(**point):
        return {"gauge": {"dataPoints": [point]}}

    rows = points_of(
        spark,
        gauge(asDouble=1.5, asInt="7"),
        gauge(asInt="7"),
        gauge(asInt=7),
        gauge(count="9"),
        gauge(),
        gauge(exemplars=[{"asDouble": 1}, {"asDouble": 2}]),
        gauge(
            attributes=[
                attribute("s", stringValue="x", intValue="1"),
                attribute("i", stringValue="", intValue="1"),
                attribute("d", doubleValue=2.5),
                attribute("b", boolValue=False),
                attribute("z", doubleValue=0.0, boolValue=True),
                attribute("none", arrayValue={}),
            ]
        ),
    )
    assert [r["value"] for r in rows] == [1.5, 7.0, 7.0, 9.0, 0.0, 0.0, 0.0]
    assert [r["exemplars_count"] for r in rows] == [0, 0, 0, 0, 0, 2, 0]
    assert rows[6]["attributes"] == {
        "s": "x", "i": "1", "d": "2.5", "b": "false", "z": "true", "none": None,
    }


def test_message_with_several_signals(spark):
    value = {**log(severityNumber=17), **span(name="s"), **metric(name="m", gauge={"dataPoints": [{}]})}
    frame = messages(spark, [value, log(), {"resourceSpans": 5}])
    flags = ops.signals_present(frame).orderBy("seq").collect()
    assert [(r.has_logs, r.has_traces, r.has_metrics) for r in flags] == [
        (True, True, True), (True, False, False), (False, True, False),
    ]
    rows = ops.history_table(frame).orderBy("seq", "pos").collect()
    assert [(r.seq, r.pos, r.severity_number) for r in rows] == [(0, 0, 17), (0, 1, 0), (0, 2, 0), (1, 0, 0)]


def test_history_defaults(spark):
    value = {**log(severityNumber=9, body={"stringValue": "four"}), **metric(gauge={"dataPoints": [{"asDouble": "NaN"}]})}
    first, second = ops.history_table(messages(spark, [value])).orderBy("pos").collect()
    assert (first.value, first.duration_ms, first.body_length, first.is_error) == (9.0, 0.0, 4, 0)
    assert (second.value, second.severity_number, second.source) == (None, 0, "unknown")


def test_feature_document(spark):
    value = {
        **log(
            observedTimeUnixNano=str(NANO),
            severityNumber=17,
            body={"stringValue": 'a "quoted" ERROR'},
            attributes=[attribute("context", stringValue='{"service.name":"s","n":[1]}')],
        ),
        **metric(name="m", sum={"dataPoints": [{"asInt": "3", "timeUnixNano": str(NANO + 1000)}], "aggregationTemporality": 2}),
    }
    document = features_document(F.col("logs"), F.col("traces"), F.col("metrics"))
    text = ops.parse(messages(spark, [value])).select(document).first()[0]
    found = json.loads(text)
    assert list(found) == ["logs", "metrics"] and ": " not in text.replace("\\", "")[:40]
    entry = found["logs"][0]
    assert entry["observed_ts"] == "2024-01-01T12:00:00+00:00"
    assert entry["context"] == {"n": [1], "service.name": "s"}
    assert entry["error"] == {"message": 'a "quoted" ERROR', "code": None}
    point = found["metrics"][0]
    assert point["timestamp"] == "2024-01-01T12:00:00.000001+00:00"
    assert point["aggregation"] == {"temporality": "cumulative", "is_monotonic": False}
    assert point["unit"] is None and point["value"] == 3.0


GOOD = {"severityNumber": 9, "body": {"stringValue": "good"}}
DAMAGED = [
    ({"resourceLogs": [{"scopeLogs": [{"logRecords": [7, GOOD]}]}]}, 1, [("$.resourceLogs[0].scopeLogs[0].logRecords[0]", "7")]),
    ({"resourceLogs": [{"scopeLogs": ["x", {"logRecords": [GOOD]}]}]}, 1, [("$.resourceLogs[0].scopeLogs[0]", '"x"')]),
    ({"resourceLogs": [{"resource": [1], "scopeLogs": [{"logRecords": [GOOD, None]}]}]}, 1,
     [("$.resourceLogs[0].resource", "[1]"), ("$.resourceLogs[0].scopeLogs[0].logRecords[1]", "null")]),
    ({"resourceLogs": ["x", {"scopeLogs": {"a": 1}}, {"scopeLogs": [{"logRecords": 5}, {"logRecords": [GOOD]}]}]}, 1,
     [("$.resourceLogs[0]", '"x"'), ("$.resourceLogs[1].scopeLogs", '{"a":1}'), ("$.resourceLogs[2].scopeLogs[0].logRecords", "5")]),
    ({"resourceLogs": 3}, 0, [("$.resourceLogs", "3")]),
    ({"resourceLogs": None, "resourceSpans": [{"resource": None, "scopeSpans": [{"spans": ["s"]}]}]}, 0,
     [("$.resourceSpans[0].scopeSpans[0].spans[0]", '"s"')]),
    ({"resourceMetrics": [{"scopeMetrics": [{"metrics": [1, {"name": "m", "gauge": 5}, {"name": "n", "sum": {"dataPoints": 2}},
      {"name": "o", "gauge": {"dataPoints": [3, {"asDouble": 1.0}]}}]}]}]}, 0,
     [("$.resourceMetrics[0].scopeMetrics[0].metrics[0]", "1"), ("$.resourceMetrics[0].scopeMetrics[0].metrics[1].gauge", "5"),
      ("$.resourceMetrics[0].scopeMetrics[0].metrics[2].sum.dataPoints", "2"),
      ("$.resourceMetrics[0].scopeMetrics[0].metrics[3].gauge.dataPoints[0]", "3")]),
    ({"resourceLogs": [{"scopeLogs": [{"logRecords": [GOOD, GOOD]}]}]}, 2, []),
]


def test_unreadable_elements_leave_the_others_and_are_kept_with_place_and_reason(spark):
    frame = messages(spark, [value for value, _, _ in DAMAGED] + ["[7]"])
    logs = ops.log_table(frame).groupBy("seq").count().collect()
    assert {r.seq: r["count"] for r in logs} == {i: n for i, (_, n, _) in enumerate(DAMAGED) if n}
    assert [r.value for r in ops.metric_table(frame).collect()] == [1.0]
    for found in (ops.quarantined(frame), ops.unread(ops.read(frame))):
        rows = found.collect()
        for i, (_, _, problems) in enumerate(DAMAGED):
            assert sorted((r.path, r.value) for r in rows if r.seq == i) == sorted(problems)
        assert [(r.path, r.value, r.reason, r.signal) for r in rows if r.seq == len(DAMAGED)] == [("$", "[7]", "not an object", None)]
    reasons = {r.path.rpartition(".")[2]: r.reason for r in ops.quarantined(frame).collect()}
    assert reasons["dataPoints"] == reasons["scopeLogs"] == "not a list" and reasons["gauge"] == "not an object"


def test_a_message_is_parsed_once(spark):
    frame = messages(spark, ["{}"])
    for plan in (ops.log_table(frame), ops.history_table(frame), ops.quarantined(frame), ops.read(frame)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("parse_json") + text.count("parseJson") == 1 and "from_json(value" not in text


def test_problems_are_looked_for_once(spark):
    """Nothing below the explosion of the problems asks for them, to drop empty lists."""
    for plan in (ops.quarantined(messages(spark, ["{}"])), ops.unread(ops.read(messages(spark, ["{}"])))):
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        below = text[text.index("Generate inline"):]
        assert "Filter" not in below and below.count("not an object") > 0


def test_a_value_that_forges_the_list_is_no_object(spark):
    bad = ['{"a":1},2', '{"a":1}], [', '{"a":1}] x', '{"a":1},{"b":2}', '{"a":1}/**/', "{\"a\":1}\x00"]
    assert ops.accepted(messages(spark, bad)).count() == 0
