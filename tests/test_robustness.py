"""Awkward messages and values: what a frame, a parser or a clock must not be misled by."""

from __future__ import annotations

import datetime as dt
import json
import math
import random

import numpy as np
import pytest
from builders import NANO, T0, history, log, messages
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.functions import scalars
from pulsegrid.operators import history as store
from pulsegrid.operators import messages as ops
from pulsegrid.operators import running, snapshot
from pulsegrid.operators.messages import history_table, parse
from pulsegrid.plans import feature_tables
from pulsegrid.streaming import job


def entry(seconds, value, seq, topic="demo-a"):
    return (topic, seconds, seq, 9, value, 0.0, 1, "s")


def at(spark, rows):
    """Messages at given seconds: (topic, seconds, seq)."""
    full = [(t, T0 + dt.timedelta(seconds=s), q) for t, s, q in rows]
    return spark.createDataFrame(full, "topic string, ts timestamp, seq long")


@pytest.mark.parametrize("early", [None, 1e10, 1e12, 1.7e18, math.inf, -math.inf])
@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_values_before_a_frame_have_no_part_in_it(spark, early, chunk):
    rows = [entry(-7200, early, 0)] if early is not None else []
    rows += [entry(i, float(i + 1), i + 1) for i in range(4)]
    probes = at(spark, [("demo-a", 10, 99)])
    (row,) = running.running_features(history(spark, rows), probes, chunk=chunk).collect()
    assert (row.value_mean, row.trend_60m, row.value_min, row.value_max) == (2.5, 1.0, 1.0, 4.0)
    assert row.value_std == pytest.approx(1.2909944487358056, rel=1e-12)


def test_frames_against_brute_force(spark):
    chance = random.Random(3)
    kinds = (lambda: chance.random(), lambda: 1e17 * chance.random(), lambda: None, lambda: -3.0)
    rows = [
        (chance.choice("ab"), chance.randrange(0, 7200), i, chance.choice([9, 17]), chance.choice(kinds)(), chance.random() * 50, 3, chance.choice("xyz"))
        for i in range(500)
    ]
    asked = [(chance.choice("ab"), chance.randrange(0, 7300), 10_000 + i) for i in range(120)]
    for limit in (None, 40):
        found = running.running_features(history(spark, rows), at(spark, asked), chunk=37, history_limit=limit)
        by_message = {r.seq: r for r in found.collect()}
        for topic, now, seq in asked:
            before = sorted((r for r in rows if r[0] == topic and r[1] <= now), key=lambda r: (r[1], r[2]))
            frame = [r for r in before[-(limit or len(before) + 1):] if r[1] >= now - 300]
            row = by_message[seq]
            assert row.recent_count == len(frame)
            if not frame:
                continue
            assert row.unique_sources == len({r[7] for r in frame})
            assert row.error_rate == pytest.approx(sum(r[3] >= 17 for r in frame) / len(frame))
            known = np.array([r[4] for r in frame if r[4] is not None])
            if len(known):
                want = (known.mean(), known.std(ddof=1) if len(known) > 1 else 0.0, np.quantile(known, 0.95), known.min(), known.max())
                have = (row.value_mean, row.value_std, row.value_p95, row.value_min, row.value_max)
                assert have == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_results_do_not_depend_on_the_cut(spark):
    chance = random.Random(5)
    rows = [entry(chance.randrange(0, 4000), chance.random() * 10 ** chance.randint(0, 12), i) for i in range(300)]
    asked = at(spark, [("demo-a", chance.randrange(0, 4000), 1000 + i) for i in range(60)])
    whole, *others = (
        {r.seq: r for r in running.running_features(history(spark, rows), asked, chunk=c, group_rows=g).collect()}
        for c, g in ((10_000, 10_000), (7, 10_000), (50, 60))
    )
    for other in others:
        assert whole.keys() == other.keys()
        for seq, row in whole.items():
            assert [*other[seq]][1:] == pytest.approx([*row][1:], rel=1e-7, abs=1e-3, nan_ok=True)


def test_a_message_sees_its_own_records(spark):
    ahead = log(observedTimeUnixNano=str(NANO + 2_000_000_000), severityNumber=17, body={"stringValue": "late"})
    tables = feature_tables.build(messages(spark, [ahead]))
    (row,) = tables.messages.collect()
    assert json.loads(row.enhanced_features)["error_rate"] == 1.0
    assert json.loads(row.sliding_features)["avg_messages_5m"] == 0.2


def test_all_records_of_a_topic_count(spark):
    rows = [entry(i / 200, 1.0, i) for i in range(12_000)]
    (whole,) = snapshot.aggregated_row(history(spark, rows), T0, T0 + dt.timedelta(seconds=60), 5).collect()
    assert whole.messages_per_minute == 12_000 / 5
    (row,) = running.running_features(history(spark, rows), at(spark, [("demo-a", 60, 99_999)]), chunk=1000).collect()
    assert row.recent_count == 12_000


def test_newest_follow_time_across_partitions(spark):
    # offsets of one partition far ahead of the other's
    seqs = [(s, (1000 - s if s % 2 else s) << 16 | s % 2) for s in range(20)]
    rows = [entry(s, float(s), q) for s, q in seqs]
    kept = store.newest(history(spark, rows), 3).collect()
    assert sorted(r.value for r in kept) == [17.0, 18.0, 19.0]


def test_a_topic_without_values_keeps_its_row(spark):
    rows = [("demo-a", 1.0, 1, 17, None, 0.0, 1, "s"), ("demo-a", 2.0, 2, 17, None, 0.0, 1, "s")]
    (row,) = snapshot.aggregated_row(history(spark, rows), T0, T0 + dt.timedelta(seconds=9), 5).collect()
    assert (row.error_rate, row.trend_coefficient) == (1.0, 0.0)


def test_nan_is_no_value_for_any_group_size(spark):
    rows = [entry(i, v, i) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, 5.0, math.nan])]
    small, large = (snapshot.enhanced_features(history(spark, rows), 5, group_rows=g).first().value_p95 for g in (10**6, 1))
    assert small == large == pytest.approx(4.8)


def test_parts_of_minutes(spark):
    rows = history(spark, [entry(-i, 1.0, i) for i in range(60)])
    assert store.recent(rows, T0, 0.5).count() == 31


WELL = ['{"a":1}', ' {"a":[1,{"b":null}]} ', '{"a":1,"a":2}', "{}", '\n{"x":1e5}\t']
ILL = ['{"a":1}][{"b":2}', "{\"a\":'x'}", "{'a':1}", '{"a":1}{"b":2}', '{"a":1},', '{"a":1}]', "[1]", "1", "null", "", '{"a":NaN}', '{"a":1', '{a:1}', '{"a":01}']


def test_one_object_strictly_read(spark):
    frame = spark.createDataFrame([(v,) for v in [*WELL, *ILL, None]], "v string")
    found = [r[0] for r in frame.select(scalars.is_json_object(F.col("v"))).collect()]
    assert found == [True] * len(WELL) + [False] * (len(ILL) + 1)
    kept = ops.quarantined(messages(spark, [*WELL, *ILL])).collect()
    assert sorted(r.value for r in kept) == sorted(ILL) and all(r.reason for r in kept)


@pytest.mark.parametrize(("given_as", "want"), [(17, 17), (17.0, 17), ("17", 17), ("17.0", 17), (17.5, 0), ("high", 0), (None, 0)])
def test_severities_as_numbers_and_text(spark, given_as, want):
    record = log(severityNumber=given_as, body={"stringValue": "x"})
    (row,) = ops.log_table(messages(spark, [record])).collect()
    assert row.severity_number == want and (row.error is not None) == (want >= 17)


@pytest.mark.parametrize("table", [ops.log_table, ops.span_table, ops.metric_table, history_table])
def test_messages_are_parsed_once(spark, table):
    rows = table(messages(spark, [log(severityNumber=9)]))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(resourceLogs") + plan.count("from_json(StructField(resourceSpans") <= 1
    assert plan.count("from_json(") - plan.count("from_json(StructField(key") <= 1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.floats(-9e13, 9e13), min_size=1, max_size=30))
def test_rounding_is_pythons(spark, xs):
    frame = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [r[0] for r in frame.select(scalars.present(F.col("x"), 2)).collect()] == [round(x, 2) for x in xs]


def test_a_late_message_opens_its_own_day(spark, tmp_path):
    root = job.TableRoot(str(tmp_path))
    for batch, day in enumerate((-9, -5, -1)):
        job.process_batch(messages(spark, [log(severityNumber=9)], ts=T0 + dt.timedelta(days=day)), batch, root)
    early = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    both = messages(spark, [log(severityNumber=17)]).unionByName(messages(spark, [log(severityNumber=9)], ts=early).withColumn("seq", F.lit(9)))
    days = []
    read = job.read_history

    def watched(*args):
        days.extend(args[4])
        return read(*args)

    job.read_history = watched
    try:
        job.process_batch(both, 3, root, keep_days=4)
    finally:
        job.read_history = read
    assert sorted(days) == [dt.date(1969, 12, 31), dt.date(1970, 1, 1), T0.date()]
    stored = {p.name for p in (tmp_path / "history").iterdir() if p.name.startswith("date=")}
    assert stored == {f"date={T0 - dt.timedelta(days=1):%Y-%m-%d}", f"date={T0:%Y-%m-%d}"}
    assert spark.read.parquet(root.table("messages")).filter("batch_id = 3").count() == 2


def test_rows_of_other_topics_are_left_out_before_ordering(spark, tmp_path, monkeypatch):
    root = job.TableRoot(str(tmp_path))
    job.process_batch(messages(spark, [log(severityNumber=9)] * 30, topic="demo-b"), 0, root)
    seen = []
    evaluate = feature_tables.running_features

    def watched(records, *args, **options):
        seen.extend(r[0] for r in records.select("topic").distinct().collect())
        return evaluate(records, *args, **options)

    monkeypatch.setattr(feature_tables, "running_features", watched)
    job.process_batch(messages(spark, [log(severityNumber=9)], topic="demo-a"), 1, root)
    assert seen == ["demo-a"]


def test_parse_gives_a_table(spark):
    assert parse(messages(spark, [log(severityNumber="17")])).select("logs").first().logs[0].severity_number == 17
