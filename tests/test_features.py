"""Rates, quantiles, trends and windows against pandas and numpy."""

from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from builders import T0, history
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.operators import running, snapshot
from pulsegrid.operators import history as hist
from pulsegrid.operators.joins import attach
from pulsegrid.operators.ordering import running_counts
from pulsegrid.operators.quantiles import exact_quantile

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
NUMBERS = st.floats(allow_nan=False, allow_infinity=False, width=64)


def close(a, b, tolerance=1e-9):
    if a is None or b is None or (isinstance(a, float) and math.isnan(a)):
        return (a is None or math.isnan(a)) and (b is None or math.isnan(b))
    return math.isclose(a, b, rel_tol=tolerance, abs_tol=1e-7)


def some_history(n=300, seed=1, topics=("demo-a", "demo-b"), step=40.0, same_time=False):
    rng = random.Random(seed)
    rows, clock = [], 0.0
    for seq in range(n):
        clock += 0 if same_time else rng.choice([0.0, rng.random() * step])
        rows.append(
            (
                topics[0] if rng.random() < 0.7 else rng.choice(topics),
                clock, seq, rng.choice([0, 9, 13, 17, 21]), rng.choice([None, rng.random() * 500 - 20, 5.0]),
                rng.choice([0.0, rng.random() * 90]), rng.randrange(60), rng.choice(["", "a", "b", "c"]),
            )
        )
    return rows


# ---- reference results in pandas ------------------------------------------


def slope_of(values):
    y = np.array([v for v in values if v is not None and not math.isnan(v)], float)
    return float(np.polyfit(np.arange(len(y)), y, 1)[0]) if len(y) > 1 else 0.0


def enhanced_of(df: pd.DataFrame, minutes: float) -> dict:
    out = {
        "messages_per_minute": len(df) / max(minutes, 1),
        "unique_sources": df["source"].nunique(),
        "error_rate": (df["severity_number"] >= 17).mean(),
    }
    for c in snapshot.MEASURES:
        x = pd.to_numeric(df[c], errors="coerce").dropna()
        if len(x):
            std = x.std() if len(x) > 1 else 0.0
            out |= {
                f"{c}_mean": x.mean(), f"{c}_std": std, f"{c}_p95": x.quantile(0.95),
                f"{c}_cv": std / x.mean() if x.mean() > 0 else 0.0, f"{c}_min": x.min(), f"{c}_max": x.max(),
            }
    out["peak_hour"] = int(df["hour"].mode().iloc[0])
    out["hour_variance"] = df["hour"].var() if len(df) > 1 else 0.0
    return out


def sliding_of(df: pd.DataFrame, w: int) -> dict:
    if not len(df):
        return {f"avg_messages_{w}m": 0.0, f"error_rate_{w}m": 0.0, f"trend_{w}m": 0.0}
    out = {
        f"avg_messages_{w}m": len(df) / max(w, 1),
        f"error_rate_{w}m": (df["severity_number"] >= 17).mean(),
        f"trend_{w}m": slope_of(df["value"]),
    }
    if len(df) > 1:
        bins = pd.cut(df["timestamp"], bins=5, labels=False)
        out[f"volume_trend_{w}m"] = slope_of(df.groupby(bins).size().to_numpy())
        out[f"duration_trend_{w}m"] = slope_of(df["duration_ms"])
        out[f"avg_duration_{w}m"] = df["duration_ms"].mean()
    return out


def check(row: dict, want: dict, names: list[str]) -> None:
    for name in names:
        if name in want:
            assert close(row[name], want[name]), (name, row[name], want[name])


# ---- ordered groups ----------------------------------------------------------


@pytest.mark.parametrize("same_time", [False, True])
def test_running_counts_sliced_equals_window(spark, same_time):
    """One topic holds most rows, in the second case all at one instant."""
    frame = history(spark, some_history(500, same_time=same_time))
    counts = {"all": F.lit(True), "errors": F.col("severity_number") >= 17}
    order = ["timestamp", "seq", "pos"]
    whole = running_counts(frame, ["topic"], order, counts)
    sliced = running_counts(frame, ["topic"], order, counts, group_rows=40)
    assert sorted(whole.collect()) == sorted(sliced.select(whole.columns).collect())
    assert {r["all"] for r in whole.filter("topic = 'demo-b'").collect()} == set(
        range(1, whole.filter("topic = 'demo-b'").count() + 1)
    )


def test_sliced_rows_spread_over_many_tasks(spark, monkeypatch):
    """A group holding most rows at one instant still fills every slice about equally."""
    import pulsegrid.operators.ordering as ordering

    kept = []
    real = ordering.materialise
    monkeypatch.setattr(ordering, "materialise", lambda df, label: kept.append(real(df, label)) or kept[-1])
    frame = history(spark, some_history(2000, same_time=True))
    running_counts(frame, ["topic"], ["timestamp", "seq", "pos"], {"n": F.lit(True)}, group_rows=200)
    sizes = [r["count"] for r in kept[0].groupBy("_slice").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 400


@SLOW
@given(st.lists(NUMBERS, min_size=1, max_size=40), st.sampled_from([0.0, 0.25, 0.5, 0.95, 1.0]))
def test_exact_quantile_equals_numpy(spark, values, q):
    frame = spark.createDataFrame([("g", float(v)) for v in values], "k string, x double")
    found = exact_quantile(frame, ["k"], ["x"], q).first()["x_q"]
    want = float(np.quantile(np.array(values), q))
    assert math.isclose(found, want, rel_tol=1e-9, abs_tol=1e-300) or abs(found - want) <= 1e-12 * max(
        map(abs, values)
    )


def test_exact_quantile_edges(spark):
    tiny, big = 5e-324, 1.7976931348623157e308
    groups = {
        "one": [3.0],
        "same": [7.0] * 1000 + [8.0],
        "close": [1.0 + k * 2.0**-52 for k in range(50)],
        "signs": [-5.5, -0.0, 0.0, 2.5, -1e-300, 1e-300],
        "range": [tiny, 2.0**-1022, 1.0, big, -big],
        "inf": [1.0, 2.0, float("inf")],
        "nan": [1.0, 3.0, float("nan"), None],
    }
    frame = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, x double")
    for limit in (1000, 0):  # broadcast targets, and the salted join
        found = {r.k: r.x_q for r in exact_quantile(frame, ["k"], ["x"], 0.5, broadcast_rows=limit).collect()}
        for key, values in groups.items():
            clean = [v for v in values if v is not None and not math.isnan(v)]
            assert found[key] == statistics.median(clean), key


def test_attach_broadcast_and_salted_agree(spark):
    left = spark.range(200).selectExpr("id", "CASE WHEN id < 150 THEN 'hot' ELSE 'k' || id END AS k")
    right = spark.createDataFrame([("hot", 1), ("k160", 2), ("none", 3)], "k string, v int")
    for how in ("left", "inner", "left_semi"):
        small = attach(left, right, ["k"], ["id"], how)
        salted = attach(left, right, ["k"], ["id"], how, limit=0).select(small.columns)
        assert sorted(small.collect(), key=str) == sorted(salted.collect(), key=str)


# ---- snapshots -----------------------------------------------------------------


def frame_of(rows) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns="topic seconds seq severity_number value duration_ms body_length source".split())
    df["timestamp"] = pd.to_datetime(T0) + pd.to_timedelta((df["seconds"] * 1e6).round(), unit="us")
    df["hour"] = df["timestamp"].dt.hour
    return df.sort_values(["timestamp", "seq"])


@pytest.mark.parametrize("group_rows", [1_000_000, 20])
def test_enhanced_features_equal_pandas(spark, group_rows):
    rows = some_history(400)
    found = snapshot.enhanced_features(history(spark, rows), 5, group_rows=group_rows).collect()
    want = {t: enhanced_of(g, 5) for t, g in frame_of(rows).groupby("topic")}
    assert len(found) == len(want)
    for row in found:
        check(row.asDict(), want[row.topic], running.enhanced_names())


def test_single_record_has_no_deviation(spark):
    row = snapshot.enhanced_features(history(spark, [("t", 0, 0, 17, 4.0, 0.0, 3, "s")])).first()
    assert (row.value_std, row.value_cv, row.hour_variance, row.value_p95) == (0.0, 0.0, 0.0, 4.0)
    assert row.duration_ms_cv == 0.0 and row.error_rate == 1.0


def test_error_basis_and_hour_tie(spark):
    rows = history(spark, [("t", 0, 0, 0, 1.0, 0.0, 0, "s"), ("t", 3600, 1, 0, 1.0, 0.0, 0, "s")])
    rows = rows.withColumn("is_error", F.lit(1))
    assert snapshot.enhanced_features(rows).first().error_rate == 0.0
    row = snapshot.enhanced_features(rows, error_basis="is_error").first()
    assert row.error_rate == 1.0 and row.peak_hour == 12


@pytest.mark.parametrize("group_rows", [1_000_000, 20])
def test_trend_equals_polyfit(spark, group_rows):
    rows = some_history(300)
    found = {r.topic: r.trend for r in snapshot.trend(history(spark, rows), "value", group_rows=group_rows).collect()}
    for topic, group in frame_of(rows).groupby("topic"):
        assert close(found[topic], slope_of(group["value"]))


def test_trend_below_two_values(spark):
    rows = [("a", 0, 0, 0, 1.0, 0.0, 0, ""), ("b", 0, 1, 0, None, 0.0, 0, ""), ("b", 1, 2, 0, 2.0, 0.0, 0, "")]
    found = {r.topic: r.trend for r in snapshot.trend(history(spark, rows), "value").collect()}
    assert found == {"a": 0.0, "b": 0.0}


@pytest.mark.parametrize("group_rows", [1_000_000, 20])
def test_sliding_snapshot_equals_pandas(spark, group_rows):
    rows = some_history(300)
    frame = frame_of(rows)
    as_of = frame["timestamp"].max() - pd.Timedelta(minutes=3)
    windows = (5, 15, 60)
    found = snapshot.sliding_snapshot(history(spark, rows), as_of.to_pydatetime(), windows, group_rows=group_rows)
    rows_found = {r.topic: r.asDict() for r in found.collect()}
    assert set(rows_found) == set(frame["topic"])
    for topic, group in frame.groupby("topic"):
        for w in windows:
            inside = group[(group.timestamp >= as_of - pd.Timedelta(minutes=w)) & (group.timestamp <= as_of)]
            want = sliding_of(inside, w)
            names = [n for n in running.sliding_names((w,))]
            check(rows_found[topic], want, names)
            assert all(rows_found[topic][n] is None for n in names if n not in want)


def test_future_records_only_with_open_end(spark):
    rows = history(spark, [("t", 0, 0, 0, 1.0, 0.0, 0, ""), ("t", 600, 1, 0, 1.0, 0.0, 0, "")])
    assert hist.recent(rows, T0, 5).count() == 1
    assert hist.recent(rows, T0, 5, open_end=True).count() == 2


def test_newest_keeps_exactly_the_last_arrivals(spark):
    rows = some_history(400)
    kept = hist.newest(history(spark, rows), 50).collect()
    for topic, group in frame_of(rows).groupby("topic"):
        want = sorted(group["seq"])[-50:]
        assert sorted(r.seq for r in kept if r.topic == topic) == want


def test_aggregated_row(spark):
    rows = some_history(300, step=4.0)
    frame = frame_of(rows)
    end = frame["timestamp"].max().to_pydatetime()
    capped = snapshot.aggregated_row(history(spark, rows), T0, end, 5, history_limit=30).collect()
    whole = snapshot.aggregated_row(history(spark, rows), T0, end, 5, history_limit=None, group_rows=10).collect()
    for found, limit in ((capped, 30), (whole, 10**9)):
        for row in found:
            group = frame[frame.topic == row.topic].sort_values("seq").tail(limit)
            group = group[group.timestamp >= pd.Timestamp(end) - pd.Timedelta(minutes=5)]
            want = enhanced_of(group, 5)
            assert close(row.messages_per_minute, want["messages_per_minute"])
            assert close(row.p95_duration_ms, want["duration_ms_p95"])
            assert close(row.trend_coefficient, slope_of(group.sort_values(["timestamp", "seq"])["value"]))


def test_aggregated_row_is_absent_without_recent_records(spark):
    rows = history(spark, [("old", 0, 0, 0, 1.0, 0.0, 0, "")])
    assert snapshot.aggregated_row(rows, T0, T0 + dt.timedelta(hours=1)).count() == 0


# ---- features at every message ---------------------------------------------------


def expected_at_messages(rows, asked, windows, minutes, limit):
    frame = frame_of(rows)
    for topic, at, seq in asked:
        mine = frame[frame.topic == topic]
        at = pd.Timestamp(at)
        upto = mine[(mine.timestamp < at) | ((mine.timestamp == at) & (mine.seq <= seq))]
        last = upto.tail(limit)
        want = {"history_count": len(upto)}
        recent = last[last.timestamp >= at - pd.Timedelta(minutes=minutes)]
        want["recent_count"] = len(recent)
        if len(recent):
            want |= enhanced_of(recent, minutes)
        for w in windows:
            want |= sliding_of(last[last.timestamp >= at - pd.Timedelta(minutes=w)], w)
        yield (topic, seq), want


@pytest.mark.parametrize(
    ("chunk", "limit", "group_rows", "same_time"),
    [(40_000, 10_000, 10**6, False), (17, 23, 50, False), (50, 7, 50, False), (9, 40, 30, True)],
)
def test_features_at_messages_equal_brute_force(spark, chunk, limit, group_rows, same_time):
    rows = some_history(220, same_time=same_time)
    frame = frame_of(rows)
    asked = [(r.topic, r.timestamp.to_pydatetime(), r.seq) for r in frame.itertuples()]
    # messages without records: before everything, in a run at one instant, far later, unknown topic
    end = frame["timestamp"].max().to_pydatetime()
    asked += [("demo-a", T0 - dt.timedelta(hours=1), 900)]
    asked += [("demo-a", end, 1000 + i) for i in range(60)]
    asked += [("demo-a", end + dt.timedelta(minutes=30), 2000), ("demo-c", end, 2001)]
    messages = spark.createDataFrame(asked, "topic string, ts timestamp, seq long")
    windows = (5, 15, 60)
    found = running.running_features(
        history(spark, rows), messages, windows, 5, limit, chunk=chunk, group_rows=group_rows
    )
    found = {(r.topic, r.seq): r.asDict() for r in found.collect()}
    names = running.enhanced_names() + running.sliding_names(windows)
    wanted = dict(expected_at_messages(rows, asked, windows, 5, limit))
    assert set(found) == set(wanted)
    for key, want in wanted.items():
        row = found[key]
        assert (row["history_count"], row["recent_count"]) == (want["history_count"], want["recent_count"])
        check(row, want, names)
        if not want["recent_count"]:
            assert row["value_mean"] is None and row["peak_hour"] is None


def test_documents_of_running_features(spark):
    rows = history(spark, [("t", 0, 0, 17, 2.0, 0.0, 3, "s")])
    asked = [("t", T0, 0), ("t", T0 + dt.timedelta(hours=2), 1), ("u", T0, 2)]
    messages = spark.createDataFrame(asked, "topic string, ts timestamp, seq long")
    found = running.running_features(rows, messages).select(
        "seq", running.enhanced_document().alias("e"), running.sliding_document().alias("s")
    )
    by = {r.seq: r for r in found.collect()}
    assert by[0].e.startswith('{"messages_per_minute":0.2,"unique_sources":1,"window_minutes":5,"error_rate":1.0')
    assert by[0].s.startswith('{"avg_messages_5m":0.2,"error_rate_5m":1.0,"trend_5m":0.0,"avg_messages_15m"')
    assert by[1].e == "" and by[1].s.startswith('{"avg_messages_5m":0.0')
    assert by[2].e == "" and by[2].s == ""
