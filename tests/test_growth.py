"""What one task does stays the same when tables grow."""

from __future__ import annotations

import datetime as dt

import pyarrow.parquet as pq
import pytest
from builders import T0, history
from pyspark.sql import functions as F
from test_features import check, expected_at_messages, frame_of, some_history

from pulsegrid.operators import quantiles, running
from pulsegrid.plans import envelopes, feature_tables
from pulsegrid.plans.queries import QUERIES
from pulsegrid.session import files_at_once
from pulsegrid.sources import messages as sources_of_messages
from pulsegrid.sources import sinks
from pulsegrid.streaming import job


def _events(spark, path, rows):
    table = spark.range(rows).select(
        F.col("id").alias("event_id"),
        F.lit(dt.datetime(2024, 1, 1)).alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(1.5).alias("value"),
    )
    table.coalesce(1).write.parquet(f"{path}/events.parquet")


@pytest.mark.parametrize("rows", [10, 5_000])
def test_splits_of_messages_grow_in_number_not_in_size(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(envelopes, "SPLIT_ROWS", 500)
    _events(spark, tmp_path, rows)
    made = envelopes.messages(envelopes.events(spark, str(tmp_path)))
    sizes = [r["count"] for r in made.groupBy(F.spark_partition_id().alias("split")).count().collect()]
    assert sum(sizes) == rows
    assert max(sizes) < 1_000


def test_routed_lines_are_written_without_a_sort(spark, tmp_path):
    rows = spark.range(40).select(
        F.format_string("r%d", F.col("id") % 5).alias("route"),
        F.lit("logs").alias("signal"),
        F.col("id").cast("string").alias("value"),
    )
    with files_at_once(spark, sinks.ROUTED_FILES):
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == str(sinks.ROUTED_FILES)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") != str(sinks.ROUTED_FILES)
    lines = rows.coalesce(1).sortWithinPartitions(F.col("value").cast("int"))
    sinks.write_routed(lines, str(tmp_path), 3)
    back = sinks.read_routed(spark, str(tmp_path))
    assert {(r["batch_id"], r["route"], r["value"]) for r in back.collect()} == {(3, f"r{i % 5}", str(i)) for i in range(40)}


def test_routed_lines_are_compressed(spark, tmp_path):
    line = F.format_string('{"resourceLogs":[{"resource":{"attributes":[{"key":"service.name","n":%d}]}}]}', F.col("id"))
    rows = spark.range(5_000).select(F.lit("flask").alias("route"), F.lit("logs").alias("signal"), line.alias("value")).coalesce(1)
    sinks.append_files(rows, str(tmp_path / "appended"))
    sinks.write_routed(rows, str(tmp_path / "written"), 3)
    lines = {r["value"] for r in rows.collect()}
    for folder in ("appended", "written"):
        files = [*(tmp_path / folder).rglob("part-*")]
        assert sum(f.stat().st_size for f in files) < sum(map(len, lines)) / 5
        assert {r["value"] for r in spark.read.text(str(tmp_path / folder)).collect()} == lines


def test_a_folder_gets_one_file_of_many_batches(spark, tmp_path):
    rows = spark.range(400).repartition(8).select(
        F.lit("demo").alias("topic"),
        F.col("id").cast("string").alias("value"),
        F.timestamp_seconds(F.col("id") * 7 % 400).alias("ts"),
        (F.col("id") % 20).alias("batch_id"),
        F.timestamp_seconds(F.col("id") % 20).alias("window_start"),
    )
    for _ in range(2):
        sinks.write_messages(rows, str(tmp_path / "messages"), many_batches=True)
    kept = spark.read.parquet(str(tmp_path / "messages"))
    assert {(int(r.value) % 20, r.value) for r in kept.collect()} == {(i % 20, str(i)) for i in range(400)}
    assert all(r.batch_id == int(r.value) % 20 for r in kept.collect())
    assert [len([*p.glob("part-*")]) for p in (tmp_path / "messages").glob("date=*/batch_id=*")] == [1] * 20
    one = [r.ts for r in spark.read.parquet(str(next((tmp_path / "messages").glob("date=*/batch_id=3")))).collect()]
    assert one == sorted(one)

    sinks.write_rollups(kept.groupBy("batch_id", "value").count().repartition(8), str(tmp_path / "rollups"))
    assert [len([*p.glob("part-*")]) for p in (tmp_path / "rollups").glob("batch_id=*")] == [1] * 20


@pytest.mark.parametrize(("chunk", "group_rows", "same_time"), [(3, 50, False), (7, 10**6, False), (5, 30, True)])
def test_long_frames_are_merged_from_parts(spark, monkeypatch, chunk, group_rows, same_time):
    rows = some_history(150, same_time=same_time)
    frame = frame_of(rows)
    asked = [(r.topic, r.timestamp.to_pydatetime(), r.seq) for r in frame.itertuples()]
    end = frame["timestamp"].max().to_pydatetime()
    asked += [("demo-a", T0 - dt.timedelta(hours=1), 900), ("demo-c", end, 2001)]
    asked += [("demo-a", end + dt.timedelta(minutes=30 * i), 2000 + i) for i in range(20)]
    messages = spark.createDataFrame(asked, "topic string, ts timestamp, seq long")
    windows, merged, plain = (5, 15, 600), [], running._far_frames
    monkeypatch.setattr(running, "_far_frames", lambda *a: merged.append(a[2]) or plain(*a))
    found = running.running_features(history(spark, rows), messages, windows, 5, chunk=chunk, group_rows=group_rows)
    found = {(r.topic, r.seq): r.asDict() for r in found.collect()}
    assert merged and 600 in merged[0]
    wanted = dict(expected_at_messages(rows, asked, windows, 5, 10**9))
    assert set(found) == set(wanted)
    for key, want in wanted.items():
        assert found[key]["history_count"] == want["history_count"]
        check(found[key], want, running.enhanced_names() + running.sliding_names(windows))


def test_further_digits_are_worked_out_for_chosen_cells_only(spark, monkeypatch):
    seen, plain = [], quantiles._with_digits
    monkeypatch.setattr(quantiles, "_with_digits", lambda cells: seen.append(cells.columns) or plain(cells))
    values = [1.0, 1.0 + 1e-9, 1.0 + 2e-9, 7.5, -3.0, 0.0, None]
    rows = spark.createDataFrame([("a", v) for v in values], "topic string, value double")
    found = quantiles.exact_quantile(rows, ["topic"], ["value"], 0.5).first()["value_q"]
    assert found == 1.0 + 0.5 * 1e-9 or abs(found - (1.0 + 0.5e-9)) < 1e-12
    assert ["low" in columns for columns in seen] == [False, True, True]


def test_a_feature_document_is_read_once(spark, tmp_path):
    """Four fields of a document take one reading of it."""
    rows = [(1, dt.datetime(2024, 1, 1, 12), 3, "error", 2.5), (2, dt.datetime(2024, 1, 1, 13), 4, "view", 7.25)]
    made = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    made.write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["f4_feature_documents"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, "SQLSTATE[42P01]: user 3", 2.5, 2.0, "app1"),
        (2, "Handled view", 7.25, 7.25, "app2"),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan and plan.count("from_json") == 1


def _sent(spark, tmp_path, rows=40, damaged=False):
    _events(spark, tmp_path, rows)
    return envelopes.messages(envelopes.events(spark, str(tmp_path)), damaged=damaged)


def test_a_batch_reads_its_messages_once(spark, tmp_path):
    """The bounds come from the parsed table, unreadable messages included; the source is not built for them again."""
    sent, seen = _sent(spark, tmp_path, damaged=True), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    tables = feature_tables.build(sent.mapInArrow(count, sent.schema))
    assert seen.value == 40
    assert tables.window_start == tables.window_end == dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    assert tables.messages.count() == 36 and tables.quarantine.count() == 4


def test_records_of_a_batch_are_exploded_once(spark, tmp_path, monkeypatch):
    kept, plain = [], feature_tables.aggregated_row
    monkeypatch.setattr(feature_tables, "aggregated_row", lambda h, *a, **o: kept.append(h) or plain(h, *a, **o))
    feature_tables.build(_sent(spark, tmp_path))
    plan = kept[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and kept[0].count() == 120


def test_the_parsed_table_keeps_no_dictionaries(spark, tmp_path):
    parsed = feature_tables.parse_batch(_sent(spark, tmp_path))
    files = [f.removeprefix("file:") for f in parsed.inputFiles()]
    chunks = [pq.ParquetFile(f).metadata.row_group(0).column(0) for f in files if pq.ParquetFile(f).metadata.num_rows]
    assert chunks and not any(c.has_dictionary_page for c in chunks)
    assert parsed.count() == 40


@pytest.mark.parametrize("rows", [40, 200])
def test_parts_of_joined_messages_grow_in_number_not_in_size(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(feature_tables, "JOINED_ROWS", 10)
    monkeypatch.setattr(feature_tables, "attach_correlation", lambda rows, scores: rows.withColumn(
        "correlation_features", F.lit("")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        made = feature_tables.build(_sent(spark, tmp_path, rows)).messages
        sizes = [r["count"] for r in made.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(sizes) == rows and max(sizes) <= 30
    filled = made.filter("features != '' AND enhanced_features != '' AND sliding_features != ''")
    assert filled.count() == rows


class _Enough(Exception):
    pass


@pytest.mark.parametrize("name", ["s5_stream_tables", "a30_across_batches"])
def test_stream_files_grow_in_number(spark, tmp_path, monkeypatch, name):
    """The messages that a query streams are written by as many tasks as their events have splits."""
    monkeypatch.setattr(envelopes, "SPLIT_ROWS", 100)
    _events(spark, tmp_path, 2_000)
    seen = {}

    def stopped(spark, path, **options):
        seen.update(options, files=spark.read.parquet(path).inputFiles())
        raise _Enough

    monkeypatch.setattr(sources_of_messages, "message_table_stream", stopped)
    with pytest.raises(_Enough):
        QUERIES[name](spark, str(tmp_path))
    signals = 3 if name.startswith("a30") else 1
    assert len(seen["files"]) == 20 * signals
    if signals > 1:
        assert seen["maxFilesPerTrigger"] == "20"


def test_the_job_reads_its_source_once_and_keeps_no_copy_of_it(spark, tmp_path, monkeypatch):
    _events(spark, tmp_path, 50)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    sent = envelopes.messages(envelopes.events(spark, str(tmp_path)))
    sent = sent.mapInArrow(counted, "topic string, value string, ts timestamp, seq bigint")

    def refused(*_):
        raise AssertionError("messages are kept")

    monkeypatch.setattr(type(sent), "persist", refused)
    root = job.TableRoot(str(tmp_path / "out"))
    job.process_batch(sent, 0, root)
    assert read.value == 50
    assert spark.read.parquet(root.table("messages")).count() == 50
