"""Streams that keep state: windows, sessions, redelivered records; restarts, late rows, bounded state."""

import pytest
from pyspark.sql import functions as F

from slumberline.functions.messages import encode_messages
from slumberline.rules import SleepRule
from slumberline.sources.events import EVENTS_TABLE_COLUMNS, canonical_events, read_events_table
from slumberline.sources.topic import append_records, stream_record_files
from slumberline.streaming import dedup, windows
from slumberline.streaming.scoring import scorable_rows, start_parquet_sink

SF_DIR = "/root/testdata/sf0.001"
RULE = SleepRule("click", 25.0)
HOUR = 3_600_000
NIGHT = 23 * HOUR
SCHEMA = "event_id bigint, timestamp bigint, sensor_id string, value float"


@pytest.fixture
def arrivals(spark, tmp_path):
    """A folder of events to which parts are added, each a file that the stream reads as a batch of its own."""
    path = str(tmp_path / "arrivals")

    def arrive(*parts):
        for part in parts:
            part.coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(path)

    return arrive


def run(rows, tmp_path, name="o"):
    query = start_parquet_sink(rows, str(tmp_path / name), str(tmp_path / f"{name}-c"), available_now=True)
    assert query.awaitTermination(120)
    return query


def made(spark, *rows):
    return spark.createDataFrame([(i, ms, "click", float(value)) for i, (ms, value) in enumerate(rows)], SCHEMA)


def time_slices(events, n):
    """The events in ``n`` parts by time."""
    cuts = [events.agg(F.percentile("timestamp", i / n)).first()[0] for i in range(1, n)]
    edges = [float("-inf"), *cuts, float("inf")]
    return [events.filter((F.col("timestamp") > low) & (F.col("timestamp") <= high)) for low, high in zip(edges, edges[1:])]


def closed(table, watermark_from):
    mark = watermark_from.agg(F.max("timestamp")).first()[0] - 600_000
    return table.filter(F.col("window_end") <= mark)


def same(one, other):
    rounded = lambda df: df.select(*[F.round(c, 6).alias(c) if k in ("double", "float") else F.col(c) for c, k in df.dtypes])
    one, other = rounded(one), rounded(other.select(*one.columns))
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


@pytest.mark.parametrize("stats", [windows.window_stats, windows.sliding_stats])
def test_windows_over_many_batches_and_a_restart_equal_batch(spark, arrivals, tmp_path, stats):
    events = read_events_table(spark, SF_DIR)
    parts = time_slices(events, 4)
    arrivals(*parts[:2])
    stream = arrivals(parts[2])
    first = run(stats(stream, RULE), tmp_path)
    arrivals(parts[3])
    second = run(stats(stream, RULE), tmp_path)
    result = spark.read.parquet(str(tmp_path / "o"))
    clicks = events.filter("sensor_id = 'click'")
    assert same(result, closed(stats(events, RULE), clicks))
    assert result.count() == result.select("window_start").distinct().count()
    # Only open windows are left in the state.
    assert windows.state_rows(first)[-1] < 12 and windows.state_rows(second)[-1] < 12
    assert max(windows.state_rows(first) + windows.state_rows(second)) < result.count()


def test_late_rows_are_left_out_and_counted(spark, arrivals, tmp_path):
    day = [(h * HOUR + m * 60_000, h + m) for h in range(10) for m in (0, 20, 40)]
    late = [(2 * HOUR + 1, 500.0), (3 * HOUR + 5, 500.0), (9 * HOUR + 50 * 60_000, 7.0)]
    stream = arrivals(made(spark, *day), made(spark, (9 * HOUR + 41 * 60_000, 1.0)), made(spark, *late))
    query = run(windows.window_stats(stream, RULE), tmp_path)
    result = spark.read.parquet(str(tmp_path / "o"))
    counts = windows.late_rows(windows.received_readings(query), result, str(tmp_path / "o-c"))
    assert counts == windows.LateRows(received=34, closed=27, open=5) and counts.late == 2
    assert result.agg(F.max("Max_Pressure")).first()[0] == 48.0
    assert [r["Count"] for r in windows.open_windows(spark, str(tmp_path / "o-c")).collect()] == [5]


def test_windows_of_few_and_unusable_readings(spark):
    nan = float("nan")
    events = made(spark, (0, 1.0), (1, 3.0), (2 * HOUR, 5.0), (4 * HOUR, nan))
    events = events.unionByName(spark.createDataFrame([(9, None, "click", 1.0), (8, 6 * HOUR, "click", None), (7, 0, "view", 9.0)], SCHEMA))
    for stats in (windows.window_stats, lambda e, r: windows.sliding_stats(e, r, slide="1 hour")):
        rows = {r["window_start"]: r for r in stats(events, RULE).collect()}
        assert set(rows) == {0, 2 * HOUR, 4 * HOUR, 6 * HOUR}
        assert rows[0]["Count"] == 2 and rows[0]["Mean_Pressure"] == 2.0 and rows[0]["StdDev_Pressure"] == 2**0.5
        assert rows[2 * HOUR]["StdDev_Pressure"] is None and rows[6 * HOUR]["Count"] == 0
        assert rows[6 * HOUR]["Mean_Pressure"] is None and rows[6 * HOUR]["Min_Pressure"] is None


def test_sessions_by_their_gap(spark):
    minute, gap = 60_000, 30 * 60_000
    rows = [(NIGHT, 30.0), (NIGHT + gap, 30.0), (NIGHT + 2 * gap + 1, 40.0), (NIGHT + 2 * gap + minute, 50.0)]
    awake = [(NIGHT + gap + minute, 10.0), (NIGHT + 15 * HOUR, 99.0), (NIGHT + 2, float("inf"))]
    found = windows.sleep_sessions(made(spark, *rows, *awake), RULE).orderBy("session_start").collect()
    assert [tuple(r)[1:] for r in found] == [
        (NIGHT, NIGHT + gap, 2, 30.0),
        (NIGHT + 2 * gap + 1, NIGHT + 2 * gap + minute, 2, 45.0),
    ]


def test_sessions_merge_over_batches(spark, arrivals, tmp_path):
    """The reading that joins two sessions comes in a later batch than both, and a restart lies between."""
    minute = 60_000
    near = [(NIGHT, 30.0), (NIGHT + 50 * minute, 30.0)]
    stream = arrivals(made(spark, *near))
    sessions = lambda: windows.sleep_sessions(stream, RULE, delay="2 hours")
    run(sessions(), tmp_path)
    assert spark.read.parquet(str(tmp_path / "o")).isEmpty()
    arrivals(made(spark, (NIGHT + 25 * minute, 36.0)), made(spark, (NIGHT + 24 * HOUR, 30.0)))
    query = run(sessions(), tmp_path)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).collect()] == [
        ("click", NIGHT, NIGHT + 50 * minute, 3, 32.0)
    ]
    assert windows.state_rows(query)[-1] == 1


def records_of(events):
    records = encode_messages(events, "event_id")
    return records.select(F.col("event_id").cast("string").cast("binary").alias("key"), "value")


def test_redelivered_records_count_once_and_leave_the_state(spark, tmp_path):
    events = read_events_table(spark, SF_DIR)
    path = str(tmp_path / "topic")
    for part in time_slices(events, 5):
        # Each part arrives, and arrives again when the producer starts anew.
        append_records(records_of(part).coalesce(1), path)
        append_records(records_of(part).coalesce(1), path)
    rows = lambda: dedup.scorable_once(stream_record_files(spark, path, max_files_per_trigger=1), RULE, "4 hours")
    query = run(rows(), tmp_path)
    result = spark.read.parquet(str(tmp_path / "o"))
    expected = scorable_rows(records_of(events), RULE)
    assert same(result, expected)
    assert windows.state_rows(query)[-1] <= 6 and max(windows.state_rows(query)) < result.count() / 2
    # A restart reads nothing twice either.
    append_records(records_of(time_slices(events, 5)[4]), path)
    run(rows(), tmp_path)
    assert same(spark.read.parquet(str(tmp_path / "o")), expected)


def test_records_without_key_and_with_one_value(spark, tmp_path):
    text = '{"timestamp":%d,"sensor_id":"click","value":1}'
    rows = [(None, text % 1), (None, text % 1), (None, text % 2), (b"a", text % 1), (b"b", text % 1), (b"a", text % 1), (None, None)]
    records = spark.createDataFrame([(k, v and v.encode()) for k, v in rows], "key binary, value binary")
    assert dedup.scorable_once(records, RULE).count() == 4
    append_records(records, str(tmp_path / "topic"))
    run(dedup.scorable_once(stream_record_files(spark, str(tmp_path / "topic")), RULE), tmp_path)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 4


def test_an_events_table_of_many_files_needs_a_wide_enough_delay(spark, arrivals, tmp_path):
    """Parts out of order: with a delay that covers the disorder nothing is late."""
    events = read_events_table(spark, SF_DIR)
    parts = time_slices(events, 4)
    stream = arrivals(parts[1], parts[0], parts[3], parts[2])
    query = run(windows.window_stats(stream, RULE, delay="20 days"), tmp_path)
    result = spark.read.parquet(str(tmp_path / "o"))
    assert windows.late_rows(windows.received_readings(query), result, str(tmp_path / "o-c")).late == 0
    assert EVENTS_TABLE_COLUMNS.event_id in canonical_events(spark.read.parquet(f"{SF_DIR}/events.parquet"), EVENTS_TABLE_COLUMNS).columns
