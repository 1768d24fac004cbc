"""Streams over several triggers, late rows, restarts and sinks."""

import os
import random
import time
from collections import Counter
from datetime import timedelta
from functools import partial

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.test_units_batch import SECOND, skewed_events
from tests.unit_simulation import units as simulated
from tidemark.catalog import stand_ins
from tidemark.operators import units as batch_units
from tidemark.operators import windows
from tidemark.plans import mentions, reconciliation, viewing
from tidemark.session import shared_folder
from tidemark.sources import streams
from tidemark.streaming import sinks
from tidemark.streaming import units as stream_units
from tidemark.streaming.replay import by_time, replay, replay_branches, replay_in_slices

BASE = 1_700_000_000 * SECOND  # a time above the first watermark, which is the year 1970
SCHEMA = "key bigint, us bigint, id bigint"


def write_file(folder, number, rows):
    """One parquet file per trigger; modification times are set so that files are taken in order."""
    os.makedirs(folder, exist_ok=True)
    columns = list(zip(*((key, BASE + us, number) for key, us, number in rows)))
    path = f"{folder}/part-{number:03d}.parquet"
    pq.write_table(pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("key", "us", "id"), columns)}), path)
    stamp = time.time() - 1000 + number
    os.utime(path, (stamp, stamp))


def stream_of(spark, folder):
    rows = streams.table_stream(spark, folder, SCHEMA, files_per_trigger=1)
    return rows.select("key", F.timestamp_micros("us").alias("ts"), "id")


@pytest.fixture(scope="module")
def timed_files(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("timed"))
    events = sorted(skewed_events(4, 900, 20, 600), key=lambda e: (e[1], e[2]))
    slices = [[e for e in events if e[1] // (100 * SECOND) == part] for part in range(6)]
    for number, rows in enumerate(slices):
        write_file(folder, number, rows)
    return folder, events


def closed(found):
    return {(r.key, r.n, r.first_ts, r.last_ts, r.status) for r in found.collect()}


@pytest.mark.parametrize("limit", [{"idle": timedelta(seconds=30)}, {"deadline": timedelta(seconds=90)}])
def test_units_over_six_triggers_equal_the_batch_form(spark, timed_files, limit):
    folder, _ = timed_files
    found = replay(stream_units.units(stream_of(spark, folder), "key", "ts", 10, **limit), "append")
    batch = spark.read.schema(SCHEMA).parquet(folder).select("key", F.timestamp_micros("us").alias("ts"), "id")
    expected = batch_units.units(batch, "key", "ts", "id", 10, flush=False, partitions=5, **limit)
    assert closed(found) == closed(expected)
    assert {r.status for r in found.select("status").distinct().collect()} == {"completed", "timed_out"}


@pytest.mark.parametrize("slice_rows, spans", [(10_000, 4), (200, 5)])
def test_slices_of_time_give_the_same_units(spark, tmp_path, slice_rows, spans):
    """The table is written in no order at all; a third and more of its rows belong to one key."""
    events = [(key, BASE + us, number) for key, us, number in skewed_events(6, 900, 20, 100_000)]
    spark.createDataFrame(events, SCHEMA).selectExpr("key", "timestamp_micros(us) AS ts", "id").write.parquet(
        str(tmp_path / "table")
    )
    rows = spark.read.parquet(str(tmp_path / "table"))
    written = spark.read.parquet(by_time(rows, "ts", slice_rows, 4))
    bounds = written.groupBy("slice").agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n")).orderBy("slice").collect()
    assert len(bounds) == spans and max(x.n for x in bounds) < 1.5 * len(events) / spans and all(x.b < y.a for x, y in zip(bounds, bounds[1:])) and sum(x.n for x in bounds) == len(events)
    limit = {"idle": timedelta(seconds=5000)}
    found = replay_in_slices(
        rows, "ts", lambda stream: stream_units.units(stream, "key", "ts", 10, **limit),
        partial(replay, mode="append"), slice_rows, 4,
    )
    assert closed(found) == closed(batch_units.units(rows, "key", "ts", "id", 10, flush=False, **limit))


def test_rows_without_a_time_lie_in_no_span(spark):
    rows = spark.createDataFrame([(1, None), (2, None)], "key bigint, us bigint").selectExpr("key", "timestamp_micros(us) AS ts")
    counted = partial(windows.tumbling, ts="ts", size="1 minute", late="2 minutes", n=F.count(F.lit(1)))
    found = replay_in_slices(rows, "ts", counted, partial(replay, mode="update", keys=["window_start", "window_end"]))
    assert found.count() == 0


@pytest.mark.parametrize("slice_rows, least", [(10_000, 1), (10_000, 5), (60, 1)])
def test_windows_do_not_depend_on_the_number_of_spans(spark, timed_files, slice_rows, least):
    folder, events = timed_files
    rows = spark.read.schema(SCHEMA).parquet(folder).select("key", F.timestamp_micros("us").alias("ts"))
    starts, arrived = [], []

    def counted(stream):
        return windows.tumbling(stream, "ts", "1 minute", "key", late="2 minutes", n=F.count(F.lit(1)))

    def run(stream, feed, **folders):
        starts.append(1)
        steps = [lambda step=step: arrived.append(1) or step() for step in feed]
        return replay(stream, "update", ["window_start", "window_end", "key"], feed=steps, **folders)

    found = replay_in_slices(rows, "ts", counted, run, slice_rows, least)
    direct = windows.tumbling(rows, "ts", "1 minute", "key", n=F.count(F.lit(1)))
    assert len(starts) == 1 and len(arrived) >= max(least, min(len(events) // slice_rows, 40) - 3)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, direct.collect()))


def test_rows_without_a_time_may_come_last(spark):
    rows = spark.createDataFrame([(i, i * SECOND if i % 3 else None) for i in range(60)], "key bigint, us bigint")
    rows = rows.selectExpr("key", "timestamp_micros(us) AS ts")
    written = spark.read.parquet(by_time(rows, "ts", 10, timeless=True))
    assert written.count() == 60 and written.where("ts IS NULL").select("slice").distinct().count() == 1
    assert written.where("ts IS NULL").first().slice == written.agg(F.max("slice")).first()[0] == 3


def shuffled(events, late_us, seed):
    """An order of arrival in which no event comes ``late_us`` or more behind the newest before it."""
    rng = random.Random(seed)
    return [event for _, event in sorted(((event[1] + rng.randrange(late_us), event) for event in events), key=lambda pair: pair[0])]


@pytest.mark.parametrize("job, files", [("idle", 1), ("idle", 5), ("deadline", 4), ("once", 3), ("members", 4)])
def test_units_of_events_out_of_order(spark, tmp_path, job, files):
    """Shuffled within 50 seconds and cut into files at any place: the units of the events in order."""
    late, events = 50 * SECOND, skewed_events(9, 500, 12, 600)
    arrived = shuffled(events, late, files)
    size = -(-len(arrived) // files)
    folder = str(tmp_path / "in")
    for number in range(files):
        write_file(folder, number, arrived[number * size : (number + 1) * size])
    write_file(folder, files, [(99, 10_000 * SECOND, -1)])  # takes the watermark past all others
    rows = stream_of(spark, folder)
    limits = {"idle": {"idle": 30 * SECOND}, "deadline": {"deadline": 90 * SECOND}, "members": {"idle": 30 * SECOND}, "once": {"deadline": 90 * SECOND}}
    limit = {name: timedelta(microseconds=us) for name, us in limits[job].items()}
    expected = simulated(events, 10, **limits[job])
    if job == "once":
        found = replay(stream_units.once_units(rows, "key", "ts", 10, late="50 seconds", **limit), "append", partitions=2)
        expected = {unit for unit in expected if unit[1] == 1 and unit[2] == 10}
    elif job == "members":
        rows = rows.withColumn("member", F.unix_micros("ts"))
        found = replay(stream_units.exact_members(rows, "key", "ts", "id", 10, ["member"], late="50 seconds", **limit), "append", partitions=2)
        full = Counter((r.key, r.member - BASE) for r in found.collect())
        bounds = [(key, first, last) for key, _, n, first, last in expected if n == 10]
        assert sum(full.values()) == 10 * len(bounds) > 0
        assert all(any(k == key and first <= us <= last for k, first, last in bounds) for key, us in full)
        return
    else:
        found = replay(stream_units.units(rows, "key", "ts", 10, late="50 seconds", **limit), "append", partitions=2)
    first, last = (F.unix_micros(name) - BASE for name in ("first_ts", "last_ts"))
    ours = sorted(tuple(r) for r in found.select("key", "n", first, last).collect())
    assert ours == sorted((key, n, a, b) for key, _, n, a, b in expected)


def test_branches_write_each_output_once(spark, timed_files):
    folder, _ = timed_files
    stream = stream_units.units(stream_of(spark, folder), "key", "ts", 10, deadline=timedelta(seconds=90))
    timed_out = F.col("status") == "timed_out"
    found = replay_branches(stream, "append", {"full": ~timed_out, "late": timed_out})
    pairs = {(r.branch, r.status) for r in found.select("branch", "status").distinct().collect()}
    assert pairs == {("full", "completed"), ("late", "timed_out")}


def test_a_restart_goes_on_with_the_open_units(spark, tmp_path):
    folder = str(tmp_path / "in")
    kept = {"folder": shared_folder(spark, "results"), "checkpoint": shared_folder(spark, "query")}

    def run():
        stream = stream_units.units(stream_of(spark, folder), "key", "ts", 3, idle=timedelta(seconds=10))
        return as_rows(replay(stream, "append", **kept))

    def as_rows(found):
        return sorted((r.key, r.n, r.status) for r in found.collect())

    write_file(folder, 0, [(1, 0, 0), (1, 1 * SECOND, 1), (2, 0, 2)])
    assert run() == []
    write_file(folder, 1, [(1, 2 * SECOND, 3), (3, 30 * SECOND, 4)])
    assert run() == [(1, 3, "completed"), (2, 1, "timed_out")]
    write_file(folder, 2, [(9, 60 * SECOND, 5)])
    assert run() == [(1, 3, "completed"), (2, 1, "timed_out"), (3, 1, "timed_out")]


@pytest.mark.parametrize("mode, counted", [("complete", 5), ("update", 4), ("append", 4)])
def test_rows_behind_the_watermark(spark, tmp_path, mode, counted):
    folder = str(tmp_path / "in")
    minute = 60 * SECOND
    write_file(folder, 0, [(1, 0, 0), (1, 10 * minute, 1)])
    write_file(folder, 1, [(1, 15 * minute, 2)])  # rows are judged by the watermark of the trigger before
    write_file(folder, 2, [(1, 1, 3), (1, 20 * minute, 4)])  # the first one comes too late
    per_minute = windows.tumbling(
        stream_of(spark, folder), "ts", "1 minute", "key", late="2 minutes", count=F.count(F.lit(1))
    )
    found = replay(per_minute, mode, ["window_start", "window_end", "key"])
    total = found.agg(F.sum("count")).first()[0]
    # append mode only gives windows that have closed; the last one stays open
    assert total == (counted - 1 if mode == "append" else counted)


def test_same_function_on_stream_and_batch(spark, timed_files):
    folder, events = timed_files

    def messages(rows):
        return rows.select(F.col("key").cast("string").cast("binary").alias("value"), F.col("ts").alias("timestamp"))

    batch = messages(spark.read.schema(SCHEMA).parquet(folder).select("key", F.timestamp_micros("us").alias("ts")))
    keys = ["window_start", "window_end", "course_name"]
    streamed = replay(viewing.windowed_seconds(messages(stream_of(spark, folder))), "update", keys)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, viewing.windowed_seconds(batch).collect()))
    text = replay(viewing.running_seconds_text(messages(stream_of(spark, folder))), "complete").collect()
    assert sum(r.seconds_watched for r in text) == 5 * len(events)


def test_broker_records_replayed_from_files(spark, timed_files, tmp_path):
    folder, events = timed_files
    rows = spark.read.schema(SCHEMA).parquet(folder).select(
        F.col("key").alias("user_id"), F.concat(F.lit("course"), "key").alias("event_type"),
        F.timestamp_micros("us").alias("ts"), F.col("id").alias("event_id"),
    )
    stand_ins.view_records(rows).repartition(3).write.parquet(str(tmp_path / "topic"))
    messages = streams.replayed_broker(spark, str(tmp_path / "topic"), files_per_trigger=1)
    found = replay(viewing.running_seconds(messages), "update", ["course_name"])
    expected = Counter(f"course{key}" for key, _, _ in events)
    assert {r.course_name: r.score for r in found.collect()} == {k: 5 * n for k, n in expected.items()}
    typed = reconciliation.events_of_messages(messages)
    assert typed.isStreaming and dict(typed.dtypes)["key"] == dict(typed.dtypes)["value"] == "string"


def test_sliding_windows_from_panes_equal_direct_windows(spark, timed_files):
    folder, _ = timed_files
    rows = spark.read.schema(SCHEMA).parquet(folder).select("key", F.timestamp_micros("us").alias("ts"))
    direct = windows.bounds(
        rows.groupBy(F.window("ts", "2 minutes", "10 seconds"), "key").agg(F.count(F.lit(1)).alias("n"))
    )
    paned = windows.sliding(rows, "ts", "2 minutes", "10 seconds", "key", n=F.count(F.lit(1)))
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, paned.collect()))


def test_complete_mode_ranks_on_the_stream_itself(spark, timed_files):
    folder, events = timed_files
    posts = stream_of(spark, folder).select(
        F.col("ts").alias("timestamp"), F.concat(F.lit("hi @"), F.col("key").cast("string")).alias("text")
    )
    found = replay(mentions.trending(mentions.mention_windows(posts), 3), "complete").collect()
    assert len(found) == 3
    counts = Counter((key, (BASE + us) // (300 * SECOND)) for key, us, _ in events)
    assert sorted((r["count"] for r in found), reverse=True) == sorted(counts.values(), reverse=True)[:3]


def test_copies_are_dropped_within_the_bound(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_file(folder, 0, [(1, i * SECOND, 0) for i in range(50)] + [(2, 0, 1)])
    write_file(folder, 1, [(1, 52 * SECOND, 0), (2, 0, 2)])
    found = replay(windows.first_of_each(stream_of(spark, folder), "ts", ["key", "id"], "1 hour"), "append")
    assert sorted((r.key, r.id) for r in found.collect()) == [(1, 0), (2, 1), (2, 2)]


def test_console_and_rate(spark, tmp_path, capfd):
    flagged = streams.rate_stream(spark, 20).withColumn("even", F.col("value") % 2 == 0)
    query = sinks.to_console(flagged, "update", str(tmp_path / "query"), sinks.every("1 second"), rows=5)
    try:
        deadline = time.time() + 30
        while time.time() < deadline and not (query.lastProgress and query.lastProgress["numInputRows"]):
            time.sleep(0.3)
        assert query.isActive and query.lastProgress["sink"]["description"].lower().find("console") >= 0
    finally:
        query.stop()


def test_broker_stream_needs_only_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.broker_stream(spark, "localhost:9092", "viewrecords", per_trigger=1000)


def test_socket_stream_is_declared_not_started(spark):
    assert streams.socket_lines(spark, "localhost", 8989).isStreaming
