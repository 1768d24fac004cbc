"""What streams keep up to date at every trigger, held against a batch over the rows up to that trigger."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_streams import BASE, SCHEMA, SECOND, stream_of, write_file
from tidemark.operators import windows
from tidemark.plans import mentions, viewing
from tidemark.session import shared_folder
from tidemark.streaming.levels import Levels
from tidemark.streaming.replay import replay, replay_into
from tidemark.streaming.views import DistinctRows, SlidingView, distinct_per_batch

MINUTE = 60 * SECOND


@pytest.fixture
def files(tmp_path):
    """Six triggers of events of three keys; some come up to four minutes late, the third trigger brings none."""
    rng, folder, batches = random.Random(5), str(tmp_path / "in"), []
    for number in range(6):
        rows = [] if number == 2 else [
            (rng.choice((1, 1, 1, 2, 3)), number * 5 * MINUTE + rng.randrange(-4 * MINUTE if number else 0, 5 * MINUTE), 100 * number + i)
            for i in range(60)
        ]
        batches.append(rows)
        if rows:
            write_file(folder, number, rows)
    return folder, batches


def by_trigger(view, stream, mode, look, tmp_path):
    """A view's content after every trigger."""
    seen = []

    class Watched:
        def __init__(self, of, into):
            self.of, self.into = view(of, into), into

        def write(self, batch, batch_id):
            self.of.write(batch, batch_id)
            if not batch.isEmpty():
                seen.append(look(self.of))

    kept = replay_into(Watched, stream, mode, partitions=2, folder=str(tmp_path / "view"), checkpoint=str(tmp_path / "query"))
    return kept.of, seen


def us(name):
    return (F.unix_micros(name) - BASE).alias(name)


def sliding(batches, size, slide):
    counts = Counter()
    for key, at, _ in (row for rows in batches for row in rows):
        last = (BASE + at) // slide * slide
        for start in range(last - size + slide, last + slide, slide):
            counts[start - BASE, start + size - BASE, key] += 1
    return sorted((*window, n) for window, n in counts.items())


def test_windows_leave_the_stream_at_every_trigger(spark, files, tmp_path):
    folder, batches = files
    panes = windows.panes(stream_of(spark, folder), "ts", "1 minute", "key", late="10 minutes", n=F.count(F.lit(1)))

    def look(view):
        rows = [sorted(map(tuple, table.read().select(us("window_start"), us("window_end"), "key", "n").collect())) for table in (view.windows, view.newest)]
        return rows

    def view(stream, into):
        return SlidingView(spark, into, stream.schema, "5 minutes", "1 minute", ["key"], ["n"], fan=2)

    kept, seen = by_trigger(view, panes, "update", look, tmp_path)
    full = [rows for rows in batches if rows]
    assert len(seen) == len(full)
    for count, (every, newest) in enumerate(seen, 1):
        expected = sliding(full[:count], 5 * MINUTE, MINUTE)
        assert every == expected
        last = max((BASE + at) // MINUTE * MINUTE for rows in full[:count] for _, at, _ in rows) + MINUTE - BASE
        assert newest == [row for row in expected if row[1] == last] != []
    order = [tuple(r) for r in kept.newest.read().select("n", "key").collect()]
    assert order == sorted(order, key=lambda pair: (-pair[0], pair[1]))
    assert len(kept.windows.runs()) <= 3


def test_a_ranking_at_every_trigger(spark, files, tmp_path):
    folder, batches = files
    posts = stream_of(spark, folder).select(F.col("ts").alias("timestamp"), F.concat(F.lit("hi @"), (F.col("key") * 10 + F.col("id") % 4).cast("string")).alias("text"))
    counts = mentions.mention_windows(posts)

    def look(view):
        names = [us("window_start"), "mention", "count", "rank"]
        return sorted(map(tuple, view.current().select(*names).collect()), key=lambda row: row[-1])

    kept, seen = by_trigger(lambda s, into: mentions.trending_view(s, into, 4), counts, "update", look, tmp_path)
    full = [rows for rows in batches if rows]
    for rows, count in zip(seen, range(1, len(full) + 1)):
        counted = Counter(((BASE + at) // (5 * MINUTE) * 5 * MINUTE - BASE, f"@{key * 10 + number % 4}") for some in full[:count] for key, at, number in some)
        best = sorted(((-n, mention, start) for (start, mention), n in counted.items()))[:4]
        assert rows == [(start, mention, -n, place) for place, (n, mention, start) in enumerate(best, 1)]
    assert len(seen) == len(full)
    every = kept.rankings.read()
    assert every.select("trigger").distinct().count() == len(full) and every.count() == 4 * len(full)


def test_distinct_rows_however_long_ago(spark, tmp_path):
    """Pairs 61 days apart, rows without a time and rows without a key."""
    folder, day = str(tmp_path / "in"), 24 * 60 * MINUTE
    batches = [[(1, 0, 0), (2, 0, 0), (1, 5, 0)], [(1, 61 * day, 1), (None, 61 * day, 1)], [(None, 62 * day, 2), (3, 62 * day, 2), (2, 1, 2)]]
    for number, rows in enumerate(batches):
        write_file(folder, number, rows)
    timeless = stream_of(spark, folder).select("key", F.when(F.col("key") != 3, F.col("ts")).alias("ts"))

    def view(stream, into):
        return DistinctRows(spark, into, stream.schema, fan=2)

    kept, seen = by_trigger(view, timeless.select("key"), "append", lambda v: sorted(map(str, (r.key for r in v.fresh.read().collect()))), tmp_path)
    assert seen == [["1", "2"], ["1", "2", "None"], ["1", "2", "3", "None"]]
    kept.write(spark.createDataFrame([(1,), (9,)], "key bigint"), 50)
    kept.write(spark.createDataFrame([(1,), (9,)], "key bigint"), 50)  # a micro-batch that is repeated
    assert kept.fresh.read().count() == 5
    assert distinct_per_batch(spark.createDataFrame([(1,), (1,), (None,)], "key bigint")).count() == 2


def rows_of(spark, pairs):
    return spark.createDataFrame(pairs, "k int, v string")


def test_levels_hold_the_latest_row_in_few_runs(spark):
    rng, expected = random.Random(1), {}
    table = Levels(spark, shared_folder(spark, "levels"), rows_of(spark, []).schema, ["k"], fan=3)
    assert table.read().count() == 0
    for batch in range(30):
        rows = {rng.randrange(12): f"{batch}" for _ in range(3)}
        expected |= rows
        table.add(rows_of(spark, list(rows.items())), batch)
        if batch % 7 == 3:  # a failed micro-batch leaves a run behind and is repeated
            table._write(rows_of(spark, [(0, "lost")]), 0, batch + 1, batch + 1)
            table.add(rows_of(spark, list(rows.items())), batch)
        runs = table.runs()
        assert len(runs) <= 2 * 4 and [r["last"] + 1 for r in runs[:-1]] == [r["first"] for r in runs[1:]]
        if batch % 5 == 4:
            assert dict(map(tuple, table.read().collect())) == expected
    files = table._files
    folders = [run for level in files.listStatus(table._path(table.folder)) if "level=" in str(level.getPath())
               for run in files.listStatus(level.getPath())]
    assert len(folders) <= 2 * len(table.runs()) + 3 and len(table._manifests()) == 2
    assert table.read(before=29).count() == len(expected)


def test_complete_mode_keeps_one_run(spark, files):
    folder, batches = files
    into = shared_folder(spark, "results")
    counted = windows.running(stream_of(spark, folder), "key", n=F.count(F.lit(1)))
    found = replay(counted, "complete", folder=into)
    assert {r.key: r.n for r in found.collect()} == Counter(key for rows in batches for key, _, _ in rows)
    assert len(Levels(spark, into, found.schema, []).runs()) == 1


def test_lines_of_every_kind_are_counted_once(spark, tmp_path):
    from tidemark.sources.streams import line_stream

    folder = str(tmp_path / "lines")
    said = ["INFO,2024-01-01 10:00:00", "INFO,Mon Jan 01 10:00:05 GMT 2024", "WARN", "WARN,", "INFO,soon", "ERROR,2024-01-01 10:00:09.5", ",2024-01-01 10:00:01"]
    spark.createDataFrame([(s,) for s in said], "value string").coalesce(1).write.text(folder)
    timed = replay_into(viewing.sliding_levels_view, viewing.pane_levels(line_stream(spark, folder)), "update").panes.read()
    untimed = replay(viewing.untimed_levels(line_stream(spark, folder, arrived=True), "arrived"), "update", ["pane", "level"])
    assert {r.level: r["count"] for r in timed.groupBy("level").agg(F.sum("count").alias("count")).collect()} == {"INFO": 2, "ERROR": 1, "": 1}
    assert {r.level: r["count"] for r in untimed.groupBy("level").agg(F.sum("count").alias("count")).collect()} == {"WARN": 2, "INFO": 1}
