"""View and log counting over event time, as batches and as replayed streams."""

from functools import partial

from pyspark.sql import functions as F

from tidemark.catalog import stand_ins as given
from tidemark.catalog.registry import registered
from tidemark.functions.registered import register_sql_functions
from tidemark.operators import windows
from tidemark.operators.rows import stacked
from tidemark.plans import viewing
from tidemark.session import removed_at_end, shared_folder
from tidemark.sources import streams
from tidemark.streaming.replay import arrivals, by_time, replay, replay_in_slices, replay_into
from tidemark.streaming.views import DistinctRows


def _tumbling(size: str, total: str) -> str:
    return f"""
        SELECT time_bucket(INTERVAL {size}, ts) AS window_start,
               time_bucket(INTERVAL {size}, ts) + INTERVAL {size} AS window_end,
               event_type AS course_name, sum(5)::BIGINT AS {total}
        FROM events GROUP BY ALL
    """


def _sliding(size: str, slide: str, copies: int, key: str, total: str) -> str:
    return f"""
        SELECT window_start, window_start + INTERVAL {size} AS window_end, event_type AS {key}, {total}
        FROM (SELECT time_bucket(INTERVAL {slide}, ts) - i * INTERVAL {slide} AS window_start, event_type
              FROM events, range({copies}) t(i))
        GROUP BY window_start, event_type
    """


def _views(spark, folder, build, run):
    """Views in spans of time through a streaming job."""
    return given.replayed(spark, folder, ["user_id", "event_id", "event_type"], lambda rows: build(given.view_records(rows)), run)


@registered("window_tumbling", _tumbling("2 minute", "seconds_watched"))
def window_tumbling(spark, folder):
    found = viewing.windowed_seconds_text(given.view_records(given.events(spark, folder)))
    return given.wall_clock(found, "window_start", "window_end")


@registered("window_sliding", _sliding("60 minute", "1 minute", 60, "course_name", "sum(5)::BIGINT AS seconds"))
def window_sliding(spark, folder):
    panes = viewing.pane_seconds(given.view_records(given.events(spark, folder)))
    return given.wall_clock(viewing.sliding_seconds(panes), "window_start", "window_end")


@registered("stream_udf_flag", "SELECT ts AS timestamp, event_id AS value, event_id % 2 = 0 AS even FROM events")
def stream_udf_flag(spark, folder):
    """A named function over a stream's column, row by row."""
    register_sql_functions(spark)
    rows = given.event_stream(spark, folder).select(F.col("ts").alias("timestamp"), F.col("event_id").alias("value"))
    return given.wall_clock(replay(rows.withColumn("even", F.call_function("is_even", "value")), "append"), "timestamp")


@registered(
    "stream_running_total",
    "SELECT event_type AS course_name, sum(5)::BIGINT AS seconds_watched FROM events GROUP BY 1",
)
def stream_running_total(spark, folder):
    """Every micro-batch writes all courses, sorted; files read back in any order, so the result is sorted again."""
    messages = given.view_records(given.event_stream(spark, folder))
    return replay(viewing.running_seconds_text(messages), "complete").orderBy(F.desc("seconds_watched"), "course_name")


@registered(
    "stream_running_update", "SELECT event_type AS course_name, sum(5)::BIGINT AS score FROM events GROUP BY 1"
)
def stream_running_update(spark, folder):
    """Only changed courses are written; sorted when read back."""
    messages = given.view_records(given.event_stream(spark, folder))
    return replay(viewing.running_seconds(messages), "update", ["course_name"]).orderBy(F.desc("score"))


@registered("stream_window_tumbling", _tumbling("1 minute", "score"))
def stream_window_tumbling(spark, folder):
    keys = ["window_start", "window_end", "course_name"]
    found = _views(spark, folder, viewing.windowed_seconds, partial(replay, mode="update", keys=keys))
    return given.wall_clock(found, "window_start", "window_end").orderBy(F.desc("score"), "window_start", "course_name")


@registered("stream_view_sliding", _sliding("60 minute", "1 minute", 60, "course_name", "sum(5)::BIGINT AS seconds"))
def stream_view_sliding(spark, folder):
    """The stream keeps one-minute panes as state; every trigger writes the windows that it changes."""
    kept = _views(spark, folder, viewing.pane_seconds, partial(replay_into, viewing.sliding_seconds_view, mode="update"))
    return given.wall_clock(kept.windows.read(), "window_start", "window_end")


@registered(
    "stream_newest_window",
    """
    SELECT w.last - INTERVAL 60 minute AS window_start, w.last AS window_end, event_type AS course_name,
           sum(5)::BIGINT AS seconds
    FROM events, (SELECT max(time_bucket(INTERVAL 1 minute, ts)) + INTERVAL 1 minute AS last FROM events) w
    WHERE ts >= w.last - INTERVAL 60 minute GROUP BY ALL
    """,
)
def stream_newest_window(spark, folder):
    """What the last trigger showed."""
    kept = _views(spark, folder, viewing.pane_seconds, partial(replay_into, viewing.sliding_seconds_view, mode="update"))
    return given.wall_clock(kept.newest.read(), "window_start", "window_end")


@registered("stream_level_sliding", _sliding("2 minute", "10 second", 12, "level", "count(*) AS count"))
def stream_level_sliding(spark, folder):
    """Text lines ``level,time`` arriving as files."""
    rows = given.log(spark, folder)
    lines = rows.select("datetime", F.concat_ws(",", "level", F.col("datetime").cast("string")).alias("value"))
    run = partial(replay_into, viewing.sliding_levels_view, mode="update")
    kept = replay_in_slices(lines, "datetime", viewing.pane_levels, run, least=given.SPANS, form="text")
    return given.wall_clock(kept.windows.read(), "window_start", "window_end")


@registered(
    "stream_level_totals",
    """
    SELECT event_type AS level, count(*) FILTER (event_id % 10 > 1) AS timed, count(*) FILTER (event_id % 10 <= 1) AS untimed,
           count(*) AS count
    FROM events GROUP BY 1
    """,
)
def stream_level_totals(spark, folder):
    """Lines of two layouts, short ones and ones without a time: the former in windows of their own time, the others in
    windows of the time they arrived; together they are all lines."""
    rows, kind = given.events(spark, folder), F.col("event_id") % 10
    said = (
        F.when(kind == 1, "no time").when(kind == 2, F.date_format(F.col("ts").cast("timestamp"), "EEE MMM dd HH:mm:ss 'GMT' yyyy"))
        .when(kind > 2, F.col("ts").cast("string"))
    )
    lines = rows.select("ts", F.concat_ws(",", "event_type", said).alias("value"))
    arriving = shared_folder(spark, "arriving")
    feed = arrivals(spark, by_time(lines, "ts", 50_000_000, given.SPANS, form="text", timeless=True), arriving)
    stream = viewing.pane_levels(streams.line_stream(spark, arriving))
    timed = replay_into(viewing.sliding_levels_view, stream, "update", feed=feed).panes.read()
    arrived = streams.line_stream(spark, arriving, files_per_trigger=8, arrived=True)
    untimed = replay(viewing.untimed_levels(arrived, "arrived"), "update", ["pane", "level"])
    removed_at_end(spark, arriving)
    every = stacked(timed.select("level", F.col("count").alias("timed"), F.lit(0).alias("untimed")),
                    untimed.select("level", F.lit(0).alias("timed"), F.col("count").alias("untimed")))
    return every.groupBy("level").agg(
        F.sum("timed").alias("timed"), F.sum("untimed").alias("untimed"), F.sum(F.col("timed") + F.col("untimed")).alias("count"))


@registered(
    "stream_late_drop",
    """
    SELECT mode, event_type, count(*) AS count
    FROM (SELECT event_type, ts, 'on time' AS came FROM events
          UNION ALL SELECT event_type, ts - INTERVAL 40 day, 'late' FROM events
          UNION ALL SELECT event_type, ts + INTERVAL 40 day, 'on time' FROM events),
         (VALUES ('complete'), ('update')) m(mode)
    WHERE mode = 'complete' OR came = 'on time' GROUP BY ALL
    """,
)
def stream_late_drop(spark, folder):
    """All events, then in a second run the same ones 40 days later and, too late, 40 days earlier.

    Update mode drops what is behind the watermark; complete mode keeps its state and counts it.
    """
    events = given.events(spark, folder).withColumn("ts", F.col("ts").cast("timestamp")).select("ts", "event_type")
    arriving = shared_folder(spark, "arriving")
    runs = {
        mode: {"folder": shared_folder(spark, "results"), "checkpoint": shared_folder(spark, "query")}
        for mode in ("update", "complete")
    }
    shifted = F.make_dt_interval(F.lit(40))
    found = {}
    later, too_late = (events.withColumn("ts", moved) for moved in (F.col("ts") + shifted, F.col("ts") - shifted))
    for rows in (events, stacked(later, too_late)):
        rows.write.mode("append").parquet(arriving)
        for mode, folders in runs.items():
            stream = streams.table_stream(spark, arriving, "ts timestamp, event_type string")
            per_day = windows.tumbling(stream, "ts", "1 day", "event_type", late="2 days", count=F.count(F.lit(1)))
            found[mode] = replay(per_day, mode, ["window_start", "window_end", "event_type"], **folders)
    removed_at_end(spark, arriving, *(into for folders in runs.values() for into in folders.values()))
    return stacked(*(
        rows.groupBy(F.lit(mode).alias("mode"), "event_type").agg(F.sum("count").alias("count"))
        for mode, rows in found.items()
    ))


@registered("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, folder):
    """Over the whole stream, with rows without a time: pairs that came before are kept in a table, not in state."""

    def seen(rows, into):
        return DistinctRows(rows.sparkSession, into, rows.schema)

    names = ["user_id", "event_type"]
    kept = given.replayed(
        spark, folder, names, lambda rows: rows.select(*names), partial(replay_into, seen, mode="append"), timeless=True,
    )
    return kept.fresh.read()
