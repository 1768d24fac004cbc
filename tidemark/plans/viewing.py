"""Seconds watched per course from view records, and counts per log level, on streams (or batches).

View records are broker records whose value is a course name; each stands for five seconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import windows
from tidemark.streaming.views import SlidingView

# Fixed value: seconds one view record stands for.
SECONDS_PER_VIEW = 5


def views_of_messages(messages: DataFrame) -> DataFrame:
    """``timestamp, course_name, total``."""
    return messages.select(
        "timestamp", F.col("value").cast("string").alias("course_name"), F.lit(SECONDS_PER_VIEW).alias("total")
    )


def running_seconds(messages: DataFrame) -> DataFrame:
    """``course_name, score`` since the start. Sort it only in complete mode or after reading it back."""
    return windows.running(views_of_messages(messages), "course_name", score=F.round(F.sum("total"), 2))


def running_seconds_text(messages: DataFrame) -> DataFrame:
    """``course_name, seconds_watched``, most watched first, as SQL text; on a stream for complete mode."""
    return messages.sparkSession.sql(
        f"""
        SELECT cast(value AS string) AS course_name, sum({SECONDS_PER_VIEW}) AS seconds_watched
        FROM {{messages}} GROUP BY course_name ORDER BY seconds_watched DESC, course_name
        """,
        messages=messages,
    )


def windowed_seconds_text(messages: DataFrame, size: str = "2 minutes") -> DataFrame:
    """``window_start, window_end, course_name, seconds_watched``, most watched first, as SQL text."""
    return messages.sparkSession.sql(
        f"""
        SELECT window.start AS window_start, window.end AS window_end, course_name, seconds_watched
        FROM (SELECT window, cast(value AS string) AS course_name, sum({SECONDS_PER_VIEW}) AS seconds_watched
              FROM {{messages}} GROUP BY window(timestamp, '{size}'), course_name)
        ORDER BY seconds_watched DESC, window_start, course_name
        """,
        messages=messages,
    )


def windowed_seconds(messages: DataFrame, size: str = "1 minute", late: str = "2 minutes") -> DataFrame:
    """``window_start, window_end, course_name, score``."""
    return windows.tumbling(
        views_of_messages(messages), "timestamp", size, "course_name", late=late, score=F.round(F.sum("total"), 2)
    )


def pane_seconds(messages: DataFrame, slide: str = "1 minute", late: str = "2 minutes") -> DataFrame:
    """The streaming half of a sliding report: seconds per pane and course, in update mode."""
    return windows.panes(
        views_of_messages(messages), "timestamp", slide, "course_name", late=late, seconds=F.sum("total")
    )


def sliding_seconds_view(panes: DataFrame, folder: str, size: str = "60 minutes", slide: str = "1 minute") -> SlidingView:
    """What keeps the windows of a stream of ``pane_seconds`` up to date at every trigger, most watched first."""
    return SlidingView(panes.sparkSession, folder, panes.schema, size, slide, ["course_name"], ["seconds"])


def sliding_seconds(panes: DataFrame, size: str = "60 minutes", slide: str = "1 minute") -> DataFrame:
    """``window_start, window_end, course_name, seconds`` of every window."""
    return windows.windows_of_panes(panes, size, slide, "course_name", totals=["seconds"])


def levels_of_lines(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``level, ts`` of lines ``level,time``, the time as a timestamp or as ``Tue Jan 02 10:11:12 GMT 2024``.

    The level stands in every line; one that is short or has another time gives a null time.
    """
    parts = F.split(F.col(column), ",")
    said = F.trim(F.get(parts, F.lit(1)))
    dated = F.try_to_timestamp(F.substr(said, F.lit(5)), F.lit("MMM d HH:mm:ss z yyyy"))
    return lines.select(*keep, F.get(parts, F.lit(0)).alias("level"), F.coalesce(F.try_to_timestamp(said), dated).alias("ts"))


def pane_levels(lines: DataFrame, slide: str = "10 seconds", late: str = "2 minutes") -> DataFrame:
    return windows.panes(levels_of_lines(lines), "ts", slide, "level", late=late, count=F.count(F.lit(1)))


def sliding_levels_view(panes: DataFrame, folder: str, size: str = "2 minutes", slide: str = "10 seconds") -> SlidingView:
    """What keeps the windows of a stream of ``pane_levels`` up to date at every trigger."""
    return SlidingView(panes.sparkSession, folder, panes.schema, size, slide, ["level"], ["count"])


def untimed_levels(lines: DataFrame, arrived: str, slide: str = "10 seconds", late: str = "2 minutes") -> DataFrame:
    """The side output of ``pane_levels``: lines without a usable time, per pane of the time they arrived.

    It is a stream of its own, since a watermark over arrivals would leave behind lines that are read long after their time.
    """
    untimed = levels_of_lines(lines, keep=(arrived,)).where("ts IS NULL")
    return windows.panes(untimed, arrived, slide, "level", late=late, count=F.count(F.lit(1)))
