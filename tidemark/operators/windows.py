"""Event-time windows and running totals; the same functions serve batch and stream inputs.

Window bounds come out as the columns ``window_start`` and ``window_end``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounds(df: DataFrame, window: str = "window") -> DataFrame:
    """Replace a window struct by its two bounds."""
    rest = [name for name in df.columns if name != window]
    return df.select(
        F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"), *rest
    )


def tumbling(df: DataFrame, ts: str, size: str, *keys: str, late: str | None = None, **totals: Column) -> DataFrame:
    """Totals per window and key. ``late`` bounds how far behind a row may come and lets a stream drop old windows."""
    if late is not None:
        df = df.withWatermark(ts, late)
    return bounds(df.groupBy(F.window(ts, size), *keys).agg(*(c.alias(n) for n, c in totals.items())))


def panes(df: DataFrame, ts: str, slide: str, *keys: str, late: str | None = None, **totals: Column) -> DataFrame:
    """Totals per slide-long pane: the only state a sliding report needs, one row instead of size/slide ones."""
    if late is not None:
        df = df.withWatermark(ts, late)
    return (
        df.groupBy(F.window(ts, slide).alias("pane"), *keys)
        .agg(*(c.alias(n) for n, c in totals.items()))
        .withColumn("pane", F.col("pane.start"))
    )


def windows_of_panes(pane_totals: DataFrame, size: str, slide: str, *keys: str, totals: list[str]) -> DataFrame:
    """Sliding totals from pane totals. ``size`` must be a multiple of ``slide``, so a pane lies in a window whole."""
    return bounds(
        pane_totals.groupBy(F.window("pane", size, slide), *keys).agg(*(F.sum(n).alias(n) for n in totals))
    )


def sliding(df: DataFrame, ts: str, size: str, slide: str, *keys: str, **totals: Column) -> DataFrame:
    """Additive totals (sums, counts) per sliding window and key.

    Rows are first added up per pane; only pane totals are copied into the windows that cover them.
    """
    return windows_of_panes(panes(df, ts, slide, *keys, **totals), size, slide, *keys, totals=list(totals))


def running(df: DataFrame, *keys: str, **totals: Column) -> DataFrame:
    """Totals per key over everything seen so far."""
    return df.groupBy(*keys).agg(*(c.alias(n) for n, c in totals.items()))


def first_of_each(df: DataFrame, ts: str, keys: list[str], within: str, salts: int = 16) -> DataFrame:
    """One row per key on a stream, as long as copies come no further than ``within`` apart.

    Copies are first dropped in ``salts`` shares per key, so a key with very many copies is worked on by that many
    tasks and reaches the final step as a few rows.
    """
    share = F.pmod(F.xxhash64(ts), F.lit(salts))
    thinned = df.withWatermark(ts, within).withColumn("_share", share).dropDuplicatesWithinWatermark([*keys, "_share"])
    return thinned.drop("_share").dropDuplicatesWithinWatermark(keys)
