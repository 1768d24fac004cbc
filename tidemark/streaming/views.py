"""Results that a stream keeps up to date at every trigger: sliding windows, the newest window, rankings, distinct rows.

Each is a sink over ``foreachBatch``. Its tables (``levels.py``) are read back with the class of the same name, while the
stream runs or afterwards; a micro-batch without rows leaves them as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidemark.operators.rows import top
from tidemark.operators.windows import windows_of_panes
from tidemark.streaming.levels import Levels
from tidemark.streaming.sinks import writer


def _same(a: DataFrame, b: DataFrame, names: Sequence[str]) -> Column:
    return reduce(Column.__and__, (a[name].eqNullSafe(b[name]) for name in names))


def _at(us: int | None) -> Column:
    return F.timestamp_micros(F.lit(us).cast("long"))


class SlidingView:
    """Sliding windows over a stream of panes in update mode (``windows.panes``): columns ``pane``, keys, totals.

    A trigger enters its panes and works out again only the windows over their span of time, from the panes around them;
    every trigger's rows are in order: window, first total descending, keys. ``newest`` holds the window that ends with
    the last pane, a row per key, in that order too.
    """

    def __init__(self, spark: SparkSession, folder: str, panes: StructType, size: str, slide: str, keys: Sequence[str],
                 totals: Sequence[str], fan: int = 8):
        self.size, self.slide, self.keys, self.totals = size, slide, list(keys), list(totals)
        times = StructType().add("window_start", "timestamp").add("window_end", "timestamp")
        windows = StructType([*times, *(panes[name] for name in (*keys, *totals))])
        self.panes = Levels(spark, f"{folder}/panes", panes, ["pane", *keys], fan)
        self.windows = Levels(spark, f"{folder}/windows", windows, [*times.names, *keys], fan)
        self.newest = Levels(spark, f"{folder}/newest", windows, [*times.names, *keys], fan)

    def _summed(self, panes: DataFrame) -> DataFrame:
        found = windows_of_panes(panes, self.size, self.slide, *self.keys, totals=self.totals)
        kinds = {field.name: field.dataType for field in self.windows.schema}
        return found.select(*(F.col(name).cast(kinds[name]).alias(name) for name in self.windows.schema.names))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            low, high = batch.agg(F.unix_micros(F.min("pane")), F.unix_micros(F.max("pane"))).first()
            if low is None:
                return
            self.panes.add(batch, batch_id)
            order = ["window_start", F.desc(self.totals[0]), *self.keys]
            reach = F.expr(f"INTERVAL {self.size}") - F.expr(f"INTERVAL {self.slide}")
            panes = self.panes.read(batch_id + 1)
            near = panes.where(F.col("pane").between(_at(low) - reach, _at(high) + reach))
            again = self._summed(near).where(F.col("window_start").between(_at(low) - reach, _at(high)))
            again.persist()  # a sort reads its input twice
            try:
                self.windows.add(again.orderBy(*order), batch_id)
            finally:
                again.unpersist()
            shown = self.newest.read(batch_id).agg(F.unix_micros(F.max("window_end"))).first()[0]
            last = F.greatest(_at(high) + F.expr(f"INTERVAL {self.slide}"), _at(shown))
            ending = panes.where((F.col("pane") >= last - F.expr(f"INTERVAL {self.size}")) & (F.col("pane") < last))
            self.newest.replace(self._summed(ending).where(F.col("window_end") == last).coalesce(1).sortWithinPartitions(*order), batch_id)
        finally:
            batch.unpersist()


class Ranking:
    """The k best rows of a stream of growing scores in update mode, anew at every trigger.

    A row that no trigger has touched since cannot rise, so the k best are among the k best before and what has changed;
    each task keeps k of these, and the last step k of those. ``rankings`` holds ``trigger, rank`` and the rows.
    """

    def __init__(self, spark: SparkSession, folder: str, rows: StructType, keys: Sequence[str], k: int, score: str,
                 *ties: str, fan: int = 8):
        self.rows, self.keys, self.k, self.order = rows, list(keys), k, (score, *ties)
        ranked = StructType().add("trigger", "long").add("rank", "integer")
        self.rankings = Levels(spark, f"{folder}/rankings", StructType([*ranked, *rows]), ranked.names, fan)

    def current(self, before: int | None = None) -> DataFrame:
        """The last ranking: its rows and ``rank``."""
        every = self.rankings.read(before)
        last = every.agg(F.max("trigger")).first()[0]
        return every.where(F.col("trigger") == F.lit(last).cast("long")).drop("trigger")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            held = self.current(batch_id).drop("rank")
            held = held.join(batch, _same(held, batch, self.keys), "left_anti")
            best = top(batch.select(*self.rows.names).unionByName(held), self.k, *self.order)
            place = F.row_number().over(Window.orderBy(F.desc(self.order[0]), *self.order[1:]))  # of k rows
            self.rankings.add(best.select(F.lit(batch_id).cast("long").alias("trigger"), place.alias("rank"), "*"), batch_id)
        finally:
            batch.unpersist()


class DistinctRows:
    """Rows of a stream that no trigger has brought before, however long ago: seen ones are kept in a table, not in state.

    ``fresh`` holds each row once; a trigger's distinct rows are anti-joined against it.
    """

    def __init__(self, spark: SparkSession, folder: str, rows: StructType, fan: int = 8):
        self.names = rows.names
        self.fresh = Levels(spark, f"{folder}/fresh", rows, rows.names, fan)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        once = batch.select(*self.names).distinct()
        seen = self.fresh.read(batch_id)
        self.fresh.add(once.join(seen, _same(once, seen, self.names), "left_anti"), batch_id)


def kept_by(view, stream: DataFrame, mode: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start a stream into a view."""
    return writer(stream, mode, checkpoint, trigger).foreachBatch(view.write).start()


def distinct_per_batch(batch: DataFrame) -> DataFrame:
    """Distinct rows of one micro-batch only, as a plain DISTINCT over a micro-batch gives them."""
    return batch.distinct()
