"""Units on a stream whose keys may be busier than one task can follow: the batch form, at every trigger.

A trigger puts its events together with those that are not settled yet, which are kept in a table instead of in state, and
lets ``operators.units`` walk them: there a key is cut over as many partitions as it needs, shares of it are described and
composed in a tree, and no task holds more than an Arrow batch, an open unit and 64 descriptions. Units that have ended by
the watermark are entered as results; events of open ones, fewer than ``size`` per key, and those beyond the watermark are
kept for the next trigger. As with ``streaming.units``, events give the same units in whatever order they arrive.

Every trigger reads all unsettled events, so this is for few keys with many events; ``streaming.units`` reads the keys that
have new ones and is for many keys with few.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.times import from_micros, to_micros
from tidemark.operators import units as batch
from tidemark.streaming.levels import Levels


def events_of(rows: DataFrame, key: str, ts: str, order: str, payload: Sequence[str] = ()) -> DataFrame:
    """The stream that the view takes: ``key, us, seq`` and the payload. ``order`` tells events of a key and time apart."""
    return rows.where(F.col(ts).isNotNull()).select(
        F.col(key).alias("key"), to_micros(F.col(ts)).alias("us"), F.col(order).alias("seq"), *payload)


class UnitsView:
    """Units (without payload: ``key, n, first_us, last_us``) or the members of full units (with one) as they end.

    An event that comes more than ``late`` behind the newest one of the triggers before is dropped.
    """

    def __init__(self, events: DataFrame, folder: str, size: int, late: timedelta = timedelta(0), *,
                 idle: timedelta | None = None, deadline: timedelta | None = None, partitions: int | None = None):
        if (idle is None) == (deadline is None):
            raise ValueError("give either idle or deadline")
        spark, kinds = events.sparkSession, events.schema
        self.size, self.late_us, self.idle, self.deadline, self.partitions = size, batch.micros(late), idle, deadline, partitions
        self.payload = [name for name in kinds.names if name not in ("key", "us", "seq")]
        found = StructType([kinds["key"]]).add("n", "long").add("first_us", "long").add("last_us", "long").add(
            "first_seq", kinds["seq"].dataType)
        self.held = Levels(spark, f"{folder}/held", kinds, [])
        self.clock = Levels(spark, f"{folder}/clock", StructType().add("newest_us", "long"), [])
        self.units = Levels(spark, f"{folder}/units", kinds, ["key", "us", "seq"]) if self.payload else Levels(
            spark, f"{folder}/units", found, ["key", "first_us", "first_seq"])

    def write(self, some: DataFrame, batch_id: int) -> None:
        before = self.clock.read(batch_id).first()
        fresh = some if before is None else some.where(F.col("us") > before["newest_us"] - self.late_us)
        newest = fresh.agg(F.max("us")).first()[0]
        if newest is None:
            return
        newest = newest if before is None else max(newest, before["newest_us"])
        passed = newest - self.late_us
        every = self.held.read(batch_id).unionByName(fresh)
        due = every.where(F.col("us") <= passed).withColumns({"_ts": from_micros(F.col("us")), "_us": F.col("us"), "_seq": F.col("seq")})
        tagged = batch.unit_members(
            due.select("key", "_ts", "_us", "_seq", *self.payload), "key", "_ts", "_seq", self.size, ["_us", "_seq", *self.payload],
            idle=self.idle, deadline=self.deadline, partitions=self.partitions).checkpoint()
        found = tagged.groupBy("key", "unit_no").agg(
            F.max("n").alias("n"), F.min("_us").alias("first_us"), F.max("_us").alias("last_us"),
            F.min(F.struct("_us", "_seq")).getField("_seq").alias("first_seq"))
        end = F.col("last_us") + batch.micros(self.idle) if self.idle is not None else F.col("first_us") + batch.micros(self.deadline)
        ended = (F.col("n") == self.size) | (end <= passed)
        members = tagged.select("key", "unit_no", "n", F.col("_us").alias("us"), F.col("_seq").alias("seq"), *self.payload)
        self.units.add(members.where(F.col("n") == self.size) if self.payload else found.where(ended), batch_id)
        still_open = found.where(~ended).select(F.col("key").alias("of_key"), F.col("unit_no").alias("of_unit"))
        kept = members.join(
            still_open, F.col("key").eqNullSafe(F.col("of_key")) & (F.col("unit_no") == F.col("of_unit")), "left_semi")
        names = self.held.schema.names
        self.held.replace(kept.select(*names).unionByName(every.where(F.col("us") > passed).select(*names)), batch_id)
        self.clock.replace(some.sparkSession.range(1).select(F.lit(newest).cast("long").alias("newest_us")), batch_id)

    def read(self, key: str) -> DataFrame:
        """Results so far, as ``streaming.units`` gives them."""
        if self.payload:
            return self.units.read().select(F.col("key").alias(key), *self.payload)
        return self.units.read().select(
            F.col("key").alias(key), "n", batch.status(self.size).alias("status"),
            from_micros(F.col("first_us")).alias("first_ts"), from_micros(F.col("last_us")).alias("last_ts"))
