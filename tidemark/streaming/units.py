"""Grouping of keyed events into units on a stream: state per key, event-time timers, independent of arrival order.

Rows of a key wait until the watermark has passed them and are then taken in order of time, so the same events give the
same units however they arrive within the lateness and wherever micro-batches are cut. What waits lies in a map state of
small sorted chunks keyed by their first time: a trigger writes its rows once and reads only chunks the watermark reaches.
Beyond that, only what the rules need is kept per key: size, first and last time of the open unit, or (for
``exact_members``) the members of the open unit, at most ``size - 1`` of them. A micro-batch hands all new rows of a key
to one call. Where these are more than an Arrow batch, or more than ``MERGED`` chunks are due, they go through the map
state and come back a stretch of time after the other, so the call holds that many chunks, one Arrow batch and what
overlaps in time, however busy the key. Bound a micro-batch at the source (``maxOffsetsPerTrigger`` /
``maxFilesPerTrigger``) all the same: a key's rows are walked by one task.

A unit is written once the watermark has passed its last event, or the time at which it ends without one. Events after
the last watermark are still open when a stream stops.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.times import from_micros, to_micros
from tidemark.operators.unit_rules import UnitRule, walk
from tidemark.operators.units import micros, status

#: Rows of a key in one entry of the map state, and entries that are put in order at once.
CHUNK, MERGED = 1024, 16
#: Shards that keys are dealt to: the calls of a trigger, and the tasks that can share it.
SHARDS = 256


def _milliseconds(us: int) -> int:
    """The first whole millisecond not before a time: a timer never fires early."""
    return -(-us // 1000)


def _sooner(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


class Waiting:
    """Rows of a key that the watermark has not passed yet, as sorted chunks keyed by their first time."""

    def __init__(self, handle: StatefulProcessorHandle, columns: dict[str, str]):
        self.back_us: int | None = None
        self.columns, self.order = columns, [name for name in ("us", "seq") if name in columns]
        arrays = ", ".join(f"`{name}` array<{kind}>" for name, kind in columns.items())
        self.chunks = handle.getMapState("waiting", "first_us bigint, number bigint", arrays)

    def sorted(self, rows: pd.DataFrame) -> pd.DataFrame:
        return rows.iloc[np.lexsort([rows[name].to_numpy() for name in reversed(self.order)])]

    def add(self, rows: pd.DataFrame) -> int | None:
        """Let sorted rows wait; their first time."""
        for start in range(0, len(rows), CHUNK):
            chunk = rows.iloc[start : start + CHUNK]
            at = (int(chunk["us"].iloc[0]), 0)
            while self.chunks.containsKey(at):
                at = (at[0], at[1] + 1)
            self.chunks.updateValue(at, tuple(_values(chunk[name], kind) for name, kind in self.columns.items()))
        return int(rows["us"].iloc[0]) if len(rows) else None

    def keys(self) -> list[tuple[int, int]]:
        return sorted(tuple(key) for key in self.chunks.keys())

    def stretches(self, due: list[tuple[int, int]], passed_us: int) -> Iterator[pd.DataFrame]:
        """Rows up to a time, which no longer wait, in order; each stretch ends where the next chunk begins, or with the
        rows of MERGED chunks. Rows of the chunks beyond that time go back, ``back_us`` being the first of their times."""
        self.back_us = None
        held: list[pd.DataFrame] = []
        for place, key in enumerate(due):
            held.append(pd.DataFrame(dict(zip(self.columns, self.chunks.getValue(key)))))
            self.chunks.removeKey(key)
            if place + 1 < len(due) and len(held) < MERGED:
                continue
            rows = self.sorted(pd.concat(held))
            until = passed_us if place + 1 == len(due) else min(passed_us, due[place + 1][0] - 1)
            cut = int(np.searchsorted(rows["us"].to_numpy(), until, "right"))
            held = [rows.iloc[cut:]]
            if cut:
                yield rows.iloc[:cut]
        if held:
            self.back_us = self.add(held[0])


def _values(column: pd.Series, kind: str) -> list:
    """Values as the state takes them; pandas turns whole numbers into floats where some are missing."""
    if not column.hasnans:
        return column.tolist()
    exact = int if kind.endswith("int") else lambda x: x
    return [None if missing else exact(x) for x, missing in zip(column.tolist(), column.isna())]


class _Ordered(StatefulProcessor):
    """Rows of a key in order of time, each once the watermark has passed it; one timer per key.

    A subclass takes the rows that are due (``walk``) and says when it has to be woken without any.
    """

    columns: dict[str, str] = {"us": "bigint"}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.waiting = handle, Waiting(handle, self.columns)
        self.clock = handle.getValueState("clock", "first_us bigint, wake_ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        return self._turn(key, (self.waiting.sorted(self.wanted(some[list(self.columns)])) for some in rows), timerValues, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._turn(key, iter(()), timerValues, True)

    def wanted(self, rows: pd.DataFrame) -> pd.DataFrame:
        return rows

    def _turn(self, key, new: Iterator[pd.DataFrame], timer_values, fired: bool) -> Iterator[pd.DataFrame]:
        passed_us = timer_values.getCurrentWatermarkInMs() * 1000
        before = self.clock.get() or (None, None)
        first_us, wake_ms = before
        rows, more = next(new, None), next(new, None)
        if more is not None:
            for some in chain((rows, more), new):
                first_us = _sooner(first_us, self.waiting.add(some))
            rows = None
        keys = self.waiting.keys() if first_us is not None and first_us <= passed_us else []
        if rows is not None and sum(at[0] <= passed_us for at in keys) > MERGED:
            self.waiting.add(rows)
            keys, rows = self.waiting.keys(), None
        due = [at for at in keys if at[0] <= passed_us]
        if due:
            first_us = min((at[0] for at in keys if at[0] > passed_us), default=None)
        stretches = self.waiting.stretches(due, passed_us)
        if len(due) > MERGED:
            for stretch in stretches:
                yield from self.walk(key, stretch, int(stretch["us"].iloc[-1]))[0]
            together = None
        else:
            parts = list(stretches)
            if rows is not None:
                cut = int(np.searchsorted(rows["us"].to_numpy(), passed_us, "right"))
                first_us = _sooner(first_us, self.waiting.add(rows.iloc[cut:]))
                parts += [rows.iloc[:cut]] if cut else []
            together = None if not parts else parts[0] if len(parts) == 1 else self.waiting.sorted(pd.concat(parts))
        found, ends_us = self.walk(key, together, passed_us)
        yield from found
        first_us = _sooner(first_us, self.waiting.back_us)
        at = _sooner(first_us, ends_us)
        self._set(before, first_us, None if at is None else _milliseconds(at), None if fired else wake_ms)

    def _set(self, before: tuple, first_us: int | None, wake_ms: int | None, timer_ms: int | None) -> None:
        """Every call to the state store costs a round trip, so what stays the same is left alone."""
        if timer_ms != wake_ms:
            if timer_ms is not None:
                self.handle.deleteTimer(timer_ms)
            if wake_ms is not None:
                self.handle.registerTimer(wake_ms)
        if (first_us, wake_ms) != tuple(before):
            if wake_ms is None:
                self.clock.clear()
            else:
                self.clock.update((first_us, wake_ms))

    def walk(self, key, rows: pd.DataFrame | None, passed_us: int) -> tuple[list[pd.DataFrame], int | None]:
        raise NotImplementedError

    def close(self) -> None:
        pass


def _units_frame(key, units: list[tuple[int, int, int]]) -> list[pd.DataFrame]:
    if not units:
        return []
    n, first, last = zip(*units)
    return [pd.DataFrame({"key": [key[0]] * len(units), "n": n, "first_us": first, "last_us": last})]


class UnitProcessor(_Ordered):
    """Units that restart after they end, by idle time or by deadline."""

    def __init__(self, rule: UnitRule):
        self.rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.open_unit = handle.getValueState("open_unit", "n bigint, first_us bigint, last_us bigint")

    def _ends_at(self, held: tuple[int, int, int]) -> int:
        _, first_us, last_us = held
        return last_us + self.rule.idle if self.rule.idle is not None else first_us + self.rule.deadline

    def walk(self, key, rows, passed_us):
        done: list[tuple[int, int, int]] = []
        held = before = self.open_unit.get()
        if rows is not None:
            us, start = rows["us"].to_numpy(), 0
            if held is not None:
                n, first_us, last_us = held
                start = self.rule.continues(us, n, first_us, last_us)
                held = (n + start, first_us, int(us[start - 1]) if start else last_us)
                if start < len(us) or held[0] == self.rule.size:
                    done.append(held)
                    held = None
            rest = us[start:]
            if len(rest):
                ends = self.rule.ends(rest)
                opened = walk(ends, 0)
                found = [(int(e - s), int(rest[s]), int(rest[e - 1])) for s, e in zip(opened, ends[opened])]
                held = None if found[-1][0] == self.rule.size else found.pop()
                done += found
        if held is not None and self._ends_at(held) <= passed_us:
            done.append(tuple(held))
            held = None
        if held is not None and held != before:
            self.open_unit.update(held)
        elif held is None and before is not None:
            self.open_unit.clear()
        return _units_frame(key, done), None if held is None else self._ends_at(held)


class OnceProcessor(_Ordered):
    """Only the first unit of a key counts: a key that completed or ran out of time is ignored afterwards.

    A finished key leaves a mark behind, which covers events up to ``forget_us`` after its deadline and is dropped then;
    ``None`` keeps it.
    """

    def __init__(self, size: int, deadline_us: int, forget_us: int | None):
        self.size, self.deadline_us, self.forget_us = size, deadline_us, forget_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.seen = handle.getValueState("seen", "n bigint, first_us bigint, finished boolean")

    def _forget_at(self, first_us: int) -> int | None:
        return None if self.forget_us is None else first_us + self.deadline_us + self.forget_us

    def wanted(self, rows):
        """Events that the mark of a finished key covers need not wait."""
        _, first_us, finished = self.seen.get() or (0, None, False)
        if not finished:
            return rows
        until = self._forget_at(first_us)
        return rows.iloc[:0] if until is None else rows[rows["us"] > until]

    def walk(self, key, rows, passed_us):
        before = self.seen.get()
        n, first_us, finished = before or (0, None, False)
        us = np.empty(0, dtype=np.int64) if rows is None else rows["us"].to_numpy()
        found = []
        while True:
            if finished:
                until = self._forget_at(first_us)
                us = us[:0] if until is None else us[us > until]
                if until is None or (not len(us) and until > passed_us):
                    break
                n, first_us, finished = 0, None, False
            if first_us is None:
                if not len(us):
                    break
                first_us = int(us[0])
            taken = us[us < first_us + self.deadline_us][: self.size - n]
            n, us = n + len(taken), us[len(taken) :]
            if n == self.size and len(taken):
                found.append((n, first_us, int(taken[-1])))
            finished = n == self.size or len(us) > 0 or first_us + self.deadline_us <= passed_us
            if not finished:
                break
        if first_us is None and before is not None:
            self.seen.clear()
        elif first_us is not None and (n, first_us, finished) != before:
            self.seen.update((n, first_us, finished))
        ends_us = None if first_us is None else self._forget_at(first_us) if finished else first_us + self.deadline_us
        return _units_frame(key, found), ends_us


class MemberProcessor(_Ordered):
    """Members of units of exactly ``size`` events; an unfinished unit is given up after ``idle`` without events."""

    def __init__(self, rule: UnitRule, payload: dict[str, str]):
        self.rule, self.payload = rule, payload
        self.columns = {"us": "bigint", "seq": "bigint", **payload}

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.members = handle.getListState("members", ", ".join(f"`{name}` {kind}" for name, kind in self.columns.items()))

    def walk(self, key, rows, passed_us):
        names, found = list(self.columns), []
        kept = rest = list(self.members.get())
        if rows is not None:
            # The open unit came before the rows that are due, so it stays in front of them.
            every = pd.concat([pd.DataFrame(kept, columns=names), rows]) if kept else rows
            ends = self.rule.ends(every["us"].to_numpy())
            opened = walk(ends, 0)
            full = [np.arange(s, e) for s, e in zip(opened, ends[opened]) if e - s == self.rule.size]
            last = opened[-1] if ends[opened[-1]] - opened[-1] < self.rule.size else len(every)
            rest = list(zip(*(_values(every[name].iloc[last:], kind) for name, kind in self.columns.items())))
            if full:
                members = every[list(self.payload)].take(np.concatenate(full))
                members.insert(0, "key", key[0])
                found.append(members)
        if rest and rest[-1][0] + self.rule.idle <= passed_us:
            rest = []
        if rest and (rows is not None):
            self.members.put(rest)
        elif kept and not rest:
            self.members.clear()
        return found, rest[-1][0] + self.rule.idle if rest else None


def _grouped(events: DataFrame, key: str, ts: str, late: str, shards: int | None, *payload):
    """Rows by shard, where keys of this type can be dealt to shards, else by key; the key's type; whether there are shards."""
    kind = events.select(key).schema[0].dataType.simpleString()
    name, dealt = F.col(key), shards is not None and kind in STAND_INS
    timed = events.where(F.col(ts).isNotNull()).withWatermark(ts, late)
    columns = [name.alias("key"), ts, to_micros(F.col(ts)).alias("us"), *payload]
    if not dealt:
        rows = timed.select(*columns)
        return rows.groupBy("key"), kind, False, rows
    # Pandas would turn whole numbers into floats where a key is missing.
    columns[0] = F.coalesce(name, F.lit(STAND_INS[kind]).cast(kind)).alias("key")
    shard = F.when(name.isNull(), NO_KEY).otherwise(F.pmod(F.xxhash64(name), F.lit(shards)))
    rows = timed.select(shard.alias("shard"), *columns)
    return rows.groupBy("shard"), kind, True, rows


def named_units(found: DataFrame, key: str, size: int) -> DataFrame:
    return found.select(
        F.col("key").alias(key), "n", status(size).alias("status"),
        from_micros(F.col("first_us")).alias("first_ts"), from_micros(F.col("last_us")).alias("last_ts"),
    )


def units(events: DataFrame, key: str, ts: str, size: int, *, idle: timedelta | None = None,
          deadline: timedelta | None = None, late: str = "0 seconds", shards: int | None = SHARDS) -> DataFrame:
    """Units as they end: ``key, n, status, first_ts, last_ts``. One of ``idle`` and ``deadline`` must be given,
    or unfinished units would stay for good. Keys that are whole numbers or text are dealt to ``shards`` (see ``shards.py``);
    ``None`` walks every key by itself."""
    if (idle is None) == (deadline is None):
        raise ValueError("give either idle or deadline")
    rule = UnitRule(size, micros(idle), micros(deadline))
    groups, kind, dealt, _ = _grouped(events, key, ts, late, shards)
    found = groups.transformWithStateInPandas(
        ShardUnits(rule, kind) if dealt else UnitProcessor(rule),
        f"key {kind}, n bigint, first_us bigint, last_us bigint", "append", "EventTime")
    return named_units(found, key, size)


def once_units(events: DataFrame, key: str, ts: str, size: int, deadline: timedelta, *,
               forget: timedelta | None = None, late: str = "0 seconds", shards: int | None = SHARDS) -> DataFrame:
    """``shards`` as for ``units``; where finished keys are never forgotten (no ``forget``) each is walked by itself, for the
    marks of a shard would be read as a whole."""
    groups, kind, dealt, _ = _grouped(events, key, ts, late, shards if forget is not None else None)
    limits = size, micros(deadline), micros(forget)
    found = groups.transformWithStateInPandas(
        ShardOnce(*limits, kind) if dealt else OnceProcessor(*limits),
        f"key {kind}, n bigint, first_us bigint, last_us bigint", "append", "EventTime")
    return named_units(found, key, size)


def exact_members(events: DataFrame, key: str, ts: str, order: str, size: int, payload: list[str], *,
                  idle: timedelta, late: str = "0 seconds", shards: int | None = SHARDS) -> DataFrame:
    """The events of units that got exactly ``size`` events: ``key, <payload>``. ``shards`` as for ``units``."""
    groups, kind, dealt, rows = _grouped(events, key, ts, late, shards, F.col(order).alias("seq"), *payload)
    kinds = {name: rows.schema[name].dataType.simpleString() for name in payload}
    columns = ", ".join(f"`{name}` {of}" for name, of in kinds.items())
    rule = UnitRule(size, micros(idle))
    return groups.transformWithStateInPandas(
        ShardMembers(rule, kind, kinds) if dealt else MemberProcessor(rule, kinds),
        f"key {kind}, {columns}", "append", "EventTime",
    ).withColumnRenamed("key", key)


from tidemark.streaming.shards import NO_KEY, STAND_INS, ShardMembers, ShardOnce, ShardUnits  # noqa: E402  they build on the processors above
