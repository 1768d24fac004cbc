"""First units of keys with a bounded memory of finished ones: what ``units.once_units`` does where keys never end.

Keys are dealt to shards, and a shard is what a stateful call sees. It holds the open units by key, and finished keys in a
Bloom filter that is cut into segments, so a key reads and writes one small entry of the map state. Filters fill up one
after the other; when the newest is full the oldest of GENERATIONS is dropped. So a shard's state is its open units plus
a fixed number of segments, whatever the number of keys, and at least the last ``remember`` finished keys stay known (as far
as they are dealt evenly to shards).

A filter never forgets a key it holds, but takes a new key for a finished one at a rate of about FALSE_DROPS per filter:
such a key's unit is lost. A key that has been forgotten may open a unit again.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

from tidemark.functions.times import to_micros
from tidemark.operators.units import micros
from tidemark.streaming.units import _Ordered, _sooner, named_units

GENERATIONS = 4
#: Bits of a key in its segment, bits of a segment, and bits of a filter for each key that it holds.
PROBES, SEGMENT_BITS, BITS_PER_KEY = 8, 32_768, 20
#: Share of new keys that one full filter takes for finished: (1 - exp(-PROBES / BITS_PER_KEY)) ** PROBES.
FALSE_DROPS = 1.4e-4


def segments_for(remember: int, shards: int) -> int:
    """Segments of a filter, so that all but the newest hold ``remember`` keys together."""
    return max(1, -(-remember * BITS_PER_KEY // (shards * (GENERATIONS - 1) * SEGMENT_BITS)))


class Finished:
    """Hashes of finished keys: generations of Bloom filters in segments of a map state."""

    def __init__(self, handle: StatefulProcessorHandle, segments: int):
        self.segments, self.capacity = segments, segments * SEGMENT_BITS // BITS_PER_KEY
        self.bits = handle.getMapState("finished", "generation bigint, segment bigint", "bits binary")
        self.progress = handle.getValueState("progress", "generation bigint, held bigint")
        self.open()

    def open(self) -> None:
        """Begin a call: what is read or written is kept until ``save``."""
        self.read: dict[tuple[int, int], bytearray | None] = {}
        self.changed: set[tuple[int, int]] = set()
        self.now: tuple[int, int] | None = None

    def _progress(self) -> tuple[int, int]:
        if self.now is None:
            self.now = tuple(self.progress.get() or (0, 0))
        return self.now

    def _segment(self, at: tuple[int, int]) -> bytearray | None:
        if at not in self.read:
            found = self.bits.getValue(at)
            self.read[at] = None if found is None else bytearray(found[0])
        return self.read[at]

    def _places(self, mark: int) -> tuple[int, list[int]]:
        mark &= 2**64 - 1
        start, step = (mark >> 16) % SEGMENT_BITS, (mark >> 40) | 1
        return mark % self.segments, [(start + i * step) % SEGMENT_BITS for i in range(PROBES)]

    def __contains__(self, mark: int) -> bool:
        newest, _ = self._progress()
        segment, places = self._places(mark)
        for generation in range(newest, max(-1, newest - GENERATIONS), -1):
            held = self._segment((generation, segment))
            if held is not None and all(held[p >> 3] >> (p & 7) & 1 for p in places):
                return True
        return False

    def add(self, mark: int) -> None:
        newest, held = self._progress()
        if held >= self.capacity:
            newest, held = newest + 1, 0
            for segment in range(self.segments):
                gone = (newest - GENERATIONS, segment)
                self.read.pop(gone, None)
                self.changed.discard(gone)
                self.bits.removeKey(gone)
        segment, places = self._places(mark)
        bits = self._segment((newest, segment))
        if bits is None:
            bits = self.read[newest, segment] = bytearray(SEGMENT_BITS // 8)
        for p in places:
            bits[p >> 3] |= 1 << (p & 7)
        self.changed.add((newest, segment))
        self.now = (newest, held + 1)

    def save(self) -> None:
        for at in self.changed:
            self.bits.updateValue(at, (bytes(self.read[at]),))
        if self.changed:
            self.progress.update(self.now)
        self.open()


class RememberingProcessor(_Ordered):
    """First units of the keys of a shard."""

    def __init__(self, size: int, deadline_us: int, segments: int, key_type: str):
        self.size, self.deadline_us, self.segments = size, deadline_us, segments
        self.key_type, self.columns = key_type, {"us": "bigint", "mark": "bigint", "key": key_type}

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.units = handle.getMapState("units", f"mark bigint, key {self.key_type}", "n bigint, first_us bigint")
        self.earliest = handle.getValueState("earliest", "first_us bigint")
        self.finished = Finished(handle, self.segments)

    def walk(self, key, rows, passed_us):
        self.finished.open()
        before = (self.earliest.get() or (None,))[0]
        earliest, found = before, []
        for name, some in [] if rows is None else rows.groupby("key", sort=False, dropna=False):
            at = (int(some["mark"].iloc[0]), None if pd.isna(name) else name.item() if isinstance(name, np.generic) else name)
            held = self.units.getValue(at)
            if held is None and at[0] in self.finished:
                continue
            us = some["us"].to_numpy()
            n, first_us = held or (0, int(us[0]))
            taken = us[us < first_us + self.deadline_us][: self.size - n]
            n += len(taken)
            if n == self.size:
                found.append((at[1], n, first_us, int(taken[-1])))
            if n == self.size or len(taken) < len(us) or first_us + self.deadline_us <= passed_us:
                self.finished.add(at[0])
                if held is not None:
                    self.units.removeKey(at)
            else:
                self.units.updateValue(at, (n, first_us))
                earliest = _sooner(earliest, first_us)
        if earliest is not None and earliest + self.deadline_us <= passed_us:
            earliest = self._out_of_time(passed_us)
        self.finished.save()
        if earliest is None and before is not None:
            self.earliest.clear()
        elif earliest != before:
            self.earliest.update((earliest,))
        frames = []
        if found:
            keys, n, first, last = zip(*found)
            frames = [pd.DataFrame({"key": keys, "n": n, "first_us": first, "last_us": last})]
        return frames, None if earliest is None else earliest + self.deadline_us

    def _out_of_time(self, passed_us: int) -> int | None:
        """Finish units whose deadline has passed; the first time of the others."""
        earliest = None
        for at, (_, first_us) in [(tuple(at), tuple(unit)) for at, unit in self.units.iterator()]:
            if first_us + self.deadline_us <= passed_us:
                self.units.removeKey(at)
                self.finished.add(at[0])
            else:
                earliest = _sooner(earliest, first_us)
        return earliest


def once_units(events: DataFrame, key: str, ts: str, size: int, deadline: timedelta, *, remember: int, shards: int = 64,
               late: str = "0 seconds") -> DataFrame:
    """Keys whose first ``size`` events all came within ``deadline`` of the first, as ``units.once_units`` gives them,
    with state bounded by open units and a memory of ``remember`` finished keys."""
    mark = F.xxhash64(F.col(key))
    rows = events.where(F.col(ts).isNotNull()).withWatermark(ts, late).select(
        F.pmod(mark, F.lit(shards)).alias("shard"), ts, to_micros(F.col(ts)).alias("us"), mark.alias("mark"), F.col(key).alias("key"))
    kind = rows.schema["key"].dataType.simpleString()
    processor = RememberingProcessor(size, micros(deadline), segments_for(remember, shards), kind)
    found = rows.groupBy("shard").transformWithStateInPandas(
        processor, f"key {kind}, n bigint, first_us bigint, last_us bigint", "append", "EventTime")
    return named_units(found, key, size)

