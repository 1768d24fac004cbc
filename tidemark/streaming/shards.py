"""Units of many keys: keys are dealt to shards, and a call walks all keys of a shard at once.

A call to a processor costs some milliseconds and several round trips to the state store, whatever it holds, so one call per
key and trigger makes the time grow with the number of keys. Here the calls of a trigger are at most as many as there are shards,
and rows are walked as whole arrays, sorted by key. A shard's rows wait as those of a key do in ``units``: in sorted chunks of
the map state, of which a call holds MERGED, one Arrow batch and what overlaps in time. Besides, a call holds the open units of
its shard: four numbers per open key, or (for members) at most ``size - 1`` rows per open key. Deal many millions of keys that are
open together to more shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessorHandle

from tidemark.operators.unit_rules import UnitRule, walk
from tidemark.streaming.units import CHUNK, _Ordered, _values

#: Values that stand for a null key, by the kind of key that can be dealt to shards; null keys have the shard NO_KEY to themselves.
STAND_INS = {"tinyint": 0, "smallint": 0, "int": 0, "bigint": 0, "string": ""}
NO_KEY = -1


class Held:
    """A table of a shard: chunks of a map state, numbered from 0."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, columns: dict[str, str]):
        self.columns, self.many = columns, 0
        self.chunks = handle.getMapState(name, "number bigint", ", ".join(f"`{c}` array<{kind}>" for c, kind in columns.items()))

    def read(self) -> pd.DataFrame | None:
        found = sorted(((tuple(at), value) for at, value in self.chunks.iterator()), key=lambda entry: entry[0])
        self.many = len(found)
        return pd.concat([pd.DataFrame(dict(zip(self.columns, value))) for _, value in found], ignore_index=True) if found else None

    def write(self, rows: pd.DataFrame | None) -> None:
        starts = range(0, 0 if rows is None else len(rows), CHUNK)
        for number, start in enumerate(starts):
            chunk = rows.iloc[start : start + CHUNK]
            self.chunks.updateValue((number,), tuple(_values(chunk[c], kind) for c, kind in self.columns.items()))
        for number in range(len(starts), self.many):
            self.chunks.removeKey((number,))
        self.many = len(starts)


class _Sharded(_Ordered):
    """A subclass walks with the open units of all keys of the shard in ``open``, which are read and written once a call."""

    held_columns: dict[str, str]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.held = Held(handle, "held", self.held_columns)

    def _turn(self, key, new, timer_values, fired: bool) -> Iterator[pd.DataFrame]:
        self.open, self.changed = self.held.read(), False
        for found in super()._turn(key, new, timer_values, fired):
            if len(found):
                yield found.assign(key=pd.Series([None] * len(found), found.index, object)) if key[0] == NO_KEY else found
        if self.changed:
            self.held.write(self.open)


class ShardUnits(_Sharded):
    """Units that restart after they end, by idle time or by deadline, of all keys of a shard."""

    def __init__(self, rule: UnitRule, key_type: str):
        self.rule, self.columns = rule, {"us": "bigint", "key": key_type}
        self.held_columns = {"key": key_type, "n": "bigint", "first_us": "bigint", "last_us": "bigint"}

    def walk(self, key, rows, passed_us):
        rule, held = self.rule, self.open
        if rows is None and held is None:
            return [], None
        done: list[pd.DataFrame] = []
        if rows is not None:
            held = self._with(held, rows["key"].to_numpy(), rows["us"].to_numpy(), done)
            self.changed = True
        ends = held["last_us"] + rule.idle if rule.idle is not None else held["first_us"] + rule.deadline
        over = ends <= passed_us
        if over.any():
            done.append(held[over])
            held, ends, self.changed = held[~over], ends[~over], True
        self.open = held if len(held) else None
        return done, int(ends.min()) if len(held) else None

    def _with(self, held: pd.DataFrame | None, names: np.ndarray, us: np.ndarray, done: list[pd.DataFrame]) -> pd.DataFrame:
        """The open units after these rows; units that ended are added to ``done``."""
        rule, size, before = self.rule, self.rule.size, 0 if held is None else len(held)
        # Keys with an open unit come first in the table, in their order.
        codes, keys = pd.factorize(names if held is None else np.concatenate([held["key"].to_numpy(), names]))
        n, first, last = (np.zeros(len(keys), np.int64) for _ in range(3))
        if held is not None:
            n[:before], first[:before], last[:before] = (held[name].to_numpy() for name in ("n", "first_us", "last_us"))
        codes = codes[before:]

        def ended(which, n, first, last):
            done.append(pd.DataFrame({"key": keys[which], "n": n, "first_us": first, "last_us": last}))

        order = np.lexsort((us, codes))
        us, codes = us[order], codes[order]
        begin = np.flatnonzero(np.diff(codes, prepend=-1))
        own, many = codes[begin], np.diff(np.append(begin, len(codes)))
        place = np.arange(len(codes)) - np.repeat(begin, many)
        # How many rows of each key still belong to its open unit.
        stop = (n[codes] == 0) | (place >= size - n[codes])
        if rule.idle is not None:
            gap = np.diff(us, prepend=us[:1])
            gap[begin] = us[begin] - last[own]
            stop |= gap >= rule.idle
        if rule.deadline is not None:
            stop |= us >= first[codes] + rule.deadline
        taken = np.minimum(np.minimum.reduceat(np.where(stop, place, len(us)), begin), many)
        n[own] += taken
        last[own] = np.where(taken > 0, us[begin + np.maximum(taken, 1) - 1], last[own])
        full = own[(n[own] > 0) & ((n[own] == size) | (taken < many))]
        ended(full, n[full], first[full], last[full])
        n[full] = 0
        # Units that open at the other rows; the last one of a key stays open unless it is full.
        rest = place >= np.repeat(taken, many)
        us, codes = us[rest], codes[rest]
        if len(us):
            ends = rule.ends(us, np.diff(codes, prepend=-1) != 0)
            opened = walk(ends, 0)
            until, of = ends[opened], codes[opened]
            stays = np.append(of[1:] != of[:-1], True) & (until - opened < size)
            ended(of[~stays], (until - opened)[~stays], us[opened[~stays]], us[until[~stays] - 1])
            n[of[stays]], first[of[stays]], last[of[stays]] = (until - opened)[stays], us[opened[stays]], us[until[stays] - 1]
        left = np.flatnonzero(n)
        return pd.DataFrame({"key": keys[left], "n": n[left], "first_us": first[left], "last_us": last[left]})


class ShardOnce(_Sharded):
    """First units of all keys of a shard. Marks of finished keys are dropped ``forget_us`` after their deadline, so a shard
    holds the keys of that time, and no others."""

    def __init__(self, size: int, deadline_us: int, forget_us: int, key_type: str):
        self.size, self.deadline_us, self.forget_us = size, deadline_us, forget_us
        self.columns = {"us": "bigint", "key": key_type}
        self.held_columns = {"key": key_type, "n": "bigint", "first_us": "bigint", "finished": "boolean"}

    def wanted(self, rows):
        """Events that the mark of a finished key covers need not wait."""
        marks = None if self.open is None else self.open[self.open["finished"]]
        if marks is None or not len(marks):
            return rows
        at = pd.Index(marks["key"]).get_indexer(rows["key"])
        until = marks["first_us"].to_numpy()[at] + self.deadline_us + self.forget_us
        return rows[(at < 0) | (rows["us"].to_numpy() > until)]

    def walk(self, key, rows, passed_us):
        held, size, done = self.open, self.size, []
        if rows is None and held is None:
            return [], None
        before = 0 if held is None else len(held)
        names = np.concatenate([some["key"].to_numpy() for some in (held, rows) if some is not None])
        codes, keys = pd.factorize(names)  # held keys come first, in their order
        n, first, finished, opened = (np.zeros(len(keys), kind) for kind in (np.int64, np.int64, bool, bool))
        if held is not None:
            n[:before], first[:before], finished[:before] = (held[name].to_numpy() for name in ("n", "first_us", "finished"))
            opened[:before] = True
        codes = codes[before:]
        us = np.zeros(0, np.int64) if rows is None else rows["us"].to_numpy()
        order = np.lexsort((us, codes))
        us, codes = us[order], codes[order]
        # Times become ranks, so that key and time fit one sorted number and one search serves all keys.
        times = np.unique(us)
        ranked = codes * (len(times) + 1) + np.searchsorted(times, us)
        at, end = (np.searchsorted(codes, np.arange(len(keys)), side) for side in ("left", "right"))

        def until(which, us, side):
            """Where the rows of these keys stand whose time is beyond ``us`` (right) or not before it (left)."""
            return np.searchsorted(ranked, which * (len(times) + 1) + np.searchsorted(times, us, side))

        live = np.arange(len(keys))
        while len(live):
            marked = live[finished[live]]
            forget = first[marked] + self.deadline_us + self.forget_us
            at[marked] = np.maximum(at[marked], until(marked, forget, "right"))
            again = marked[(at[marked] < end[marked]) | (forget <= passed_us)]
            n[again], finished[again], opened[again] = 0, False, False
            live = np.concatenate([live[~np.isin(live, marked)], again])
            live = live[opened[live] | (at[live] < end[live])]
            new = live[~opened[live]]
            first[new], opened[new] = us[at[new]], True
            taken = np.maximum(np.minimum(until(live, first[live] + self.deadline_us, "left") - at[live], size - n[live]), 0)
            n[live] += taken
            at[live] += taken
            full = live[(n[live] == size) & (taken > 0)]
            if len(full):
                done.append(pd.DataFrame({"key": keys[full], "n": n[full], "first_us": first[full], "last_us": us[at[full] - 1]}))
            finished[live] = (n[live] == size) | (at[live] < end[live]) | (first[live] + self.deadline_us <= passed_us)
            live = live[finished[live]]
        left = np.flatnonzero(opened)
        now = pd.DataFrame({"key": keys[left], "n": n[left], "first_us": first[left], "finished": finished[left]})
        if held is None or not now.equals(held):
            self.open, self.changed = now if len(now) else None, True
        ends = first[left] + self.deadline_us + np.where(finished[left], self.forget_us, 0)
        return done, int(ends.min()) if len(left) else None


class ShardMembers(_Sharded):
    """Members of units of exactly ``size`` events, of all keys of a shard; an unfinished unit is given up after ``idle``."""

    def __init__(self, rule: UnitRule, key_type: str, payload: dict[str, str]):
        self.rule, self.payload = rule, payload
        self.columns = self.held_columns = {"us": "bigint", "seq": "bigint", "key": key_type, **payload}

    def walk(self, key, rows, passed_us):
        found, every = [], self.open
        if rows is not None:
            # An open unit came before the rows that are due, so it stays in front of them.
            every = rows if every is None else pd.concat([every, rows], ignore_index=True)
            codes, _ = pd.factorize(every["key"].to_numpy())
            order = np.argsort(codes, kind="stable")
            codes = codes[order]
            ends = self.rule.ends(every["us"].to_numpy()[order], np.diff(codes, prepend=-1) != 0)
            opened = walk(ends, 0)
            many, of = ends[opened] - opened, codes[opened]
            full = many == self.rule.size
            if full.any():
                which = (opened[full][:, None] + np.arange(self.rule.size)).ravel()
                found.append(every[["key", *self.payload]].take(order[which]))
            stays = np.append(of[1:] != of[:-1], True) & ~full
            which = np.repeat(opened[stays], many[stays]) + np.arange(many[stays].sum()) - np.repeat(
                np.cumsum(many[stays]) - many[stays], many[stays])
            every = every.take(order[which]).reset_index(drop=True)
            self.changed = True
        if every is None or not len(every):
            self.open = None
            return found, None
        last = every.groupby("key", sort=False)["us"].transform("last")
        over = (last + self.rule.idle <= passed_us).to_numpy()
        if over.any():
            every, last, self.changed = every[~over], last[~over], True
        self.open = every if len(every) else None
        return found, int(last.min()) + self.rule.idle if len(every) else None
