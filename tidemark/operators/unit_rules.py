"""When a unit of keyed events ends. Shared by the batch and the stream form.

Events of a key are taken in order. A unit opens with the first event after the previous one ended, and ends

* when it holds ``size`` events,
* with ``idle``: before an event that comes ``idle`` or more after the one before it,
* with ``deadline``: before an event that comes ``deadline`` or more after the unit's first one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class UnitRule:
    size: int
    idle: int | None = None  # microseconds
    deadline: int | None = None  # microseconds

    def __post_init__(self):
        if self.size < 1:
            raise ValueError("a unit holds at least one event")

    def ends(self, us: np.ndarray, key_starts: np.ndarray | None = None) -> np.ndarray:
        """For every row: where a unit that opens at it would end (one past its last row).

        ``us`` holds event times sorted within each key; ``key_starts`` marks rows where another key begins.
        """
        n = len(us)
        row = np.arange(n)
        cut = np.zeros(n, dtype=bool) if key_starts is None else key_starts.copy()
        if self.idle is not None:
            cut[1:] |= us[1:] - us[:-1] >= self.idle
        next_cut = np.full(n + 1, n)
        next_cut[:n] = np.minimum.accumulate(np.where(cut, row, n)[::-1])[::-1]
        ends = np.minimum(row + self.size, next_cut[1:])
        if self.deadline is not None:
            # Times become ranks, so that key number and time fit one sorted number and one search serves all keys.
            times = np.unique(us)
            key = (np.zeros(n, np.int64) if key_starts is None else np.cumsum(key_starts)) * (len(times) + 1)
            too_late = key + np.searchsorted(times, us + self.deadline, "left")
            ends = np.minimum(ends, np.searchsorted(key + np.searchsorted(times, us), too_late, "left"))
        return np.minimum(ends, n)

    def continues(self, us: np.ndarray, held: int, first_us: int, last_us: int) -> int:
        """How many of the rows ``us`` still belong to an open unit of ``held`` rows."""
        us = us[: self.size - held]
        stop = np.zeros(len(us), dtype=bool)
        if len(us) and self.idle is not None:
            stop |= np.diff(us, prepend=last_us) >= self.idle
        if self.deadline is not None:
            stop |= us >= first_us + self.deadline
        return int(stop.argmax()) if stop.any() else len(us)


def walk(ends: np.ndarray, first: int) -> np.ndarray:
    """Rows at which units open, when one opens at ``first``."""
    opened, jumps, row, n = [], ends.tolist(), first, len(ends)
    while row < n:
        opened.append(row)
        row = jumps[row]
    return np.array(opened, dtype=np.int64)
