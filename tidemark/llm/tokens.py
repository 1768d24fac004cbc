"""Words and hashes of whole Arrow batches of texts, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts handled at a time, in bytes; a longer text is handled alone.
PIECE_BYTES = 4_000_000


def _table(blank: bytes) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(blank)] = False
    return table


#: Bytes of words between blanks: all but the blank and 0x09 to 0x0D.
NOT_BLANK = _table(bytes([0x20, *range(0x09, 0x0E)]))
#: Bytes of words of letters and digits: digits, letters and everything beyond ASCII.
ALPHANUMERIC = _table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def pieces(batch: pa.RecordBatch, column: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each."""
    _, offsets = flat(batch.column(column))
    start, rows = 0, batch.num_rows
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield batch.slice(start, end - start)
        start = end


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each text starts (one more entry for the end). Null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each text the number of its first word (one more entry at the end)."""
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = is_word[data]
    starts = inside[:-1].copy()
    starts[1:] &= ~inside[:-2]
    cut = offsets[1:-1]
    cut = cut[cut < len(data)]
    starts[cut] = inside[cut]
    ends = inside[:-1] & ~inside[1:]
    before = cut[cut > 0] - 1
    ends[before] = inside[before]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


_powers: list[np.ndarray] = []


def _powers_up_to(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, kept for the largest size asked for."""
    if not _powers or len(_powers[0]) < size:
        wide = 1 << max(16, (size - 1).bit_length())
        made = [np.full(wide, x, np.uint64) for x in (_BASE, _INVERSE)]
        for x in made:
            x[0] = 1
        _powers[:] = [np.multiply.accumulate(x) for x in made]
    return _powers


class RangeHashes:
    """64-bit hashes of any ranges of a sequence; equal ranges hash alike wherever they stand."""

    def __init__(self, symbols: np.ndarray):
        up, self.down = _powers_up_to(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[: len(symbols)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return RangeHashes(data).of(starts, ends)
