"""Burrows-Wheeler transforms of small shards of strings, and their merge by interleave refinement.

Each string ends with a mark of its own that sorts before all bytes, in the order of the strings. A merge starts from
the transforms laid end to end and sorts by one more leading byte in each round: the byte before each suffix says
where that suffix goes, so a stable sort by it turns an order by h - 1 bytes into one by h. Only which shard each
place belongs to moves; the transforms themselves are read in order. The round in which two neighbours first part is
their common prefix plus one.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_PACKED = 7


class Shard(NamedTuple):
    """Transform (0 is an end mark, else byte + 1), number of strings, and place of each suffix in the joined strings."""

    transform: np.ndarray
    strings: int
    places: np.ndarray


def transform(strings: list[bytes]) -> Shard:
    """The transform of some strings, suffixes sorted by prefix doubling. Strings are valid UTF-8, so no byte is 255."""
    lengths = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(lengths) - 1
    symbols = np.zeros(int(lengths.sum()), np.uint8)
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    symbols[inside] = np.frombuffer(b"".join(strings), np.uint8) + np.uint8(1)
    owner = np.repeat(np.arange(len(strings)), lengths)
    left = ends[owner] - np.arange(len(symbols))
    packed = np.zeros(len(symbols), np.uint64)
    padded = np.concatenate([symbols, np.zeros(_PACKED, np.uint8)])
    for k in range(_PACKED):
        packed = (packed << np.uint64(8)) | np.where(left >= k, padded[k:k + len(symbols)], 0).astype(np.uint64)
    tie = np.where(left < _PACKED, owner + 1, 0)
    order = np.lexsort((tie, packed))
    ranks, step = _ranks(order, packed, tie), _PACKED
    while ranks.max() + 1 < len(symbols):
        second = np.zeros(len(symbols), np.int64)
        second[:-step] = np.where(left[:-step] >= step, ranks[step:] + 1, 0)
        both = ranks * np.int64(len(symbols) + 1) + second
        order = np.argsort(both, kind="stable")
        ranks, step = _ranks(order, both), 2 * step
    return Shard(symbols[order - 1] if len(order) else symbols, len(strings), order)


def _ranks(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(order), np.int64)
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def merged(first: Shard, second: Shard, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Which places of the common order by ``depth`` bytes belong to the second shard, and the common prefix of each
    place with the one before (``depth`` if it is that long or longer).

    The suffixes that share their first h bytes are a block: a range of places in each shard, those of the first shard
    ahead. A block that a round leaves as it was sends its suffixes to where they are already, so a round refines only
    by the blocks that the one before made.
    """
    shards = (first, second)
    size, marks = len(first.transform) + len(second.transform), first.strings + second.strings
    # By byte, then place: how many entries are less than (byte, place) is where that byte before that place leads.
    ranked = [np.sort(_keyed(s.transform, np.arange(len(s.transform)), len(s.transform))) for s in shards]
    parted = np.zeros(size + 1, bool)
    parted[size] = True
    ahead = np.zeros(size + 1, np.int64)
    ahead[size] = len(first.transform)
    prefix = np.full(size, depth, np.int32)
    byte = np.unique(np.concatenate([first.transform, second.transform]))
    byte, mark = byte[byte > 0], np.arange(marks)
    edges = [(np.clip(mark - skip, 0, s.strings), np.clip(mark + 1 - skip, 0, s.strings)) for s, skip in zip(shards, (0, first.strings))]
    blocks = [np.concatenate([edge, np.searchsorted(ranks, _keyed(byte + n, 0, len(ranks)))])
              for ranks, pair in zip(ranked, edges) for n, edge in enumerate(pair)]
    for length in range(1, depth + 1):
        begin, end = blocks[0] + blocks[2], blocks[1] + blocks[3]
        made = ~(parted[begin] & parted[end])
        blocks = [edge[made] for edge in blocks]
        begin = begin[made]
        if not len(begin):
            break
        fresh = ~parted[begin]
        prefix[begin[fresh]] = length - 1
        parted[begin] = True
        ahead[begin] = blocks[0]
        blocks = _led(shards, ranked, blocks)
    heads = np.flatnonzero(parted[:size])
    share = np.diff(ahead[np.append(heads, size)])
    of_second = np.arange(size) - np.repeat(heads, np.diff(np.append(heads, size))) >= np.repeat(share, np.diff(np.append(heads, size)))
    return of_second, prefix


def _keyed(byte: np.ndarray, place: np.ndarray | int, size: int) -> np.ndarray:
    return np.asarray(byte).astype(np.int64) * (size + 1) + place


def _led(shards: tuple[Shard, Shard], ranked: list[np.ndarray], blocks: list[np.ndarray]) -> list[np.ndarray]:
    """The blocks that each byte (end marks left out) before the suffixes of ``blocks`` leads to, in order like them."""
    seen, number = [], len(blocks[0])
    for which, (shard, begin, end) in enumerate(zip(shards, blocks[::2], blocks[1::2])):
        many = end - begin
        owner = np.repeat(np.arange(number), many)
        place = np.arange(len(owner)) + np.repeat(begin - (np.cumsum(many) - many), many)
        before = shard.transform[place].astype(np.int64)
        seen.append(((before * number + owner) * 2 + which)[before > 0])
    every = np.sort(np.concatenate(seen))
    if not len(every):
        return [every] * 4
    first = np.flatnonzero(np.diff(every >> 1, prepend=-1))
    byte, owner = np.divmod(every[first] >> 1, number)
    of_second = np.add.reduceat(every & 1, first)
    of_first = np.diff(np.append(first, len(every))) - of_second
    begins = [np.searchsorted(ranks, _keyed(byte, begin[owner], len(ranks))) for ranks, begin in zip(ranked, blocks[::2])]
    return [begins[0], begins[0] + of_first, begins[1], begins[1] + of_second]


def repeated_places(strings: list[bytes], depth: int) -> np.ndarray:
    """Places in the joined strings (one end mark after each) where ``depth`` bytes start that also start elsewhere."""
    half = (len(strings) + 1) // 2
    first, second = transform(strings[:half]), transform(strings[half:])
    of_second, prefix = merged(first, second, depth)
    equal = prefix >= depth
    equal[:-1] |= equal[1:]
    places = np.empty(len(equal), np.int64)
    places[~of_second] = first.places
    places[of_second] = second.places + len(first.places)
    return np.sort(places[equal])
