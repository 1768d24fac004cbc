"""Balanced parentheses of a tree in preorder, with minima of the excess per block and a tree of minima above them."""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    """An opening and a closing parenthesis per node; the subtree of a node lies between its two.

    Built from paths in order: ``shared[i]`` steps that path i has in common with the one before, ``lengths[i]`` in all.
    The first pair is the root, which holds all paths.
    """

    def __init__(self, shared: np.ndarray, lengths: np.ndarray):
        before = np.concatenate([[0], lengths[:-1]])
        turns = np.stack([before - shared, lengths - shared], axis=1).ravel()
        closed_then_opened = np.repeat(np.tile([False, True], len(lengths)), turns)
        self.opening = np.concatenate([[True], closed_then_opened, np.zeros(lengths[-1] + 1, dtype=bool)])
        self.excess = np.cumsum(np.where(self.opening, 1, -1))
        self.opens = np.flatnonzero(self.opening)
        filled = np.full(-(-len(self.excess) // BLOCK) * BLOCK, len(self.excess), dtype=np.int64)
        filled[: len(self.excess)] = self.excess
        self.filled = filled
        self.minima = [filled.reshape(-1, BLOCK).min(axis=1)]
        while len(self.minima[-1]) > 1:
            below = self.minima[-1]
            below = np.append(below, len(self.excess)) if len(below) % 2 else below
            self.minima[-1] = below
            self.minima.append(below.reshape(-1, 2).min(axis=1))

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Where the parentheses opened at these places close: the next place with a smaller excess."""
        below = self.excess[at] - 1
        found = np.full(len(at), -1)
        waiting = np.arange(len(at))
        for step in range(1, BLOCK):  # inside the block
            place = at[waiting] + step
            inside = place // BLOCK == at[waiting] // BLOCK
            hit = inside & (self.filled[np.minimum(place, len(self.filled) - 1)] == below[waiting])
            found[waiting[hit]] = place[hit]
            waiting = waiting[inside & ~hit]
            if not len(waiting):
                break
        far = np.flatnonzero(found < 0)
        node, level = at[far] // BLOCK, np.full(len(far), -1)
        for height, least in enumerate(self.minima):  # up, until the right neighbour reaches low enough
            climbing = level < 0
            right = node + 1
            reaches = climbing & (node % 2 == 0) & (right < len(least))
            reaches[reaches] = least[right[reaches]] <= below[far][reaches]
            level[reaches] = height
            node = np.where(reaches, right, np.where(climbing, node // 2, node))
        for height in range(len(self.minima) - 1, 0, -1):  # and down to the first block that does
            falling = level >= height
            left = 2 * node[falling]
            node[falling] = np.where(self.minima[height - 1][left] <= below[far][falling], left, left + 1)
        place = node * BLOCK
        waiting = np.arange(len(far))
        for _ in range(BLOCK):
            hit = self.filled[place[waiting]] == below[far][waiting]
            found[far[waiting[hit]]] = place[waiting[hit]]
            waiting = waiting[~hit]
            place[waiting] += 1
            if not len(waiting):
                break
        return found

    def rank_open(self) -> np.ndarray:
        """Opening parentheses before each place."""
        return np.concatenate([[0], np.cumsum(self.opening)])

    def leaf_pairs(self) -> np.ndarray:
        """Where a pair closes at once: a node without children."""
        return np.append(self.opening[:-1] & ~self.opening[1:], False)


def least_in(values: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The minimum of values[first:after] for ranges that are not empty, by doubling."""
    out = np.empty(len(first), dtype=values.dtype)
    length = after - first
    width, least = 1, values
    while True:
        here = (length >= width) & (length < 2 * width)
        out[here] = np.minimum(least[first[here]], least[after[here] - width])
        if 2 * width > length.max(initial=0):
            return out
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
