"""SimHash near-duplicates by anchor-point covering.

A fingerprint is cut into blocks, and of two fingerprints that differ in at most ``threshold`` bits one block differs
in no more than its part of that threshold (the parts plus one each add up to the threshold plus one). The anchors of
a block are the words of a perfect Hamming code over as many of its bits as fit (covering radius 1), times all values
of its other bits. Every fingerprint has a home, the anchor within the radius, and is copied to every anchor within
radius plus threshold, so it meets the home of each partner. Per anchor, homes are compared with copies.

A text's words are runs other than blank and 0x09 to 0x0D with A-Z lower-cased; fewer words than a shingle make one
shingle; a text without words (null, empty) has fingerprint 0 and is linked like any other. Rows that repeat share a
fingerprint and so a component. A component is named by its least key; null keys are passed over unless all are null.

Texts of any length count whole; an empty table gives no rows. ``components`` reads two columns, whatever the others are
named; ``first_of_each`` hands them through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import least_nodes
from tidemark.llm.staging import staged
from tidemark.llm.tokens import LOWER, pieces

SHINGLE = 4
THRESHOLD = 4
BLOCKS = 2
SEED = 42
_LOWER = LOWER.tobytes()
#: For each byte its bits as eight one-byte counters in a 64-bit number.
_LANES = sum(((np.arange(256, dtype=np.uint64) >> np.uint64(j)) & np.uint64(1)) << np.uint64(8 * j) for j in range(8))
_AT_ONCE = 255 * 400


def _shingle_hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles in order, repeats included, a part at a time."""
    words = text.translate(_LOWER).split()
    if not words:
        return
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    many = max(1, len(words) - shingle + 1)
    starts, ends = (ends - lengths)[:many].tolist(), ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, many, _AT_ONCE):
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + _AT_ONCE], ends[at:at + _AT_ONCE])], np.uint64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the hashes of all shingles, repeats included."""
    counts, many = np.zeros(64, np.int64), 0
    for hashes in _shingle_hashes(text, shingle):
        many += len(hashes)
        lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > many, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fingerprint) of every row."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                prints = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in piece.column("text")]
                yield pa.RecordBatch.from_arrays([piece.column("key"), pa.array(prints, pa.int64())], names=["key", "fingerprint"])

    return docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text")).mapInArrow(run, "key long, fingerprint long")


class Block:
    """The code of one block of bits and the error patterns that lead from a value to its anchors."""

    def __init__(self, shift: int, size: int, part: int):
        self.shift, self.size = np.uint64(shift), size
        self.coded = (1 << ((size + 1).bit_length() - 1)) - 1
        patterns: list[list[int]] = [[] for _ in range(self.coded + 1)]
        for weight in range(part + 2):
            frees = [sum(1 << (self.coded + f) for f in flips) for many in range(part - max(0, weight - 1) + 1)
                     for flips in combinations(range(size - self.coded), many)]
            for flips in combinations(range(self.coded), weight):
                syndrome = 0
                for f in flips:
                    syndrome ^= f + 1
                patterns[syndrome] += [sum(1 << f for f in flips) | free for free in frees]
        self.patterns = [np.array(p, np.uint64) for p in patterns]

    def copies(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, whether it is home, fingerprint) for every anchor that a fingerprint is copied to."""
        values = (prints >> self.shift) & np.uint64((1 << self.size) - 1)
        syndromes = np.zeros(len(prints), np.int64)
        for bit in range(self.coded):
            syndromes ^= np.where((values >> np.uint64(bit)) & np.uint64(1), bit + 1, 0)
        parts = []
        for syndrome in np.unique(syndromes):
            mine = syndromes == syndrome
            anchors = values[mine][:, None] ^ self.patterns[syndrome][None, :]
            own = self.patterns[syndrome] == np.uint64(1 << (int(syndrome) - 1) if syndrome else 0)
            parts.append((anchors.ravel(), np.tile(own, mine.sum()), np.repeat(prints[mine], len(own))))
        return tuple(np.concatenate(x) for x in zip(*parts))


def blocks_of(threshold: int, blocks: int) -> list[Block]:
    if not 1 <= blocks <= threshold + 1:
        raise ValueError("there can be at most one block more than bits that may differ")
    made, shift = [], 0
    for i in range(blocks):
        size = 64 // blocks + (i < 64 % blocks)
        part = (threshold + 1) // blocks + (i < (threshold + 1) % blocks) - 1
        made.append(Block(shift, size, part))
        shift += size
    return made


def anchored(prints: DataFrame, threshold: int, blocks: int) -> DataFrame:
    """Every distinct fingerprint at each of its anchors: (cell, copied, fingerprint); copied is 0 at home, else 1."""

    def run(batches):
        codes = blocks_of(threshold, blocks)
        for batch in batches:
            every = batch.column("fingerprint").to_numpy().view(np.uint64)
            for at in range(0, len(every), 2000):
                for number, code in enumerate(codes):
                    anchors, own, copies = code.copies(every[at:at + 2000])
                    cells = anchors.view(np.int64) | np.int64(number << 48)
                    columns = [pa.array(cells), pa.array((~own).astype(np.int32)), pa.array(copies.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["cell", "copied", "fingerprint"])

    return prints.select("fingerprint").mapInArrow(run, "cell long, copied int, fingerprint long")


def _joining(ends: np.ndarray, far: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Places of the closest pairs first that join two groups not yet joined, and the group of each node.

    ``ends`` are pairs of nodes counted from 0. Pairs within a group are passed over in bulk.
    """
    todo = np.argsort(far, kind="stable")
    group, kept, size = np.arange(ends.max(initial=-1) + 1), [], 1024
    while len(todo):
        head, todo = todo[:size], todo[size:]
        above = group.tolist()
        for place, (x, y) in zip(head.tolist(), ends[head].tolist()):
            while above[x] != x:
                x = above[x]
            while above[y] != y:
                y = above[y]
            if x != y:
                above[max(x, y)] = min(x, y)
                kept.append(place)
        group = np.array(above, np.int64)
        while (group != group[group]).any():
            group = group[group]
        todo = todo[group[ends[todo, 0]] != group[ends[todo, 1]]]
        size *= 2
    return kept, group


def _bits(pairs: np.ndarray) -> np.ndarray:
    return np.bitwise_count(pairs[:, 0] ^ pairs[:, 1])


def _forest(pairs: np.ndarray) -> np.ndarray:
    """Closest pairs first, those that join two groups not yet joined."""
    ends = np.unique(pairs, return_inverse=True)[1].reshape(-1, 2)
    return pairs[_joining(ends, _bits(pairs))[0]]


def _near(homes: np.ndarray, others: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of a home and another fingerprint within the threshold, compared a block at a time."""
    step = max(1, 2_000_000 // max(1, len(homes)))
    for at in range(0, len(others), step):
        part = others[at:at + step]
        h, o = np.nonzero(np.bitwise_count(homes[:, None] ^ part[None, :]) <= threshold)
        apart = homes[h] != part[o]
        yield h[apart], o[apart] + at


def _meetings(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[tuple[bool, np.ndarray]]:
    """(whether a batch ends, pairs met): two fingerprints within the threshold.

    Rows come sorted by cell with homes first; the homes of one cell are held and the copies passed by in batches.
    """
    last, homes = None, np.zeros(0, np.uint64)
    for batch in batches:
        cells, copied = batch.column("cell").to_numpy(), batch.column("copied").to_numpy()
        values = batch.column("fingerprint").to_numpy().view(np.uint64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(cells)) + 1, [len(cells)]]) if len(cells) else np.zeros(1, int)
        n_homes = np.add.reduceat((copied == 0).astype(np.int64), cuts[:-1]) if len(cells) else np.zeros(0, int)
        for i in range(len(cuts) - 1):
            a, b = cuts[i], cuts[i + 1]
            going_on = i == 0 and cells[a] == last
            if not going_on and (n_homes[i] == 0 or b - a == 1) and i < len(cuts) - 2:
                continue
            new = slice(a, a + n_homes[i])
            homes = np.concatenate([homes, values[new]]) if going_on else values[new]
            if len(homes):
                for h, o in _near(homes, values[a:b], threshold):
                    if len(h):
                        yield False, np.stack([homes[h], values[a:b][o]], axis=1)
        if len(cells):
            last = cells[-1]
        yield True, np.zeros((0, 2), np.uint64)


def links(prints: DataFrame, threshold: int = THRESHOLD, blocks: int = BLOCKS) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect the same ones as all pairs within the threshold do.

    Of the pairs in a batch, closest first, only those are kept that join groups not joined before, so output never
    exceeds input.
    """
    def run(batches):
        pairs = []
        for whole, met in _meetings(batches, threshold):
            pairs.append(_forest(met) if len(met) > 1 else met)
            if whole:
                kept = _forest(np.concatenate(pairs)).view(np.int64)
                pairs = []
                yield pa.RecordBatch.from_arrays([pa.array(kept[:, 0]), pa.array(kept[:, 1])], names=["u", "v"])

    met = anchored(prints, threshold, blocks).repartition("cell").sortWithinPartitions("cell", "copied")
    return met.mapInArrow(run, "u long, v long")


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD,
               blocks: int = BLOCKS) -> DataFrame:
    """(key, fingerprint, component) of every row. Equal fingerprints are compared once, whatever their number."""
    prints = staged(fingerprints(docs, key, text, shingle), "fingerprints")
    distinct = staged(prints.groupBy("fingerprint").agg(F.min("key").alias("least")), "fingerprints-distinct")
    roots = least_nodes(links(distinct, threshold, blocks))
    rooted = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left")
    rooted = rooted.select(F.col("fingerprint").alias("print"), "least", F.coalesce("root", "fingerprint").alias("root"))
    named = rooted.groupBy(F.col("root").alias("top")).agg(F.min("least").alias("component"))
    classes = rooted.join(named, F.col("root") == F.col("top")).select("print", "component")
    return prints.join(classes, F.col("fingerprint") == F.col("print")).select("key", "fingerprint", "component")


def first_of_each(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD, blocks: int = BLOCKS) -> DataFrame:
    """One document of each component, the first in the table, with the columns the documents came with.

    The table is written once with a number per row, so every later step means the same row by it.
    """
    every = F.struct(*(docs[f"`{name}`"] for name in docs.columns))
    numbered = staged(docs.select(F.monotonically_increasing_id().alias("place"), every.alias("doc")), "numbered")
    texts = numbered.select("place", F.col("doc").getField(text).alias("text"))
    classes = components(texts, "place", "text", shingle, threshold, blocks)
    kept = classes.where("key = component").select(F.col("key").alias("place"))
    return numbered.join(kept, "place", "left_semi").select("doc.*")
