"""Repeated word windows, found level by level: a window is looked at only if its beginning is repeated itself.

The first level are anchors of four words, of which every window of 13 holds one chosen by content (see
``fragments``). Fragments of an anchor that repeats are compared whole, which settles copies of any length at once:
all 13-word windows of a fragment that a document with a smaller id has too are repeated. What is left, the first
occurrence of each fragment of an anchor with several, is extended by doubling: windows of 8 words that repeat in
another document go on to 16, cut to 13, and stop there, since a longer repeat is a chain of 13-word ones.

Words are runs other than blank and 0x09 to 0x0D, taken unchanged. A window counts as repeated in a document if its
words also start in one with a smaller id; ids that are null count like the greatest possible one, and rows with one id
do not repeat each other. Null, empty and short texts have no windows and stay as they are. Long texts are read in parts,
with windows across them. An empty table gives no rows. Two columns are read, whatever the others are named. Windows are
compared by hashes of 64 bits of their words, which are not held against the words again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import fragments
from tidemark.llm.staging import staged
from tidemark.llm.tokens import NOT_BLANK, RangeHashes, flat, pieces, word_bounds, word_hashes

WIDTH = 13
ANCHOR = 4
#: Fragments of one anchor that may come together in one task, at most 22 words each.
FAMILY = 20_000
_LAST = 2**63 - 1


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(texts)
    starts, ends, first = word_bounds(data, offsets, NOT_BLANK)
    return word_hashes(data, starts, ends), first


def levels(width: int, anchor: int) -> list[int]:
    """Lengths after the anchors': doubled until the width is reached, the last one cut to it."""
    lengths = [anchor]
    while lengths[-1] < width:
        lengths.append(min(2 * lengths[-1], width))
    return lengths[1:]


def _fragments_of(texts: DataFrame) -> DataFrame:
    """The word hashes of the listed parts: (anchor, kinds, row, key, start, words)."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                words, first = _words(piece.column("text"))
                parts = piece.column("parts")
                text = np.repeat(np.arange(len(parts)), np.diff(parts.offsets.to_numpy()))
                inner, take = parts.flatten(), pa.array(text)
                sizes = inner.field("length").to_numpy().astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                at = np.repeat(first[text] + inner.field("start").to_numpy() - ends[:-1], sizes) + np.arange(ends[-1])
                listed = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(words[at].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [inner.field("anchor"), inner.field("kinds"), piece.column("row").take(take), piece.column("key").take(take), inner.field("start"), listed],
                    names=["anchor", "kinds", "row", "key", "start", "words"])

    return texts.mapInArrow(run, "anchor long, kinds long, row long, key long, start int, words array<long>")


def _window_hashes(batch: pa.RecordBatch, width: int, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of every window of the fragments in a batch: fragment, start in it, and hashes of its beginnings by length."""
    words = batch.column("words")
    offsets = words.offsets.to_numpy().astype(np.int64)
    hashes = RangeHashes(words.flatten().to_numpy().view(np.uint64))
    offsets = offsets - offsets[0]
    many = np.diff(offsets) - width + 1
    which = np.repeat(np.arange(len(many)), many)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
    at = offsets[which] + inside
    return which, inside, [hashes.of(at, at + n) for n in lengths]


def _shared(hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash occurs under another key too, and the least key it occurs under."""
    _, inverse = np.unique(hashes, return_inverse=True)
    least, most = np.full(inverse.max(initial=-1) + 1, _LAST), np.full(inverse.max(initial=-1) + 1, -_LAST - 1)
    np.minimum.at(least, inverse, keys)
    np.maximum.at(most, inverse, keys)
    return (least < most)[inverse], least[inverse]


def _families(rows: DataFrame, width: int, lengths: list[int]) -> DataFrame:
    """Repeated windows (row, start, end) among fragments that come sorted by anchor, level by level."""
    def solve(batch: pa.RecordBatch) -> pa.RecordBatch:
        which, inside, levels = _window_hashes(batch, width, lengths)
        keys = batch.column("key").to_numpy()[which]
        alive = np.arange(len(which))
        for hashes in levels:
            shared, least = _shared(hashes[alive], keys[alive])
            alive, least = alive[shared], least[shared]
        alive = alive[keys[alive] > least]
        start = batch.column("start").to_numpy()[which[alive]] + inside[alive]
        return pa.RecordBatch.from_arrays(
            [batch.column("row").take(pa.array(which[alive])), pa.array(start.astype(np.int32)), pa.array((start + width).astype(np.int32))],
            names=["row", "start", "end"])

    def run(batches):
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            anchors = batch.column("anchor").to_numpy()
            whole = int(np.searchsorted(anchors, anchors[-1])) if len(anchors) else 0
            if whole:
                yield solve(pa.Table.from_batches([*waiting, batch.slice(0, whole)]).combine_chunks().to_batches()[0])
                waiting = []
            waiting.append(batch.slice(whole))
        if sum(map(len, waiting)):
            yield solve(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])

    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "row long, start int, end int")


def _exploded(rows: DataFrame, width: int, lengths: list[int]) -> DataFrame:
    """The same for families too large for a task: each window is a row, each level a sum by hash and a join."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                which, inside, levels = _window_hashes(part, width, lengths)
                take = pa.array(which)
                start = part.column("start").to_numpy()[which] + inside
                yield pa.RecordBatch.from_arrays(
                    [part.column("row").take(take), part.column("key").take(take), pa.array(start.astype(np.int32)), *[pa.array(h.view(np.int64)) for h in levels]],
                    names=["row", "key", "start", *[f"h{n}" for n in lengths]])

    candidates = rows.mapInArrow(run, "row long, key long, start int, " + ", ".join(f"h{n} long" for n in lengths))
    for length in lengths:
        name = f"h{length}"
        ranges = candidates.groupBy(F.col(name).alias("h")).agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most")
        survivors = candidates.join(ranges, F.col(name) == F.col("h"))
        candidates = survivors.drop("h", "least", "most") if length < width else survivors
    return candidates.where("key > least").select("row", "start", (F.col("start") + width).alias("end"))


def repeated_spans(rows: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, family: int = FAMILY) -> DataFrame:
    """Word spans (row, start, end) that cover exactly the repeated windows of ``rows`` (row, key, text)."""
    wanted = staged(fragments.summed(rows, _words, width, anchor).where("least < most OR kinds > 1"), "substring-fragments")
    lengths = levels(width, anchor)
    places = staged(fragments.occurrences(rows, _words, width, anchor, wanted).select(
        "row", "start", "length", (F.col("key") > F.col("least")).alias("copy"), "anchor", "kinds"), "substring-places")
    whole = places.where("copy").select("row", "start", (F.col("start") + F.col("length")).alias("end"))
    opened = places.where("NOT copy AND kinds > 1").select("row", "start", "length", "anchor", "kinds")
    parts = staged(_fragments_of(fragments.with_texts(rows, opened, "inner")), "substring-families")
    small = _families(parts.where(F.col("kinds") <= family), width, lengths)
    large = _exploded(parts.where(F.col("kinds") > family), width, lengths)
    return staged(whole.unionByName(small).unionByName(large), "substring-spans")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, anchor: int = ANCHOR,
                    family: int = FAMILY, stored: bool = False) -> DataFrame:
    """(key, n_words, n_removed, kept): the words left of every document, joined by one blank.

    ``stored`` says that ``docs`` are rows of a Parquet table, whose places name them; other frames are written once.
    """
    named = fragments.numbered(docs, text, key, stored)
    rows = named.withColumn("key", F.coalesce("key", F.lit(_LAST)))
    spans = repeated_spans(rows, width, anchor, family)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                kept, n_words, n_removed = [], [], []
                for text, parts in zip(piece.column("text").to_pylist(), piece.column("parts")):
                    words = (text or "").encode().split()
                    gone = np.zeros(len(words), bool)
                    if parts.is_valid:
                        inner = parts.values
                        gone = fragments.union_of(np.stack([inner.field("start").to_numpy(), inner.field("end").to_numpy()], axis=1), len(words))
                    kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode())
                    n_words.append(len(words))
                    n_removed.append(int(gone.sum()))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                    names=["key", "n_words", "n_removed", "kept"])

    return fragments.with_texts(named, spans, "left").mapInArrow(run, "key long, n_words long, n_removed long, kept string")
