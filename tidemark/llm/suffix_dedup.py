"""Repeated byte strings by merged Burrows-Wheeler transforms.

Every byte covered by a string of ``width`` bytes that also starts elsewhere (in any document, the same one included)
is removed; overlapping repeats count, and all strings are judged on the input. A transform of a whole corpus would
have to be refined over all its bytes in each of ``width`` rounds, so the corpus is first cut to the stretches that
can matter (see ``fragments``): a fragment that occurs twice is repeated as a whole, and of the rest only the distinct
fragments of one anchor can share a string. They come together in one task, family by family, in groups of bounded
size; parts of them that hashes show to be unique are cut away, equal parts are kept once, the rest is split into two
shards, each shard is transformed, and the transforms are merged by interleave refinement, which gives the common prefixes and with them the repeated intervals. A family with more fragments than
``family`` would make a task grow with the data; its strings are counted by hash instead.

Texts are taken as UTF-8; null counts as empty. Matches never cross documents, rows that repeat are removed whole, and
texts shorter than ``width`` stay. What is left of a character that is cut is kept as bytes. Texts of any length count
whole. An empty table gives no rows. Two columns are read, whatever the others are named.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import fragments
from tidemark.llm.bwt import repeated_places
from tidemark.llm.staging import staged
from tidemark.llm.tokens import RangeHashes, flat, mixed, pieces

WIDTH = 200
ANCHOR = 40
#: Bytes of fragments that are transformed together.
GROUP_BYTES = 1_000_000
#: Fragments of one anchor that may come together in one task; with fewer than 2 * width - anchor bytes each they take 1.5 MB.
FAMILY = 4096
#: Neighbouring strings that are looked at together before the transforms.
STEP = 8


def _cut(texts: DataFrame) -> DataFrame:
    """The bytes of the listed parts: (anchor, fragment, kinds, bytes)."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, bounds = flat(piece.column("text"))
                parts = piece.column("parts")
                inner = parts.flatten()
                begin = np.repeat(bounds[:-1], np.diff(parts.offsets.to_numpy())) + inner.field("start").to_numpy()
                end, whole = begin + inner.field("length").to_numpy(), data.tobytes()
                cut = pa.array([whole[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [inner.field("anchor"), inner.field("fragment"), inner.field("kinds"), cut], names=["anchor", "fragment", "kinds", "bytes"])

    return texts.mapInArrow(run, "anchor long, fragment long, kinds long, bytes binary")


def shared_parts(strings: list[bytes], anchors: np.ndarray, width: int, anchor: int) -> list[tuple[int, int, int]]:
    """(string, start, end) of the parts that can share a string of ``width`` bytes with another of the same anchor.

    Strings that are equal stand equally far from their anchors. Of STEP neighbouring ones at the same distance the
    bytes common to all must occur twice, or none of them does.
    """
    lengths = np.array([len(s) for s in strings])
    begin = np.cumsum(lengths) - lengths
    hashes = RangeHashes(np.frombuffer(b"".join(strings), np.uint8))
    owner = np.repeat(np.arange(len(strings)), lengths - anchor + 1)
    places = np.arange(len(owner)) - np.repeat(np.cumsum(lengths - anchor + 1) - (lengths - anchor + 1), lengths - anchor + 1)
    hit = np.flatnonzero(hashes.of(begin[owner] + places, begin[owner] + places + anchor) == anchors[owner])
    at = places[hit[np.searchsorted(owner[hit], np.arange(len(strings)))]]
    reach, last = width - anchor, lengths - width
    low, high = (reach - at) // STEP, (last - at + reach) // STEP
    many = high - low + 1
    which = np.repeat(np.arange(len(strings)), many)
    block = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
    first = at[which] + block * STEP - reach
    cores = hashes.of(begin[which] + first + STEP - 1, begin[which] + first + width)
    keys = mixed(cores ^ mixed(anchors[which] + block.astype(np.uint64)))
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    kept = np.flatnonzero(counts[inverse] > 1)
    cut = np.flatnonzero((np.diff(which[kept]) != 0) | (np.diff(block[kept]) != 1)) + 1
    heads, tails = kept[np.concatenate([[0], cut]).astype(int)] if len(kept) else kept, kept[np.concatenate([cut, [len(kept)]]).astype(int) - 1] if len(kept) else kept
    starts, ends = np.maximum(first[heads], 0), np.minimum(first[tails] + STEP - 1, last[which[tails]]) + width
    return list(zip(which[heads].tolist(), starts.tolist(), ends.tolist()))


def repeated_parts(strings: list[bytes], anchors: np.ndarray, width: int, anchor: int) -> list[tuple[int, int, int]]:
    """(string, start, end) of what strings of ``width`` bytes cover that start twice or more among all strings.

    Equal parts are transformed once; being there twice, they are repeated from end to end.
    """
    parts = shared_parts(strings, anchors, width, anchor)
    distinct: dict[bytes, list[tuple[int, int]]] = {}
    for string, start, end in parts:
        distinct.setdefault(strings[string][start:end], []).append((string, start))
    texts = list(distinct)
    if len(texts) > 1:
        lengths = np.array([len(t) + 1 for t in texts])
        places = repeated_places(texts, width)
        begin = np.cumsum(lengths) - lengths
        own = np.searchsorted(begin, places, side="right") - 1
        edge = np.flatnonzero((np.diff(own) != 0) | (np.diff(places) > width)) + 1
        first, last = np.concatenate([[0], edge]).astype(int), np.concatenate([edge, [len(places)]]).astype(int) - 1
        if not len(places):
            first = last = np.zeros(0, int)
        spans = zip(own[first].tolist(), (places[first] - begin[own[first]]).tolist(), (places[last] - begin[own[first]] + width).tolist())
    else:
        spans = iter(())
    found = [(string, start + a, start + b) for t, a, b in spans for string, start in distinct[texts[t]] if len(distinct[texts[t]]) == 1]
    return found + [(string, start, start + len(t)) for t, owners in distinct.items() if len(owners) > 1 for string, start in owners]


def _merged_groups(families: DataFrame, width: int, anchor: int, group_bytes: int) -> DataFrame:
    """(anchor, fragment, start, end) of what is repeated in each fragment. Rows come sorted by anchor."""
    def solve(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        spans = []
        if len(rows) > 1:
            spans = repeated_parts([r[2] for r in rows], np.array([r[0] for r in rows], np.int64).view(np.uint64), width, anchor)
        columns = zip(*[(rows[i][0], rows[i][1], a, b) for i, a, b in spans]) if spans else ([], [], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
            names=["anchor", "fragment", "start", "end"])

    def run(batches):
        waiting, size = [], 0
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "fragment", "bytes")]):
                if size >= group_bytes and row[0] != waiting[-1][0]:
                    yield solve(waiting)
                    waiting, size = [], 0
                waiting.append(row)
                size += len(row[2])
        yield solve(waiting)

    sorted_rows = families.repartition("anchor").sortWithinPartitions("anchor", "fragment")
    return sorted_rows.mapInArrow(run, "anchor long, fragment long, start int, end int")


def _counted(families: DataFrame, width: int) -> DataFrame:
    """The same for families that are too large for a task: every string of every fragment is counted by its hash."""
    def run(batches):
        for batch in batches:
            bounds = batch.column("bytes").cast(pa.large_binary())
            for i, value in enumerate(bounds.to_pylist()):
                hashes = RangeHashes(np.frombuffer(value, np.uint8))
                places = np.arange(len(value) - width + 1)
                many = len(places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(many, batch.column("anchor")[i].as_py())), pa.array(np.full(many, batch.column("fragment")[i].as_py())),
                     pa.array(places.astype(np.int32)), pa.array(hashes.of(places, places + width).view(np.int64))],
                    names=["anchor", "fragment", "start", "h"])

    windows = families.mapInArrow(run, "anchor long, fragment long, start int, h long")
    twice = windows.groupBy(F.col("anchor").alias("a"), F.col("h").alias("g")).agg(F.count("*").alias("n")).where("n > 1")
    hit = windows.join(twice, (F.col("anchor") == F.col("a")) & (F.col("h") == F.col("g")))
    runs = F.col("start") - F.row_number().over(Window.partitionBy("anchor", "fragment").orderBy("start"))
    return hit.withColumn("run", runs).groupBy("anchor", "fragment", "run").agg(
        F.min("start").alias("start"), (F.max("start") + width).cast("int").alias("end")).drop("run")


def repeated_spans(rows: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, group_bytes: int = GROUP_BYTES, family: int = FAMILY) -> DataFrame:
    """Byte spans (row, start, end) that cover exactly the repeated strings of ``rows`` (row, key, text); key is the row."""
    wanted = staged(fragments.summed(rows, flat, width, anchor), "suffix-fragments")
    places = staged(fragments.occurrences(rows, flat, width, anchor, wanted).drop("most"), "suffix-places")
    whole = places.where("n > 1").select("row", "start", (F.col("start") + F.col("length")).alias("end"))
    one_of_each = places.where("kinds > 1 AND row = least").groupBy("anchor", "fragment").agg(
        F.first("row").alias("row"), F.min("start").alias("start"), F.first("length").alias("length"), F.first("kinds").alias("kinds"))
    families = staged(_cut(fragments.with_texts(rows, one_of_each, "inner")), "suffix-families")
    small = _merged_groups(families.where(F.col("kinds") <= family), width, anchor, group_bytes)
    large = _counted(families.where(F.col("kinds") > family), width)
    inner = staged(small.unionByName(large), "suffix-repeats").select(
        F.col("anchor").alias("a"), F.col("fragment").alias("f"), F.col("start").alias("from"), F.col("end").alias("to"))
    single = places.where("n = 1 AND kinds > 1").join(inner, (F.col("anchor") == F.col("a")) & (F.col("fragment") == F.col("f")))
    return whole.unionByName(single.select("row", (F.col("start") + F.col("from")).alias("start"), (F.col("start") + F.col("to")).alias("end")))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", stored: bool = False, **options) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept, kept_sha256): the bytes left of every document.

    ``stored`` says that ``docs`` are rows of a Parquet table, whose places name them; other frames are written once.
    """
    rows = fragments.numbered(docs, text, key, stored)
    spans = repeated_spans(rows.withColumn("key", F.col("row")), **options)
    schema = "key long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, bounds = flat(piece.column("text"))
                kept, counts = [], []
                for i, parts in enumerate(piece.column("parts")):
                    own = data[bounds[i]:bounds[i + 1]]
                    gone = np.zeros(len(own), bool)
                    if parts.is_valid:
                        inner = parts.values
                        gone = fragments.union_of(np.stack([inner.field("start").to_numpy(), inner.field("end").to_numpy()], axis=1), len(own))
                    kept.append(own[~gone].tobytes())
                    counts.append((len(own), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum())))
                columns = [pa.array(list(c), pa.int64()) for c in zip(*counts)] if counts else [pa.array([], pa.int64())] * 3
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), *columns, pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                    names=["key", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return fragments.with_texts(rows, spans, "left").mapInArrow(run, schema)
