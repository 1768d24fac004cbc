"""Repeated windows by fragments: the part of the work that byte and word windows share.

Among the ``width - anchor + 1`` anchors (short ranges of symbols) inside a window, the one with the least hash, the
leftmost of equals, is the window's anchor. It depends on the window's content alone, so equal windows have equal
anchors at equal places. A fragment is the range that consecutive windows with one anchor span. Windows can only be
equal if their anchors are, and all windows of a fragment are repeated if the fragment is. That leaves for closer
comparison the distinct fragments of anchors that have at least two of them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.staging import staged
from tidemark.llm.tokens import RangeHashes, pieces

#: The lowest bits of an anchor's sort key hold its place, so that the leftmost of equals is least.
_PLACE = np.uint64((1 << 24) - 1)
#: Bits of a row's number that hold its place in its file: 69 billion rows a file, 134 million files.
_IN_FILE = 36
#: Symbols that are hashed together, and bytes of whole texts that are handled together: some twenty arrays of 8 bytes a symbol
#: are held meanwhile, so this sets a task's memory.
PART, PIECE_BYTES = 1 << 20, 1_000_000
#: Bytes of fragments (24 each) that are summed before the shuffle.
SUMMED_BYTES = 4_000_000


def _running_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values: from minima running forwards and backwards inside blocks."""
    many = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.uint64(2**64 - 1), np.uint64)
    padded[:len(values)] = values
    tiles = padded.reshape(-1, width)
    forward = np.minimum.accumulate(tiles, axis=1).ravel()
    backward = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:many], forward[width - 1:width - 1 + many])


def fragments_of(symbols: np.ndarray, bounds: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, fragment hash, text, start, length) of each fragment of texts that lie end to end in ``symbols``.

    ``bounds`` says where each text begins (one more entry for the end); starts are counted from the text's own.
    Long stretches are handled in overlapping parts of PART symbols, which sets memory and cuts no window.
    """
    found = []
    part = max(PART - width, width)
    for at in range(0, max(0, len(symbols) - width + 1), part):
        stop = min(len(symbols), at + part + width - 1)
        hashes = RangeHashes(symbols[at:stop])
        places = np.arange(stop - at - anchor + 1)
        keys = hashes.of(places, places + anchor)
        order = (keys & ~_PLACE) | places.astype(np.uint64)
        least = _running_least(order, width - anchor + 1)
        chosen = (least & _PLACE).astype(np.int64)
        windows = np.arange(len(chosen))
        text = np.searchsorted(bounds, windows + at, side="right") - 1
        whole = windows + (at + width) <= bounds[text + 1]
        windows, chosen, text = windows[whole], chosen[whole], text[whole]
        if not len(windows):
            continue
        new = np.ones(len(windows), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1]) | (windows[1:] != windows[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(windows)]]) - 1
        starts, ends = windows[first], windows[last] + width
        found.append((keys[chosen[first]], hashes.of(starts, ends), text[first], starts + at - bounds[text[first]], ends - starts))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found))


def numbered(docs: DataFrame, text: str, key: str, stored: bool = False) -> DataFrame:
    """(row, key, text), with one number per row that is the same in every job, however a job's scan is split.

    A row of a ``stored`` table, that is a Parquet table or columns and rows picked from one, is named by its file and
    its place in the file. The files are numbered once, in the order of their paths;
    there is one row per file, of which Spark's driver holds a list already, so this table is broadcast. Any other frame
    is written with its numbers first.
    """
    columns = [docs[key].cast("long").alias("key"), docs[text].alias("text")]
    if not stored:
        return staged(docs.select(F.monotonically_increasing_id().alias("row"), *columns), "numbered")
    where = docs.metadataColumn("_metadata")
    path, place = where.getField("file_path"), where.getField("row_index")
    one_each = docs.select(path.alias("path")).distinct().repartition(1).sortWithinPartitions("path")
    files = staged(one_each.select("path", F.monotonically_increasing_id().alias("file")), "files")
    placed = docs.select(path.alias("in_file"), place.alias("place"), *columns)
    row = F.shiftleft("file", _IN_FILE).bitwiseOR(F.col("place"))
    return placed.join(F.broadcast(files), F.col("in_file") == F.col("path")).select(row.alias("row"), "key", "text")


def _columns(piece: pa.RecordBatch, symbols_of: Callable, width: int, anchor: int):
    symbols, bounds = symbols_of(piece.column("text"))
    anchors, prints, text, starts, lengths = fragments_of(symbols, bounds, width, anchor)
    at = pa.array(text)
    return (anchors.view(np.int64), prints.view(np.int64), piece.column("row").take(at), piece.column("key").take(at),
            starts.astype(np.int32), lengths.astype(np.int32))


def summed(rows: DataFrame, symbols_of: Callable, width: int, anchor: int) -> DataFrame:
    """Per distinct fragment: anchor, fragment, least (of keys), most, n (occurrences), kinds (fragments of the anchor).

    Only fragments are returned that occur twice or share their anchor. Batches are summed before the shuffle, so
    a fragment that is everywhere arrives as one row per SUMMED_BYTES of fragments.
    """
    def together(found):
        return pa.concat_tables(found).group_by(["anchor", "fragment"]).aggregate(
            [("key", "min"), ("key", "max"), ("key", "count")]).select([0, 1, 2, 3, 4]).rename_columns(
            ["anchor", "fragment", "least", "most", "n"]).to_batches()

    def run(batches):
        for batch in batches:
            found = []
            for piece in pieces(batch, "text", PIECE_BYTES):
                anchors, prints, _, keys, _, _ = _columns(piece, symbols_of, width, anchor)
                found.append(pa.table({"anchor": anchors, "fragment": prints, "key": keys}))
                if sum(some.nbytes for some in found) >= SUMMED_BYTES:
                    yield from together(found)
                    found = []
            if found:
                yield from together(found)

    parts = rows.mapInArrow(run, "anchor long, fragment long, least long, most long, n long").repartition("anchor")
    whole = parts.groupBy("anchor", "fragment").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n"))
    kinds = F.count("*").over(Window.partitionBy("anchor"))
    return whole.withColumn("kinds", kinds).where("n > 1 OR kinds > 1")


def occurrences(rows: DataFrame, symbols_of: Callable, width: int, anchor: int, wanted: DataFrame) -> DataFrame:
    """Every place of the ``wanted`` fragments: (row, key, start, length) and the columns of ``wanted``."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text", PIECE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) if isinstance(x, np.ndarray) else x for x in _columns(piece, symbols_of, width, anchor)],
                    names=["f_anchor", "f_fragment", "row", "key", "start", "length"])

    every = rows.mapInArrow(run, "f_anchor long, f_fragment long, row long, key long, start int, length int")
    same = (F.col("f_anchor") == F.col("anchor")) & (F.col("f_fragment") == F.col("fragment"))
    return every.join(wanted, same).drop("f_anchor", "f_fragment")


def with_texts(rows: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """(row, key, text, parts): whole texts with the list of their ``places`` (row and further columns)."""
    columns = [c for c in places.columns if c != "row"]
    grouped = places.groupBy(F.col("row").alias("place_row")).agg(F.collect_list(F.struct(*columns)).alias("parts"))
    return rows.join(grouped, F.col("row") == F.col("place_row"), how).select("row", "key", "text", "parts")


def union_of(spans: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in any [start, end) of ``spans``."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, spans[:, 0], 1)
    np.add.at(change, spans[:, 1], -1)
    return np.cumsum(change[:-1]) > 0

