"""Benchmark decontamination: a broadcast hash set of benchmark n-grams, looked up in every window of every document.

Words are runs of ASCII letters and digits and of anything beyond ASCII, with A-Z lower-cased. A window is ``size``
consecutive words of an item; an item of fewer words is one window. Windows are looked up by a 64-bit hash, and each
hit is verified word for word. Null and empty texts have no words and are never hit. Repeated items with one id count
once, items with equal windows are all reported. Items without an id are one item with a null id, listed last. Texts of any
length are scanned whole. Without documents there are no rows, without items no hits. Documents may have any columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tokens import ALPHANUMERIC, LOWER, flat, mixed, pieces, word_bounds, word_hashes

SIZE = 10
#: Bytes of benchmark text whose windows are broadcast at a time; a larger benchmark is looked up in several passes.
BROADCAST_BYTES = 16_000_000

FOUND = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("key", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
])


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` word hashes."""
    many = len(words) - size + 1
    if many <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(many, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9FB21C651E98DF25) + words[k:k + many]
    return mixed(total)


class Grams:
    """Windows of some items by length: sorted hashes, and for each exact window the items that have it."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.items: dict[bytes, list[str]] = {}
        hashes: dict[int, list[np.ndarray]] = {}
        for name, text in items:
            data = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
            starts, ends, _ = word_bounds(data, np.array([0, len(data)]), ALPHANUMERIC)
            if not len(starts):
                continue
            length, whole = min(size, len(starts)), data.tobytes()
            words = [whole[a:b] for a, b in zip(starts, ends)]
            hashes.setdefault(length, []).append(gram_hashes(word_hashes(data, starts, ends), length))
            for i in range(len(words) - length + 1):
                self.items.setdefault(b" ".join(words[i:i + length]), []).append(name)
        for length, parts in hashes.items():
            values = np.unique(np.concatenate(parts))
            sieve = np.zeros(1 << 20, bool)
            sieve[values >> np.uint64(44)] = True
            self.by_length[length] = values, sieve

    def places(self, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, length) of windows whose hash is in the set."""
        for length, (values, sieve) in self.by_length.items():
            grams = gram_hashes(words, length)
            maybe = np.flatnonzero(sieve[grams >> np.uint64(44)])
            at = np.minimum(np.searchsorted(values, grams[maybe]), len(values) - 1)
            for start in maybe[values[at] == grams[maybe]]:
                yield int(start), length


def scan_texts(texts: pa.Array, grams: Grams) -> list[pa.Array]:
    """n_words, n_hit, items and spans of each text."""
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, ALPHANUMERIC)
    change = np.zeros(len(starts) + 1, np.int32)
    items: dict[int, set[str]] = {}
    whole = None
    for start, length in grams.places(word_hashes(data, starts, ends)):
        doc = int(np.searchsorted(first, start, side="right")) - 1
        if start + length > first[doc + 1]:
            continue
        whole = whole if whole is not None else data.tobytes()
        names = grams.items.get(b" ".join(whole[starts[i]:ends[i]] for i in range(start, start + length)))
        if names:
            change[start] += 1
            change[start + length] -= 1
            items.setdefault(doc, set()).update(names)
    hit = np.cumsum(change[:-1]) > 0
    hits = np.concatenate([[0], np.cumsum(hit)])
    spans = [[] for _ in range(len(texts))]
    for doc in items:
        a, b = first[doc], first[doc + 1]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit[a:b], [False]]).astype(np.int8)))
        spans[doc] = [[int(x), int(y)] for x, y in edge.reshape(-1, 2)]
    return [
        pa.array(np.diff(first), pa.int64()), pa.array(hits[first[1:]] - hits[first[:-1]], pa.int64()),
        pa.array([sorted(items.get(i, ()), key=lambda n: (n is None, n or "")) for i in range(len(texts))], pa.list_(pa.string())),
        pa.array(spans, pa.list_(pa.list_(pa.int64()))),
    ]


def _blocks(bench: DataFrame, item: str, text: str) -> list[DataFrame]:
    """The benchmark in parts that each fit BROADCAST_BYTES by measure, split by a hash of the text."""
    rows = bench.select(bench[item].cast("string").alias("item"), bench[text].alias("text")).where("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = int(total // BROADCAST_BYTES) + 1
    return [rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(many)) == k) for k in range(many)]


def _shared(part: DataFrame, size: int):
    """The hash set of one part of the benchmark, broadcast."""
    items = [(r["item"], r["text"]) for r in part.collect()]
    return part.sparkSession.sparkContext.broadcast(Grams(items, size))


def found(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text", size: int = SIZE) -> DataFrame:
    """One row per document: key, n_words, n_hit, items (ids as sorted strings) and the hit spans in words.

    The hash set is broadcast after measuring the benchmark. One that is larger is cut into parts, each scanned in a
    pass of its own; spans of the passes are joined per document and counted again.
    """
    narrow = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].cast("long").alias("key"), docs[text].alias("text"))

    def scan(part: DataFrame) -> DataFrame:
        shared = _shared(part, size)

        def run(batches):
            for batch in batches:
                for piece in pieces(batch, "text"):
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("row"), piece.column("key"), *scan_texts(piece.column("text"), shared.value)], names=FOUND.names)

        return narrow.mapInArrow(run, FOUND)

    first, *others = map(scan, _blocks(bench, item, item_text))
    if not others:
        return first.drop("row")
    for other in others:
        first = first.unionByName(other)
    merged = first.groupBy("row").agg(
        F.first("key").alias("key"), F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    zero = F.lit(0).cast("long")
    step = lambda a, s: F.struct(
        F.greatest(a.end, s[1]).alias("end"), (a.n + F.greatest(zero, s[1] - F.greatest(a.end, s[0]))).alias("n"))
    covered = F.aggregate("spans", F.struct(zero.alias("end"), zero.alias("n")), step, lambda a: a.n)
    return merged.select("key", "n_words", covered.alias("n_hit"), "items", "spans")


def clean_documents(docs: DataFrame, bench: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                    size: int = SIZE) -> DataFrame:
    """The documents without any hit, with the columns they came with; no row leaves its partition."""
    kept = docs
    for part in _blocks(bench, item, item_text):
        def run(batches, shared=_shared(part, size)):
            for batch in batches:
                for piece in pieces(batch, text):
                    hits = scan_texts(piece.column(text), shared.value)[1]
                    yield piece.filter(pa.compute.equal(hits, 0))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
