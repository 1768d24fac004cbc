"""The prefix tree of conversations: which turns they share from the start, and what sharing them saves.

A conversation becomes a path: 16 bytes of digest per turn, role and text together. Paths are sorted over range
partitions, so that the conversations below a node lie side by side, and every task walks its partition in pieces. A piece
is one tree in balanced parentheses (``parentheses.py``): the closing one delimits a subtree, ranks of pairs count its
leaves, and differences of running sums its members and savings. Only nodes on the first or last path of a piece can go on
in another one. They are carried along as two spines, holding for each node what its finished children add up to, and are
merged: within a task piece by piece, between tasks a fixed number of partitions at a time, until one tree is left.

No task holds more than a piece, two spines and one Arrow batch. Members that end at one node are digested in order of
their ids, which takes them through one task, but never into its memory.

Defined results: rows without a conversation id belong to none and are left out. A null role or text is empty. Turns are
taken in order of ``turn``, null first; turns of the same number in order of their digests; repeated rows are turns of their
own. Texts of any length count whole. The digests of one conversation (16 bytes a turn, not its texts) are one record. An
empty table gives no nodes. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.parentheses import Parentheses, least_in
from tidemark.llm.staging import staged

UNIT = 16  # bytes of a turn in a path
PIECE = 1 << 18  # turns, about, that a task holds at a time
FAN_IN = 64  # partitions whose spines are merged at a time
NOBODY = np.iinfo(np.int64).max
NO_ENDS = hashlib.sha256(b"").hexdigest()

_SUMS = ("n", "kids", "leaves", "saved")
_SPINE = pa.schema([
    ("side", pa.int64()), ("path", pa.binary()), ("chars", pa.list_(pa.int64())),
    *((name, pa.list_(pa.int64())) for name in (*_SUMS, "low")), ("ends", pa.list_(pa.string()))])
_NODE = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("node", pa.binary()), ("parent", pa.binary())])
_FOUND = "part long, spine struct<side: long, path: binary, chars: array<long>, n: array<long>, kids: array<long>, " \
    "leaves: array<long>, saved: array<long>, low: array<long>, ends: array<string>>, node struct<conv_id: long, " \
    "depth: long, parent_conv_id: long, n_convs: long, n_children: long, n_leaves: long, saved_tokens: long, " \
    "ends_sha256: string, node: binary, parent: binary>"


@dataclass
class Spine:
    """A path with what is attached to each of its nodes, the root first: members that end there or below finished
    children, how many such children, and their leaves, savings, smallest member. ``ends`` digests those that end there.

    A path fresh from the table has one attachment, at its end."""

    path: bytes
    chars: np.ndarray
    sums: dict[str, np.ndarray] | None
    low: np.ndarray | int
    ends: list | str
    n: int = 0

    def __len__(self) -> int:
        return len(self.chars)


def shared_turns(a: bytes, b: bytes) -> int:
    some = min(len(a), len(b))
    if a[:some] == b[:some]:
        return some // UNIT
    return int(np.argmax(np.frombuffer(a[:some], np.uint8) != np.frombuffer(b[:some], np.uint8))) // UNIT


def prefix_names(path: bytes) -> list[bytes]:
    """A name for each node of a path, the root first."""
    running, names = hashlib.sha256(), []
    for start in range(0, len(path) + 1, UNIT):
        names.append(running.copy().digest()[:UNIT])
        running.update(path[start : start + UNIT])
    return names


class Piece:
    """The tree of some paths in order."""

    def __init__(self, spines: list[Spine]):
        self.spines = spines
        lengths = np.array([len(s) for s in spines])
        shared = np.array([0, *(shared_turns(a.path, b.path) for a, b in zip(spines, spines[1:]))])
        self.tree = Parentheses(shared, lengths)
        count = len(self.tree.opens)
        self.parent, self.depth = np.arange(-1, count - 1), self.tree.excess[self.tree.opens] - 1
        self.chars = np.zeros(count, dtype=np.int64)
        self.own = {name: np.zeros(count, dtype=np.int64) for name in _SUMS}
        self.own_low = np.full(count, NOBODY)
        self.ends: dict[int, str] = {}
        self.names: dict[int, bytes] = {}
        current, free = np.zeros(lengths.max(initial=0) + 1, dtype=np.int64), 1
        for place, spine in enumerate(spines):
            kept, length = shared[place], lengths[place]
            if length > kept:
                self.parent[free] = current[kept]
                current[kept + 1 : length + 1] = np.arange(free, free + length - kept)
                self.chars[free : free + length - kept] = spine.chars[kept:]
                free += length - kept
            if place == 0:
                self.first = current[: length + 1].copy()
            self._attach(spine, current[: length + 1])
        self.last = current[: lengths[-1] + 1]

    def _attach(self, spine: Spine, nodes: np.ndarray) -> None:
        if spine.sums is None:
            self.own["n"][nodes[-1]] += spine.n
            self.own_low[nodes[-1]] = min(self.own_low[nodes[-1]], spine.low)
            self.ends[int(nodes[-1])] = spine.ends
            return
        for name, values in spine.sums.items():
            self.own[name][nodes] += values
        self.own_low[nodes] = np.minimum(self.own_low[nodes], spine.low)
        self.ends.update((int(node), ends) for node, ends in zip(nodes, spine.ends) if ends is not None)
        self.names.update(zip(nodes.tolist(), prefix_names(spine.path)))

    def settle(self) -> None:
        """Members, smallest member, children, leaves and savings of every node, of its whole subtree."""
        tree, opens = self.tree, self.tree.opens
        closes, rank = tree.find_close(opens), tree.rank_open()
        first, after = rank[opens], rank[closes]

        def below(values: np.ndarray) -> np.ndarray:
            running = np.concatenate([[0], np.cumsum(values)])
            return running[after] - running[first]

        self.n = below(self.own["n"])
        self.low = least_in(self.own_low, first, after)
        self.kids = np.bincount(self.parent[1:], minlength=len(opens)) + self.own["kids"]
        pairs = tree.leaf_pairs()
        pairs[opens] &= self.own["kids"] == 0
        pairs_before = np.concatenate([[0], np.cumsum(pairs)])
        self.leaves = pairs_before[closes] - pairs_before[opens] + below(self.own["leaves"])
        self.saved = below(self.own["saved"] + (self.n - 1) * self.chars)

    def folded(self, last: bool) -> tuple[pa.RecordBatch | None, list[Spine]]:
        """The finished nodes, and the spines that go on; the last piece of all finishes every node."""
        self.settle()
        going_on = np.zeros(len(self.parent), dtype=bool)
        if not last:
            going_on[self.first] = going_on[self.last] = True
        done = np.flatnonzero(~going_on)
        hanging = done[(done > 0) & going_on[np.maximum(self.parent[done], 0)]]
        above = self.parent[hanging]
        for name, values in (("n", self.n), ("leaves", self.leaves), ("saved", self.saved), ("kids", np.ones_like(self.n))):
            np.add.at(self.own[name], above, values[hanging])
        np.minimum.at(self.own_low, above, self.low[hanging])
        spines = [] if last else self._spines()
        return (self._nodes(done, going_on) if len(done) else None), spines

    def _spines(self) -> list[Spine]:
        out, given = [], 0
        for spine, nodes in ((self.spines[0], self.first), (self.spines[-1], self.last))[: 1 + (len(self.spines) > 1)]:
            fresh = np.arange(len(nodes)) >= given  # what both paths share is carried by the first
            out.append(Spine(
                spine.path, np.asarray(spine.chars), {name: np.where(fresh, self.own[name][nodes], 0) for name in _SUMS},
                np.where(fresh, self.own_low[nodes], NOBODY),
                [self.ends.get(int(node)) if new else None for node, new in zip(nodes, fresh)]))
            given = 1 + shared_turns(self.spines[0].path, self.spines[-1].path)
        return out

    def _nodes(self, done: np.ndarray, going_on: np.ndarray) -> pa.RecordBatch:
        parent = self.parent[done]
        known = (parent >= 0) & ~going_on[np.maximum(parent, 0)]
        hangs = (parent >= 0) & ~known
        if hangs.any():
            for spine, nodes in ((self.spines[0], self.first), (self.spines[-1], self.last)):
                self.names.update(zip(nodes.tolist(), prefix_names(spine.path)))
        names = [self.names.get(int(node)) for node in done]
        parents = [self.names[int(node)] if of_spine else None for node, of_spine in zip(parent, hangs)]
        columns = [
            pa.array(self.low[done]), pa.array(self.depth[done], pa.int64()), pa.array(self.low[np.maximum(parent, 0)], pa.int64(), mask=~known),
            pa.array(self.n[done]), pa.array(self.kids[done], pa.int64()), pa.array(self.leaves[done], pa.int64()), pa.array(self.saved[done]),
            pa.array([self.ends.get(int(node), NO_ENDS) for node in done], pa.string()),
            pa.array(names, pa.binary()), pa.array(parents, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, schema=_NODE)


def _found(part: int, nodes: pa.RecordBatch | None, spines: list[Spine]) -> Iterator[pa.RecordBatch]:
    if nodes is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(nodes), pa.int64()), pa.nulls(len(nodes), pa.struct(list(_SPINE))), nodes.to_struct_array()],
            ["part", "spine", "node"])
    if spines:
        rows = [{"side": side, "path": s.path, "chars": s.chars.tolist(), "low": s.low.tolist(), "ends": s.ends,
                 **{name: s.sums[name].tolist() for name in _SUMS}} for side, s in enumerate(spines)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(rows), pa.int64()), pa.array(rows, pa.struct(list(_SPINE))), pa.nulls(len(rows), pa.struct(list(_NODE)))],
            ["part", "spine", "node"])


class _Ends:
    """Members that end at one node, taken in order, in a digest that is never longer than itself."""

    def __init__(self, path: bytes, chars: np.ndarray):
        self.path, self.chars, self.n, self.low, self.digest = path, chars, 0, NOBODY, hashlib.sha256()

    def add(self, ids: list[int]) -> None:
        self.digest.update((("," if self.n else "") + ",".join(map(str, ids))).encode())
        self.n, self.low = self.n + len(ids), min(self.low, ids[0])

    def spine(self) -> Spine:
        return Spine(self.path, self.chars, None, self.low, self.digest.hexdigest(), self.n)


def _distinct_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[Spine]:
    now = None
    for batch in batches:
        ids, chars = batch.column("conv_id").to_pylist(), batch.column("chars")
        for path, some in groupby(enumerate(batch.column("path").to_pylist()), key=lambda pair: pair[1]):
            places = [place for place, _ in some]
            if now is None or now.path != path:
                if now is not None:
                    yield now.spine()
                now = _Ends(path, np.asarray(chars[places[0]].values, dtype=np.int64))
            now.add([ids[place] for place in places])
    if now is not None:
        yield now.spine()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted partition, piece by piece."""
    part = 0

    def noted():
        nonlocal part
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
                yield batch

    carried: list[Spine] = []
    piece: list[Spine] = []
    size = 0
    for spine in _distinct_paths(noted()):
        piece.append(spine)
        size += 1 + len(spine)
        if size >= PIECE:
            nodes, carried = Piece(carried + piece).folded(False)
            piece, size = [], 0
            yield from _found(part, nodes, [])
    if piece:
        nodes, carried = Piece(carried + piece).folded(False)
        yield from _found(part, nodes, [])
    yield from _found(part, None, carried)


def _spine_of(row: dict) -> Spine:
    whole = {name: np.array(row[name], dtype=np.int64) for name in (*_SUMS, "low", "chars")}
    return Spine(bytes(row["path"]), whole.pop("chars"), {name: whole[name] for name in _SUMS}, whole["low"], list(row["ends"]))


def _merge(spines: DataFrame, fan_in: int, last: bool) -> DataFrame:
    """Spines of neighbouring partitions into one piece each, one group at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for group, some in groupby(rows, key=lambda row: row["group"]):
            yield from _found(group, *Piece([_spine_of(row["spine"]) for row in some]).folded(last))

    numbered = spines.select(F.floor(F.col("part") / fan_in).cast("long").alias("group"), "part", "spine")
    return numbered.repartition("group").sortWithinPartitions("group", "part", "spine.side").mapInArrow(run, _FOUND)


def nodes_of(paths: DataFrame, partitions: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """Nodes of the tree of ``conv_id, path, chars``: their measures, one row per node."""
    partitions = partitions or int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = paths.repartitionByRange(partitions, "path").sortWithinPartitions("path", "conv_id")
    rounds = [staged(ranged.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(_walk, _FOUND), "trie")]
    while True:
        spines = rounds[-1].where("spine IS NOT NULL").select("part", "spine")
        highest = spines.agg(F.max("part")).first()[0]
        if highest is None:
            break
        last = highest < fan_in
        rounds.append(staged(_merge(spines, fan_in, last), "spines"))
    nodes = rounds[0]
    for other in rounds[1:]:
        nodes = nodes.unionByName(other)
    nodes = nodes.where("node IS NOT NULL").select("node.*")
    named = nodes.where("node IS NOT NULL").select(F.col("node").alias("parent"), F.col("conv_id").alias("named"))
    settled, hanging = nodes.where("parent IS NULL"), nodes.where("parent IS NOT NULL")
    hanging = hanging.join(named.hint("merge"), "parent").withColumn("parent_conv_id", F.col("named")).drop("named")
    return settled.unionByName(hanging).drop("node", "parent")


def turns_of(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, path, chars``: the digests of a conversation's turns one after the other, and their code points."""
    said, by = F.coalesce(rows[text], F.lit("")), F.coalesce(rows[role], F.lit(""))
    unit = F.substring(F.sha2(F.concat(F.length(by).cast("string"), F.lit(":"), by, said), 256), 1, 2 * UNIT)
    turns = rows.where(rows[conv].isNotNull()).select(
        rows[conv].cast("long").alias("conv_id"),
        F.struct(rows[turn].isNotNull().alias("placed"), F.coalesce(rows[turn].cast("long"), F.lit(0)).alias("turn"),
                 unit.alias("unit"), F.length(said).cast("long").alias("chars")).alias("t"))
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return ordered.select(
        "conv_id", F.unhex(F.array_join(F.transform("t", lambda t: t["unit"]), "")).alias("path"),
        F.transform("t", lambda t: t["chars"]).alias("chars"))


def with_borrowed_heads(paths: DataFrame, lender: Column, many: Column, most: int) -> DataFrame:
    """Paths whose first ``many`` turns (at most ``most``) are those of another conversation, the lender; its turns that
    are there, or none."""
    sized = paths.select("*", lender.alias("lender"), many.cast("int").alias("many"))
    heads = paths.select(
        F.col("conv_id").alias("lender"), F.substring("path", 1, UNIT * most).alias("head"), F.slice("chars", 1, most).alias("head_chars"))
    both = sized.join(heads, "lender", "left")
    no_bytes, none = F.lit(b""), F.array().cast("array<bigint>")
    cut = F.col("many") * UNIT
    path = F.concat(F.substr(F.coalesce("head", no_bytes), F.lit(1), cut), F.substr("path", cut + 1))
    chars = F.concat(
        F.slice(F.coalesce("head_chars", none), F.lit(1), F.col("many")),
        F.slice("chars", F.col("many") + 1, F.greatest(F.size("chars") - F.col("many"), F.lit(0))))
    return both.select("conv_id", path.alias("path"), chars.alias("chars"))
