"""Hard negatives by a vertical scan: scores grow dimension by dimension while bounds on the rest strike rows out.

Rows are dealt to blocks, anchors to blocks of their own, and each pair of blocks is one group of a Spark shuffle. In a
group the rows stand as columns, one per dimension. An anchor reads them in the order of its own components, largest
magnitude first; after every few it adds the least and the most that the remaining dimensions can contribute (from each
column's minimum and maximum) and strikes out rows that can no longer be among its results. What is left at the end has
its exact score, so nothing is approximate.

Two passes: the first finds each anchor's positives among rows of its label, the second the best rows of other labels in
the window that each positive's score opens. Each group hands on at most ``positives`` rows per anchor, then at most
``negatives`` rows per window; a ranking over these few gives the result.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part. An id counts
once: of rows that share one, the one with the least label, then the least vector. Ties go to the smaller id. Vectors of
different lengths are compared over the dimensions they share; empty ones score 0. The window of a negative score is
empty. Scores are exact integers; one beyond 64 bits counts as the nearest 64-bit number. Anchors without a positive, and
positives without a negative, give no rows; an empty table gives none. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.staging import staged

#: Rows, and anchors, in a block at most, about. Small tables are cut finer, so that all tasks have work.
BLOCK = 16_384
FINE = 1024
#: Dimensions read between two looks at the bounds.
STEP = 8
#: Integers below this are exact as doubles, sums included.
EXACT = 2.0**53
LONG = np.iinfo(np.int64)


def usable(rows: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """``id, label, vector`` of the rows that take part, one per id."""
    named = rows.select(rows[key].cast("long").alias("id"), label.cast("long").alias("label"), rows[vector].alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return named.dropna().where(finite).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*")


def columns_of(vectors: pd.Series, dims: int) -> np.ndarray:
    """One row per dimension of floor(256 x); shorter vectors are filled up with zeros."""
    out = np.zeros((dims, len(vectors)))
    for place, vector in enumerate(vectors):
        out[: len(vector), place] = vector
    return np.floor(256.0 * out)


def scan(anchor: np.ndarray, columns: np.ndarray, ends: tuple[np.ndarray, np.ndarray],
         possible: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the rows that ``possible`` (of least and greatest scores) never strikes out.

    ``ends`` holds the minimum and maximum of each column. Rows struck out stay in place until a quarter of the places
    is void, then the places left are drawn together.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    either = np.stack([anchor * ends[0], anchor * ends[1]])[:, order]
    least = np.append(np.cumsum(either.min(0)[::-1])[::-1], 0)
    most = np.append(np.cumsum(either.max(0)[::-1])[::-1], 0)
    places, scores = None, np.zeros(columns.shape[1])
    for start in range(0, max(len(order), 1), STEP):
        some = order[start : start + STEP]
        scores = scores + anchor[some] @ (columns[some] if places is None else columns[np.ix_(some, places)])
        read = start + len(some)
        alive = possible(scores + least[read], scores + most[read])
        if read == len(order) or 4 * np.count_nonzero(alive) < 3 * len(alive):
            places, scores = np.flatnonzero(alive) if places is None else places[alive], scores[alive]
        if not len(scores):
            break
    return places, scores


def at_once(anchor: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Scores too large for doubles, as Python integers."""
    whole = [int(x) for x in anchor]
    scores = [sum(a * int(x) for a, x in zip(whole, row)) for row in columns.T]
    return np.array([min(max(score, LONG.min), LONG.max) for score in scores], dtype=object)


def among_best(k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rows that may be among the k best: as good at most as the k-th best is at least."""

    def possible(least, most):
        return most >= np.partition(least, -k)[-k] if len(least) > k else np.ones(len(least), dtype=bool)

    return possible


def in_windows(windows: list[tuple[int, int]], k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rows that may be among the k best within one of the windows."""

    def possible(least, most):
        alive = np.zeros(len(least), dtype=bool)
        for low, high in windows:
            reach = (most >= low) & (least <= high)
            sure = least[(least >= low) & (most <= high)]
            if len(sure) > k:
                reach &= most >= np.partition(sure, -k)[-k]
            alive |= reach
        return alive

    return possible


def window(score: int) -> tuple[int, int]:
    """The scores from 80 to 100 percent of a positive's, bounds included."""
    return -(-4 * score // 5), score


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best by score, then smaller id."""
    order = np.lexsort((ids, -scores))[:k] if scores.dtype != object else sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
    return [(int(ids[i]), int(scores[i])) for i in order]


class Block:
    """A block of rows as columns, by label, against a block of anchors."""

    def __init__(self, rows: pd.DataFrame, anchors: pd.DataFrame):
        dims = max((len(v) for part in (rows, anchors) for v in part["vector"]), default=0)
        self.ids, self.labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        self.columns = columns_of(rows["vector"], dims)
        self.anchors = columns_of(anchors["vector"], dims).T
        largest = [np.abs(part).max(initial=0) for part in (self.columns, self.anchors)]
        self.exact = max(dims, 1) * max(largest[0], 1) * max(largest[1], 1) < EXACT

    def search(self, numbers: np.ndarray, chosen: np.ndarray, possible_of):
        """Survivors (ids, scores) of some anchors among the chosen rows."""
        ids, columns = self.ids[chosen], self.columns[:, chosen]
        if not len(ids):
            return
        ends = columns.min(1), columns.max(1)
        for number in numbers:
            if self.exact:
                places, scores = scan(self.anchors[number], columns, ends, possible_of(number))
                yield number, ids[places], scores
            else:
                yield number, ids, at_once(self.anchors[number], columns)


def _by_label(anchors: pd.DataFrame):
    labels = anchors["label"].to_numpy()
    return ((label, np.flatnonzero(labels == label)) for label in np.unique(labels))


def positives_in(anchors: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best other rows of each anchor's label within a block."""
    out, block = [], Block(rows, anchors)
    names = anchors["id"].to_numpy()
    for label, numbers in _by_label(anchors):
        # One more than k: the anchor itself may be among them.
        for number, ids, scores in block.search(numbers, block.labels == label, lambda _: among_best(k + 1)):
            others = ids != names[number]
            out += [(names[number], *pair) for pair in best(ids[others], scores[others], k)]
    return _frame(out, ["anchor_id", "positive_id", "positive_score"])


def negatives_in(anchors: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of other labels within a block, for each window of each anchor."""
    out, block = [], Block(rows, anchors)
    names = anchors["id"].to_numpy()
    opened = [[(p["positive_id"], int(p["positive_score"]), window(int(p["positive_score"]))) for p in some] for some in anchors["positives"]]
    for label, numbers in _by_label(anchors):
        found = block.search(numbers, block.labels != label, lambda number: in_windows([w for *_, w in opened[number]], k))
        for number, ids, scores in found:
            for positive, positive_score, (low, high) in opened[number]:
                inside = ((scores >= low) & (scores <= high)).astype(bool)
                out += [(names[number], positive, positive_score, *pair) for pair in best(ids[inside], scores[inside], k)]
    return _frame(out, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names, dtype="int64")


def _blocks(n: int, tasks: int) -> int:
    return max(-(-n // BLOCK), min(tasks, -(-n // FINE)), 1)


def _against(anchors: DataFrame, rows: DataFrame, blocks: int, parts: int, search, schema: str) -> DataFrame:
    """Every block of anchors against every block of rows, a group each."""
    numbered = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = anchors.withColumn("part", numbered(parts)).withColumn("block", every(blocks))
    right = rows.withColumn("block", numbered(blocks)).withColumn("part", every(parts))
    tasks = min(4 * blocks * parts, 20_000)
    left, right = (side.repartition(tasks, "block", "part").groupBy("block", "part") for side in (left, right))

    def run(some: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        return search(some, others) if len(some) and len(others) else _frame([], schema.replace(" long", "").split(", "))

    return left.cogroup(right).applyInPandas(run, schema)


def _first(found: DataFrame, by: list[str], score: str, then: str, k: int) -> DataFrame:
    ranked = Window.partitionBy(*by).orderBy(F.desc(score), then)
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def mined(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
          every: int = 100, positives: int = 5, negatives: int = 5) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for anchors with ids divisible by ``every``."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = staged(usable(rows, key, vector, rows[label] if isinstance(label, str) else label), "vectors")
    anchors = kept.where(F.col("id") % every == 0)
    blocks, parts = _blocks(kept.count(), tasks), -(-max(anchors.count(), 1) // BLOCK)

    found = _against(anchors, kept, blocks, parts, lambda a, r: positives_in(a, r, positives),
                     "anchor_id long, positive_id long, positive_score long")
    chosen = _first(found, ["anchor_id"], "positive_score", "positive_id", positives)
    opened = chosen.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    anchors = staged(anchors.join(opened, "id"), "anchors")

    found = _against(anchors, kept, blocks, parts, lambda a, r: negatives_in(a, r, negatives),
                     "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    ranked = _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
