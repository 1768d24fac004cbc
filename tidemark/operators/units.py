"""Grouping of keyed events into units, batch form, without ever putting one key into one task.

Where a unit ends depends on where the one before it ended, so a key has to be walked in order.
To walk a key of any size in parallel:

1. range-partition by (key, time, id). A busy key is cut over as many partitions as it needs;
   the layout is checkpointed, because the next two steps must see the same cuts;
2. every partition describes its first and its last key in one row each: how many rows, and for each of
   the ``size`` offsets at which a first new unit could open, which unit would be open at the end;
3. those few rows (two per partition) are composed in a tree of fixed fan-in, upwards and back down, which tells every
   partition what enters it, however many partitions a key is cut over;
4. every partition walks its rows once more and writes its units.

Steps 2 and 4 are ``mapInArrow`` over sorted partitions: memory is one Arrow batch plus one open unit.
"""

from __future__ import annotations

from collections.abc import Iterator

from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.times import from_micros, to_micros
from tidemark.operators.unit_rules import UnitRule, walk
from tidemark.session import checkpoint_root

RESERVED = ("key", "us", "seq", "part", "skip", "head_n", "opened", "tail_n", "tail_us", "unit_no", "n")
_RUN = "rows bigint, last_us bigint, prefix array<bigint>, exit_us array<bigint>, exit_n array<bigint>, exit_opened array<bigint>"
#: Runs of a key that a task composes at a time.
FAN_IN = 64


def _micros(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _key_starts(keys: pa.Array, before: pa.Array | None) -> np.ndarray:
    """Where a key differs from the one in the row above (``before`` is the key above the first row)."""
    above = pa.concat_arrays([keys[:1] if before is None else before, keys[:-1]])
    same = pc.or_(pc.fill_null(pc.equal(keys, above), False), pc.and_(pc.is_null(keys), pc.is_null(above)))
    starts = ~same.to_numpy(zero_copy_only=False)
    if before is None:
        starts[0] = True
    return starts


class _Run:
    """The rows of one key in one partition, followed batch by batch."""

    def __init__(self, key: pa.Array, opens_partition: bool, rule: UnitRule):
        self.key, self.opens_partition, self.rule = key, opens_partition, rule
        self.rows, self.last_us = 0, None
        self.prefix = np.empty(0, dtype=np.int64)
        self.left = np.empty(0, dtype=np.int64)
        self.at = None if opens_partition else np.zeros(1, dtype=np.int64)
        self.opened = np.zeros(rule.size if opens_partition else 1, dtype=np.int64)

    def extend(self, us: np.ndarray, ends_here: bool) -> None:
        self.rows += len(us)
        self.last_us = int(us[-1])
        if self.opens_partition and len(self.prefix) < self.rule.size:
            self.prefix = np.concatenate([self.prefix, us])[: self.rule.size]
        if ends_here:
            return
        self.left = np.concatenate([self.left, us])
        if self.at is None and len(self.left) >= self.rule.size:
            self.at = np.arange(self.rule.size)
        if self.at is not None:
            self._advance()

    def _advance(self) -> None:
        ends = self.rule.ends(self.left)
        moving = ends[self.at] < len(self.left)
        while moving.any():
            self.opened += moving
            self.at = np.where(moving, ends[self.at], self.at)
            moving = ends[self.at] < len(self.left)
        done = self.at.min()
        self.left, self.at = self.left[done:], self.at - done

    def exits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.at is None:  # fewer rows than a unit holds
            self.at = np.arange(len(self.left))
            self.opened = self.opened[: len(self.left)]
            self._advance()
        return self.left[self.at], len(self.left) - self.at, self.opened + 1


def _describe(batches: Iterator[pa.RecordBatch], rule: UnitRule) -> Iterator[pa.RecordBatch]:
    head = run = before = part = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, us = batch.column("key"), _micros(batch.column("us"))
        part = batch.column("part")[0].as_py()
        starts = np.flatnonzero(_key_starts(keys, before))
        before = keys[-1:]
        going_on = starts[0] if len(starts) else len(us)
        if run is not None and going_on:
            run.extend(us[:going_on], ends_here=len(starts) > 0)
        if not len(starts):
            continue
        if run is None:
            first = _Run(keys[:1], True, rule)
            first.extend(us[: starts[1]] if len(starts) > 1 else us, ends_here=len(starts) > 1)
            run = first
            if len(starts) == 1:
                continue
        if run.opens_partition:
            head = run
        last = starts[-1]
        run = _Run(keys[last : last + 1], False, rule)
        run.extend(us[last:], ends_here=False)
    if run is None:
        return
    for each in [run] if head is None else [head, run]:
        none = np.empty(0, dtype=np.int64)
        exit_us, exit_n, opened = (none, none, none) if each is head else each.exits()
        values = [
            [part], [each.rows], [each.last_us],
            [each.prefix.tolist()], [exit_us.tolist()], [exit_n.tolist()], [opened.tolist()],
        ]
        kinds = [pa.int32(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * 4
        yield pa.RecordBatch.from_arrays(
            [each.key, *(pa.array(v, k) for v, k in zip(values, kinds))],
            ["key", "part", "rows", "last_us", "prefix", "exit_us", "exit_n", "exit_opened"],
        )


def _composed(runs: pd.DataFrame, rule: UnitRule) -> dict:
    """Neighbouring runs of a key as one: what ``_describe`` would have said of all their rows together."""
    whole = None
    for run in runs.sort_values("part").itertuples():
        lists = [np.asarray(x, dtype=np.int64) for x in (run.prefix, run.exit_us, run.exit_n, run.exit_opened)]
        next_run = (int(run.rows), int(run.last_us), *lists)
        whole = next_run if whole is None else _followed(whole, next_run, rule)
    rows, last_us, prefix, exit_us, exit_n, opened = whole
    return {"rows": rows, "last_us": last_us, "prefix": prefix, "exit_us": exit_us, "exit_n": exit_n, "exit_opened": opened}


def _followed(first: tuple, then: tuple, rule: UnitRule) -> tuple:
    """Two runs in a row. An exit says which unit is open at the end if the first new one opens at that row."""
    rows, last_us, prefix, exit_us, exit_n, opened = first
    more, end_us, next_prefix, next_us, next_n, next_opened = then
    exits = []
    for us, n, no in zip(exit_us.tolist(), exit_n.tolist(), opened.tolist()):
        taken = rule.continues(next_prefix, n, us, last_us)
        if not len(next_us):  # the key ends there, no run follows
            break
        if taken == more:
            exits.append((us, n + taken, no))
        else:
            exits.append((int(next_us[taken]), int(next_n[taken]), no + int(next_opened[taken])))
    if len(exit_us) == rows < rule.size:  # offsets beyond the first run
        exits += list(zip(next_us.tolist(), next_n.tolist(), next_opened.tolist()))[: rule.size - rows]
    if len(prefix) < rule.size:
        prefix = np.concatenate([prefix, next_prefix])[: rule.size]
    found = [np.array(column, dtype=np.int64) for column in zip(*exits)] or [np.empty(0, dtype=np.int64)] * 3
    return rows + more, end_us, prefix, *found


_STATE = "held bigint, first_us bigint, before_us bigint, opened bigint, skip bigint, head_n bigint, tail_n bigint, tail_us bigint"


def _passed(runs: pd.DataFrame, rule: UnitRule, entering: dict | None = None) -> pd.DataFrame:
    """Neighbouring runs of a key from left to right: what enters each, and how the units end that are open at its ends.

    ``entering`` is the same for the run that they make up together; without it they are the whole key.
    """
    runs = runs.sort_values("part").reset_index(drop=True)
    names = [part.split()[0] for part in _STATE.split(", ")]
    out = {name: [None] * len(runs) for name in names}
    held, first_us, last_us, opened = (0, 0, 0, 0) if entering is None else (entering[n] for n in names[:4])
    waiting: list[tuple[int, str]] = []  # runs that show the open unit, and at which end

    def close(n: int, us: int) -> None:
        for place, side in waiting:
            out[f"{side}_n"][place] = n
            if side == "tail":
                out["tail_us"][place] = us
        waiting.clear()

    for place, run in enumerate(runs.itertuples()):
        out["held"][place], out["first_us"][place], out["before_us"][place], out["opened"][place] = held, first_us, last_us, opened
        prefix = np.asarray(run.prefix, dtype=np.int64)
        skip = rule.continues(prefix, held, first_us, last_us) if held else 0
        out["skip"][place] = skip
        if skip:
            held += skip
            last_us = int(run.last_us) if skip == run.rows else int(prefix[skip - 1])
            waiting.append((place, "head"))
        if skip == run.rows:
            waiting.append((place, "tail"))
            continue
        close(held, last_us)
        held = 0
        if len(run.exit_us):
            first_us, held, last_us = int(run.exit_us[skip]), int(run.exit_n[skip]), int(run.last_us)
            opened += int(run.exit_opened[skip])
            waiting.append((place, "tail"))
    if entering is None or entering["tail_n"] is None:
        close(held, last_us)
    else:
        close(entering["tail_n"], entering["tail_us"])
    found = pd.DataFrame({name: pd.array(values, dtype="Int64") for name, values in out.items()})
    return found.assign(key=runs["key"], part=runs["part"])[["key", "part", *names]]


def _entering(runs: DataFrame, rule: UnitRule, partitions: int, fan_in: int) -> DataFrame:
    """What enters each run of each key, found in a tree: no task sees more than ``fan_in`` runs of a key at a time.

    Upwards, neighbouring runs are composed; downwards, what enters a composed run is passed on through its parts.
    """
    kind = runs.schema["key"].dataType.simpleString()
    described, passed = f"key {kind}, part int, {_RUN}", f"key {kind}, part int, {_STATE}"
    group = F.floor(F.col("part") / fan_in).cast("int")
    levels, width = [runs], partitions
    while width > fan_in:
        if len(levels) == 1:
            levels = [runs.checkpoint()]  # read on the way up and on the way down

        def up(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame([{"key": key[0], "part": key[1], **_composed(some, rule)}])

        levels.append(levels[-1].groupBy("key", group.alias("group")).applyInPandas(up, described))
        width = -(-width // fan_in)
    found = levels.pop().groupBy("key").applyInPandas(lambda some: _passed(some, rule), passed)

    def down(some: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        one = above.iloc[0]
        return _passed(some, rule, {name: None if pd.isna(one[name]) else int(one[name]) for name in above.columns[2:]})

    for lower in reversed(levels):
        found = lower.withColumn("group", group).groupBy("key", "group").cogroup(
            found.withColumnRenamed("part", "group").groupBy("key", "group")
        ).applyInPandas(lambda some, above: down(some.drop(columns="group"), above), passed)
    return found


def _emit(batches: Iterator[pa.RecordBatch], rule: UnitRule, members: bool,
          payload: list[str]) -> Iterator[pa.RecordBatch]:
    left: pa.Table | None = None
    before = None  # key above the first row of the buffer, while a partition is being read
    opened = 0  # units opened so far for that key
    to_skip, head_n = 0, None
    fresh = True

    def rows_of(table: pa.Table, numbers: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        columns = [table.column(name).combine_chunks() for name in ["key", *payload]]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64())],
            ["key", *payload, "unit_no", "n"],
        )

    def units_of(keys: pa.Array, numbers, sizes, first, last) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [keys, *(pa.array(v, pa.int64()) for v in (numbers, sizes, first, last))],
            ["key", "unit_no", "n", "first_us", "last_us"],
        )

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        if fresh:
            fresh = False
            to_skip = table.column("skip")[0].as_py() or 0
            head_n = table.column("head_n")[0].as_py()
            opened = table.column("opened")[0].as_py() or 0
            before = table.column("key").chunk(0)[:1]
        if to_skip:
            absorbed = table.slice(0, to_skip)
            to_skip -= absorbed.num_rows
            if members:
                count = absorbed.num_rows
                yield rows_of(absorbed, np.full(count, opened), np.full(count, head_n))
            table = table.slice(absorbed.num_rows)
            if not table.num_rows:
                continue
        if left is not None:
            table = pa.concat_tables([left, table]).combine_chunks()
        keys = table.column("key").combine_chunks()
        us = _micros(table.column("us").combine_chunks())
        key_starts = _key_starts(keys, before)
        at = walk(rule.ends(us, key_starts), 0)
        new_key = key_starts[at]
        new_key_place = np.maximum.accumulate(np.where(new_key, np.arange(len(at)), -1))
        numbers = np.where(new_key_place < 0, opened + 1 + np.arange(len(at)), np.arange(len(at)) - new_key_place + 1)
        closed, numbers_closed = at[:-1], numbers[:-1]
        sizes, open_at = np.diff(at), int(at[-1])
        if len(closed):
            if members:
                yield rows_of(table.slice(0, open_at), np.repeat(numbers_closed, sizes), np.repeat(sizes, sizes))
            else:
                yield units_of(keys.take(pa.array(closed)), numbers_closed, sizes, us[closed], us[at[1:] - 1])
        left = table.slice(open_at).combine_chunks()
        # the open unit's own key stands above it, unless it opens that key
        opened = int(numbers[-1]) - 1
        before = left.column("key").chunk(0)[:1]
    if left is None:
        return
    count, us = left.num_rows, _micros(left.column("us").combine_chunks())
    tail_n, tail_us = left.column("tail_n")[-1].as_py(), left.column("tail_us")[-1].as_py()
    total = count if tail_n is None else tail_n
    if members:
        yield rows_of(left, np.full(count, opened + 1), np.full(count, total))
    else:
        yield units_of(
            left.column("key").chunk(0)[:1], [opened + 1], [total], [us[0]], [us[-1] if tail_us is None else tail_us]
        )


def _laid_out(events: DataFrame, key: str, ts: str, order: str, payload: list[str],
              partitions: int | None) -> DataFrame:
    """Events with a known time, sorted by (key, time, id) over range partitions, fixed by a checkpoint."""
    checkpoint_root(events.sparkSession)
    rows = events.where(F.col(ts).isNotNull()).select(
        F.col(key).alias("key"), to_micros(F.col(ts)).alias("us"), F.col(order).alias("seq"), *payload
    )
    by = ["key", "us", "seq"]
    ranged = rows.repartitionByRange(*by) if partitions is None else rows.repartitionByRange(partitions, *by)
    return (
        ranged.sortWithinPartitions(*by)
        .withColumn("part", F.spark_partition_id())
        .checkpoint()
    )


def _walked(events: DataFrame, key: str, ts: str, order: str, rule: UnitRule, members: bool,
            payload: list[str], partitions: int | None) -> DataFrame:
    clashing = set(payload) & set(RESERVED)
    if clashing:
        raise ValueError(f"rename these columns first: {sorted(clashing)}")
    laid_out = _laid_out(events, key, ts, order, payload, partitions)
    key_type = laid_out.schema["key"].dataType.simpleString()
    runs = laid_out.select("key", "us", "part").mapInArrow(
        lambda batches: _describe(batches, rule),
        f"key {key_type}, part int, {_RUN}",
    )
    entering = _entering(runs, rule, laid_out.rdd.getNumPartitions(), FAN_IN)
    # Two rows per partition at most, a key and five numbers each: the number of partitions bounds what is broadcast here.
    entering = F.broadcast(
        entering.select(F.col("key").alias("of_key"), F.col("part").alias("of_part"), "skip", "head_n", "opened", "tail_n", "tail_us"))
    rows = laid_out.join(
        entering, (F.col("part") == F.col("of_part")) & F.col("key").eqNullSafe(F.col("of_key")), "left"
    ).drop("of_key", "of_part", "part", "seq")
    if members:
        kept = "".join(f", `{name}` {laid_out.schema[name].dataType.simpleString()}" for name in payload)
        schema = f"key {key_type}{kept}, unit_no bigint, n bigint"
    else:
        schema = f"key {key_type}, unit_no bigint, n bigint, first_us bigint, last_us bigint"
    return rows.mapInArrow(lambda batches: _emit(batches, rule, members, payload), schema)


def micros(length: timedelta | None) -> int | None:
    return None if length is None else length // timedelta(microseconds=1)


def units(events: DataFrame, key: str, ts: str, order: str, size: int, *, idle: timedelta | None = None,
          deadline: timedelta | None = None, flush: bool = True, partitions: int | None = None) -> DataFrame:
    """Units of ``size`` events per key: ``key, unit_no, n, status, first_ts, last_ts``.

    ``status`` is ``completed`` for a full unit, else ``timed_out``. Units still open when the input ends count
    as timed out; with ``flush=False`` only those whose time had run out by the last event of the input do.
    Events without a time cannot be placed and are left out.
    """
    rule = UnitRule(size, micros(idle), micros(deadline))
    found = _walked(events, key, ts, order, rule, False, [], partitions)
    if not flush:
        newest = events.agg(F.max(to_micros(F.col(ts))).alias("newest_us"))
        out_of_time = F.lit(False)
        if idle is not None:
            out_of_time |= F.col("last_us") + rule.idle <= F.col("newest_us")
        if deadline is not None:
            out_of_time |= F.col("first_us") + rule.deadline <= F.col("newest_us")
        found = found.join(F.broadcast(newest)).where((F.col("n") == size) | out_of_time)
    return found.select(
        F.col("key").alias(key), "unit_no", "n", status(size).alias("status"),
        from_micros(F.col("first_us")).alias("first_ts"), from_micros(F.col("last_us")).alias("last_ts"),
    )


def status(size: int):
    return F.when(F.col("n") == size, "completed").otherwise("timed_out")


def unit_members(events: DataFrame, key: str, ts: str, order: str, size: int, payload: list[str], *,
                 idle: timedelta | None = None, deadline: timedelta | None = None, partitions: int | None = None) -> DataFrame:
    """Every event with the number and the final size of its unit: ``key, <payload>, unit_no, n``."""
    rule = UnitRule(size, micros(idle), micros(deadline))
    return _walked(events, key, ts, order, rule, True, payload, partitions).withColumnRenamed("key", key)


def exact_members(events: DataFrame, key: str, ts: str, order: str, size: int, payload: list[str], *,
                  idle: timedelta | None = None, partitions: int | None = None) -> DataFrame:
    """The events of units that got exactly ``size`` events."""
    tagged = unit_members(events, key, ts, order, size, payload, idle=idle, partitions=partitions)
    return tagged.where(F.col("n") == size).drop("unit_no", "n")


def pages_per_key(df: DataFrame, key: str, ts: str, order: str, value: str, page_rows: int,
                  partitions: int | None = None) -> DataFrame:
    """All values of each key in order, as lists of at most ``page_rows``: ``key, page, n, values``.

    One list per key would grow with the data; pages hold the same values and stay small.
    """
    tagged = unit_members(
        df.withColumns({"_value": F.col(value), "_place": F.col(order), "_us": to_micros(F.col(ts))}),
        key, ts, order, page_rows, ["_us", "_place", "_value"], partitions=partitions,
    )
    listed = F.array_sort(F.collect_list(F.struct("_us", "_place", "_value")))
    return tagged.groupBy(key, F.col("unit_no").alias("page")).agg(
        F.count(F.lit(1)).alias("n"), F.transform(listed, lambda pair: pair["_value"]).alias("values")
    )


def once_units(events: DataFrame, key: str, ts: str, order: str, size: int, deadline: timedelta) -> DataFrame:
    """Keys whose first ``size`` events all came within ``deadline`` of the first: ``key, n, status, first_ts, last_ts``.

    Whatever else happens on a key is ignored. Only the first ``size`` events of a key matter, and every task
    keeps just those before the shuffle (Spark's window group limit), so a busy key costs no more than others.
    """
    rows = events.where(F.col(ts).isNotNull()).select(
        F.col(key).alias("key"), to_micros(F.col(ts)).alias("us"), F.col(order).alias("seq")
    )
    first = Window.partitionBy("key").orderBy("us", "seq")
    groups = (
        rows.withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= size)
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))
    )
    return groups.where(
        (F.col("n") == size) & (F.col("last_us") < F.col("first_us") + micros(deadline))
    ).select(
        F.col("key").alias(key), "n", status(size).alias("status"),
        from_micros(F.col("first_us")).alias("first_ts"), from_micros(F.col("last_us")).alias("last_ts"),
    )
