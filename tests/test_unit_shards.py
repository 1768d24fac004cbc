"""All keys of a shard in one call: the units of every key, in any order within the lateness, any split into triggers."""

from datetime import timedelta
from functools import partial
from types import SimpleNamespace

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.test_unit_processors import MS, RULES, Handle, accepted, arrivals, in_order
from tests.unit_simulation import walk_key
from tidemark.operators import units as batch_units
from tidemark.operators.unit_rules import UnitRule
from tidemark.streaming import shards
from tidemark.streaming import units as stream_units
from tidemark.streaming.replay import replay, replay_in_slices

BASE = 1_700_000_000_000_000  # a time above the first watermark, which is the year 1970
CHUNKS = st.sampled_from([(1, 1), (2, 3), (1024, 16)])


def run(processor, triggers, late, chunks, shard=3):
    """As for a single key; ``triggers`` hold (us, id), and the key of an event is its id modulo 4, as text."""
    kept = stream_units.CHUNK, stream_units.MERGED, shards.CHUNK
    stream_units.CHUNK, stream_units.MERGED, shards.CHUNK = *chunks, chunks[0]
    try:
        handle, out, watermark, newest = Handle(), [], 0, 0
        processor.init(handle)
        for rows in [*triggers, [], []]:
            now = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
            if rows:
                frame = pd.DataFrame({"us": [r[0] for r in rows], "seq": [r[1] for r in rows], "key": [f"k{r[1] % 4}" for r in rows], "member": [r[1] for r in rows]})
                halves = [frame[len(frame) // 2 :], frame[: len(frame) // 2]]
                out += processor.handleInputRows((shard,), iter(h for h in halves if len(h)), now)
                newest = max(newest, *(us for us, _ in rows))
            for due in sorted(t for t in handle.timers if t <= watermark):
                handle.timers.discard(due)
                out += processor.handleExpiredTimer((shard,), now, SimpleNamespace(getExpiryTimeInMs=lambda due=due: due))
            watermark = max(watermark, (newest - late) // MS)
        return [tuple(row) for frame in out for row in frame.itertuples(index=False)], handle, watermark * MS
    finally:
        stream_units.CHUNK, stream_units.MERGED, shards.CHUNK = kept


def of_each_key(rows):
    return {f"k{k}": [row for row in rows if row[1] % 4 == k] for k in range(4)}.items()


@settings(max_examples=400, deadline=None)
@given(arrivals(), st.integers(1, 6), RULES, CHUNKS)
def test_units_of_all_keys_of_a_shard(arrived, size, bound, chunks):
    late, triggers = arrived
    triggers = accepted(late, triggers)
    kind, length = bound[0], bound[1] * MS
    found, handle, watermark = run(shards.ShardUnits(UnitRule(size, **{kind: length}), "string"), triggers, late, chunks)
    expected, still_open = [], 0
    for key, rows in of_each_key(in_order(triggers, watermark)):
        units = list(walk_key(rows, size, **{kind: length})) if rows else []
        for unit in units:
            first, last = unit[0][0], unit[-1][0]
            if len(unit) == size or (last if kind == "idle" else first) + length <= watermark or unit is not units[-1]:
                expected.append((key, len(unit), first, last))
            else:
                still_open += 1
    assert sorted(found) == sorted(expected)
    assert sum(len(value[0]) for value in handle.states["held"].entries.values()) == still_open
    assert len(handle.timers) == (handle.states["clock"].value is not None)


@settings(max_examples=400, deadline=None)
@given(arrivals(), st.integers(1, 6), CHUNKS)
def test_members_of_all_keys_of_a_shard(arrived, size, chunks):
    late, triggers = arrived
    triggers = accepted(late, triggers)
    found, handle, watermark = run(shards.ShardMembers(UnitRule(size, idle=8 * MS), "string", {"member": "bigint"}), triggers, late, chunks)
    expected = []
    for key, rows in of_each_key(in_order(triggers, watermark)):
        units = list(walk_key(rows, size, idle=8 * MS)) if rows else []
        expected += [(key, number) for unit in units if len(unit) == size for _, number in unit]
    assert sorted(found, key=lambda member: member[0]) == expected  # those of a key come in order
    assert len(handle.timers) == (handle.states["clock"].value is not None)


@settings(max_examples=600, deadline=None)
@given(arrivals(), st.integers(1, 4), st.integers(1, 9), st.integers(0, 9), CHUNKS)
def test_first_units_of_all_keys_of_a_shard(arrived, size, deadline, forget, chunks):
    late, triggers = arrived
    triggers = accepted(late, triggers)
    found, handle, watermark = run(shards.ShardOnce(size, deadline * MS, forget * MS, "string"), triggers, late, chunks)
    expected = []
    for key, rows in of_each_key(in_order(triggers, watermark)):
        while rows:
            first = rows[0][0]
            unit = [us for us, _ in rows if us < first + deadline * MS][:size]
            if len(unit) == size:
                expected.append((key, size, first, unit[-1]))
            rows = [row for row in rows if row[0] > first + (deadline + forget) * MS]
    assert sorted(found) == sorted(expected)
    assert len(handle.timers) == (handle.states["clock"].value is not None)


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("limit", [{"idle": timedelta(seconds=40)}, {"deadline": timedelta(seconds=90)}])
def test_null_and_large_keys(spark, kind, limit):
    """A null key is a key of its own, and whole numbers beyond 53 bits stay as they are beside it."""
    keys = [None, 0, 2**62 + 1, 2**62 + 2, -(2**62) - 1]
    rows = spark.createDataFrame([(keys[i * 7 % 5], BASE + 10_000_000 * i, i) for i in range(300)], "key bigint, us bigint, id bigint")
    rows = rows.select(F.col("key").cast(kind).alias("key"), F.timestamp_micros("us").alias("ts"), "id")
    found = replay_in_slices(rows, "ts", lambda s: stream_units.units(s, "key", "ts", 3, **limit), partial(replay, mode="append", partitions=2), least=3)
    expected = batch_units.units(rows, "key", "ts", "id", 3, flush=False, **limit)
    columns = ["key", "n", "status", "first_ts", "last_ts"]
    assert found.schema["key"].dataType.simpleString() == kind
    ours, theirs = (sorted(map(str, frame.select(*columns).collect())) for frame in (found, expected))
    assert ours == theirs and any("key=None" in row for row in ours)


def test_members_of_null_keys(spark):
    rows = spark.createDataFrame([(None if i % 2 else 2**62 + 1, BASE + 1_000_000 * i, i, None if i % 3 else f"p{i}") for i in range(60)], "key bigint, us bigint, id bigint, p string")
    rows = rows.select("key", F.timestamp_micros("us").alias("ts"), "id", "p")
    found = replay_in_slices(
        rows, "ts", lambda s: stream_units.exact_members(s.withColumn("number", F.col("id")), "key", "ts", "id", 5, ["number", "p"], idle=timedelta(days=1)),
        partial(replay, mode="append", partitions=2), least=3)
    members = {(r.key, r.number, r.p) for r in found.collect()}
    assert members == {(None if i % 2 else 2**62 + 1, i, None if i % 3 else f"p{i}") for i in range(60)}


@pytest.mark.parametrize("kind, calls", [("bigint", 256), ("string", 256), ("date", 3000)])
def test_calls_do_not_grow_with_the_number_of_keys(spark, kind, calls):
    key = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")) if kind == "date" else F.col("id").cast(kind)
    rows = spark.range(3000).select(key.alias("k"), F.timestamp_seconds("id").alias("ts"))
    groups, *_ = stream_units._grouped(rows, "k", "ts", "0 seconds", stream_units.SHARDS)
    assert groups.count().count() == calls
