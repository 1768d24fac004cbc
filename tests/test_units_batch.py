import random
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.unit_simulation import units as simulated
from tidemark.operators import units as U
from tidemark.operators.unit_rules import UnitRule, walk

SECOND = 1_000_000


def frame(spark, events):
    df = spark.createDataFrame(events, "key bigint, us bigint, id bigint")
    return df.selectExpr("key", "timestamp_micros(us) AS ts", "id")


def as_set(found):
    rows = found.selectExpr("key", "unit_no", "n", "unix_micros(first_ts) f", "unix_micros(last_ts) l").collect()
    assert len(rows) == len({tuple(r) for r in rows})
    return {tuple(r) for r in rows}


def skewed_events(seed, rows, keys, span_s):
    """About two thirds of the rows on one key, times with ties and bursts."""
    rng = random.Random(seed)
    return [
        (0 if rng.random() < 0.66 else rng.randrange(1, keys), rng.randrange(span_s) * SECOND, i)
        for i in range(rows)
    ]


@pytest.mark.parametrize("bound", [None, ("idle", 4), ("idle", 40), ("deadline", 5), ("deadline", 60)])
@pytest.mark.parametrize("size, partitions", [(1, 7), (3, 40), (10, 1), (10, 7)])
def test_units_over_cut_keys_equal_the_simulation(spark, size, bound, partitions):
    events = skewed_events(size * 100 + partitions, 600, 12, 900)
    limits = {} if bound is None else {bound[0]: timedelta(seconds=bound[1])}
    found = U.units(frame(spark, events), "key", "ts", "id", size, partitions=partitions, **limits)
    expected = simulated(events, size, **({} if bound is None else {bound[0]: bound[1] * SECOND}))
    assert as_set(found) == expected


def test_gap_exactly_at_the_bound_closes_the_unit(spark):
    events = [(1, 0, 1), (1, 5 * SECOND, 2), (1, 10 * SECOND - 1, 3)]
    found = U.units(frame(spark, events), "key", "ts", "id", 10, idle=timedelta(seconds=5))
    assert {(r.n, r.status) for r in found.collect()} == {(1, "timed_out"), (2, "timed_out")}
    found = U.units(frame(spark, events), "key", "ts", "id", 10, deadline=timedelta(seconds=5))
    assert {(r.n, r.status) for r in found.collect()} == {(1, "timed_out"), (2, "timed_out")}


def test_members_carry_the_final_size_across_partitions(spark):
    events = skewed_events(5, 500, 9, 400)
    tagged = U.unit_members(
        frame(spark, events).selectExpr("key", "ts", "id", "id AS place"),
        "key", "ts", "id", 10, ["place"], partitions=23,
    ).collect()
    assert sorted(r.place for r in tagged) == list(range(500))
    sizes = {(key, no): n for key, no, n, _, _ in simulated(events, 10)}
    assert {(r.key, r.unit_no): r.n for r in tagged} == sizes


def test_text_keys_and_nested_payload(spark):
    events = skewed_events(2, 300, 6, 200)
    rows = frame(spark, events).selectExpr("concat('k', key) AS key_text", "ts", "id", "struct(id AS a, ts AS b) AS both")
    found = U.units(rows, "key_text", "ts", "id", 4, idle=timedelta(seconds=9), partitions=11)
    named = {(f"k{key}", *rest) for key, *rest in simulated(events, 4, idle=9 * SECOND)}
    assert {
        tuple(r)
        for r in found.selectExpr("key_text", "unit_no", "n", "unix_micros(first_ts)", "unix_micros(last_ts)").collect()
    } == named
    members = U.exact_members(rows, "key_text", "ts", "id", 4, ["both"], partitions=11)
    full = sum(n for _, _, n, _, _ in simulated(events, 4) if n == 4)
    assert members.count() == full and members.select("both.a").distinct().count() == full


def test_null_keys_form_their_own_group(spark):
    events = [(None, i * SECOND, i) for i in range(5)] + [(1, i * SECOND, 10 + i) for i in range(4)]
    found = U.units(frame(spark, events), "key", "ts", "id", 2, partitions=4)
    assert sorted((str(r.key), r.n) for r in found.collect()) == [
        ("1", 2), ("1", 2), ("None", 1), ("None", 2), ("None", 2)
    ]


def test_flush_false_keeps_only_units_whose_time_has_run_out(spark):
    events = [(1, 0, 1), (2, 100 * SECOND, 2), (3, 0, 3), (3, 1, 4)]
    found = U.units(frame(spark, events), "key", "ts", "id", 2, idle=timedelta(seconds=50), flush=False)
    assert {(r.key, r.status) for r in found.collect()} == {(1, "timed_out"), (3, "completed")}


@pytest.mark.parametrize("size", [2, 10, 1500])
def test_once_units_look_at_the_first_events_only(spark, size):
    events = skewed_events(3, 4000, 30, 500)
    deadline = 300
    expected = {
        (key, first, last)
        for key, no, n, first, last in simulated(events, size)
        if no == 1 and n == size and last < first + deadline * SECOND
    }
    found = U.once_units(frame(spark, events), "key", "ts", "id", size, timedelta(seconds=deadline))
    rows = found.selectExpr("key", "unix_micros(first_ts) f", "unix_micros(last_ts) l").collect()
    assert {tuple(r) for r in rows} == expected and expected


def test_once_units_limit_each_group_before_the_shuffle(spark):
    found = U.once_units(frame(spark, skewed_events(1, 50, 5, 50)), "key", "ts", "id", 10, timedelta(seconds=9))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_pages_hold_every_value_in_order(spark):
    events = skewed_events(8, 700, 4, 300)
    pages = U.pages_per_key(frame(spark, events), "key", "ts", "id", "id", 50, partitions=9).collect()
    assert all(len(p["values"]) == p.n <= 50 for p in pages)
    assert sorted(v for p in pages for v in p["values"]) == list(range(700))


def test_pages_follow_time_where_ids_fall(spark):
    rows = spark.sql("SELECT 1 AS key, timestamp_seconds(id) AS ts, 100 - id AS place, id AS value FROM range(6)")
    pages = U.pages_per_key(rows, "key", "ts", "place", "value", 3, partitions=2).orderBy("page").collect()
    assert [p["values"] for p in pages] == [[0, 1, 2], [3, 4, 5]]


def in_a_tree(runs, rule, fan_in, width=None):
    """Upwards and downwards as the tasks do it, on the runs of one key."""
    if width is None:
        width = int(runs["part"].max()) + 1
    if width <= fan_in:
        return U._passed(runs, rule)
    groups = list(runs.groupby(runs["part"] // fan_in))
    above = pd.DataFrame([{"key": some["key"].iloc[0], "part": group, **U._composed(some, rule)} for group, some in groups])
    entered = in_a_tree(above, rule, fan_in, -(-width // fan_in)).set_index("part")
    assert all(len(some) <= fan_in for _, some in groups)
    return pd.concat([
        U._passed(some, rule, {name: None if pd.isna(x) else int(x) for name, x in entered.loc[group].items() if name != "key"})
        for group, some in groups
    ])


@pytest.mark.parametrize("limits", [{}, {"idle": 12}, {"deadline": 40}])
def test_a_key_over_two_thousand_partitions(limits):
    rng, rule = random.Random(3), UnitRule(10, **limits)
    us = sorted(rng.randrange(40_000) for _ in range(9_000))
    table = pa.table({"key": pa.array([5] * 9_000, pa.int64()), "us": pa.array(us, pa.int64())})
    bounds = sorted(rng.randrange(9_000) for _ in range(1_999))
    pieces = [table.slice(a, b - a) for a, b in zip([0, *bounds], [*bounds, 9_000])]
    pieces = [p.append_column("part", pa.array([i] * len(p), pa.int32())) for i, p in enumerate(pieces)]
    runs = pd.concat([b.to_pandas() for p in pieces for b in U._describe(p.to_batches(), rule)])
    names = ["skip", "head_n", "opened", "tail_n", "tail_us"]
    entered = in_a_tree(runs, rule, 8).set_index("part")[names]
    found = set()
    for part, piece in enumerate(pieces):
        if len(piece):
            for name in names:
                value = entered.loc[part, name]
                piece = piece.append_column(name, pa.array([None if pd.isna(value) else int(value)] * len(piece), pa.int64()))
            found |= {tuple(r.values()) for out in U._emit(piece.to_batches(), rule, False, []) for r in out.to_pylist()}
    assert found == simulated([(5, t, i) for i, t in enumerate(us)], 10, **limits)


@pytest.mark.parametrize("limit", [{}, {"idle": 4}, {"deadline": 60}])
def test_units_by_a_tree_of_runs(spark, limit, monkeypatch):
    """40 partitions composed three at a time: four levels."""
    monkeypatch.setattr(U, "FAN_IN", 3)
    events = skewed_events(77, 600, 12, 900) + [(None, i * SECOND, 1000 + i) for i in range(90)]
    found = U.units(frame(spark, events), "key", "ts", "id", 4, partitions=40, **{n: timedelta(seconds=s) for n, s in limit.items()})
    assert as_set(found) == simulated_with_null(events, 4, {n: s * SECOND for n, s in limit.items()})


def simulated_with_null(events, size, limit):
    return {(None if key == -1 else key, *rest) for key, *rest in simulated([(-1 if k is None else k, us, i) for k, us, i in events], size, **limit)}


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30)), min_size=1, max_size=60),
    st.integers(1, 6),
    st.sampled_from([{}, {"idle": 3}, {"idle": 1}, {"deadline": 4}, {"deadline": 9}]),
    st.integers(1, 30),
    st.integers(1, 7),
    st.integers(2, 40),
)
def test_any_cut_into_partitions_and_batches_gives_the_same_units(pairs, size, limits, partitions, batch_rows, fan_in):
    """The steps run here on plain Arrow batches, cut at every kind of place."""
    rule = UnitRule(size, **limits)
    events = sorted((key, us, i) for i, (key, us) in enumerate(pairs))
    cuts = np.array_split(np.arange(len(events)), partitions)

    def batches(part, extra=None):
        rows = [events[i] for i in cuts[part]]
        for at in range(0, len(rows), batch_rows):
            some = rows[at : at + batch_rows]
            columns = {
                "key": pa.array([r[0] for r in some], pa.int64()),
                "us": pa.array([r[1] for r in some], pa.int64()),
                "part": pa.array([part] * len(some), pa.int32()),
            }
            for name in ("skip", "head_n", "opened", "tail_n", "tail_us") if extra is not None else ():
                columns[name] = pa.array([extra.get((part, r[0]), {}).get(name) for r in some], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    described = [b.to_pandas() for part in range(partitions) for b in U._describe(batches(part), rule)]
    runs = pd.concat(described)
    entering = {}
    for _, one in runs.groupby("key"):
        for row in in_a_tree(one, rule, fan_in).to_dict("records"):
            entering[(row["part"], row["key"])] = {k: None if v is pd.NA else v for k, v in row.items()}
    found = set()
    for part in range(partitions):
        for out in U._emit(batches(part, entering), rule, False, []):
            found |= {tuple(r.values()) for r in out.to_pylist()}
    assert found == simulated(events, size, **limits)


def test_walk_visits_each_opening_row():
    assert walk(UnitRule(2).ends(np.arange(5)), 0).tolist() == [0, 2, 4]
