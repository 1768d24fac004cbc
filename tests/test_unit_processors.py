"""The stateful processors on an in-memory state: any order within the lateness, any split into triggers."""

from types import SimpleNamespace

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.unit_simulation import walk_key
from tidemark.operators.unit_rules import UnitRule
from tidemark.streaming import units as stream_units
from tidemark.streaming.units import MemberProcessor, OnceProcessor, UnitProcessor

MS = 1000


class Value:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = tuple(value)

    def clear(self):
        self.value = None


class Listed:
    def __init__(self):
        self.rows = []

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def clear(self):
        self.rows = []


class Mapped:
    def __init__(self):
        self.entries = {}

    def keys(self):
        return iter(list(self.entries))

    def containsKey(self, key):
        return key in self.entries

    def getValue(self, key):
        return self.entries.get(key)

    def updateValue(self, key, value):
        assert not isinstance(value[0], list) or len(value[0]) <= stream_units.CHUNK
        self.entries[key] = value

    def removeKey(self, key):
        self.entries.pop(key, None)

    def iterator(self):
        return iter(list(self.entries.items()))


class Handle:
    def __init__(self):
        self.timers, self.states = set(), {}

    def _state(self, name, state):
        self.states[name] = state
        return state

    def getValueState(self, name, *_):
        return self._state(name, Value())

    def getListState(self, name, *_):
        return self._state(name, Listed())

    def getMapState(self, name, *_):
        return self._state(name, Mapped())

    def registerTimer(self, ms):
        assert ms not in self.timers
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)

    def is_empty(self):
        return not self.timers and not any(
            state.value if isinstance(state, Value) else state.rows if isinstance(state, Listed) else state.entries
            for state in self.states.values())


def run(processor, triggers, late=0):
    """triggers: lists of (us, id) in any order. Rows of a trigger come first, then the timers that are due, both under
    the watermark of the triggers before; one more trigger without rows follows the last."""
    handle, out, watermark, newest = Handle(), [], 0, 0
    processor.init(handle)
    for rows in [*triggers, []]:
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        if rows:
            frame = pd.DataFrame(rows, columns=["us", "seq"]).assign(member=[r[1] for r in rows])
            halves = [frame[len(frame) // 2 :], frame[: len(frame) // 2]]
            out += processor.handleInputRows((7,), iter(h for h in halves if len(h)), now)
            newest = max(newest, *(us for us, _ in rows))
        for due in sorted(t for t in handle.timers if t <= watermark):
            handle.timers.discard(due)
            out += processor.handleExpiredTimer((7,), now, SimpleNamespace(getExpiryTimeInMs=lambda due=due: due))
        watermark = max(watermark, (newest - late) // MS)
    for due in sorted(t for t in handle.timers if t <= watermark):
        handle.timers.discard(due)
        out += processor.handleExpiredTimer((7,), SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark), None)
    return [row for frame in out for row in frame.itertuples(index=False)], handle, watermark * MS


@st.composite
def arrivals(draw):
    """Rows in an order in which none comes more than ``late`` behind the newest before it, cut into triggers."""
    late = draw(st.integers(0, 15)) * MS
    us = draw(st.lists(st.integers(1, 40_000), min_size=1, max_size=40) if draw(st.booleans()) else
              st.lists(st.integers(1, 40).map(lambda t: t * MS), min_size=1, max_size=40))
    rows = [(t, number) for number, t in enumerate(us)]
    delays = draw(st.lists(st.integers(0, max(late - 1, 0)), min_size=len(rows), max_size=len(rows)))
    rows = [row for _, row in sorted(zip((t + d for (t, _), d in zip(rows, delays)), rows))]
    at = sorted(draw(st.lists(st.integers(0, len(rows)), max_size=6)))
    bounds = [0, *at, len(rows)]
    return late, [rows[a:b] for a, b in zip(bounds, bounds[1:]) if a < b]


def in_order(triggers, watermark):
    """All rows that the last watermark has passed, sorted."""
    return sorted(row for rows in triggers for row in rows if row[0] <= watermark)


def accepted(late, triggers):
    """What Spark lets through: rows not behind the watermark of the trigger before."""
    newest, out = 0, []
    for rows in triggers:
        kept = [row for row in rows if row[0] > (newest - late) // MS * MS]
        newest = max([newest, *(us for us, _ in rows)])
        out.append(kept)
    return [rows for rows in out if rows]


RULES = st.sampled_from([("idle", 3), ("idle", 9), ("deadline", 4), ("deadline", 12)])


@settings(max_examples=400, deadline=None)
@given(arrivals(), st.integers(1, 6), RULES)
def test_units_do_not_depend_on_arrival(arrived, size, bound):
    late, triggers = arrived
    triggers = accepted(late, triggers)
    kind, length = bound[0], bound[1] * MS
    found, handle, watermark = run(UnitProcessor(UnitRule(size, **{kind: length})), triggers, late)
    rows, expected = in_order(triggers, watermark), []
    units = list(walk_key(rows, size, **{kind: length})) if rows else []
    for unit in units:
        first, last = unit[0][0], unit[-1][0]
        if len(unit) == size or (last if kind == "idle" else first) + length <= watermark or unit is not units[-1]:
            expected.append((7, len(unit), first, last))
    assert list(map(tuple, found)) == expected
    assert len(handle.timers) == (handle.states["clock"].value is not None)


@settings(max_examples=400, deadline=None)
@given(arrivals(), st.integers(1, 6), st.integers(1, 20))
def test_once_units_do_not_depend_on_arrival(arrived, size, deadline):
    late, triggers = arrived
    triggers = accepted(late, triggers)
    found, _, watermark = run(OnceProcessor(size, deadline * MS, None), triggers, late)
    rows = in_order(triggers, watermark)
    unit = next(walk_key(rows, size, deadline=deadline * MS), [])
    assert list(map(tuple, found)) == ([(7, size, unit[0][0], unit[-1][0])] if len(unit) == size else [])


@settings(max_examples=300, deadline=None)
@given(arrivals(), st.integers(1, 4), st.integers(1, 9), st.integers(0, 9))
def test_forgotten_keys_start_again(arrived, size, deadline, forget):
    late, triggers = arrived
    triggers = accepted(late, triggers)
    found, handle, watermark = run(OnceProcessor(size, deadline * MS, forget * MS), triggers, late)
    rows, expected = in_order(triggers, watermark), []
    while rows:
        first = rows[0][0]
        unit = [us for us, _ in rows if us < first + deadline * MS][:size]
        if len(unit) == size:
            expected.append((7, size, first, unit[-1]))
        rows = [row for row in rows if row[0] > first + (deadline + forget) * MS]
    assert list(map(tuple, found)) == expected


def test_finished_keys_are_forgotten_after_a_while():
    rows = [(1 * MS, 1), (2 * MS, 2), (20 * MS, 3), (100 * MS, 4), (101 * MS, 5), (102 * MS, 6), (500 * MS, 7)]
    kept, handle, _ = run(OnceProcessor(2, 10 * MS, None), [[r] for r in rows])
    assert len(kept) == 1 and handle.states["seen"].value[2]
    # Forgotten 20 ms after the deadline; what comes until then is ignored.
    again, _, _ = run(OnceProcessor(2, 10 * MS, 20 * MS), [[r] for r in rows])
    assert [(r.first_us, r.last_us) for r in again] == [(1 * MS, 2 * MS), (100 * MS, 101 * MS)]
    again, handle, _ = run(OnceProcessor(2, 10 * MS, 20 * MS), [rows[:2], [(900 * MS, 8)]], late=5 * MS)
    assert handle.states["seen"].value is None and len(handle.states["waiting"].entries) == 1


@settings(max_examples=400, deadline=None)
@given(arrivals(), st.integers(1, 6))
def test_members_do_not_depend_on_arrival(arrived, size):
    late, triggers = arrived
    triggers = accepted(late, triggers)
    processor = MemberProcessor(UnitRule(size, idle=8 * MS), {"member": "bigint"})
    found, handle, watermark = run(processor, triggers, late)
    units = walk_key(in_order(triggers, watermark), size, idle=8 * MS)
    assert [r.member for r in found] == [number for unit in units if len(unit) == size for _, number in unit]
    assert len(handle.timers) == (handle.states["clock"].value is not None)


def test_the_case_of_an_event_out_of_order():
    """Times 10, 100, 50 and 5000 s give one unit from 10 to 100 s, in one micro-batch or in four."""
    rows = [(t * 1000 * MS, t) for t in (10, 100, 50, 5000)]
    for triggers in ([rows], [[row] for row in rows]):
        found, _, _ = run(UnitProcessor(UnitRule(10, idle=600 * 1000 * MS)), triggers, late=100 * 1000 * MS)
        assert [tuple(r) for r in found] == [(7, 3, rows[0][0], rows[1][0])]


def test_waiting_rows_lie_in_small_chunks(monkeypatch):
    """A release reads the chunks it reaches, and no others."""
    monkeypatch.setattr(stream_units, "CHUNK", 4)
    rows = [(t * MS, t) for t in range(1, 101)]
    read = []
    monkeypatch.setattr(Mapped, "getValue", lambda self, key: read.append(key) or self.entries[key])
    found, handle, _ = run(UnitProcessor(UnitRule(3, idle=500 * MS)), [rows, [(101 * MS, 101)]], late=91 * MS)
    assert [(r.n, r.first_us) for r in found] == [(3, 1 * MS), (3, 4 * MS), (3, 7 * MS)]
    assert len(read) <= 2 * 3 and len(handle.states["waiting"].entries) > 20


@settings(max_examples=100, deadline=None)
@given(arrivals(), st.integers(1, 6), RULES, st.integers(1, 4), st.integers(1, 3))
def test_busy_keys_are_walked_in_stretches(arrived, size, bound, chunk, merged):
    """With tiny chunks and more than one Arrow batch a call, units are the same, and no walk gets more than it may."""
    late, triggers = arrived
    triggers = accepted(late, triggers)
    kind, length = bound[0], bound[1] * MS
    whole, _, _ = run(UnitProcessor(UnitRule(size, **{kind: length})), triggers, late)
    kept = stream_units.CHUNK, stream_units.MERGED
    stream_units.CHUNK, stream_units.MERGED = chunk, merged
    try:
        parts, handle, _ = run(UnitProcessor(UnitRule(size, **{kind: length})), triggers, late)
    finally:
        stream_units.CHUNK, stream_units.MERGED = kept
    assert list(map(tuple, parts)) == list(map(tuple, whole))


def test_a_call_holds_a_bounded_number_of_rows(monkeypatch):
    """30,000 rows of one key in one micro-batch of many Arrow batches."""
    processor, handle, sizes = UnitProcessor(UnitRule(7, idle=50 * MS)), Handle(), []
    processor.init(handle)
    walked = processor.walk
    monkeypatch.setattr(processor, "walk", lambda key, rows, us: sizes.append(0 if rows is None else len(rows)) or walked(key, rows, us))
    batches = (pd.DataFrame({"us": [(1 + i % 1000 + 1000 * b) * MS for i in range(1000)]}) for b in range(30))
    assert list(processor.handleInputRows((7,), batches, SimpleNamespace(getCurrentWatermarkInMs=lambda: 0))) == []
    handle.timers.clear()
    found = pd.concat(processor.handleExpiredTimer((7,), SimpleNamespace(getCurrentWatermarkInMs=lambda: 10**6), None))
    assert sum(found["n"]) == 30_000 and max(sizes) <= stream_units.CHUNK * (stream_units.MERGED + 1) and handle.is_empty()


def test_missing_payload_values_wait_too():
    rows = pd.DataFrame({"us": [5 * MS, 6 * MS], "seq": [1, 2], "a": [1.0, None], "b": ["x", None]})
    processor, handle = MemberProcessor(UnitRule(2, idle=50 * MS), {"a": "bigint", "b": "string"}), Handle()
    processor.init(handle)
    at = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    assert list(processor.handleInputRows((7,), iter([rows]), at(0))) == []
    handle.timers.clear()
    (found,) = processor.handleExpiredTimer((7,), at(6), None)
    assert found.to_dict("list") == {"key": [7, 7], "a": [1, None], "b": ["x", None]} or found["a"].isna().tolist() == [False, True]
    assert handle.is_empty()
