"""Grouping events into units, as batches and as replayed streams."""

from datetime import timedelta
from functools import partial

from pyspark.sql import functions as F

from tidemark.catalog import stand_ins as given
from tidemark.catalog.registry import registered
from tidemark.operators import units
from tidemark.plans import reconciliation as recon
from tidemark.streaming import remembered
from tidemark.streaming import units as stream_units
from tidemark.streaming.replay import replay, replay_branches, replay_into
from tidemark.streaming.unit_batches import UnitsView, events_of

# Settings that give both full and timed-out units on the test events, which span 30 days.
SIZE = 10
IDLE = timedelta(hours=24)
DEADLINE = timedelta(hours=120)
GIVE_UP = timedelta(days=60)
APPENDED = partial(replay, mode="append")

_STATUS = "CASE WHEN count(*) = 10 THEN 'completed' ELSE 'timed_out' END"
_IDLE = f"""
    WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 24 hour THEN 1 ELSE 0 END AS b
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
         s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM g),
         k AS (SELECT *, (row_number() OVER (PARTITION BY user_id, sid ORDER BY ts, event_id) - 1) // 10 AS ch FROM s),
         u AS (SELECT user_id, count(*) AS n, {_STATUS} AS status, min(ts) AS first_ts, max(ts) AS last_ts
               FROM k GROUP BY user_id, sid, ch)
"""
_DEADLINE = f"""
    WITH RECURSIVE
    e AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    r AS (SELECT user_id, ts, rn, ts AS first_ts, 1 AS pos, 1 AS unit FROM e WHERE rn = 1
          UNION ALL
          SELECT e.user_id, e.ts, e.rn, CASE WHEN nw THEN e.ts ELSE r.first_ts END,
                 CASE WHEN nw THEN 1 ELSE r.pos + 1 END, CASE WHEN nw THEN r.unit + 1 ELSE r.unit END
          FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1,
               LATERAL (SELECT (r.pos = 10 OR e.ts >= r.first_ts + INTERVAL 120 hour) AS nw)),
    u AS (SELECT user_id, count(*) AS n, {_STATUS} AS status, min(ts) AS first_ts, max(ts) AS last_ts
          FROM r GROUP BY user_id, unit)
"""
_ONCE = """
    SELECT user_id, count(*) AS n, 'completed' AS status, min(ts) AS first_ts, max(ts) AS last_ts
    FROM (SELECT user_id, ts, min(ts) OVER (PARTITION BY user_id) AS f,
                 row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
    WHERE rn <= 10 AND ts < f + INTERVAL 120 hour GROUP BY user_id HAVING count(*) = 10
"""
_MEMBERS = """
    SELECT user_id AS windowId, event_id AS counter, event_id::VARCHAR AS accountNumber,
           event_type AS accountName, value AS balance
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
                 count(*) OVER (PARTITION BY user_id) AS total FROM events)
    WHERE rn <= total - total % 10
"""
_NUMBERED = "row_number() OVER (PARTITION BY user_id ORDER BY first_ts) AS unit_no"


# A stream takes events that its watermark, in whole milliseconds, has passed; later ones are still open.
_PASSED = "(SELECT * FROM events WHERE ts <= (SELECT date_trunc('millisecond', max(ts)) FROM events))"
_NOW = "(SELECT date_trunc('millisecond', max(ts)) FROM events)"


def _streamed(sql: str) -> str:
    return sql.replace("FROM events", f"FROM {_PASSED}")


def _note(text: str) -> str:
    return f"CASE status WHEN 'completed' THEN 'Completed' ELSE {text} END AS note"


_IDLE_NOTE = _note("user_id || ' is timing out'")
_DEADLINE_NOTE = _note("'Timed out'")


@registered("units_idle", f"{_IDLE} SELECT *, {_NUMBERED}, {_IDLE_NOTE} FROM u")
def units_idle(spark, folder):
    found = units.units(given.events(spark, folder), "user_id", "ts", "event_id", SIZE, idle=IDLE)
    return given.wall_clock(recon.with_note(found, recon.idle_note("user_id")), "first_ts", "last_ts")


@registered("units_deadline", f"{_DEADLINE} SELECT *, {_NUMBERED}, {_DEADLINE_NOTE} FROM u")
def units_deadline(spark, folder):
    found = units.units(given.events(spark, folder), "user_id", "ts", "event_id", SIZE, deadline=DEADLINE)
    return given.wall_clock(recon.with_note(found, recon.deadline_note()), "first_ts", "last_ts")


@registered("units_once", _ONCE)
def units_once(spark, folder):
    found = units.once_units(given.events(spark, folder), "user_id", "ts", "event_id", SIZE, DEADLINE)
    return given.wall_clock(found, "first_ts", "last_ts")


def _accounts(rows):
    """Account messages with the columns that order them."""
    messages = given.account_messages(rows)
    return recon.accounts_of_messages(messages, keep=("timestamp", "offset"))


@registered("units_exact_members", _MEMBERS)
def units_exact_members(spark, folder):
    found = units.exact_members(
        _accounts(given.events(spark, folder)), "windowId", "timestamp", "offset", SIZE, ["counter", "account"]
    )
    return found.select("windowId", "counter", "account.*")


@registered(
    "stream_units_idle",
    f"{_streamed(_IDLE)} SELECT * FROM u WHERE n = 10 OR last_ts + INTERVAL 24 hour <= {_NOW}",
)
def stream_units_idle(spark, folder):
    """Units of keyed broker records, re-shaped from their binary form."""

    def build(rows):
        events = recon.events_of_messages(given.broker_records(rows, F.col("value"), "reconreplay"))
        return stream_units.units(events, "key", "timestamp", SIZE, idle=IDLE)

    found = given.replayed(spark, folder, ["user_id", "event_id", "value"], build, APPENDED)
    found = found.withColumn("user_id", F.col("key").cast("bigint")).drop("key")
    return given.wall_clock(found, "first_ts", "last_ts")


@registered(
    "stream_units_deadline",
    f"""{_streamed(_DEADLINE)} SELECT *, status AS branch FROM u
        WHERE n = 10 OR first_ts + INTERVAL 120 hour <= {_NOW}""",
)
def stream_units_deadline(spark, folder):
    """Full and timed-out units go to outputs of their own."""
    branches = {"completed": ~recon.is_timed_out(), "timed_out": recon.is_timed_out()}
    found = given.replayed(
        spark, folder, ["user_id"], lambda rows: stream_units.units(rows, "user_id", "ts", SIZE, deadline=DEADLINE),
        partial(replay_branches, mode="append", branches=branches),
    )
    return given.wall_clock(found, "first_ts", "last_ts")


@registered("stream_units_once", _streamed(_ONCE))
def stream_units_once(spark, folder):
    found = given.replayed(
        spark, folder, ["user_id"],
        lambda rows: stream_units.once_units(rows, "user_id", "ts", SIZE, DEADLINE, forget=GIVE_UP), APPENDED,
    )
    return given.wall_clock(found, "first_ts", "last_ts")


@registered("stream_units_remembered", _streamed(_ONCE))
def stream_units_remembered(spark, folder):
    """The same with a memory of finished keys that does not grow with them."""
    found = given.replayed(
        spark, folder, ["user_id"],
        lambda rows: remembered.once_units(rows, "user_id", "ts", SIZE, DEADLINE, remember=1_000_000, shards=8), APPENDED,
    )
    return given.wall_clock(found, "first_ts", "last_ts")


@registered("stream_units_exact_members", _streamed(_MEMBERS))
def stream_units_exact_members(spark, folder):
    """Members wait in the state as columns and are written once their unit is full."""

    def members(rows):
        return stream_units.exact_members(
            _accounts(rows).select("*", "account.*"), "windowId", "timestamp", "offset", SIZE,
            ["counter", "accountNumber", "accountName", "balance"], idle=GIVE_UP,
        )

    return given.replayed(spark, folder, ["user_id", "event_id", "event_type", "value"], members, APPENDED)


def _busy(found, folder):
    return UnitsView(found, folder, SIZE, idle=IDLE)


@registered(
    "stream_units_busy_keys",
    f"{_IDLE} SELECT * FROM u WHERE n = 10 OR last_ts + INTERVAL 24 hour <= (SELECT max(ts) FROM events)",
)
def stream_units_busy_keys(spark, folder):
    """Units for keys that one task could not follow: shares of a key are walked apart and composed at every trigger."""
    kept = given.replayed(
        spark, folder, ["user_id", "event_id"], lambda rows: events_of(rows, "user_id", "ts", "event_id"),
        partial(replay_into, _busy, mode="append"),
    )
    return given.wall_clock(kept.read("user_id"), "first_ts", "last_ts")
