"""Units of busy keys at every trigger, against a record-by-record simulation."""

from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_streams import BASE, SCHEMA, shuffled, stream_of, write_file
from tests.test_units_batch import SECOND, skewed_events
from tests.unit_simulation import units as simulated
from tidemark.session import shared_folder
from tidemark.streaming.replay import replay_into
from tidemark.streaming.unit_batches import UnitsView, events_of

LATE = timedelta(seconds=50)


@pytest.mark.parametrize("bound, files", [({"idle": 30}, 4), ({"deadline": 90}, 1)])
def test_units_of_events_out_of_order(spark, tmp_path, bound, files):
    """Two thirds of the events are of one key, which is cut over several partitions; the last file ends all units."""
    events, folder = skewed_events(9, 500, 12, 600), str(tmp_path / "in")
    arrived = shuffled(events, 50 * SECOND, files)
    size = -(-len(arrived) // files)
    for number in range(files):
        write_file(folder, number, arrived[number * size : (number + 1) * size])
    write_file(folder, files, [(99, 10_000 * SECOND, -1), (None, 10_000 * SECOND, -2)])
    limit = {name: timedelta(seconds=s) for name, s in bound.items()}
    rows = events_of(stream_of(spark, folder), "key", "ts", "id")
    # ids repeat within a file; keys and times tell rows apart well enough for counting, not for the order of equal ones
    kept = replay_into(lambda stream, into: UnitsView(stream, into, 10, LATE, partitions=7, **limit), rows, "append")
    first, last = (F.unix_micros(name) - BASE for name in ("first_ts", "last_ts"))
    ours = Counter(tuple(r) for r in kept.read("key").select("key", "n", first, last).collect())
    expected = simulated(events, 10, **{name: s * SECOND for name, s in bound.items()})
    assert ours == Counter((key, n, a, b) for key, _, n, a, b in expected)
    assert kept.held.read().count() == 2


def test_members_of_full_units_and_a_repeated_micro_batch(spark, tmp_path):
    late = [(1, 30, 3), (1, 10, 1), (2, 5, 9)]
    batches = [[(1, 20, 2), (2, 1, 8), (2, 2, 7)], late, [(3, 500, 4)]]
    frames = [spark.createDataFrame([(k, BASE + s * SECOND, i, f"e{i}") for k, s, i in rows], f"{SCHEMA}, name string")
              .select("key", F.timestamp_micros("us").alias("ts"), "id", "name") for rows in batches]
    view = UnitsView(events_of(frames[0], "key", "ts", "id", ["name"]), shared_folder(spark, "view"), 3, LATE, idle=timedelta(seconds=60), partitions=2)
    for number, frame in enumerate(frames):
        for _ in range(2):  # every micro-batch is repeated, as after a failure
            view.write(events_of(frame, "key", "ts", "id", ["name"]), number)
    found = view.read("key").collect()
    assert sorted((r.key, r.name) for r in found) == [(1, "e1"), (1, "e2"), (1, "e3"), (2, "e7"), (2, "e8"), (2, "e9")]
    view.write(events_of(frames[0], "key", "ts", "id", ["name"]), 3)  # too late by now
    assert view.read("key").count() == 6 and view.held.read().count() == 1
    with pytest.raises(ValueError):
        UnitsView(events_of(frames[0], "key", "ts", "id"), "x", 3)
