"""The vertical scan against all scores, computed one by one with Python integers."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.oracle import compare
from tidemark.llm import hard_negatives as hn
from tidemark.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, id string, block int"


def made(seed, many=700, dims=19):
    rng = random.Random(seed)
    rows = []
    for number in range(many):
        vector = [float(np.float32(rng.gauss(0.3, 0.5))) for _ in range(dims)]
        rows.append((number, vector, rng.choice((0, 0, 1, 2, 9)), "x", 1))
    copies = [(many + i, rows[5][1], i % 3, "copy", 1) for i in range(200)]  # ties
    odd = [
        (None, rows[0][1], 1, None, None), (9_000, None, 1, None, None), (9_100, rows[0][1], None, None, None),
        (9_200, [None, 1.0], 1, None, None), (9_300, [math.nan] * dims, 1, None, None), (9_400, [math.inf] * dims, 1, None, None),
        (9_500, [], 3, None, None), (9_501, [1.5], 3, None, None), (9_600, [0.0] * dims, 4, None, None), rows[100], rows[100],
        (100, [9.0] * dims, 9, None, None),
    ]
    return rows + copies + odd


def restated(rows, moved=True):
    rows = [(k, v, l) for k, v, l, *_ in rows if k is not None and v is not None and l is not None and all(x is not None and math.isfinite(x) for x in v)]
    relabelled = [(k, (l + 1) % 10 if k % 7 == 0 else l, v) for k, v, l in rows]
    unique = {}
    for row in sorted(relabelled):
        unique.setdefault(row[0], (row[1], [math.floor(256 * x) for x in row[2]]))
    out = []
    for anchor, (label, v) in unique.items():
        if anchor % 100:
            continue
        ranked = sorted((-sum(a * b for a, b in zip(v, w)), k, l) for k, (l, w) in unique.items() if k != anchor)
        for score, positive, _ in [r for r in ranked if r[2] == label][:5]:
            inside = [r for r in ranked if r[2] != label and 80 * -score <= 100 * -r[0] <= 100 * -score][:5]
            out += [(anchor, positive, place, k, -score, -s) for place, (s, k, _) in enumerate(inside, 1)]
    return sorted(out)


def write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def found(spark, folder):
    return sorted(map(tuple, QUERIES["op12_hard_negatives"](spark, folder).collect()))


@pytest.mark.parametrize("block, fine", [(16_384, 1024), (300, 100), (64, 16)])
def test_query_equals_all_scores(spark, tmp_path, monkeypatch, block, fine):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "FINE", fine)
    rows = made(4)
    result = found(spark, write(spark, tmp_path, rows))
    assert result == restated(rows) and len(result) > 100


def test_query_on_odd_rows_equals_its_sql(spark, tmp_path, monkeypatch):
    pq.write_table(spark.createDataFrame(made(5, 300), SCHEMA).toArrow(), tmp_path / "embeddings.parquet")
    monkeypatch.setattr("tests.oracle.TABLES", ["embeddings"])
    ours, theirs = compare(spark, str(tmp_path), QUERIES["op12_hard_negatives"], ORACLES["op12_hard_negatives"])
    assert ours == theirs and ours[1]


def test_empty_and_lonely_rows(spark, tmp_path):
    assert found(spark, write(spark, tmp_path / "none", [])) == []
    assert found(spark, write(spark, tmp_path / "one", [(100, [1.0], 1, None, None)])) == []
    two = [(100, [1.0], 1, None, None), (101, [1.0], 1, None, None), (102, [1.0], 2, None, None), (103, [0.5], 2, None, None)]
    assert found(spark, write(spark, tmp_path / "two", two)) == [(100, 101, 1, 102, 65536, 65536)]


def test_scores_beyond_doubles_and_longs(spark, tmp_path):
    big = [(100, [2.0**12, 1.0], 1, None, None), (101, [2.0**30, 3.0], 1, None, None), (102, [2.0**30, 1.0], 2, None, None)]
    assert found(spark, write(spark, tmp_path / "big", big)) == restated(big) != []
    huge = [(100, [2.0**60], 1, None, None), (101, [2.0**60], 1, None, None), (102, [2.0**60], 2, None, None)]
    assert found(spark, write(spark, tmp_path / "huge", huge)) == [(100, 101, 1, 102, 2**63 - 1, 2**63 - 1)]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 40), st.integers(1, 30), st.integers(1, 4))
def test_scan_keeps_whatever_may_win(seed, rows, dims, k):
    rng = np.random.default_rng(seed)
    columns = rng.integers(-9, 9, (dims, rows)).astype(float) * rng.integers(0, 20, (dims, 1))
    anchor = rng.integers(-9, 9, dims).astype(float)
    exact, ends = anchor @ columns, (columns.min(1), columns.max(1))
    places, scores = hn.scan(anchor, columns, ends, hn.among_best(k))
    assert (scores == exact[places]).all() and set(np.flatnonzero(exact >= np.sort(exact)[-min(k, rows)])) <= set(places.tolist())
    low, high = sorted(rng.choice(exact, 2))
    places, scores = hn.scan(anchor, columns, ends, hn.in_windows([(low, high)], k))
    inside = np.sort(exact[(exact >= low) & (exact <= high)])
    assert (scores == exact[places]).all()
    assert set(np.flatnonzero((exact >= inside[-min(k, len(inside))]) & (exact <= high))) <= set(places.tolist())


def test_windows_include_their_bounds():
    assert [hn.window(s) for s in (100, 99, 0, -5)] == [(80, 100), (80, 99), (0, 0), (-4, -5)]


def test_bounds_do_strike_rows_out():
    """On rows of falling size most are gone before the last dimensions are read."""
    rng = np.random.default_rng(1)
    columns = np.floor(256 * rng.random((64, 5000)) * np.linspace(1, 0, 64)[:, None] ** 4)
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            out = np.asarray(super().__getitem__(at))
            read.append(out.shape[-1])
            return out

    hn.scan(np.linspace(300, 1, 64), columns.view(Watched), (columns.min(1), columns.max(1)), hn.among_best(5))
    assert read[0] == 5000 and read[-1] < 100
