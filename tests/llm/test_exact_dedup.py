"""The digest index against a plain restatement, batch by batch."""

import hashlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.oracle import compare
from tidemark.llm import exact_dedup
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.session import shared_folder

SCHEMA = "doc_id long, text string, row string, digest int, n_chars long"
ROWS = [
    (1, "a", "x", 1, 1), (5, "a", None, 2, 1), (3, "a", "y", 3, 1), (2, None, "z", 4, 1), (7, "", "z", 5, 1), (4, "A", "z", 6, 1),
    (None, "a", "z", 7, 1), (None, "b", "z", 8, 1), (None, "b", "z", 9, 1), (6, "é" * 70_000, "z", 10, 1), (8, "é" * 70_000, "z", 11, 1),
    (5, "a", None, 2, 1), (9, " a", "z", 12, 1), *((100 + i, "common", "c", i, 1) for i in range(400)),
]


def restated(rows):
    groups = defaultdict(list)
    for key, text, *_ in rows:
        groups[text or ""].append(key)
    named = {text: max((k for k in keys if k is not None), default=None) for text, keys in groups.items()}
    return sorted(
        (str(key), str(named[text or ""]), len(groups[text or ""]), hashlib.sha256((text or "").encode()).hexdigest())
        for key, text, *_ in rows
    )


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def index(spark, buckets=5):
    return exact_dedup.opened(spark, shared_folder(spark, "index"), buckets)


@pytest.mark.parametrize("hot", [1, 50, 1024])
def test_verdicts_equal_the_restatement(spark, docs, hot, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT", hot)
    ours, rows = index(spark), exact_dedup.digested(docs)
    for batch in exact_dedup.descending_halves(rows):
        exact_dedup.ingest(ours, batch)
    found = exact_dedup.verdicts(ours, rows).withColumn("sha", F.lower(F.hex("digest"))).collect()
    assert sorted((str(r.key), str(r.keep_id), r.group_size, r.sha) for r in found) == restated(ROWS)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.sha for r in found}) and len({r.sha for r in kept}) == len(kept)
    assert all(r.key == r.keep_id for r in kept)


def test_an_index_lives_on_and_its_batches_are_anti_joined(spark, docs):
    first = index(spark)
    some = docs.where("doc_id < 5 OR doc_id IS NULL")
    before = exact_dedup.without_copies(some, first).count()
    again = exact_dedup.opened(spark, first.folder, first.buckets)  # as a later session would
    assert again.rows().count() == before == 4
    later = exact_dedup.without_copies(docs.where("doc_id >= 5"), again)
    assert later.columns == docs.columns  # row and digest are the caller's own columns here
    texts = [r.text for r in later.select("text").collect()]
    assert sorted(t[:6] for t in texts) == sorted([" a", "common", "éééééé"])
    assert exact_dedup.without_copies(docs.where("doc_id >= 5"), again).count() == 3  # fed again: the same verdicts
    smaller = exact_dedup.compacted(again, shared_folder(spark, "index"))
    assert sorted(map(tuple, smaller.rows().collect())) == sorted(map(tuple, again.rows().collect()))


def test_the_index_is_never_shuffled(spark, docs):
    ours, rows = index(spark, 8), exact_dedup.digested(docs)
    exact_dedup.ingest(ours, rows)
    fresh = rows.select("digest").join(ours.rows().hint("merge"), "digest", "left_anti")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_normalised_texts(spark, docs):
    lowered = exact_dedup.without_copies(docs, index(spark), normalise=lambda text: F.lower(F.trim(text)))
    assert lowered.where("lower(trim(text)) = 'a'").count() == 1


def test_empty_table(spark, docs):
    ours = index(spark)
    assert exact_dedup.without_copies(docs.limit(0), ours).count() == 0 and ours.rows().count() == 0
    rows = exact_dedup.digested(docs.limit(0))
    assert len(exact_dedup.descending_halves(rows)) == 1 and exact_dedup.verdicts(ours, rows).count() == 0


def test_query_on_odd_rows_equals_its_sql(spark, docs, tmp_path, monkeypatch):
    once = docs.dropDuplicates(["doc_id", "text"]).coalesce(1)
    pq.write_table(once.toArrow(), tmp_path / "documents.parquet")
    monkeypatch.setattr("tests.oracle.TABLES", ["documents"])
    ours, theirs = compare(spark, str(tmp_path), QUERIES["op11_exact_dedup"], ORACLES["op11_exact_dedup"])
    assert ours == theirs
