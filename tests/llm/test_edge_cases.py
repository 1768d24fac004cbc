"""Queries and stages on nulls, empty and very long texts, repeats, no rows at all, and columns with clashing names."""

import hashlib
import re
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.oracle import compare
from tidemark.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("row", "key", "place", "doc", "digest", "size", "copies", "bucket", "n_row", "kept", "group_size", "hits", "words", "print", "anchor",
            "s_bucket", "s_order", "start", "target", "mix_source", "drawn", "q_text", "fingerprint", "component", "least", "spans", "items")
PASSAGE = " ".join(f"w{i}" for i in range(70))
ROWS = [
    (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, PASSAGE, "en", "a", 1), (4, PASSAGE, "en", "a", 1), (5, PASSAGE + " more", "de", "b", 1),
    (None, PASSAGE + " x", None, None, None), (6, "The of and to " * 4_000, "en", "b", 1), (7, "ü" * 100_000, "en", "c", 1),
    (2**63 - 1, "head " + PASSAGE + " tail", "en", "c", 1), (8, "mail a@b.de, 10.0.0.1 and +49 30 1234567 or 4111 1111 1111 1111", "en", "a", 1),
    (9, "a@b.c a@b..d 300.1.1.1 4111111111111112 +1 23", "en", "a", 1),
]
DOCUMENT_QUERIES = [name for name in QUERIES if name not in ("op3_url_filter", "op12_hard_negatives", "op13_conversation_trie")]


def stored(spark, folder, rows, clashing):
    docs = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        docs = docs.withColumns({name: F.lit(f"{name} of mine") for name in CLASHING})
    pq.write_table(docs.toArrow(), folder / "documents.parquet")
    pq.write_table(spark.createDataFrame([(1, " ".join(PASSAGE.split()[3:20])), (2, None)], "item_id long, text string").toArrow(), folder / "benchmark.parquet")
    return str(folder)


def rows_of(frame):
    return sorted((tuple(map(str, row)) for row in frame.select(*sorted(frame.columns)).collect()))


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_other_columns_play_no_part(spark, tmp_path, name):
    (tmp_path / "plain").mkdir(), (tmp_path / "clashing").mkdir()
    plain = QUERIES[name](spark, stored(spark, tmp_path / "plain", ROWS, False))
    clashing = QUERIES[name](spark, stored(spark, tmp_path / "clashing", ROWS, True))
    if name == "op4_sharding":  # every column counts for the order
        names = ["doc_id", "size", "text_crc32", "law", "grown_shard"]
        plain, clashing = plain.select(*names), clashing.select(*names)
    found = rows_of(plain)
    assert found == rows_of(clashing) and len(found) == len(ROWS)
    assert sorted(r.doc_id for r in plain.where("doc_id IS NOT NULL").select("doc_id").collect()) == sorted(r[0] for r in ROWS if r[0] is not None)


@pytest.mark.parametrize("name", [name for name in DOCUMENT_QUERIES if name in ORACLES])
def test_odd_rows_equal_the_sql(spark, tmp_path, name, monkeypatch):
    rows = [row for row in ROWS if row[0] is not None and row[0] < 100]  # ids as the contracts have them
    folder = stored(spark, tmp_path, rows, False)
    monkeypatch.setattr("tests.oracle.TABLES", ["documents", "benchmark"])
    ours, theirs = compare(spark, folder, QUERIES[name], ORACLES[name])
    assert ours == theirs


@pytest.mark.parametrize("stage", [stage for stage, _ in corpus_pipeline.STAGES])
def test_stages_hand_columns_through(spark, tmp_path, stage):
    folder = stored(spark, tmp_path, ROWS, True)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    run = dict(corpus_pipeline.STAGES)[stage]
    found = run(spark, docs, folder)
    assert found.columns == docs.columns + (["shard", "slot"] if stage == "sharding" else [])
    given = {tuple(r) for r in docs.collect()}
    assert {tuple(r)[: len(docs.columns)] for r in found.collect()} <= given
    none = run(spark, docs.limit(0), folder)
    assert none.count() == 0 and none.columns == found.columns


def test_the_greatest_id_is_not_null(spark, tmp_path):
    found = {r.doc_id: r for r in QUERIES["op9_substring_dedup"](spark, stored(spark, tmp_path, ROWS, False)).collect()}
    assert found[2**63 - 1].n_removed == 70 and found[None].n_removed == 70 and found[3].n_removed == 0


def test_shards_by_the_law_of_rows(spark, tmp_path):
    """Sizes, checksums and places one by one; counts at most one apart, no gaps."""
    rows = ROWS + [(100 + i, "same", "en", "a", 4) for i in range(40)]
    found = QUERIES["op4_sharding"](spark, stored(spark, tmp_path, rows, False))
    assert dict(found.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    found = found.collect()
    expected = sorted((str(key), len((text or "").encode()) + 1, zlib.crc32((text or "").encode())) for key, text, *_ in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == expected
    slots = [sorted(r.slot for r in found if r.shard == shard) for shard in range(8)]
    assert all(some == list(range(len(some))) for some in slots) and max(map(len, slots)) - min(map(len, slots)) <= 1
    assert {r.law for r in found} == {"rows"} and {r.grown_shard for r in found} == {None}


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def test_personal_data_columns_one_by_one(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    found = QUERIES["op1_pii"](spark, sf_dir).collect()
    assert len(found) == len(docs)
    for r in found:
        spans = []
        for place, (kind, (pattern, holds)) in enumerate(PATTERNS.items()):
            matches = [m for m in re.finditer(pattern, docs[r.doc_id]) if holds(m[0])]
            spans += [(m.start(), place, f"{kind}:{m.start()}:{m.end()}") for m in matches]
            assert r[f"n_{kind}"] == len(matches)
        base = [text for *_, text in sorted(spans)]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert set(base) <= set(every) and [int(s.split(":")[1]) for s in every] == sorted(int(s.split(":")[1]) for s in every)
