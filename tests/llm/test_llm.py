"""The training-data operators against brute force, on small tables with nulls, ties, copies, long and empty texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.oracle import compare
from tidemark.llm import bwt, components, decontaminate, fragments, licenses, mixing, pii, quality_rules, sharding, simhash, substring_dedup, suffix_dedup, tokens, url_filter
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.session import settings as session_settings

WORDS = "alpha beta gamma delta the of and é ñu Zeta x".split()


def made(seed: int, many: int = 40) -> list[tuple]:
    rng = random.Random(seed)
    prose = lambda n: " ".join(rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(n))
    base = [prose(rng.choice((3, 60, 120))) for _ in range(8)]
    texts = [None, "", " \n\t ", "ü" * 700, base[0], base[0], "x " * 500, prose(3000)]
    while len(texts) < many:
        a, b = rng.choice(base), rng.choice(base)
        texts.append(rng.choice((prose(50), a, a + " " + prose(9), a[:len(a) // 2] + "é" + b[len(b) // 3:], prose(5) + "\n" + b + "\n" + a)))
    rows = [(i, t, rng.choice(("en", None)), rng.choice(("s1", "s1", "s10", "s2", None)), 1) for i, t in enumerate(texts)]
    return [*rows, (None, base[1], None, None, None), rows[4]]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VECTORS, TURNS = "vec_id long, embedding array<float>, label int", "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(3), SCHEMA)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(made(3), SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "alpha1 beta2"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, None), (2, ""), (3, "http://A.org/fr/x?y")], "page_id long, url string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([(100, [0.5, 1.0], 1), (101, None, 1), (None, [1.0], 2), (103, [0.5, 1.0], 1), (104, [0.5, 1.0], 2)], VECTORS).write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([(0, 0, "user", "a"), (0, None, None, None), (None, 1, "user", "b"), (7, 1, "user", "a")], TURNS).write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id long, text string"), ("pages", "page_id long, url string"),
                         ("embeddings", VECTORS), ("conversations", TURNS)):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_takes_odd_and_empty_tables(spark, stored, empty, name):
    found = QUERIES[name](spark, stored).count()
    if name in ("op12_hard_negatives", "op13_conversation_trie"):  # rows of their own making
        assert found > 0
    else:
        table = "pages" if "url" in name else "documents"
        assert found == spark.read.parquet(f"{stored}/{table}.parquet").count()
    assert QUERIES[name](spark, empty).count() == 0


# 10 ----------------------------------------------------------------------------------------------------------------

def test_quality_counts_equal_brute_force(docs):
    for row in quality_rules.judged(docs).collect():
        text = row["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (row["n_words"], row["word_chars"]) == (len(words), sum(map(len, words)))
        assert row["n_repeat_words"] == len(hit)
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_symbols"] == sum(c in "#*$%&|<>" for c in text)


def test_passing_keeps_columns_and_follows_the_table(spark, docs):
    wide = docs.withColumn("n_words", quality_rules.F.lit("clash"))
    kept = quality_rules.passing(wide)
    assert kept.columns == wide.columns
    assert kept.count() == quality_rules.judged(docs).where("passes").count()


# 5 -----------------------------------------------------------------------------------------------------------------

def poured(sizes: dict, weights: dict, budget: float) -> dict:
    """Reshare the excess round by round until none is above."""
    target, open_sources, left = dict.fromkeys(sizes, 0.0), set(sizes), budget
    while open_sources and left > 1e-9:
        total = sum(weights[s] for s in open_sources)
        given_out, left = left, 0.0
        for s in list(open_sources):
            target[s] += given_out * weights[s] / total
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_sources.discard(s)
    return target


def test_mixing_targets_and_copies(docs):
    rows = mixing.with_copies(docs).collect()
    again = mixing.with_copies(docs.repartition(5)).collect()
    assert sorted((r["row"]["doc_id"] or -1, r["copies"]) for r in rows) == sorted((r["row"]["doc_id"] or -1, r["copies"]) for r in again)
    sizes = defaultdict(int)
    for r in rows:
        assert r["size"] == len((r["row"]["text"] or "").split()) and r["copies"] <= 2
        sizes[r["row"]["source"]] += r["size"]
    ranked = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(ranked)}
    wanted = poured(sizes, weights, 1.5 * sum(sizes.values()))
    for r in rows:
        assert math.isclose(r["target"], wanted[r["row"]["source"]], rel_tol=1e-9)
        rate = r["target"] / r["source_size"]
        assert r["copies"] in (math.floor(rate), math.floor(rate) + 1)
    assert mixing.mixed_documents(docs).count() == sum(r["copies"] for r in rows)


# 4 -----------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("bucket_bytes", [500, 20_000, 1 << 25])
def test_shards_are_even_and_gapless(docs, bucket_bytes):
    rows = sharding.dealt(docs, shards=3, bucket_bytes=bucket_bytes).collect()
    again = sharding.dealt(docs, shards=3, bucket_bytes=bucket_bytes).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    counts = [len(by_shard[s]) for s in range(3)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == docs.count()
    assert sorted(str(r["text"]) for r in rows) == sorted(str(r["text"]) for r in docs.collect())


def test_written_shards_come_back(spark, docs, tmp_path):
    placed = sharding.dealt(docs, shards=3)
    sharding.write_shards(placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["shard"], r["slot"]) for r in back.collect()) == sorted((r["shard"], r["slot"]) for r in placed.collect())


# 3 -----------------------------------------------------------------------------------------------------------------

def test_url_verdicts(spark):
    cases = [
        ("http://x.example.net/en/1", "example.net/en/", "allow"), ("http://example.net/de/1", "net/", "block"), ("http://badnet/x", None, "allow"),
        ("http://a.org/fr/porn", "org/fr/", "allow"), ("http://a.org/porn", None, "block"), ("http://a.org/spornx", None, "allow"),
        ("http://a.org/casino-poker", None, "block"), ("http://a.org/casino-casino", None, "allow"), ("a.org/xxx", None, "block"),
        ("http://NET?x", None, "allow"), (None, None, "allow"), ("", None, "allow"),
    ]
    frame = spark.createDataFrame([(i, u, "clash") for i, (u, _, _) in enumerate(cases)], "page_id long, url string, host string")
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judged(frame).collect()}
    assert found == {i: (rule, verdict) for i, (_, rule, verdict) in enumerate(cases)}


# 2 -----------------------------------------------------------------------------------------------------------------

def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_decontamination_equals_brute_force(spark, docs, monkeypatch):
    words = plain(made(3)[7][1])
    items = [(1, " ".join(words[20:40]).upper()), (2, "; ".join(words[100:110])), (3, " ".join(words[200:203])), (4, None), (5, " - "), (6, "nowhere to be found"), (1, " ".join(words[60:72]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wanted = {}
    for i, row in enumerate(made(3)):
        own, hit, names = plain(row[1]), set(), set()
        for item, text in items:
            gram = plain(text)
            size = min(10, len(gram))
            for j in range(len(gram) - size + 1 if size else 0):
                for k in range(len(own) - size + 1):
                    if own[k:k + size] == gram[j:j + size]:
                        hit.update(range(k, k + size))
                        names.add(str(item))
        wanted[i] = (len(own), len(hit), sorted(names))
    numbered = spark.createDataFrame([(i, r[1]) for i, r in enumerate(made(3))], "doc_id long, text string")
    for limit in (decontaminate.BROADCAST_BYTES, 100):
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
        found = {r["key"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.found(numbered, bench).collect()}
        assert found == wanted
        assert decontaminate.clean_documents(numbered, bench).count() == sum(not w[1] for w in wanted.values())


def test_items_without_an_id_are_listed_last():
    passage = " ".join(f"w{i}" for i in range(10))
    grams = decontaminate.Grams([(None, passage), ("b", passage), ("a", passage), (None, passage)], 10)
    assert decontaminate.scan_texts(pa.array([passage, None]), grams)[2].to_pylist() == [["a", "b", None], []]


# 6 -----------------------------------------------------------------------------------------------------------------

def slow_print(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs, nodes):
    top = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(top[a], top[b])
            changed |= top[a] != low or top[b] != low
            top[a] = top[b] = low
    return top


def test_simhash_components_equal_brute_force(docs):
    found = simhash.components(docs).collect()
    prints = [(r[0], slow_print(r[1], 4)) for r in made(3)]
    assert sorted((r["key"] or -1, r["fingerprint"] & (2**64 - 1)) for r in found) == sorted((k or -1, p) for k, p in prints)
    values = sorted({p for _, p in prints})
    top = classes([(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4], values)
    least = {}
    for k, p in prints:
        if k is not None:
            least[top[p]] = min(least.get(top[p], k), k)
    assert {(r["fingerprint"] & (2**64 - 1), r["component"]) for r in found} == {(p, least.get(top[p])) for _, p in prints}


@pytest.mark.parametrize("threshold,blocks", [(4, 2), (6, 3), (4, 3), (3, 1 + 1)])
def test_covering_meets_every_pair(spark, threshold, blocks):
    rng = random.Random(threshold * 10 + blocks)
    values = [rng.getrandbits(64) for _ in range(30)]
    for v in list(values):
        for many in (1, threshold - 1, threshold, threshold, threshold + 1):
            values.append(v ^ sum(1 << b for b in rng.sample(range(64), many)))
    values = sorted(set(values))
    signed = [v - (v >> 63 << 64) for v in values]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fingerprint long"), threshold, blocks).collect()
    pairs = {(r["u"], r["v"]) for r in edges}
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= threshold for a, b in pairs)
    wanted = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= threshold]
    assert classes(pairs, signed) == classes(wanted, signed)


def test_the_first_document_of_each_component_stays(spark):
    """Whatever the documents' own columns are named, with copies, nulls and no rows."""
    schema = "place long, doc string, n_row int, text string, key long"
    texts = [None, "", "one two", "ONE  two", *(" ".join(f"w{(i * 7 + j) % 50}" for j in range(80)) for i in range(5)), "one two"]
    frame = spark.createDataFrame([(i, f"d{i}", -i, t, 1) for i, t in enumerate(texts)], schema).coalesce(1)
    found = simhash.first_of_each(frame)
    assert found.columns == frame.columns
    assert sorted(r.place for r in found.collect()) == [0, 2, 4, 5, 6, 7, 8]
    assert simhash.first_of_each(frame.limit(0)).count() == 0


def test_closest_pairs_form_the_forest():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**63, 60, np.uint64)
    values[30:] = values[:30] ^ np.uint64(5)
    pairs = np.array([(a, b) for a in values for b in values if a < b], np.uint64)
    kept = [tuple(p) for p in simhash._forest(pairs).tolist()]
    assert len(kept) == 59
    for bits in (2, 20, 25, 30, 64):
        near = lambda ps: [(a, b) for a, b in ps if (a ^ b).bit_count() <= bits]
        assert classes(near(kept), values.tolist()) == classes(near(pairs.tolist()), values.tolist())


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 199), (199, 200)] + [(rng.randint(300, 330), rng.randint(300, 330)) for _ in range(25)]
    found = {r["node"]: r["root"] for r in components.least_nodes(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert found == {n: r for n, r in classes([e for e in edges if e[0] != e[1]], nodes).items() if n != r}


# 7 -----------------------------------------------------------------------------------------------------------------

def test_license_phrases_and_templates(spark):
    rows = [
        (1, "Released under the MIT License."), (2, "CC BY-NC 4.0. cc, by; cc"), (3, None), (4, ""), (5, "the mit of license"),
        (6, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
        (7, "This work is licensed under the GNU General Public License, version 3."), (8, "x " * 5000 + "apache license " * 3), (1, "Released under the MIT License."),
    ]
    found = [r.asDict() for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    for r in found:
        text = next(t for k, t in rows if k == r["key"])
        words = plain(text)
        places = [(i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert r["first_word"] == min((i for i, _ in places), default=None) and r["last_word"] == max((i for i, _ in places), default=None)
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert 0 <= r["score"] <= 1
    labels = {r["key"]: r["labels"] for r in found}
    assert labels[2] == "cc-by,cc-by-nc" and labels[6] == "mit-text" and labels[7] == "gpl,gpl-3.0" and labels[5] == "" and len(found) == len(rows)


def test_every_licence_of_a_long_document_is_found(spark):
    wording = {label: w for label, w, _ in licenses.TEMPLATES}
    prose = " some plain prose " * 300
    both = prose.join(["", wording["bsd"], wording["mit-text"], wording["apache-2.0"], ""])
    rows = [(0, both)] + [(i, wording["apache-2.0"]) for i in range(1, 10)]
    found = licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string")).where("key = 0").first()
    assert found["labels"] == "apache,apache-2.0,bsd,mit-text"


def test_license_query_on_several_licences_equals_its_sql(spark, tmp_path, monkeypatch):
    """Every licence word counts in both, however many a document holds."""
    rng, wordings = random.Random(8), [w for _, w, _ in licenses.TEMPLATES]
    prose = lambda: " ".join(rng.choice(licenses.vocabulary() + ["plain", "prose", "the"]) for _ in range(40))
    rows = [(i, " ".join(rng.choice((prose(), rng.choice(wordings))) for _ in range(6))) for i in range(60)] + [(None, wordings[0]), (7, None), (8, "")]
    pq.write_table(spark.createDataFrame(rows, "doc_id long, text string").toArrow(), tmp_path / "documents.parquet")
    monkeypatch.setattr("tests.oracle.TABLES", ["documents"])
    ours, theirs = compare(spark, str(tmp_path), QUERIES["op7_license_scan"], ORACLES["op7_license_scan"])
    assert ours == theirs


# 8 and 9 -----------------------------------------------------------------------------------------------------------

def slow_bytes(texts, width):
    places = defaultdict(list)
    data = [(t or "").encode() for t in texts]
    for i, d in enumerate(data):
        for j in range(len(d) - width + 1):
            places[d[j:j + width]].append((i, j))
    gone = [bytearray(len(d)) for d in data]
    for found in places.values():
        if len(found) > 1:
            for i, j in found:
                gone[i][j:j + width] = b"\1" * width
    return [(len(d), sum(g), len(re.findall(b"\1+", bytes(g))), hashlib.sha256(bytes(x for x, y in zip(d, g) if not y)).hexdigest()) for d, g in zip(data, gone)]


@pytest.mark.parametrize("options", [{}, {"width": 40, "anchor": 9}, {"width": 40, "anchor": 9, "family": 1}, {"width": 40, "anchor": 9, "group_bytes": 10}])
def test_repeated_bytes_equal_brute_force(docs, options):
    wanted = slow_bytes([r[1] for r in made(3)], options.get("width", 200))
    found = suffix_dedup.without_repeats(docs, **options).collect()
    assert Counter((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found) == Counter(wanted)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab\0é", min_size=1, max_size=30), min_size=2, max_size=8, unique=True), st.integers(1, 12))
def test_merged_transforms_find_what_starts_twice(texts, depth):
    strings = [t.encode() for t in texts]
    joined = b"\xff".join(strings) + b"\xff"
    starts = [i for s, off in zip(strings, np.cumsum([0] + [len(x) + 1 for x in strings])) for i in range(off, off + len(s) - depth + 1)]
    counts = Counter(joined[i:i + depth] for i in starts)
    assert bwt.repeated_places(strings, depth).tolist() == [i for i in starts if counts[joined[i:i + depth]] > 1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abé", max_size=20), min_size=2, max_size=8), st.integers(1, 12))
def test_a_merge_gives_the_common_order_and_prefixes(texts, depth):
    strings = [t.encode() for t in texts]
    half = (len(strings) + 1) // 2
    suffixes = [(s[i:], i == len(s), n) for n, s in enumerate(strings) for i in range(len(s) + 1)]
    # By their first bytes, an end before all others and ends in the order of the strings; then the first shard's ahead.
    suffixes.sort(key=lambda x: ([b + len(strings) for b in x[0][:depth]] + ([x[2]] if len(x[0]) < depth else []), x[2] >= half))
    common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b), depth))
    of_second, prefix = bwt.merged(bwt.transform(strings[:half]), bwt.transform(strings[half:]), depth)
    assert of_second.tolist() == [n >= half for _, _, n in suffixes]
    assert prefix.tolist() == [0] + [min(depth, common(a[0], b[0])) for a, b in zip(suffixes, suffixes[1:])]


@pytest.mark.parametrize("options", [{}, {"family": 1}, {"width": 5, "anchor": 2}])
def test_repeated_words_equal_brute_force(docs, options):
    width, rows = options.get("width", 13), made(3)
    words = [(r[1] or "").split() for r in rows]
    least = {}
    for r, own in zip(rows, words):
        for i in range(len(own) - width + 1):
            key = tuple(own[i:i + width])
            least[key] = min(least.get(key, math.inf), math.inf if r[0] is None else r[0])
    wanted = []
    for r, own in zip(rows, words):
        gone = {i + k for i in range(len(own) - width + 1) if least[tuple(own[i:i + width])] < (math.inf if r[0] is None else r[0]) for k in range(width)}
        wanted.append((r[0], len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    found = substring_dedup.without_repeats(docs, **options).collect()
    assert Counter((r["key"], r["n_words"], r["n_removed"], r["kept"]) for r in found) == Counter(wanted)


@pytest.mark.parametrize("operator", [lambda d: suffix_dedup.without_repeats(d, width=40, anchor=9, stored=True), lambda d: substring_dedup.without_repeats(d, stored=True)])
def test_a_stored_table_may_be_split_anew_between_steps(spark, docs, tmp_path, operator):
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    table = spark.read.parquet(str(tmp_path / "docs"))
    wanted = sorted(map(str, operator(table).collect()))
    found = operator(table)
    with session_settings(spark, spark__sql__files__maxPartitionBytes=500, spark__sql__files__openCostInBytes=1):
        assert table.rdd.getNumPartitions() > 10
        assert sorted(map(str, found.collect())) == wanted


def test_rows_of_a_stored_table_have_one_number_each(spark, docs, tmp_path):
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    table = spark.read.parquet(str(tmp_path / "docs")).withColumns({"path": F.lit(1), "file": F.lit(2), "place": F.lit(3), "_metadata": F.lit(4)})
    numbers = lambda: sorted((r.row, r.text or "") for r in fragments.numbered(table, "text", "doc_id", stored=True).collect())
    first = numbers()
    with session_settings(spark, spark__sql__files__maxPartitionBytes=500, spark__sql__files__openCostInBytes=1):
        assert numbers() == first
    assert len({row for row, _ in first}) == len(first) == docs.count()
    assert {row >> 36 for row, _ in first} == {0, 1, 2}


def test_fragments_cover_every_window_once():
    rng = np.random.default_rng(1)
    symbols, bounds = rng.integers(0, 3, 500).astype(np.uint64), np.array([0, 100, 100, 107, 500])
    *_, text, starts, lengths = fragments.fragments_of(symbols, bounds, 20, 5)
    covered = sorted((int(t), int(s) + k) for t, s, n in zip(text, starts, lengths) for k in range(n - 19))
    assert covered == [(0, i) for i in range(81)] + [(3, i) for i in range(374)]


@pytest.mark.parametrize("part", [1, 30, 64])
def test_long_texts_are_cut_to_parts_that_lose_no_window(monkeypatch, part):
    rng = np.random.default_rng(2)
    symbols, bounds = rng.integers(0, 3, 500).astype(np.uint64), np.array([0, 100, 100, 107, 500])
    whole = fragments.fragments_of(symbols, bounds, 20, 5)[0].tolist()
    monkeypatch.setattr(fragments, "PART", part)
    anchors, _, text, starts, lengths = fragments.fragments_of(symbols, bounds, 20, 5)
    covered = sorted((int(t), int(s) + k) for t, s, n in zip(text, starts, lengths) for k in range(n - 19))
    assert covered == [(0, i) for i in range(81)] + [(3, i) for i in range(374)]
    assert set(whole) == set(anchors.tolist())


def test_memory_of_fragments_does_not_grow_with_the_text():
    """Some fifteen arrays of 8 bytes a symbol are held for a part of the text, never for all of it."""
    symbols = np.random.default_rng(3).integers(0, 64, 4_000_000).astype(np.uint8)
    tracemalloc.start()
    try:
        fragments.fragments_of(symbols, np.array([0, len(symbols)]), 200, 40)
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak < 250_000_000


# 1 -----------------------------------------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_spans(text):
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15}[kind]:
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], list(BASE).index(s[0])))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a.@-+ 0159(é\n", max_size=40))
def test_patterns_equal_plain_ones(text):
    assert pii.pattern_spans(text) == slow_spans(text)


def test_patterns_on_listed_cases():
    text = "é a@b.c@d.e 4111 1111 1111 1111 1.2.3.4.5.6.7.256 +1 (974) 555-3436 000255.1.1.1 4111111111111112"
    assert pii.pattern_spans(text) == slow_spans(text) and {s[0] for s in pii.pattern_spans(text)} >= {"email", "ip"}


def test_field_on_held_out_lines_and_clean_text():
    field = pii.default_field()
    hashes, bounds, labels = pii._lines_of(pii.labelled_table(seed=99))
    found = field.decode(field.emissions(hashes), bounds)
    assert (found == labels).mean() > 0.97 and (found[labels > 0] == labels[labels > 0]).mean() > 0.9
    texts = pa.array(["Thnt er on. In the and of.", None, "", "call 555-123-4567 now\nssn 123-45-6789", "é Call (030) 555-1234."])
    spans = pii.field_spans(texts, field)
    assert spans[:3] == [[], [], []] and {s[0] for s in spans[3]} == {"phone", "id"} and spans[4][0][1:] == (7, 21)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(2)
    kinds = len(pii.LABELS)
    field = pii.Field([], [], rng.normal(size=(kinds, kinds)).astype(np.float32))
    bounds = np.array([0, 3, 3, 4])
    scores = rng.normal(size=(4, kinds)).astype(np.float32)
    best = field.decode(scores, bounds)
    paths = np.stack(np.meshgrid(*[range(kinds)] * 3, indexing="ij"), -1).reshape(-1, 3)
    value = field.moves[0, paths[:, 0]] + scores[range(3), paths].sum(1) + field.moves[paths[:, 0], paths[:, 1]] + field.moves[paths[:, 1], paths[:, 2]] + field.moves[paths[:, 2], 0]
    assert best[:3].tolist() == paths[value.argmax()].tolist()


# Words -------------------------------------------------------------------------------------------------------------

@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t.0", max_size=12)), max_size=8))
def test_word_bounds_equal_patterns(texts):
    texts = [t and t.lower() for t in texts]
    data, offsets = tokens.flat(pa.array(texts, pa.string()))
    for table, pattern in ((tokens.NOT_BLANK, rb"[^\x20\x09-\x0D]+"), (tokens.ALPHANUMERIC, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        starts, ends, first = tokens.word_bounds(data, offsets, table)
        words = [[data[a:b].tobytes() for a, b in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]])] for i in range(len(texts))]
        assert words == [re.findall(pattern, (t or "").encode()) for t in texts]


# Pipeline ----------------------------------------------------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    kept = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    assert kept.columns == names
    unique = corpus_pipeline.STAGES[1][1](spark, corpus_pipeline.staged(kept, "t"), sf_dir)
    prints = {r["doc_id"]: simhash.fingerprint((r["text"] or "").encode()) & (2**64 - 1) for r in kept.collect()}
    values = sorted(set(prints.values()))
    top = classes([(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4], values)
    left = [r["doc_id"] for r in unique.collect()]
    assert sorted(top[prints[d]] for d in left) == sorted(set(top.values())) and len(left) < len(prints)
    clean = corpus_pipeline.STAGES[2][1](spark, corpus_pipeline.staged(unique, "t"), sf_dir)
    bench = {tuple(w[i:i + min(10, len(w))]) for w in (plain(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()) for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(g) for g in bench}
    dirty = {r["doc_id"] for r in unique.collect() for w in [plain(r["text"])] if any(tuple(w[i:i + n]) in bench for n in sizes for i in range(len(w) - n + 1))}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in unique.collect()} - dirty
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.columns == [*names, "shard", "slot"]
    mixed = corpus_pipeline.STAGES[3][1](spark, corpus_pipeline.staged(clean, "t"), sf_dir)
    assert sorted(r["doc_id"] for r in result.collect()) == sorted(r["doc_id"] for r in mixed.collect())


def test_pipeline_takes_an_empty_table(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0
