"""The named query of each operator over the standard tables, each with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import conversation_trie, decontaminate, exact_dedup, hard_negatives, licenses, mixing, oracles, pii, quality_rules, sharding, simhash, substring_dedup, suffix_dedup, url_filter
from tidemark.llm.staging import staged
from tidemark.session import removed_at_end, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@registered("op2_decontamination", oracles.DECONTAMINATION)
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = decontaminate.found(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("key").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@registered("op3_url_filter", oracles.URL_FILTER)
def urls(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict on every page's url."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judged(pages).select("page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft")


@registered("op4_sharding")
def shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents dealt to eight shards of equal counts."""
    docs = table(spark, folder, "documents")
    text = F.coalesce("text", F.lit(""))
    sized = docs.select("doc_id", "text", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.dealt(sized, columns=["doc_id", "size", "text_crc32"], shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))


@registered("op5_mixing", oracles.MIXING)
def mix(spark: SparkSession, folder: str) -> DataFrame:
    """How often each document is taken to give its source its target share."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.with_copies(docs).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@registered("op10_quality_rules", oracles.QUALITY_RULES)
def quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality measures and the verdict on every document."""
    judged = quality_rules.judged(table(spark, folder, "documents").select("doc_id", "text"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & F.col("passes")).alias("kept"), "n_stop_words", "n_alpha_words", "n_bullet_lines", "n_ellipsis_lines")


@registered("op6_simhash")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.components(table(spark, folder, "documents").select("doc_id", "text"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select(F.col("key").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


@registered("op9_substring_dedup", oracles.REPEATED_WORDS)
def repeated_words(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document that a document with a smaller id has in a window of 13."""
    found = substring_dedup.without_repeats(table(spark, folder, "documents").select("doc_id", "text"), stored=True)
    return found.select(F.col("key").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@registered("op8_suffix_dedup", oracles.REPEATED_BYTES)
def repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of each document that strings of 200 bytes cover which start elsewhere too."""
    found = suffix_dedup.without_repeats(table(spark, folder, "documents").select("doc_id", "text"), stored=True)
    return found.select(F.col("key").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@registered("op7_license_scan", oracles.LICENSES)
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and labels of every document."""
    found = licenses.scanned(table(spark, folder, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("key", "doc_id")


@registered("op1_pii")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.found(table(spark, folder, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    return found.select(
        F.col("key").alias("doc_id"), *map(count, ("email", "ip", "card", "phone")),
        F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


@registered("op11_exact_dedup", oracles.EXACT_COPIES)
def exact_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Equal texts, entered into a digest index in two batches, larger ids first."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = exact_dedup.opened(spark, shared_folder(spark, "digest-index"), buckets)
    rows = exact_dedup.digested(table(spark, folder, "documents").select("doc_id", "text"))
    for batch in exact_dedup.descending_halves(rows):
        exact_dedup.ingest(index, batch)
    removed_at_end(spark, index.folder)
    return exact_dedup.verdicts(index, rows).select(
        F.col("key").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@registered("op12_hard_negatives", oracles.HARD_NEGATIVES)
def hard(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of other labels that score almost as high with an anchor as its positives do."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(vectors, label=moved)


@registered("op13_conversation_trie", oracles.CONVERSATIONS)
def conversation_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the prefix tree of conversations that borrow their first turns from another one."""
    paths = staged(conversation_trie.turns_of(table(spark, folder, "conversations")), "turns")
    conv = F.col("conv_id")
    heads = conversation_trie.with_borrowed_heads(paths, conv - conv % 100, F.crc32(conv.cast("string")) % 6, 5)
    return conversation_trie.nodes_of(staged(heads, "paths"))
