"""Exact duplicates by a persistent index of text digests, bucketed and sorted by digest.

The index is a table of (digest, keep_id) in a folder of its own, one row per text ever seen. New data is reduced to one
row per digest before it moves, dealt once into the buckets of the index, sort-merged against it (left anti) and what is
new appended; the index itself is never shuffled. Because a batch is dealt by the very hash that buckets the index, each
append adds one sorted file per bucket; ``compacted`` writes an index that has seen many batches anew.

Defined results: a null text counts as empty, so null and empty texts are equal. Of equal texts the row with the largest
key stays, a null key being the smallest; among rows that repeat key and text one stays. Across batches the text that came
first stays, so feed larger keys first where the largest has to stay. A batch that is fed again gets the verdicts it got
before. Texts of any length count whole, as their SHA-256. An empty table gives an empty result and adds nothing. Other
columns, whatever their names, play no part; ``without_copies`` hands them through.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.staging import staged

#: A text with at least one row in so many is joined by broadcast; there are at most so many such texts.
HOT = 1024


@dataclass(frozen=True)
class DigestIndex:
    """The index below ``folder``. ``buckets`` is fixed for its life: hand in the number it was made with."""

    spark: SparkSession
    folder: str
    buckets: int
    name: str

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, fresh: DataFrame) -> None:
        fresh.select("digest", "keep_id").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def opened(spark: SparkSession, folder: str, buckets: int) -> DigestIndex:
    """The index kept in a folder, made if there is none yet; any later session may open it again."""
    index = DigestIndex(spark, folder, buckets, f"digests_{uuid.uuid4().hex}")
    spark.sql(
        f"CREATE TABLE {index.name} (digest BINARY, keep_id BIGINT) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    return index


def compacted(index: DigestIndex, folder: str) -> DigestIndex:
    """The same index in another folder with one file per bucket, whatever the number of batches."""
    copy = opened(index.spark, folder, index.buckets)
    copy.add(index.rows().repartition(index.buckets, "digest"))
    return copy


def digest(text: Column, normalise: Callable[[Column], Column] = lambda text: text) -> Column:
    return F.unhex(F.sha2(normalise(F.coalesce(text, F.lit(""))), 256))


def digested(docs: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = False,
             normalise: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """``row, key, digest`` of every document, written once: later steps read neither texts nor the source again.

    With ``whole`` the document itself goes along as the struct ``doc``.
    """
    doc = [F.struct(*(docs[f"`{name}`"] for name in docs.columns)).alias("doc")] if whole else []
    return staged(docs.select(
        F.monotonically_increasing_id().alias("row"), docs[key].cast("long").alias("key"),
        digest(docs[text], normalise).alias("digest"), *doc), "digests")


def _per_digest(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per digest, dealt as the index is; copies are added up before they move."""
    one = rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("key", "row")).alias("top"))
    return one.repartition(buckets, "digest")


def ingest(index: DigestIndex, rows: DataFrame) -> None:
    """Enter a batch of ``digested`` rows: texts that the index lacks are appended with their largest key."""
    # Written first: the optimizer moves an anti-join below an aggregation, which would send all copies of a text to it.
    one = staged(_per_digest(rows, index.buckets).select("digest", F.col("top.key").alias("keep_id")), "batch")
    index.add(one.join(index.rows().hint("merge"), "digest", "left_anti"))


def verdicts(index: DigestIndex, rows: DataFrame) -> DataFrame:
    """``row, key, digest, keep_id, group_size, kept`` for rows that have been entered.

    ``group_size`` counts equal texts among ``rows``. A text that makes up one row in HOT or more (there are at most
    HOT of them) is looked up by broadcast, all others by sort-merge, so no task gathers the copies of a frequent text.
    """
    entries = _per_digest(rows, index.buckets).join(index.rows().hint("merge"), "digest")
    entries = staged(entries.select(
        "digest", "keep_id", F.col("n").alias("group_size"), F.col("top.row").alias("top_row")), "entries")
    hot = F.col("group_size") * HOT >= rows.count()
    frequent, others = F.broadcast(entries.where(hot)), entries.where(~hot).hint("merge")
    looked_up = rows.join(frequent, "digest").unionByName(
        rows.join(frequent.select("digest"), "digest", "left_anti").join(others, "digest"))
    kept = F.col("key").eqNullSafe(F.col("keep_id")) & (F.col("row") == F.col("top_row"))
    return looked_up.withColumn("kept", kept).drop("top_row")


def descending_halves(rows: DataFrame) -> list[DataFrame]:
    """Rows with larger keys, then all others: a table as two batches in an order that keeps the largest key."""
    ends = rows.agg(F.min("key").alias("low"), F.max("key").alias("high")).first()
    if ends["low"] is None:
        return [rows]
    upper = F.col("key") > (ends["low"] + ends["high"]) // 2
    return [rows.where(upper), rows.where(~upper | F.col("key").isNull())]


def without_copies(docs: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text",
                   normalise: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """Enter a batch and return its documents that stay, with the columns they came with."""
    whole = digested(docs, key, text, True, normalise)
    rows = whole.drop("doc")
    ingest(index, rows)
    stay = verdicts(index, rows).where("kept").select("row")
    return whole.join(stay.hint("merge"), "row", "left_semi").select("doc.*")
