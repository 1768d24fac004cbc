"""Sharding by a two-pass external shuffle: scatter rows into memory-sized buckets, shuffle each bucket, deal it out.

The first pass writes every row with the bucket that a seeded hash gives it. The second permutes each bucket by
Spark's ``shuffle`` function, a seeded Fisher-Yates shuffle, over row numbers only: rows stay in a spilling sort, and
a bucket costs memory for one number per row. Positions run on through all buckets and are dealt to shards in turn,
so shard counts differ by at most one and slots have no gaps. The order depends on the seed, on the data and, since rows
equal in all columns are told apart by their place, on how the table is split into tasks: the same stored table read by
the same cluster gives the same order, a table dealt anew may not. Null keys and texts are hashed like any value. Texts of
any length go through whole; one larger than a bucket makes that bucket larger. An empty table gives no rows. Columns may
have any names; one named ``shard`` or ``slot`` is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.staging import staged

SEED = 20_240_229
BUCKET_BYTES = 32 * 1024 * 1024
#: Bucket counts are summed in blocks, so that the last sum is over one row per block.
BLOCK = 1024


def scattered(docs: DataFrame, text: str, payload: DataFrame, bucket_bytes: int, seed: int) -> tuple[DataFrame, int]:
    """First pass: ``payload`` rows with ``s_bucket`` and ``s_order``, written; and the number of buckets."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("long") + 1)).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    return staged(payload.withColumn("s_bucket", F.pmod("s_order", F.lit(buckets))), "sharding-scatter"), buckets


def bucket_table(rows: DataFrame, buckets: int, seed: int) -> DataFrame:
    """One row per bucket: the position its rows begin at, and a Fisher-Yates permutation of its row numbers."""
    counts = rows.groupBy("s_bucket").agg(F.count("*").alias("n")).withColumn("block", F.floor(F.col("s_bucket") / BLOCK))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("block_n"))
    blocks = blocks.select("block", (F.sum("block_n").over(Window.orderBy("block")) - F.col("block_n")).alias("block_start"))
    inside = F.sum("n").over(Window.partitionBy("block").orderBy("s_bucket")) - F.col("n")
    placed = counts.withColumn("inside", inside).join(blocks, "block")
    placed = placed.select(F.col("s_bucket").alias("b_bucket"), "n", (F.col("inside") + F.col("block_start")).alias("start"))
    # Spark's shuffle draws on from row to row of a partition, so partitions and their order are fixed here.
    laid = placed.repartition(min(buckets, 2000), "b_bucket").sortWithinPartitions("b_bucket")
    order = F.shuffle(F.sequence(F.lit(0), F.col("n").cast("int") - 1), F.lit(seed))
    return laid.select("b_bucket", "start", order.alias("order"))


def dealt(docs: DataFrame, text: str = "text", shards: int = 8, columns: list[str] | None = None,
          bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """The documents (``columns`` of them, all by default) with ``shard`` and ``slot``."""
    names = [c for c in (columns or docs.columns) if c not in ("shard", "slot")]
    hashed = [docs[c] for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    order = F.xxhash64(F.lit(seed), *hashed, F.monotonically_increasing_id())
    payload = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), order.alias("s_order"))
    rows, buckets = scattered(docs, text, payload, bucket_bytes, seed)
    number = F.row_number().over(Window.partitionBy("s_bucket").orderBy("s_order"))
    numbered = rows.withColumn("s_number", number)
    placed = numbered.join(bucket_table(rows, buckets, seed), F.col("s_bucket") == F.col("b_bucket"))
    position = F.col("start") + F.element_at("order", F.col("s_number"))
    placed = placed.select("row", position.alias("position"))
    return placed.select(
        "row.*", (F.col("position") % shards).cast("int").alias("shard"), F.floor(F.col("position") / shards).alias("slot"))


def write_shards(placed: DataFrame, folder: str) -> None:
    """Write each shard as files in slot order below ``folder/shard=N``; a shard may span several tasks."""
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
